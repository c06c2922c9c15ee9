"""Where the driver's tables are, by scale."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
