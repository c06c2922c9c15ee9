"""Row numbers of a global order, without a single-task window (survey IDs SORT1-SORT4).

``orderBy`` range-partitions the rows; inside a part they are numbered as they
come.  The sorted parts are written once, so that a part means the same rows
whatever is recomputed later, and a row per part (how many rows it has) is
enough to know where each part begins.  Rows that the order ties are numbered
by their other columns; only identical rows may change places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize

# --- fixed values -----------------------------------------------------------
# monotonically_increasing_id holds the part above this bit, the row below it.
PART_BIT = 33
# ---------------------------------------------------------------------------


def _tie_break(df: DataFrame) -> list[Column]:
    """The sortable columns, as they are; maps and the like can't be ordered."""
    kinds = ("map", "variant")
    return [F.asc_nulls_last(f.name) for f in df.schema.fields if not f.dataType.simpleString().startswith(kinds)]


def part_starts(parts: DataFrame) -> DataFrame:
    """(part, start): how many rows the parts before have.  ``parts`` has a (part, n) row for each part.

    The list is as long as the sort has parts, whatever the rows, and is
    summed up in one row by array functions.
    """
    listed = parts.agg(F.array_sort(F.collect_list(F.struct("part", "n"))).alias("ps"))
    summed = F.aggregate(
        "ps", F.struct(F.lit(0).cast("long").alias("sum"), F.expr("cast(array() as array<struct<part: bigint, start: bigint>>)").alias("out")),
        lambda acc, p: F.struct((acc["sum"] + p["n"]).alias("sum"),
                                F.concat(acc["out"], F.array(F.struct(p["part"].alias("part"), acc["sum"].alias("start")))).alias("out")),
        lambda acc: acc["out"])
    return listed.select(F.inline(summed))


def numbered(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """``df`` with its row number (from 1) in this order, as column ``name``."""
    if name in df.columns:
        raise ValueError(f"the rows already have a column {name!r}")
    number = F.monotonically_increasing_id()
    rows = materialize(df.orderBy(*order, *_tie_break(df)).withColumn("__at", number), "sorted")
    part = F.shiftright("__at", PART_BIT)
    starts = part_starts(rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")))
    within = F.col("__at").bitwiseAND(F.lit((1 << PART_BIT) - 1))
    return (rows.withColumn("__part", part).join(starts.withColumnRenamed("part", "__part"), "__part")
            .withColumn(name, F.col("start") + within + 1).select(*df.columns, name))
