"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize


def connected(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable over the links (a, b).

    Every round each node takes the smallest label among itself and its
    neighbours and then that label's own label, so stars settle in two rounds
    and chains in a number of rounds that grows with the logarithm of their
    length.  The aggregates combine before the shuffle, so a node with many
    links is no bottleneck; every round is a table in the shared folder.
    """
    both = materialize(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                         .select("node", F.least("node", "m").alias("comp")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node"))
                .agg(F.min("comp").alias("near")))
        # a node also hands its new label to its old label's node
        stepped = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("next"))
        offered = (stepped.select("node", "next").union(stepped.select(F.col("comp").alias("node"), "next"))
                   .groupBy("node").agg(F.min("next").alias("next")))
        up = labels.select(F.col("node").alias("next"), F.col("comp").alias("jump"))
        new = materialize(
            labels.join(offered, "node").join(up, "next", "left")
            .select("node", F.least("next", F.coalesce("jump", "next")).alias("comp"),
                    (F.col("comp") != F.least("next", F.coalesce("jump", "next"))).alias("moved")), "labels")
        labels = new.select("node", "comp")
        if not new.where("moved").limit(1).count():
            return labels
