"""What a stream observed while it ran (survey ID AGG10).

``Dataset.observe`` counts rows inside the streaming plan, without a pass of
its own; a ``StreamingQueryListener`` receives the counts of each micro-batch.
"""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

# --- fixed values -----------------------------------------------------------
METRICS_SCHEMA = "batch STRING, number BIGINT, metric STRING, name STRING, value BIGINT"
WAIT_S = 30            # for the last event of a query that has ended
# ---------------------------------------------------------------------------


class RunMetrics(StreamingQueryListener):
    """Collects the observed metrics of the queries that run while it is attached: a few numbers per micro-batch."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.found: dict[tuple[str, int], dict] = {}
        self.ended: dict[str, threading.Event] = {}

    def __enter__(self) -> RunMetrics:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.observedMetrics:
            self.found[str(p.runId), p.batchId] = {k: r.asDict() for k, r in p.observedMetrics.items()}

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def of(self, query) -> dict[int, dict]:
        """{batch number: {metric: values}} of a query that has ended (events arrive after it)."""
        run = str(query.runId)
        self.ended.setdefault(run, threading.Event()).wait(WAIT_S)
        return {number: found for (of, number), found in sorted(self.found.items()) if of == run}

    def write(self, query, path: str, stream: str) -> None:
        """Add a row per micro-batch, metric and value to a table, replacing those of the same micro-batches."""
        rows = [(f"{stream}-{number}", number, metric, name, value)
                for number, found in self.of(query).items() for metric, values in found.items() for name, value in values.items()]
        if rows:
            (self.spark.createDataFrame(rows, METRICS_SCHEMA).coalesce(1).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path))


def read_metrics(spark: SparkSession, path: str):
    """(number, n_pages, n_empty, ...) per micro-batch."""
    rows = spark.read.schema(METRICS_SCHEMA).parquet(path)
    return rows.groupBy("batch", "number").pivot("name", ["n_pages", "n_empty"]).agg(F.max("value"))
