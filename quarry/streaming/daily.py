"""Daily counts as a stream (survey IDs STM3, STM4, AGG6).

Each micro-batch reduces the events that landed since the last one to a row
per day and writes it under its batch number, replacing what an interrupted
attempt left there; the result is the sum over the batches.  Every event
counts whenever it arrives: no watermark closes a day or drops late rows, and
no state is kept but one small row per day and batch.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import checkpoint_dir

def day_counts(events: DataFrame, ts: str = "ts") -> DataFrame:
    """``(day, n_events)`` of these events.

    A ``TIMESTAMP_NTZ`` column gives wall-clock days whatever the session time
    zone; a ``TIMESTAMP`` gives days of the session's zone.
    """
    return (events.where(F.col(ts).isNotNull()).groupBy(F.col(ts).cast("date").alias("day"))
            .agg(F.count(F.lit(1)).alias("n_events")))


def run_daily_counts(spark: SparkSession, source_dir: str, sink_path: str, checkpoint: str,
                     available_now: bool = True, glob: str = "*.parquet", ts: str = "ts"):
    """Start the stream over a Parquet landing folder; returns the query handle."""
    schema = spark.read.option("pathGlobFilter", glob).parquet(source_dir).schema
    src = spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(source_dir)

    def write(batch: DataFrame, number: int) -> None:
        day_counts(batch, ts).coalesce(1).write.mode("overwrite").parquet(f"{sink_path}/batch={number}")

    w = src.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_daily_counts(spark: SparkSession, sink_path: str) -> DataFrame:
    """All days that the stream has seen, with their counts so far."""
    return (spark.read.schema("day DATE, n_events BIGINT").parquet(sink_path)
            .groupBy("day").agg(F.sum("n_events").alias("n_events")))


def daily_counts_stream_batch(spark: SparkSession, source_dir: str,
                              glob: str = "*.parquet") -> DataFrame:
    """Run the stream once over what has landed and return all days."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/daily-{uuid.uuid4().hex}"
    run_daily_counts(spark, source_dir, f"{base}/out", f"{base}/chk", glob=glob).awaitTermination()
    return read_daily_counts(spark, f"{base}/out")
