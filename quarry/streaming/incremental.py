"""Incremental ingest as a stream (survey IDs STM1, STM2, STM4, AGG10).

Listing pages land as Parquet files in a folder.  Each scheduled run is one
``availableNow`` trigger: the file source's commit log hands every page to
exactly one micro-batch, and ``foreachBatch`` runs the ingest plan in
``filter`` mode against the archive as it is at that batch (the anti join is
the cross-run dedup; ``first_by`` dedups within the batch).  Old items are
dropped by the lookback predicate.

``run_deduplicated`` puts a keyed state in front (``streaming.seen``): URLs
that this stream has seen within its window are dropped before they reach the
archive, and items that come later than the watermark are set aside in a table
of their own, from which ``ingest_late`` takes them.
"""

from __future__ import annotations

import zlib
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.extract import listing_items
from quarry.plans.ingest import IngestParams, ingest_items, run_ingest
from quarry.session import materialize
from quarry.streaming.metrics import RunMetrics
from quarry.streaming.seen import LATE, NEW, flagged

# --- fixed values -----------------------------------------------------------
LATE_SCHEMA = "page INT, pos INT, date STRING, title STRING, url STRING, types ARRAY<STRING>, batch STRING"
ITEM_COLUMNS = ("page", "pos", "date", "title", "url", "types")
# ---------------------------------------------------------------------------


def ingest_batch(batch: DataFrame, archive_path: str, params: IngestParams, **kw) -> dict:
    """One micro-batch of listing pages: new rows -> staged -> written under the batch's ``name``.

    A batch that is run again does not see its own rows as known and replaces
    what it left, wherever it was interrupted.
    """
    return run_ingest(batch, archive_path, replace(params, mode="filter"), **kw)


def _landed(spark: SparkSession, landing_path: str, files_per_batch: int | None) -> DataFrame:
    schema = spark.read.parquet(landing_path).schema
    src = spark.readStream.schema(schema)
    if files_per_batch:
        src = src.option("maxFilesPerTrigger", files_per_batch)
    return src.parquet(landing_path)


def _stream_id(checkpoint: str) -> str:
    return f"{zlib.crc32(checkpoint.encode()):08x}"   # batch numbers are per checkpoint


def run_incremental(spark: SparkSession, landing_path: str, archive_path: str, checkpoint: str,
                    params: IngestParams, *, files_per_batch: int | None = None, metrics_path: str | None = None, **kw):
    """Process every listing page landed since the last run, then stop.

    ``metrics_path``: the pages that each micro-batch saw, as the stream
    observed them, are added to that table.
    """
    src = _landed(spark, landing_path, files_per_batch)
    stream = _stream_id(checkpoint)
    # counted inside the stream, while the batch is processed
    src = src.observe("landed", F.count(F.lit(1)).alias("n_pages"), F.count_if(F.col("html").isNull()).alias("n_empty"))

    def run(batch: DataFrame, number: int) -> None:
        ingest_batch(batch, archive_path, params, name=f"stream-{stream}-{number}", **kw)

    with RunMetrics(spark) as seen:
        q = (src.writeStream.foreachBatch(run)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
        if metrics_path:
            seen.write(q, metrics_path, f"stream-{stream}")
    return q


def run_deduplicated(spark: SparkSession, landing_path: str, archive_path: str, checkpoint: str, params: IngestParams, *,
                     window_days: int, late_path: str, files_per_batch: int | None = None, **kw):
    """Like ``run_incremental``, with a bounded memory of the URLs seen (STM2).

    Items of a URL seen within ``window_days`` of event time go no further;
    items older than the watermark (the newest date seen, less the window) go
    to ``late_path`` under their batch's name and are counted there.
    """
    items = listing_items(_landed(spark, landing_path, files_per_batch))
    stream = _stream_id(checkpoint)

    def run(batch: DataFrame, number: int) -> None:
        name = f"stream-{stream}-{number}"
        rows = materialize(batch, "flagged")          # the state step runs once
        late = rows.filter(F.col("status") == LATE).select(*ITEM_COLUMNS).withColumn("batch", F.lit(name))
        (late.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(late_path))
        fresh = rows.filter(F.col("status") == NEW).select(*ITEM_COLUMNS)
        ingest_items(fresh, None, archive_path, replace(params, mode="filter"), name=name, **kw)

    q = (flagged(items, window_days).writeStream.foreachBatch(run).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def late_items(spark: SparkSession, late_path: str) -> DataFrame:
    """Items that came after the watermark, with the batch that set them aside."""
    try:
        return spark.read.schema(LATE_SCHEMA).parquet(late_path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], LATE_SCHEMA)
        raise


def ingest_late(spark: SparkSession, late_path: str, archive_path: str, params: IngestParams, *, name: str = "late", **kw) -> dict:
    """Bring what was set aside into the archive: unknown URLs only, once each, under one batch name."""
    rows = late_items(spark, late_path).drop("batch")
    return ingest_items(materialize(rows, "late"), None, archive_path, replace(params, mode="filter"), name=name, **kw)
