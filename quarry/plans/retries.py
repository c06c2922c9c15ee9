"""Failed answers and their next turn (survey IDs ANN3, ANN4).

Every run adds the outcome of each text it sent to a retry table, under its
batch name.  What is due is an aggregate over that table: URLs that never
succeeded and have not used up their attempts.  The next run takes the due
ones besides what is new, so a failure is retried without scanning the archive
for holes, and one that keeps failing stops costing calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.annotate import Answerer, annotate, stage

# --- fixed values -----------------------------------------------------------
MAX_ATTEMPTS = 6       # calls for one text, over all runs
OUTCOME_SCHEMA = "url STRING, ok BOOLEAN, n_attempts INT, error STRING, model_used STRING, latency_ms DOUBLE, batch STRING"
# ---------------------------------------------------------------------------


def record_outcomes(answered: DataFrame, path: str, batch: str) -> None:
    """Add the outcome of every text that was sent, replacing what this batch recorded before.

    ``answered``: rows of ``annotate``, whole or not.
    """
    ok = F.col("answered") if "answered" in answered.columns else F.col("response").isNotNull()
    sent = answered.filter(F.col("n_attempts").isNotNull() & (F.coalesce("url", F.lit("")) != ""))
    (sent.select("url", ok.alias("ok"), "n_attempts", "error", "model_used", "latency_ms", F.lit(batch).alias("batch"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path))


def outcomes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OUTCOME_SCHEMA).parquet(path)


def retry_state(found: DataFrame) -> DataFrame:
    """(url, ok, n_attempts, n_rounds, error, model_used) over all rounds; the error is the last round's."""
    last = F.max_by(F.struct("error"), F.struct("batch", "n_attempts"))
    return found.groupBy("url").agg(
        F.bool_or("ok").alias("ok"), F.sum("n_attempts").cast("int").alias("n_attempts"), F.count(F.lit(1)).cast("int").alias("n_rounds"),
        last.alias("__last"), F.max("model_used").alias("model_used")).select(
        "url", "ok", "n_attempts", "n_rounds", F.when(~F.col("ok"), F.col("__last.error")).alias("error"), "model_used")


def due(found: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """URLs to be sent again."""
    return retry_state(found).filter(~F.col("ok") & (F.col("n_attempts") < max_attempts)).select("url", "n_attempts")


def retry_round(texts: DataFrame, path: str, answerer: Answerer, batch: str, topic: str | None = None,
                max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Send what is due again and record it; returns the answered rows.  ``texts``: a (url, text) row per URL."""
    spark = texts.sparkSession
    # a round that is repeated doesn't count its own outcomes
    wanted = due(outcomes(spark, path).filter(F.col("batch") != batch), max_attempts)
    # written first: Spark then knows how few they are before it moves any texts
    rows = stage(texts.join(stage(wanted.select("url"), "due-urls"), "url", "left_semi"), "due")
    answered = stage(annotate(rows, answerer, topic=topic), "retried")
    record_outcomes(answered, path, batch)
    return answered
