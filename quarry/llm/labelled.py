"""Which rows a labelled model may learn from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents that a classifier is fitted on, at most.
FIT_ROWS = 8192


def held_out(doc_id: Column | str, remainder: int = 0) -> Column:
    """True where crc32(doc_id as text) mod 5 is ``remainder`` (a null id counts as empty text)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 5 == remainder


def fit_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = FIT_ROWS) -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents outside the held-out fold.

    The documents are the first ``rows`` in the order of a hash of their id.
    Rows without id or label are passed over; of repeated ids the smallest
    label and the smallest text count.  The ids picked (bounded by ``rows``)
    are broadcast, so the texts of the corpus are not shuffled.
    """
    picked = (labels.select("doc_id", F.col(label).cast("int").alias("label"))
              .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out("doc_id"))
              .groupBy("doc_id").agg(F.min("label").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(picked), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
            .select("text", "label"))
