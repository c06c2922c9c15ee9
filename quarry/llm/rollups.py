"""Token counts: rollups that signed deltas maintain.

A ledger is a folder with two Parquet tables, each partitioned by batch:

    signed/   one row per change: doc_id, version, source, lang, tokens, docs
              (docs is +1 or -1, tokens carries the same sign)
    totals/   the batch's change of every (source, lang, version) total

A batch of changes upserts counts of (doc_id, version) or deletes them.  What
the ledger holds for the touched keys is taken out with a minus sign, what
the batch brings goes in with a plus; a revised count is both, and an
unchanged one neither.  Totals are additive, so the rollup is the sum of the
small ``totals`` rows of all batches, however many documents there are.

*Idempotent commits.*  A batch reads only batches with smaller numbers and
replaces its own folders, ``signed`` first and ``totals`` last; a batch
counts once its ``totals`` are there.  Running it again, after a crash
between the two writes or after a success, leaves the same tables.  Batches
are numbered by the caller and committed in order; a batch that is run again
must be the newest or bring the same changes as before.

Of several changes of one key in a batch a delete wins, otherwise the largest
(tokens, source, lang).  Null keys and null group values are values like any
other; a null count is 0.  Rows that repeat an id are one key to the ledger;
``document_rollup`` gives each row a key of its own.  An empty batch commits no change.  Further columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import textcore as tc
from quarry.llm import wavelet
from quarry.session import materialize

KEY = ("doc_id", "version")
GROUP = ("source", "lang", "version")


class Ledger:
    """Token totals under ``root``; ``doc_id`` is the Spark type of document ids (or of rows' keys)."""

    def __init__(self, spark: SparkSession, root: str, doc_id: str = "long"):
        self.spark, self.root = spark, root.rstrip("/")
        self.signed_schema = f"doc_id {doc_id}, version string, source string, lang string, tokens long, docs long"
        self.totals_schema = "source string, lang string, version string, tokens long, docs long"

    def _read(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(f"{schema}, batch long").parquet(f"{self.root}/{table}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"{schema}, batch long")

    def _before(self, batch: int) -> DataFrame:
        """Signed rows of the committed batches before this one."""
        committed = [r.batch for r in self._read("totals", self.totals_schema).select("batch").distinct().collect()]
        return self._read("signed", self.signed_schema).where(F.col("batch").isin([b for b in committed if b < batch]))

    def _replace(self, df: DataFrame, table: str, batch: int) -> DataFrame:
        path = f"{self.root}/{table}/batch={batch}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)).parquet(path)

    def commit(self, batch: int, changes: DataFrame) -> None:
        """Apply (doc_id, version, source, lang, tokens, deleted) as the batch of this number."""
        wanted = (changes.groupBy(*KEY).agg(F.max(F.struct(
            F.coalesce("deleted", F.lit(False)).alias("deleted"), F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"),
            "source", "lang")).alias("new")).select(*KEY, "new.*"))
        wanted = materialize(wanted, "ledger-batch")
        touched = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in KEY]
        held = (self._before(batch).alias("old").join(wanted.alias("new"), touched, "left_semi")
                .groupBy(*KEY, "source", "lang").agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs"))
                .where("docs <> 0"))
        columns = [*KEY, "source", "lang", "tokens", "docs"]
        signed = (held.select(*KEY, "source", "lang", (-F.col("tokens")).alias("tokens"), (-F.col("docs")).alias("docs"))
                  .unionByName(wanted.where("not deleted").select(*KEY, "source", "lang", "tokens", F.lit(1).cast("long").alias("docs")))
                  .groupBy(*KEY, "source", "lang").agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs"))
                  .where("tokens <> 0 or docs <> 0").select(*columns))
        written = self._replace(signed, "signed", batch)
        delta = written.groupBy(*GROUP).agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs"))
        empty = self.spark.createDataFrame([(None, None, None, 0, 0)], self.totals_schema)  # commits also a batch without change
        self._replace(delta.select("source", "lang", "version", "tokens", "docs").unionByName(empty), "totals", batch)

    def totals(self) -> DataFrame:
        """source, lang, version, docs, tokens over all committed batches."""
        return (self._read("totals", self.totals_schema).groupBy(*GROUP)
                .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0"))

    def counts(self) -> DataFrame:
        """The ledger's present rows: doc_id, version, source, lang, tokens."""
        return (self._before(1 << 62).groupBy(*KEY, "source", "lang")
                .agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs")).where("docs <> 0").drop("docs"))

    def recounted(self) -> DataFrame:
        """The totals counted again from the present rows; equal to ``totals``."""
        return self.counts().groupBy(*GROUP).agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens"))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, source, lang, copy (the text's hash, 32 bytes), words, pieces of every document.

    ``words`` are runs of bytes other than space and 0x09-0x0D, ``pieces`` the
    ids of the tokenizer at ``path``.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def counted(batches):
        for batch, texts in tc.chunks(batches):
            _, pieces = wavelet.encoder(path).encode(texts, None)
            _, _, document, _ = tc.words(*tc.text_bytes(texts))
            at = batch.schema.get_field_index
            yield pa.RecordBatch.from_arrays(
                [batch.column(at("doc_id")), batch.column(at("source")), batch.column(at("lang")), batch.column(at("copy")),
                 pa.array(np.bincount(document, minlength=batch.num_rows).astype(np.int64)), pa.array(pieces)],
                names=["doc_id", "source", "lang", "copy", "words", "pieces"])

    return (docs.select("doc_id", "source", "lang", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("copy"), "text")
            .mapInArrow(counted, f"doc_id {kind}, source string, lang string, copy binary, words long, pieces long"))


def _rows(counts: DataFrame, version: str, tokens, deleted: bool = False) -> DataFrame:
    return counts.select("doc_id", F.lit(version).alias("version"), "source", "lang", tokens.alias("tokens"), F.lit(deleted).alias("deleted"))


def _three_batches(ledger: Ledger, counts: DataFrame) -> DataFrame:
    """Commits the batches of ``corpus_rollup``; returns the counts that the second one deletes."""
    words, pieces = F.col("words"), F.col("pieces")
    ledger.commit(1, _rows(counts, "words", words).unionByName(_rows(counts, "pieces", pieces)))
    first = counts.groupBy("copy").agg(F.min("doc_id").alias("first"))
    copies = counts.join(first, "copy").where(~F.col("doc_id").eqNullSafe(F.col("first")))
    removal = _rows(copies, "words", words, True).unionByName(_rows(copies, "pieces", pieces, True))
    ledger.commit(2, removal)
    ledger.commit(2, removal)
    revised = ledger.counts().where("version = 'pieces'").select(
        "doc_id", "version", "source", "lang", (F.col("tokens") + 1).alias("tokens"), F.lit(False).alias("deleted"))
    ledger.commit(3, revised)
    return copies


def corpus_rollup(docs: DataFrame, path: str, root: str) -> DataFrame:
    """Totals of the texts' first copies: three batches over the whole corpus, the second of them committed twice.

    1. every document is inserted with its word and its piece count;
    2. every copy of a text but the one with the smallest id is deleted;
    3. the piece counts are revised to include the end-of-text id.
    """
    ledger = Ledger(docs.sparkSession, root, docs.schema["doc_id"].dataType.simpleString())
    _three_batches(ledger, materialize(token_counts(docs, path), "token-counts"))
    return ledger.totals()


def by_row(counts: DataFrame) -> DataFrame:
    """The counts with a key of each row's own as ``doc_id``: id, text hash, source, lang and a number among equal rows.

    Equal rows are counted and unfolded again, which takes no task per key.
    """
    same = counts.groupBy(*counts.columns).agg(F.count("*").alias("n"))
    numbered = same.select(*counts.columns, F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("nth"))
    return numbered.withColumn("doc_id", F.struct("doc_id", "copy", "source", "lang", "nth")).select(*counts.columns)


def document_rollup(docs: DataFrame, path: str, root: str) -> DataFrame:
    """Totals of all rows of documents: the batches of ``corpus_rollup`` over keys of :func:`by_row`, and

    4. the deleted copies are inserted again, with the end-of-text id.
    """
    counts = materialize(by_row(token_counts(docs, path)), "token-counts")
    ledger = Ledger(docs.sparkSession, root, counts.schema["doc_id"].dataType.simpleString())
    copies = _three_batches(ledger, counts)
    ledger.commit(4, _rows(copies, "words", F.col("words")).unionByName(_rows(copies, "pieces", F.col("pieces") + 1)))
    return ledger.totals()
