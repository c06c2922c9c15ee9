"""Backfill of missing annotations (survey IDs PIP2, FIL6, FIL8, JOIN3-JOIN4, SNK3).

Rows without a description or grade get text (content cache, else extracted
page), are annotated, and the answers are written back to exactly those rows;
all other rows pass through unchanged, in the topic they are in.

Two steps, so the answers can be staged between them:

* ``backfill_answers``: the rows that need work -> one answer per row key;
* ``apply_answers``: archive LEFT JOIN answers on the row key.

Jobs on stored archives (``filled_in``) join only the rows that lack something
with the answers; those that lack nothing are read and written where they are.
``run_backfill`` reads and rewrites only the partitions (topic and batch) that
hold a row with an answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import text_file_path
from quarry.operators.annotate import PARSED_COLUMNS, Answerer, annotate, reads_text, stage
from quarry.operators.filters import missing_summary
from quarry.operators.joins import first_by
from quarry.session import materialize
from quarry.sources.archive import (ARCHIVE_COLUMNS, PARTITIONS, new_batch, read_silver, rewrite_partitions,
                                   slug_or_base, staged_rewrite, to_silver)

ROW_KEY = "__rid"


def with_row_key(archive: DataFrame, key: str = ROW_KEY) -> DataFrame:
    """A deterministic row key: two independent 64-bit hashes of the row.

    Identical rows share a key and get the same answer, so the write-back
    join can't fan out on duplicate URLs (Q6).  128 bits keep accidental
    collisions out of reach at billions of rows (one 64-bit hash would not).
    """
    cols = [F.coalesce(F.col(c), F.lit("\u0000")) for c in (*ARCHIVE_COLUMNS, *(p for p in PARTITIONS if p in archive.columns))]
    return archive.withColumn(key, F.concat(F.xxhash64(*cols).cast("string"), F.lit(":"),
                                            F.xxhash64(F.lit("\u0001"), *cols).cast("string")))


def backfill_answers(archive: DataFrame, answerer: Answerer, *, key: str = ROW_KEY, content: DataFrame | None = None,
                     article_pages: DataFrame | None = None, topic: str | None = None,
                     container: str = "main", carry: tuple[str, ...] = ()) -> DataFrame:
    """``key`` + ``carry`` + answer columns for every row that lacks one and has text."""
    from quarry.plans.ingest import window_text

    need = first_by(archive.filter(missing_summary()).select(key, "url", *carry), key, ())
    texts = materialize(window_text(need, content, article_pages, container, whole=reads_text(answerer)), "missing")
    # FIL8 + Q8: a row with no readable text gets no model call and no answer
    ann = annotate(texts, answerer, keys=(key,), topic=topic)
    return ann.filter(F.col("response").isNotNull()).select(key, *carry, *PARSED_COLUMNS)


def apply_answers(archive: DataFrame, answers: DataFrame, *, key: str = ROW_KEY,
                  topic: str | None = None, output_dir: str = "texts", today: str = "1970-01-01") -> DataFrame:
    """JOIN4: write answers back to their rows; ``updated`` flags them."""
    ans = answers.select(key, F.lit(True).alias("__upd"),
                         *[F.col(c).alias("__" + c) for c in PARSED_COLUMNS])
    out = archive.join(ans, key, "left")
    upd = F.coalesce(F.col("__upd"), F.lit(False))
    new_topic = F.lit(topic) if topic else F.coalesce(F.col("relevance_topic"), F.lit(""))
    path = F.coalesce(F.nullif(F.col("text_file"), F.lit("")),
                      text_file_path(output_dir, "date", "title", today))
    cols = {c: F.when(upd, F.col("__" + c)).otherwise(F.col(c)) for c in PARSED_COLUMNS}
    cols.update({
        "relevance_topic": F.when(upd, new_topic).otherwise(F.col("relevance_topic")),
        "text_file": F.when(upd, path).otherwise(F.col("text_file")),
        "updated": upd,
    })
    return out.withColumns(cols).drop("__upd", *["__" + c for c in PARSED_COLUMNS])


def filled_in(archive: DataFrame, answers: DataFrame, by: tuple[str, ...] = (), **kw) -> DataFrame:
    """``apply_answers`` on a stored archive, read twice: rows that lack nothing have no answer and aren't moved to find one.

    The others are gathered ``by`` partition columns.
    """
    filled = apply_answers(archive.filter(missing_summary()), answers, **kw)
    return ((filled.hint("rebalance", *by) if by else filled)
            .unionByName(archive.filter(~missing_summary()).withColumn("updated", F.lit(False))))


def backfill_rows(archive: DataFrame, answerer: Answerer, *, content: DataFrame | None = None,
                  article_pages: DataFrame | None = None, topic: str | None = None, output_dir: str = "texts",
                  today: str = "1970-01-01", container: str = "main") -> DataFrame:
    """PIP2 as one plan: the whole archive with answers filled in, plus ``updated``."""
    arch = with_row_key(archive)
    ans = backfill_answers(arch, answerer, content=content, article_pages=article_pages, topic=topic, container=container)
    return apply_answers(arch, ans, topic=topic, output_dir=output_dir, today=today).drop(ROW_KEY)


def run_backfill(spark: SparkSession, archive_path: str, answerer: Answerer, *, topic: str | None = None,
                 dataset: str | None = None, name: str | None = None, output_dir: str = "texts",
                 today: str = "1970-01-01", **kw) -> int:
    """Fill in the answers of a silver archive, in place; returns rows updated.

    ``dataset`` restricts the work to one topic's partition (``""``: the rows
    without a topic); ``topic`` is the scope of the questions and is stamped
    on the rows.  Only partitions with an answered row are read in full and
    replaced.  Give the same ``name`` to repeat a backfill that was stopped:
    from the point on where its rows were staged, model calls don't repeat.
    """
    name = name or new_batch()
    if staged_rewrite(spark, archive_path, name) is None:
        silver = read_silver(spark, archive_path)
        if silver is None:
            return 0
        if dataset is not None:
            silver = silver.filter(F.col("topic_slug") == slug_or_base(F.lit(dataset)))
        keyed = with_row_key(silver.drop("date_dt", "relevance", "types_list"))
        answers = stage(backfill_answers(keyed, answerer, topic=topic, carry=PARTITIONS, **kw), "backfill")
        if answers.isEmpty():
            return 0
        # the touched partitions, as a partition filter that the scan applies
        touched = answers.agg(F.collect_set(F.struct(*PARTITIONS))).scalar()
        rows = keyed.filter(F.array_contains(touched, F.struct(*PARTITIONS)))
        rows = filled_in(rows, answers.select(ROW_KEY, *PARSED_COLUMNS), PARTITIONS, topic=topic, output_dir=output_dir, today=today)
        done = rewrite_partitions(spark, archive_path, to_silver(rows.drop(ROW_KEY)), name, but=("updated",), gathered=True)
    else:
        done = rewrite_partitions(spark, archive_path, None, name, but=("updated",))
    return done.filter("updated").count()


def run_backfill_csv(spark: SparkSession, csv_path: str, out_path: str, answerer: Answerer, *, topic: str | None = None,
                     output_dir: str = "texts", today: str = "1970-01-01", **kw) -> int:
    """SRC3 + PIP2 on the bronze CSV: read it, fill answers, write the whole
    archive as CSV to ``out_path`` (a new folder; the input is never
    overwritten).  Returns rows updated, counted while they are written.
    """
    from quarry.sources.archive import read_archive_csv, write_archive_csv

    arch = with_row_key(read_archive_csv(spark, csv_path))
    answers = stage(backfill_answers(arch, answerer, topic=topic, **kw), "backfill-csv")
    rows = filled_in(arch, answers, topic=topic, output_dir=output_dir, today=today).drop(ROW_KEY)
    written = Observation()
    write_archive_csv(rows.observe(written, F.count_if("updated").alias("n_updated")), out_path, mode="errorifexists", extra=True)
    return written.get["n_updated"]
