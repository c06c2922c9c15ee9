"""Registered queries that run whole jobs: they write tables in the shared folder and return what those hold.

Every job works on archives, listings, pages and recorded answers that Spark
derives from the driver's tables (``quarry.sources.landing``), in folders of
its own.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import clean_text
from quarry.operators.annotate import Answerer, annotate, latency_report, recorded
from quarry.operators.extract import article_results, unreadable
from quarry.plans.backfill import run_backfill, run_backfill_csv
from quarry.plans.ingest import IngestParams, run_ingest, run_scheduled, window_text
from quarry.plans.retries import outcomes, record_outcomes, retry_round, retry_state
from quarry.session import checkpoint_dir, materialize
from quarry.sources import landing as LD
from quarry.sources.archive import (ARCHIVE_COLUMNS, append_silver, export_texts, read_archive_csv, read_archive_dir, read_silver,
                                   silver_of_topic, to_silver, write_archive_csv)
from quarry.streaming.incremental import ingest_late, late_items, run_deduplicated, run_incremental
from quarry.streaming.metrics import read_metrics

# --- fixed values (query parameters) ----------------------------------------
AS_OF = _dt.datetime(2025, 12, 31, 12, 0, 0)
TODAY = "2025-12-31"
TOPIC = "environmental impacts"
NUMBER_TOPIC = "0075"
OUTPUT_DIR = "texts"
CONTAINER = "article"
LOOKBACK_NARROW = 60
WINDOW_DAYS = 90
SEED_FROM = 600            # thousandths of the documents: the archive before the job
FIRST_LANDING = 300        # thousandths of the listing pages that land first
LOST_PAGE = (9, 4)         # number % 9 = 4: the listing page wasn't fetched
# ----------------------------------------------------------------------------


def scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/job-{name}-{uuid.uuid4().hex}"


def _params(**kw) -> IngestParams:
    return IngestParams(**{"as_of": AS_OF, "lookback_days": None, "topic": TOPIC, "output_dir": OUTPUT_DIR, **kw})


def _recorded(spark: SparkSession, sf: str, later: bool = False) -> Answerer:
    return recorded(lambda urls: LD.attempts(spark, sf, later, urls))


def _later(spark: SparkSession, sf: str) -> DataFrame:
    """Archive rows of the later part of the documents."""
    return LD.actions(spark, sf).filter(F.col("doc_id") * 1000 >= LD.size_of(spark, sf) * SEED_FROM)


def _lost(pages: DataFrame) -> DataFrame:
    every, which = LOST_PAGE
    return pages.withColumn("html", F.when(F.col("page") % every != which, F.col("html")))


def ingest_then_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """SNK1, SNK3, PIP1, PIP2 on one archive that holds other topics already; answers come in two rounds."""
    path = scratch(spark, "archive")
    append_silver(to_silver(_later(spark, sf).select(*ARCHIVE_COLUMNS)), path, "seed")
    content = LD.content(spark, sf)
    run_ingest(LD.listing_pages(LD.actions(spark, sf)), path, _params(), name="run", content=content,
               answerer=_recorded(spark, sf))
    run_backfill(spark, path, _recorded(spark, sf, later=True), topic=TOPIC, dataset=TOPIC, content=content,
                 output_dir=OUTPUT_DIR, today=TODAY)
    return read_silver(spark, path).select("url", "topic_slug", "batch", "relevance_topic", "description", "relevant_eo",
                                           "full_summary", "relevance")


def ingest_update_missing(spark: SparkSession, sf: str) -> DataFrame:
    """PIP1 with ``update_missing``: one run that also fills its topic's older rows (AGG10's counters)."""
    path = scratch(spark, "archive")
    append_silver(silver_of_topic(_later(spark, sf).select(*ARCHIVE_COLUMNS), TOPIC), path, "seed", gathered=True)
    got = run_ingest(LD.listing_pages(LD.actions(spark, sf)), path, _params(mode="filter"), name="run", content=LD.content(spark, sf),
                     answerer=_recorded(spark, sf), update_missing=True)
    counted = read_silver(spark, path).groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.coalesce("description", F.lit("")) != "").alias("n_described"),
        F.count_if(F.col("relevant_eo").isNotNull()).alias("n_graded"))
    return counted.withColumns({k: F.lit(got[k]).cast("long") for k in ("new", "annotated", "failed", "updated")})


def ingest_two_topics(spark: SparkSession, sf: str) -> DataFrame:
    """SNK5, JOIN1, FIL16: two topics on one archive, known URLs by topic from the bucketed table; the third run adds nothing."""
    path, known = scratch(spark, "archive"), scratch(spark, "known")
    pages = LD.listing_pages(LD.actions(spark, sf))
    for topic, name in ((TOPIC, "one"), (NUMBER_TOPIC, "two"), (TOPIC, "three")):
        run_ingest(pages, path, _params(topic=topic, mode="filter"), name=name, known_path=known)
    return read_silver(spark, path).select("topic_slug", "batch", "url", "date", "title", "types")


def merged_batches(spark: SparkSession, sf: str) -> DataFrame:
    """COL1 (Q16): a batch with a column that earlier ones lack; both are read as one archive, also after a rewrite."""
    path = scratch(spark, "archive")
    a = LD.actions(spark, sf)
    lang = LD.table(spark, sf, "documents").select("doc_id", "lang")
    append_silver(to_silver(a.filter("doc_id % 2 = 0").select(*ARCHIVE_COLUMNS)), path, "even")
    append_silver(to_silver(a.filter("doc_id % 2 = 1").join(lang, "doc_id").select(*ARCHIVE_COLUMNS, "lang")), path, "odd")
    run_backfill(spark, path, _recorded(spark, sf), content=LD.content(spark, sf), dataset="src1", topic=TOPIC, today=TODAY)
    return read_silver(spark, path).select("url", "batch", "topic_slug", "title", "lang", "relevance_topic", "relevant_eo")


def dataset_headers(spark: SparkSession, sf: str) -> DataFrame:
    """SRC8: a folder of CSV datasets, some with the columns in another order, one column less and one more."""
    base = scratch(spark, "datasets")
    lang = LD.table(spark, sf, "documents").select("doc_id", "lang")
    rows = LD.actions(spark, sf).join(lang, "doc_id")
    write_archive_csv(rows.filter("lang = 'en'"), f"{base}/en")
    other = [c for c in reversed(ARCHIVE_COLUMNS) if c != "text_file"]
    write = rows.filter("lang <> 'en'").select(*other, "lang").write
    write.options(header="true", quote='"', escape='"', encoding="UTF-8", emptyValue="", nullValue="",
                  ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(f"{base}/other")
    return read_archive_dir(spark, f"{base}/*").select(
        "url", "date", "title", "types", "description", "relevance_topic", "relevant_eo", "full_summary", "lang")


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """SRC1, SRC2, SNK4: the archive as CSV and back, with its derived columns."""
    path = scratch(spark, "csv")
    write_archive_csv(LD.actions(spark, sf), path)
    return to_silver(read_archive_csv(spark, path)).select("url", "date", "title", "types", "description", "relevance_topic",
                                                           "relevance", "date_dt", "full_summary")


def backfill_csv(spark: SparkSession, sf: str) -> DataFrame:
    """SRC3, PIP2: the CSV archive filled in, written to another folder and read again."""
    path, out = scratch(spark, "csv"), scratch(spark, "csv")
    write_archive_csv(LD.actions(spark, sf), path)
    n = run_backfill_csv(spark, path, out, _recorded(spark, sf), content=LD.content(spark, sf), topic=TOPIC, today=TODAY)
    return read_archive_csv(spark, out).select("url", "description", "relevant_eo", "full_summary", "relevance_topic",
                                               F.lit(n).cast("long").alias("n_updated"))


def scheduled_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """PIP4: the fixed preset (its topic, 15 days) over the listing."""
    path = scratch(spark, "archive")
    run_scheduled(LD.listing_pages(LD.actions(spark, sf)), path, AS_OF, name="scheduled", content=LD.content(spark, sf),
                  answerer=_recorded(spark, sf), output_dir=OUTPUT_DIR)
    return read_silver(spark, path).select("url", "date", "title", "text_file", "relevance_topic", "relevant_eo", "topic_slug", "batch")


def page_counts(spark: SparkSession, sf: str) -> DataFrame:
    """AGG10 per listing page, EXT3 for listings: pages that weren't fetched say so."""
    path, pages = scratch(spark, "archive"), scratch(spark, "pages")
    append_silver(silver_of_topic(_later(spark, sf).select(*ARCHIVE_COLUMNS), TOPIC), path, "seed", gathered=True)
    run_ingest(_lost(LD.listing_pages(LD.actions(spark, sf))), path, _params(mode="filter"), name="run", pages_path=pages)
    return spark.read.parquet(pages).select("page", "n_found", "n_new", "error")


def answer_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """ANN2-ANN8: every text's recorded attempts: who answered, what it cost, what failed, what it says."""
    got = annotate(LD.content(spark, sf), _recorded(spark, sf), topic=TOPIC)
    return got.select("url", "model_used", "error", "latency_ms", "n_attempts", "description", "relevant_eo", "full_summary")


def answer_latency(spark: SparkSession, sf: str) -> DataFrame:
    """ANN8: rows, failures and retries per model (quantiles are approximate and tested apart)."""
    got = annotate(LD.content(spark, sf), _recorded(spark, sf), parse=False)
    return latency_report(got).select("model_used", "n_rows", "n_failed", "n_retries")


def retry_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """ANN3, ANN4 over runs: failures go to the retry table, the next round takes them from there."""
    path = scratch(spark, "retries")
    texts = materialize(LD.content(spark, sf), "texts")
    record_outcomes(annotate(texts, _recorded(spark, sf), parse=False, whole=False), path, "round-1")
    later = _recorded(spark, sf, later=True)
    for name in ("round-2", "round-2", "round-3"):     # a round that is repeated counts once
        retry_round(texts, path, later, name)
    return retry_state(outcomes(spark, path))


def page_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """JOIN3: texts of pages, from the cache where it has them (every second page), else from the page itself."""
    pages = materialize(LD.fetched_pages(spark, sf), "fetched")
    docs = LD.table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), clean_text("text").alias("text"))
    cache = pages.filter("page_id % 2 = 0").join(docs, "page_id").select("url", "text")
    return window_text(pages.select("page_id", "url"), cache, pages, CONTAINER).select("page_id", "url", "text_source", "text")


def quarantined_pages(spark: SparkSession, sf: str) -> DataFrame:
    """EXT3: article pages that couldn't be read, with the reason."""
    got = article_results(LD.fetched_pages(spark, sf), container=CONTAINER, keep=("page_id", "url"))
    return unreadable(got)


def saved_texts(spark: SparkSession, sf: str) -> DataFrame:
    """SNK2 + EXT3: texts as files, the sentinel for those that couldn't be read."""
    path = scratch(spark, "texts")
    got = article_results(LD.fetched_pages(spark, sf), container=CONTAINER, keep=("page_id", "url"))
    export_texts(got.withColumn("text_file", F.concat(F.lit(f"{OUTPUT_DIR}/"), F.col("page_id").cast("string"), F.lit(".txt"))), path)
    return spark.read.parquet(path)


def _land(spark: SparkSession, sf: str, base: str, part: str, one_file: bool = False) -> None:
    """Land the first pages, or all of them (as one file for a stream that takes file by file)."""
    pages = LD.listing_pages(LD.actions(spark, sf))
    last = LD.actions(spark, sf).agg(F.max("page")).scalar()
    first = F.col("page") * 1000 <= last * FIRST_LANDING
    chosen = {"first": pages.filter(first), "rest": pages.filter(~first), "all": pages}[part]
    (chosen.coalesce(1) if one_file else chosen).write.mode("append").parquet(f"{base}/landing")


def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """STM1, STM4: two landings, a run each, into an archive that holds the later part already."""
    base = scratch(spark, "incremental")
    append_silver(silver_of_topic(_later(spark, sf).select(*ARCHIVE_COLUMNS), TOPIC), f"{base}/archive", "seed", gathered=True)
    for part in ("first", "all"):
        _land(spark, sf, base, part)
        run_incremental(spark, f"{base}/landing", f"{base}/archive", f"{base}/chk", _params(lookback_days=LOOKBACK_NARROW * 6),
                        content=LD.content(spark, sf), answerer=_recorded(spark, sf))
    got = read_silver(spark, f"{base}/archive")
    return got.select("url", "date", "title", "types", "text_file", "description", "relevance_topic", "relevant_eo", "full_summary",
                      F.when(F.col("batch") == "seed", F.lit("seed")).otherwise(F.regexp_extract("batch", "[0-9]+$", 0)).alias("batch"))


def stream_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """AGG10 in the stream: pages per micro-batch as observed, beside the rows that each one added."""
    base = scratch(spark, "observed")
    _land(spark, sf, base, "first", one_file=True)
    _land(spark, sf, base, "rest", one_file=True)
    run_incremental(spark, f"{base}/landing", f"{base}/archive", f"{base}/chk", _params(), files_per_batch=1,
                    metrics_path=f"{base}/metrics")
    added = read_silver(spark, f"{base}/archive").groupBy("batch").agg(F.count(F.lit(1)).alias("n_new"))
    return read_metrics(spark, f"{base}/metrics").join(added, "batch", "left").select(
        F.col("number").alias("micro_batch"), "n_pages", "n_empty", F.coalesce("n_new", F.lit(0).cast("long")).alias("n_new"))


def _deduplicated(spark: SparkSession, sf: str) -> str:
    base = scratch(spark, "dedup")
    append_silver(silver_of_topic(_later(spark, sf).select(*ARCHIVE_COLUMNS), TOPIC), f"{base}/archive", "seed", gathered=True)
    for part in ("first", "all"):
        _land(spark, sf, base, part)
        run_deduplicated(spark, f"{base}/landing", f"{base}/archive", f"{base}/chk", _params(), window_days=WINDOW_DAYS,
                         late_path=f"{base}/late")
    return base


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """STM2: two landings into a non-empty archive, with a bounded memory; what came late is taken in afterwards."""
    base = _deduplicated(spark, sf)
    ingest_late(spark, f"{base}/late", f"{base}/archive", _params())
    origin = F.when(F.col("batch").isin("seed", "late"), F.col("batch")).otherwise(F.lit("stream"))
    return read_silver(spark, f"{base}/archive").select("url", "date", "title", "types", origin.alias("origin"))


def stream_late_items(spark: SparkSession, sf: str) -> DataFrame:
    """STM2, STM4: the rows that came after the watermark, each of them."""
    base = _deduplicated(spark, sf)
    return late_items(spark, f"{base}/late").select("page", "url", "date", "title")


QUERIES = {f.__name__: f for f in (
    ingest_then_backfill, ingest_update_missing, ingest_two_topics, merged_batches, dataset_headers, csv_round_trip, backfill_csv,
    scheduled_ingest, page_counts, answer_outcomes, answer_latency, retry_rounds, page_fallback, quarantined_pages, saved_texts,
    incremental_ingest, stream_metrics, stream_dedup, stream_late_items)}
