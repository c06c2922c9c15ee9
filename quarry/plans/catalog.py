"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each reads the driver's tables (or archives Spark derives from them, see
``quarry.sources.landing``) in full; parameters are fixed values below.
The DuckDB text for the same results is in ``quarry.plans.oracle``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as TX
from quarry.functions.response import parse_response, prompt_text
from quarry.operators import filters as FL
from quarry.operators import report as RP
from quarry.operators.annotate import recorded
from quarry.operators.crawl import crawl_window, new_items, run_metrics
from quarry.operators.extract import article_text, listing_items
from quarry.operators.joins import first_by
from quarry.operators.topics import label_paths, ranked_catalogue, topic_catalogue
from quarry.plans import jobs as J
from quarry.plans.backfill import backfill_rows
from quarry.plans.ingest import IngestParams, ingest_rows
from quarry.plans.report import dashboard
from quarry.sources import landing as LD
from quarry.sources.archive import known_state, to_silver

# --- fixed values (query parameters) ----------------------------------------
AS_OF = _dt.datetime(2025, 12, 31, 12, 0, 0)
TODAY = "2025-12-31"
DATE_RANGE = ("2025-06-01", "2025-08-31")
RELEVANCE = "Maybe"
TYPES = ("src1", "de")
SEARCH = "ou(ai|en)"
ALL_RANGE = ("2025-03-01", "2025-11-30")
ALL_RELEVANCE = "Yes"
ALL_TYPES = ("src2", "fr")
ALL_SEARCH = "e"
TOPIC = "environmental impacts"
BASE_CSV = "archive.csv"
OUTPUT_DIR = "texts"
ARTICLE_CONTAINER = "article"
LOOKBACK_WIDE = 500
LOOKBACK_NARROW = 60
PAGES_FROM = 3
ROW_COLUMNS = ("url", "date", "title", "types", "relevance", "date_dt")
LITERAL_SEARCH = "e."
MAX_PAGES = 7
# ----------------------------------------------------------------------------


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return to_silver(LD.actions(spark, sf))


def _rows(df: DataFrame) -> DataFrame:
    return df.select(*ROW_COLUMNS)


def listing(spark: SparkSession, sf: str, archive: DataFrame | None = None) -> DataFrame:
    """Listing items as the crawler sees them: archive rows with a date tag."""
    a = archive if archive is not None else LD.actions(spark, sf)
    return a.filter(F.col("date") != "").select("page", "pos", "date", "title", "url", "types")


def listing_and_known(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The listing and the known URLs, both from one derivation of the archive."""
    a = LD.actions(spark, sf)
    return listing(spark, sf, a), LD.known(spark, sf, a)


def q_kpis(spark, sf):
    return RP.kpis(silver(spark, sf))


def q_relevance_breakdown(spark, sf):
    return RP.ranked_breakdown(silver(spark, sf))


def q_daily_counts(spark, sf):
    return RP.daily_counts(silver(spark, sf))


def q_daily_events(spark, sf):
    ev = LD.table(spark, sf, "events")
    return (ev.groupBy(F.col("ts").cast("date").alias("day"))
            .agg(F.count(F.lit(1)).alias("n_events")).orderBy("day"))


def q_type_options(spark, sf):
    return RP.ranked_types(silver(spark, sf))


def q_filter_date(spark, sf):
    return _rows(FL.dashboard_filter(silver(spark, sf), date_range=DATE_RANGE))


def q_filter_relevance(spark, sf):
    return _rows(FL.dashboard_filter(silver(spark, sf), relevance=RELEVANCE))


def q_filter_types(spark, sf):
    return _rows(FL.dashboard_filter(silver(spark, sf), types=list(TYPES)))


def q_search_text(spark, sf):
    return _rows(FL.dashboard_filter(silver(spark, sf), query=SEARCH))


def q_filter_all(spark, sf):
    return _rows(FL.dashboard_filter(silver(spark, sf), date_range=ALL_RANGE, relevance=ALL_RELEVANCE,
                                     types=list(ALL_TYPES), query=ALL_SEARCH))


def q_filter_types_exact(spark, sf):
    return _rows(FL.dashboard_filter(silver(spark, sf), types=list(TYPES), exact_types=True))


def q_search_literal(spark, sf):
    return _rows(FL.dashboard_filter(silver(spark, sf), query=LITERAL_SEARCH, literal=True))


def q_filter_date_compat(spark, sf):
    return _rows(FL.dashboard_filter(silver(spark, sf), date_range=DATE_RANGE, compat=True))


def q_results_table(spark, sf):
    return RP.ranked_results(silver(spark, sf))


def q_dashboard_table(spark, sf):
    """PIP3 with its defaults: the archive's span is the date range."""
    return dashboard(silver(spark, sf))["table"]


def q_detail_view(spark, sf):
    return RP.detail_view(silver(spark, sf))


def q_export_rows(spark, sf):
    f = FL.dashboard_filter(silver(spark, sf), date_range=DATE_RANGE)
    return RP.export_projection(f).drop("doc_id", "page", "pos")


def q_missing_summaries(spark, sf):
    return silver(spark, sf).filter(FL.missing_summary()).select("url", "date", "title")


def q_known_state(spark, sf):
    a = LD.actions(spark, sf)
    return known_state(a.join(LD.known(spark, sf, a), "url", "left_semi"))


def q_new_urls(spark, sf):
    items, known = listing_and_known(spark, sf)
    return new_items(items, known).select("page", "pos", "url", "title", "date")


def _window(df):
    return df.select("page", "pos", "date", "title", "url", "types")


def q_crawl_window_known(spark, sf):
    items, known = listing_and_known(spark, sf)
    return _window(crawl_window(items, known=known, as_of=AS_OF, lookback_days=LOOKBACK_WIDE))


def q_crawl_window_lookback(spark, sf):
    items, known = listing_and_known(spark, sf)
    return _window(crawl_window(items, known=known, as_of=AS_OF, lookback_days=LOOKBACK_NARROW))


def q_crawl_window_pages(spark, sf):
    return _window(crawl_window(listing(spark, sf), start_page=PAGES_FROM))


def q_crawl_window_max_pages(spark, sf):
    """LIM1: a page cap from the start page on."""
    return _window(crawl_window(listing(spark, sf), start_page=PAGES_FROM, max_pages=MAX_PAGES))


def q_crawl_window_gap(spark, sf):
    """FIL4: a listing in which a page is missing ends before it."""
    items = listing(spark, sf)
    hole = items.agg(F.floor(F.max("page") * 7 / 10)).scalar()
    return _window(crawl_window(items.filter(F.col("page") != hole)))


def q_first_per_title(spark, sf):
    """SET3: titles repeat (documents have near and exact copies); the first listed row of each stays."""
    return first_by(listing(spark, sf).select("title", "page", "pos", "url"), "title", ("page", "pos"))


def q_crawl_window_filter(spark, sf):
    items, known = listing_and_known(spark, sf)
    return _window(crawl_window(items, known=known, as_of=AS_OF, lookback_days=LOOKBACK_NARROW,
                                mode="filter"))


def q_run_metrics(spark, sf):
    items, known = listing_and_known(spark, sf)
    win = crawl_window(items, known=known, as_of=AS_OF, lookback_days=LOOKBACK_WIDE)
    return run_metrics(items, win, known)


def q_listing_items(spark, sf):
    items = listing_items(LD.listing_pages(LD.actions(spark, sf)))
    return items.select("page", "date", "title", "url", TX.join_types("types").alias("types"))


def q_article_text(spark, sf):
    return article_text(LD.article_pages(spark, sf), container=ARTICLE_CONTAINER,
                        keep=("page_id", "url"))


def q_response_parse(spark, sf):
    return parse_response(LD.responses(spark, sf)).drop("response")


def q_prompt_build(spark, sf):
    docs = LD.table(spark, sf, "documents")
    return docs.select("doc_id", prompt_text("text", TOPIC).alias("prompt"))


def q_clean_text(spark, sf):
    docs = LD.table(spark, sf, "documents")
    return docs.select("doc_id", TX.clean_text("text").alias("clean_text"))


def q_safe_name(spark, sf):
    return LD.actions(spark, sf).select("url", TX.safe_filename("title", 120).alias("safe_title"))


def q_text_path(spark, sf):
    return LD.actions(spark, sf).select(
        "url", TX.text_file_path(OUTPUT_DIR, "date", "title", TODAY).alias("text_file"))


def q_topic_slug(spark, sf):
    return LD.actions(spark, sf).select("url", TX.topic_csv_name(BASE_CSV, "title").alias("topic_csv"))


def topic_files(spark, sf):
    """The archive split into one dataset file per language (English is the base); the Spanish one has no topics."""
    a = LD.actions(spark, sf)
    name = F.when(F.col("lang") == "en", F.lit(BASE_CSV)).otherwise(
        F.concat(F.lit("archive - "), F.col("lang"), F.lit(".csv")))
    docs = LD.table(spark, sf, "documents").select("doc_id", "lang")
    return a.join(docs, "doc_id").select(
        name.alias("file_name"), F.when(F.col("lang") != "es", F.col("relevance_topic")).alias("relevance_topic"),
        F.struct(F.lit(0).cast("long").alias("_block"), F.col("doc_id").alias("_row")).alias("ord"))


def q_topic_catalogue(spark, sf):
    return ranked_catalogue(topic_files(spark, sf), BASE_CSV)


def q_label_paths(spark, sf):
    """SET2 over the catalogue; datasets whose commonest topic is the same share a label."""
    return label_paths(topic_catalogue(topic_files(spark, sf), BASE_CSV)).select("label", "file_name")


def q_backfill(spark, sf):
    out = backfill_rows(LD.actions(spark, sf).drop("page", "pos"), recorded(lambda urls: LD.attempts(spark, sf, of=urls)),
                        content=LD.content(spark, sf), topic=TOPIC, output_dir=OUTPUT_DIR, today=TODAY)
    return out.select("url", "description", "relevant_eo", "full_summary", "relevance_topic", "updated")


def q_ingest(spark, sf):
    params = IngestParams(as_of=AS_OF, lookback_days=LOOKBACK_WIDE, topic=TOPIC, output_dir=OUTPUT_DIR)
    a = LD.actions(spark, sf)
    rows = ingest_rows(LD.listing_pages(a), LD.known(spark, sf, a), params, content=LD.content(spark, sf),
                       answerer=recorded(lambda urls: LD.attempts(spark, sf, of=urls)), texts=False)
    return rows.select("page", "date", "title", "url", "types", "text_file", "description",
                       "relevance_topic", "relevant_eo", "full_summary", "model_used", "error", "n_attempts")


def q_daily_events_stream(spark, sf):
    from quarry.streaming.daily import daily_counts_stream_batch
    return daily_counts_stream_batch(spark, sf, glob="events.parquet")


QUERIES = {
    "kpis": q_kpis,
    "relevance_breakdown": q_relevance_breakdown,
    "daily_counts": q_daily_counts,
    "daily_events": q_daily_events,
    "type_options": q_type_options,
    "filter_date": q_filter_date,
    "filter_relevance": q_filter_relevance,
    "filter_types": q_filter_types,
    "search_text": q_search_text,
    "filter_all": q_filter_all,
    "filter_types_exact": q_filter_types_exact,
    "search_literal": q_search_literal,
    "filter_date_compat": q_filter_date_compat,
    "results_table": q_results_table,
    "dashboard_table": q_dashboard_table,
    "detail_view": q_detail_view,
    "export_rows": q_export_rows,
    "missing_summaries": q_missing_summaries,
    "known_state": q_known_state,
    "new_urls": q_new_urls,
    "crawl_window_known": q_crawl_window_known,
    "crawl_window_lookback": q_crawl_window_lookback,
    "crawl_window_pages": q_crawl_window_pages,
    "crawl_window_max_pages": q_crawl_window_max_pages,
    "crawl_window_gap": q_crawl_window_gap,
    "crawl_window_filter": q_crawl_window_filter,
    "first_per_title": q_first_per_title,
    "run_metrics": q_run_metrics,
    "listing_items": q_listing_items,
    "article_text": q_article_text,
    "response_parse": q_response_parse,
    "prompt_build": q_prompt_build,
    "clean_text": q_clean_text,
    "safe_name": q_safe_name,
    "text_path": q_text_path,
    "topic_slug": q_topic_slug,
    "topic_catalogue": q_topic_catalogue,
    "label_paths": q_label_paths,
    "backfill": q_backfill,
    "ingest": q_ingest,
    "daily_events_stream": q_daily_events_stream,
    **J.QUERIES,
}
