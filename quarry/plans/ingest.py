"""Ingest (survey IDs PIP1, PIP4, JOIN3, FIL7, COL6, AGG10, SNK1-SNK2).

Landed listing pages -> items -> crawl window against the archive's known
URLs -> article text (content cache first, then extracted pages) -> model
annotation of the readable texts -> rows to append.

``ingest_rows`` is the pure plan (a DataFrame); ``run_ingest`` stages the
annotated rows once and writes texts, known URLs and archive rows, in that
order, all under the run's batch name.  A run that is repeated under its name
doesn't count its own rows as known and replaces what an earlier attempt left,
wherever that stopped.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import join_types, text_file_path
from quarry.operators.annotate import ANSWER_COLUMNS, PARSED_COLUMNS, Answerer, annotate, reads_text, stage
from quarry.operators.crawl import crawl_window, page_counts, page_range
from quarry.operators.extract import article_text, items_of, listing_results, unreadable
from quarry.operators.joins import restrict_to
from quarry.plans.backfill import run_backfill
from quarry.plans.retries import record_outcomes
from quarry.session import materialize
from quarry.sources.archive import (ARCHIVE_COLUMNS, append_content, append_known, append_silver, known_in_topic,
                                   new_batch, read_content, read_known, silver_of_topic)


@dataclass(frozen=True)
class IngestParams:
    """PIP1's parameters; ``as_of`` replaces the clock (always explicit)."""
    as_of: _dt.datetime
    lookback_days: int | None = 15
    start_page: int = 1
    max_pages: int | None = None
    single_page: bool = False
    topic: str | None = None
    mode: str = "prefix"
    output_dir: str = "texts"
    container: str = "main"


# PIP4: the scheduled single-topic preset (fixed values).
SCHEDULED_TOPIC = "environmental impacts"
SCHEDULED_LOOKBACK_DAYS = 15


def scheduled_params(as_of: _dt.datetime) -> IngestParams:
    return IngestParams(as_of=as_of, lookback_days=SCHEDULED_LOOKBACK_DAYS, topic=SCHEDULED_TOPIC)


def run_scheduled(listing_pages: DataFrame, archive_path: str, as_of: _dt.datetime, **kw) -> dict:
    """PIP4: one scheduled single-topic run with the fixed preset."""
    overrides = {k: kw.pop(k) for k in ("output_dir", "container") if k in kw}
    return run_ingest(listing_pages, archive_path, replace(scheduled_params(as_of), **overrides), **kw)


def _one_text(texts: DataFrame, name: str, whole: bool) -> DataFrame:
    """One non-empty text per URL (the smallest, whatever order rows arrive in), or just that there is one."""
    texts = texts.filter(F.coalesce(F.col("text"), F.lit("")) != "")
    if not whole:
        return texts.select("url").distinct().withColumn(name, F.lit(True))
    return texts.groupBy("url").agg(F.min("text").alias(name))


def window_text(window: DataFrame, content: DataFrame | None, article_pages: DataFrame | None,
                container: str = "main", whole: bool = True) -> DataFrame:
    """JOIN3: ``text`` per window URL: cached text, else extracted page text.

    The content cache and the landed pages hold every text ever seen; both
    are first reduced to the window's URLs, pages also to those without a
    cached text, so only what is needed is parsed.  Each side gives one text
    per URL: repeated content rows or pages don't multiply the window's rows.

    Without ``whole`` the rows tell where their text is (``text_source``, NULL
    without one) and don't hold it: texts are looked at where they lie, and
    URLs alone move.
    """
    kind = "string" if whole else "boolean"
    out = window.withColumn("__cached", F.lit(None).cast(kind))
    missing = window
    if content is not None:
        cached = _one_text(restrict_to(content.select("url", "text"), window, "url"), "__cached", whole)
        out = window.join(cached, "url", "left")
        missing = window.select("url").join(cached.select("url"), "url", "left_anti")
    out = out.withColumn("__fetched", F.lit(None).cast(kind))
    if article_pages is not None:
        wanted = restrict_to(article_pages, missing, "url")
        fetched = _one_text(article_text(wanted, container=container).select("url", "text"), "__fetched", whole)
        out = out.drop("__fetched").join(fetched, "url", "left")
    source = (F.when(F.col("__cached").isNotNull(), F.lit("cache"))
              .when(F.col("__fetched").isNotNull(), F.lit("page")))
    text = {"text": F.coalesce("__cached", "__fetched")} if whole else {}
    return out.withColumns(text | {"text_source": source}).drop("__cached", "__fetched")


def listed(listing_pages: DataFrame, params: IngestParams) -> tuple[DataFrame, DataFrame]:
    """(items, results) of the pages in range, extracted once (Python) and staged for all that read them."""
    landed = page_range(listing_pages, params.start_page, params.max_pages, params.single_page)
    results = materialize(listing_results(landed), "listing")
    return items_of(results), results


def ingest_rows(listing_pages: DataFrame | None, known: DataFrame | None, params: IngestParams, *,
                content: DataFrame | None = None, article_pages: DataFrame | None = None,
                answerer: Answerer | None = None, items: DataFrame | None = None, texts: bool = True) -> DataFrame:
    """PIP1 as one plan: the archive rows this run appends (plus page/pos and the answers' particulars).

    Without ``texts`` the rows have no ``text``, and texts move only if the answerer reads them.
    """
    if items is None:
        items, _ = listed(listing_pages, params)
    window = crawl_window(items, known=known, as_of=params.as_of, lookback_days=params.lookback_days,
                          start_page=params.start_page, max_pages=params.max_pages,
                          single_page=params.single_page, mode=params.mode)
    # the window feeds several joins: each reads rows, not the crawl plan
    window = materialize(window, "window")
    rows = window_text(window, content, article_pages, params.container, whole=texts or reads_text(answerer))
    today = params.as_of.strftime("%Y-%m-%d")
    rows = rows.withColumn("text_file", text_file_path(params.output_dir, "date", "title", today))
    if answerer is not None:
        # staged: the texts go to the model step and to the rows
        rows = annotate(materialize(rows, "texts"), answerer, keys=("page", "pos"), topic=params.topic)
        rows = rows.withColumn("relevance_topic",
                               F.when(F.col("relevant_eo").isNotNull(), F.lit(params.topic or "")))
    else:
        kinds = {"latency_ms": "double", "n_attempts": "int"}
        rows = rows.withColumns({c: F.lit(None).cast(kinds.get(c, "string"))
                                 for c in (*PARSED_COLUMNS, "relevance_topic", *ANSWER_COLUMNS)})
    return rows.withColumn("types", join_types("types")).select(
        "page", "pos", *ARCHIVE_COLUMNS, *(["text"] if texts else []), "text_source", *ANSWER_COLUMNS)


def run_ingest(listing_pages: DataFrame, archive_path: str, params: IngestParams, **kw) -> dict:
    """One run over landed listing pages: see :func:`ingest_items`."""
    items, results = listed(listing_pages, params)
    return ingest_items(items, results, archive_path, params, **kw)


def ingest_items(items: DataFrame, results: DataFrame | None, archive_path: str, params: IngestParams, *,
                 name: str | None = None, content: DataFrame | None = None, article_pages: DataFrame | None = None,
                 answerer: Answerer | None = None, content_path: str | None = None, known_path: str | None = None,
                 pages_path: str | None = None, retry_path: str | None = None, update_missing: bool = False) -> dict:
    """Append one run's new items to the silver archive; returns run metrics (AGG10).

    ``name``: the run's batch; give the same one to repeat a run.
    ``content_path``: texts extracted from pages in this run are added to the
    content table (SNK2) and found there by later runs.
    ``known_path``: known URLs come from the known-URL table, which gets the
    run's new ones; otherwise the archive's URL column is scanned.
    ``pages_path``: a row per listing page (items found, items new, error) is
    added to that table (``results`` are the extraction's rows).
    ``retry_path``: the outcome of every answered row goes to the retry table.
    ``update_missing``: afterwards the topic's rows without a summary are
    filled in (PIP2).
    """
    spark = items.sparkSession
    name = name or new_batch()
    known = read_known(spark, known_path, params.topic, name) if known_path else known_in_topic(spark, archive_path, params.topic, name)
    if content is None and content_path:
        content = read_content(spark, content_path, but=name)
    # texts and whole answers are kept only for the tables that take them
    rows = ingest_rows(None, known, params, content=content, article_pages=article_pages, answerer=answerer, items=items,
                       texts=bool(content_path))
    rows = stage(rows if retry_path else rows.drop("response"), "ingest")
    m = rows.agg(F.count(F.lit(1)).alias("n"), F.count("relevant_eo").alias("a"), F.count("error").alias("e"),
                 F.count_if(F.col("text_source") == "page").alias("f")).first()
    if content_path and m["f"]:
        append_content(rows.filter(F.col("text_source") == "page"), content_path, name)
    if retry_path:
        record_outcomes(rows, retry_path, name)
    bad = 0
    if results is not None:
        bad = unreadable(results).count()
        if pages_path:
            page_counts(results, rows).withColumn("batch", F.lit(name)).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(pages_path)
    if m["n"]:
        if known_path:
            append_known(rows, known_path, params.topic, name)
        append_silver(silver_of_topic(rows.select(*ARCHIVE_COLUMNS), params.topic), archive_path, name, gathered=True)
    updated = 0
    if update_missing and answerer is not None:
        updated = run_backfill(spark, archive_path, answerer, topic=params.topic, dataset=params.topic or "",
                               output_dir=params.output_dir, today=params.as_of.strftime("%Y-%m-%d"), content=content,
                               article_pages=article_pages, container=params.container, name=f"{name}-missing")
    return {"new": m["n"], "annotated": m["a"], "failed": m["e"], "fetched": m["f"], "updated": updated, "unreadable_pages": bad}
