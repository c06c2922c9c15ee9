"""Landing tables derived from the driver's parquet tables.

The archive, listing pages, model answers and content cache the jobs work
on are derived, row for row, from ``documents``, ``labels`` and ``pages``
(the derivation is the one documented in FIXTURES.md), so every query's work
grows with those tables.  Each builder here is a plain DataFrame plan; the
matching DuckDB text lives in ``quarry.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import clean_text

# --- fixed values -----------------------------------------------------------
# Newest archive day, the days the archive spans and the listing geometry.
LAST_DAY = "2025-12-31"
SPAN_DAYS = 400
ITEMS_PER_PAGE = 10
URL_PREFIX = "https://example.org/a/"
# Known archive, in thousandths of the documents: everything from here on, and
# one early hit inside the new ground.
KNOWN_FROM = 600
KNOWN_EARLY_HIT = 457
# Declared schemas of the landed tables (no inference from file footers).
SCHEMAS = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}
# Recorded answers: which calls failed (by document number) and how.
FIRST_FAILS = (5, 2)         # number % 5 = 2: the first model's call
FALLBACK_FAILS = (25, 7)     # number % 25 = 7: the fallback's, too
LATER_FAILS = (50, 32)       # number % 50 = 32: both again in the next round
RATE_LIMIT = "RateLimitError: 429"
NO_ANSWER = "EmptyAnswer"
MODELS = ("gpt-4o", "gpt-4o-mini")
# Every so many pages one wasn't fetched; every so many listings one is missing.
UNFETCHED = (13, 5)
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A landed table; known tables are read with their declared schema."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def url_of(number: Column) -> Column:
    """The archive URL of a document number; no two numbers share one."""
    return F.concat(F.lit(URL_PREFIX), number.cast("string"))


def size_of(spark: SparkSession, sf_dir: str):
    """Largest document id + 1, as a scalar subquery: positions are shares of it."""
    return table(spark, sf_dir, "documents").agg(F.max("doc_id") + 1).scalar()


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive as the crawler wrote it (bronze columns + doc_id/page/pos).

    Titles are first lines, descriptions first paragraphs and full summaries
    whole texts; the documents are spread over ``SPAN_DAYS``, newest first.
    """
    # titles are cut before the join: who wants no more of the text than those doesn't move it
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.trim(F.substring_index("text", "\n", 1)).alias("title"), "text", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    d = docs.join(labels, "doc_id", "left").withColumn(
        "day", F.date_sub(F.lit(LAST_DAY).cast("date"),
                          F.floor(F.col("doc_id") * SPAN_DAYS / size_of(spark, sf_dir)).cast("int")))
    i = F.col("doc_id")
    date = (F.when(i % 97 == 96, F.lit(""))
            .when(i % 4 == 3, F.date_format("day", "yyyy-MM-dd"))
            .when(i % 4 == 2, F.date_format("day", "dd-MMM-yy"))
            .otherwise(F.date_format("day", "MMMM d, yyyy")))
    q, t = F.col("quality"), F.col("toxic")
    return d.select(
        "doc_id",
        (F.floor(i / ITEMS_PER_PAGE).cast("int") + 1).alias("page"),
        (i % ITEMS_PER_PAGE).cast("int").alias("pos"),
        date.alias("date"),
        "title",
        url_of(i).alias("url"),
        F.when(i % 11 == 10, F.lit("no types"))
        .otherwise(F.concat("source", F.lit("; "), "lang")).alias("types"),
        F.lit(None).cast("string").alias("text_file"),
        F.when(q.isNotNull() & (i % 7 != 0), F.substring_index("text", "\n\n", 1)).alias("description"),
        F.col("source").alias("relevance_topic"),
        F.when((q == 1) & (t == 0), F.lit("Yes")).when(q == 1, F.lit("Maybe - see details"))
        .when(q == 0, F.lit("No.")).alias("relevant_eo"),
        F.when(q == 1, F.col("text")).alias("full_summary"),
    )


def known(spark: SparkSession, sf_dir: str, archive: DataFrame | None = None) -> DataFrame:
    """URLs already in the archive before this run (from ``archive`` if given,
    so one derivation of the archive serves a whole query)."""
    a = archive if archive is not None else actions(spark, sf_dir)
    n = size_of(spark, sf_dir)
    return a.filter((F.col("doc_id") * 1000 >= n * KNOWN_FROM)
                    | (F.col("doc_id") == F.floor(n * KNOWN_EARLY_HIT / 1000))).select("url")


def _esc(c):
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))


def listing_pages(archive: DataFrame) -> DataFrame:
    """One listing HTML page per ``page``: the archive rendered newest first.

    Blank dates get no date tag and ``no types`` no category tag, like the
    live listing would.  One shuffle on ``page`` (ten rows per group).
    """
    li = F.concat(
        F.lit('<li class="wp-block-post"><h2 class="wp-block-post-title"><a href="'),
        F.col("url"), F.lit('"> '), _esc(F.col("title")), F.lit(" </a></h2>"),
        F.when(F.col("date") == "", F.lit("")).otherwise(
            F.concat(F.lit('<div class="wp-block-post-date"><time>'), F.col("date"),
                     F.lit("</time></div>"))),
        F.when(F.col("types") == "no types", F.lit("")).otherwise(
            F.concat(F.lit('<div class="taxonomy-category"><a>'),
                     F.replace(F.col("types"), F.lit("; "), F.lit("</a><a>")), F.lit("</a></div>"))),
        F.lit("</li>"))
    items = archive.select("page", "pos", li.alias("li"))
    return items.groupBy("page").agg(
        F.concat(F.lit("<ul>"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "li"))),
                                          lambda s: s["li"]), ""),
                 F.lit("</ul>")).alias("html"))


def _said(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, said): the first answer of each conversation."""
    turns = table(spark, sf_dir, "conversations").filter("role = 'assistant'")
    return turns.groupBy("conv_id").agg(F.min_by("text", "turn").alias("said"))


def conversations_n(spark: SparkSession, sf_dir: str):
    return table(spark, sf_dir, "conversations").agg(F.max("conv_id") + 1).scalar()


def document_answers(spark: SparkSession, sf_dir: str, refused: Column | None = None, of: DataFrame | None = None) -> DataFrame:
    """(doc_id, url, response, other): what a model said about each document, in given texts.

    Labelled documents: the document's first line, its grade and the rest of
    it, as labelled lines, numbered lines or bare lines.  Others: the first
    answer of the conversation with the document's number (``other``: of the
    next one), which follows no form at all.  ``other`` is there where
    ``response`` isn't and where ``refused`` (of ``doc_id``) says that the
    response won't do.  ``of``: the URLs (each once) whose documents are asked for.

    Every table is joined by URL, like the answers are later, so a text moves
    once; conversations are looked up by number alone and only for documents
    that need them.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", url_of(F.col("doc_id")).alias("url"), "text")
    narrow = docs.select("doc_id", "url", F.col("text").isNull().alias("blank"))
    if of is not None:
        docs, narrow = (d.join(of, "url", "left_semi") for d in (docs, narrow))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    n, i, nl = conversations_n(spark, sf_dir), F.col("doc_id"), F.lit("\n")
    said = _said(spark, sf_dir)
    first = F.trim(F.substring_index("text", "\n", 1))
    rest = F.expr("substr(text, length(substring_index(text, '\n', 1)) + 2)")
    grade = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit("Yes")).when(F.col("quality") == 1, F.lit("Maybe, in part")).otherwise(F.lit("No"))
    formed = (F.when(i % 3 == 0, F.concat(F.lit("Summary: "), first, nl, F.lit("Relevant: "), grade, nl, F.lit("Details: "), rest))
              .when(i % 3 == 1, F.concat(F.lit("1. Summary: "), first, nl, F.lit("2. Relevance: "), grade, nl, F.lit("3. "), rest))
              .otherwise(F.concat(first, nl, nl, F.lit("- "), F.lower(grade), nl, rest)))
    numbers = narrow.filter(i.isNotNull()).join(
        labels.select("doc_id", "quality"), "doc_id", "left").groupBy("doc_id").agg(
        F.bool_or(F.col("quality").isNull()).alias("bare"),
        F.coalesce(F.bool_or("blank" if refused is None else F.col("blank") | refused), F.lit(False)).alias("again"))

    def asking(step: int) -> DataFrame:
        return numbers.withColumn("conv_id", (i + step) % n)
    # a labelled document that has a text has its own response, others have one if somebody said something
    unheard = asking(0).filter("bare and not again").join(said.filter("said is not null").select("conv_id"), "conv_id", "left_anti")
    second = asking(1).filter("again").unionByName(unheard.withColumn("conv_id", (i + 1) % n))

    def told(asked: DataFrame, name: str) -> DataFrame:
        return asked.select("doc_id", "conv_id").join(said, "conv_id").select(url_of(i).alias("url"), F.col("said").alias(name))
    rows = docs.join(labels.select(url_of(i).alias("url"), "quality", "toxic"), "url", "left")
    return (rows.join(told(asking(0).filter("bare"), "said"), "url", "left").join(told(second, "other"), "url", "left")
            .select("doc_id", "url", F.when(F.col("quality").isNotNull(), formed).otherwise(F.col("said")).alias("response"), "other"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, response): every recorded answer: one per document, and all assistant turns."""
    docs = document_answers(spark, sf_dir).select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("source"), "response")
    turns = table(spark, sf_dir, "conversations").filter("role = 'assistant'").select(
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("source"),
        F.col("text").alias("response"))
    return docs.unionByName(turns)


def attempts(spark: SparkSession, sf_dir: str, later: bool = False, of: DataFrame | None = None) -> DataFrame:
    """(url, attempt, model, response, error, latency_ms): the recorded calls for each archive URL, or each URL in ``of``.

    The first model's calls fail for a fifth of the documents, or give
    nothing; then the fallback was asked, which fails for some of them.
    ``later``: the calls of the next round, for those without an answer.
    Latencies are the events' values, by number.
    """
    i = F.col("doc_id")
    fails = lambda rule: i % rule[0] == rule[1]
    first_failed, second_failed = (fails(LATER_FAILS),) * 2 if later else (fails(FIRST_FAILS), fails(FALLBACK_FAILS))
    # events after the last document are nobody's
    ev = table(spark, sf_dir, "events").select("event_id", "value").filter(F.col("event_id") <= size_of(spark, sf_dir))
    rows = (document_answers(spark, sf_dir, refused=first_failed, of=of)
            .join(ev.select(url_of(F.col("event_id")).alias("url"), F.col("value").alias("l1")), "url", "left")
            .join(ev.select(url_of(F.col("event_id") - 1).alias("url"), F.col("value").alias("l2")), "url", "left"))

    def call(attempt, model, failed, text, latency):
        error = F.when(failed, F.lit(RATE_LIMIT)).when(text.isNull(), F.lit(NO_ANSWER))
        return F.struct(F.lit(attempt).alias("attempt"), F.lit(model).alias("model"), F.when(error.isNull(), text).alias("response"),
                        error.alias("error"), F.col(latency).alias("latency_ms"))
    first = call(1, MODELS[0], first_failed, F.col("response"), "l1")
    second = call(2, MODELS[1], second_failed, F.col("other"), "l2")
    calls = rows.select("url", F.when(first["error"].isNull(), F.array(first)).otherwise(F.array(first, second)).alias("calls"))
    return calls.select("url", F.inline("calls"))


def fetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article pages ``(page_id, url, html)`` as fetched: every so many have no html."""
    every, which = UNFETCHED
    return article_pages(spark, sf_dir).withColumn("html", F.when(F.col("page_id") % every != which, F.col("html")))


def article_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw article pages ``(page_id, url, html)`` as landed."""
    return table(spark, sf_dir, "pages").select("page_id", "url", "html")


def content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cached article text per archive URL (cleaned, like extraction output)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select(url_of(F.col("doc_id")).alias("url"),
                       clean_text("text").alias("text"))
