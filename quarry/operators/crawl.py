"""The crawl window (survey section 2.6: CRW1, FIL1-FIL5, JOIN1-JOIN2, SET1, SET3).

The crawler walks a newest-first listing page by page and stops at the first
item it already knows, the first item older than the lookback, or the first
page with no items.  Relationally that is an *ordered prefix*:

    stop   = min over (page, pos) of every stop candidate
    window = items with (page, pos) < stop       (all items when no stop)

Both the stop candidates and the first page gap come from one small table
with a row per page (its first known or too-old position), computed in one
aggregate over the items and written to the shared folder; the stop is a
scalar subquery over it and the window a plain filter on the items: no global
sort, no unpartitioned window function, no join with the stop row.

``mode="filter"`` is the order-insensitive batch form: every item that is not
known and not older than the cutoff.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.dates import lookback_cutoff, older_than, parse_archive_date, parse_ingest_date
from quarry.operators.joins import first_by, restrict_to
from quarry.session import materialize


def position():
    """The (page, pos) struct; struct order is lexicographic."""
    return F.struct(F.col("page").alias("page"), F.col("pos").alias("pos"))


def page_range(items: DataFrame, start_page: int = 1, max_pages: int | None = None,
               single_page: bool = False) -> DataFrame:
    """FIL5/LIM1: pages ``start .. start + n - 1`` (``n >= 1``; None = unlimited)."""
    n = 1 if single_page else (None if max_pages is None else max(int(max_pages), 1))
    cond = F.col("page") >= start_page
    if n is not None:
        cond = cond & (F.col("page") <= start_page + n - 1)
    return items.filter(cond)


def complete_items(items: DataFrame) -> DataFrame:
    """FIL1: items with both a title link and a date tag."""
    return items.filter(F.col("date").isNotNull() & F.col("title").isNotNull())


def known_hits(items: DataFrame, known: DataFrame) -> DataFrame:
    """JOIN2: the distinct item URLs that the archive already holds.

    The archive's URL set is scanned once and reduced to the listed URLs, so
    the result is no larger than the listing.  AQE broadcasts the listing's
    URLs when their measured bytes allow; else a known-URL table, which is
    bucketed by URL, is joined where it lies and only the listing is
    exchanged, and a plain archive shuffles both.
    """
    return restrict_to(known.select("url"), items, "url").distinct()


def page_stops(items: DataFrame, *, known: DataFrame | None = None, cutoff=None,
               parse=parse_ingest_date) -> DataFrame:
    """(page, first): each present page and its first known or too-old position (or NULL)."""
    flagged = items.select("page", "pos", "url", "date")
    hit = F.lit(False)
    if known is not None:
        seen = known_hits(items, known)
        flagged = flagged.join(seen.select("url", F.lit(True).alias("__known")), "url", "left")
        hit = F.coalesce(F.col("__known"), F.lit(False))
    if cutoff is not None:
        hit = hit | F.coalesce(older_than(parse("date"), cutoff), F.lit(False))
    return flagged.groupBy("page").agg(F.min(F.when(hit, F.col("pos"))).alias("first"))


def stop_position(items: DataFrame, *, known: DataFrame | None = None, cutoff=None,
                  parse=parse_ingest_date, page_gap: bool = True,
                  start_page: int = 1) -> Column | None:
    """The first stop candidate in (page, pos) order, as a scalar subquery column.

    Candidates: the first known or too-old item (FIL2, FIL3) and, with
    ``page_gap``, position -1 of the first page without items at or after the
    start page (FIL4).  None when no stop condition is configured.
    """
    if known is None and cutoff is None and not page_gap:
        return None
    pages = materialize(page_stops(items, known=known, cutoff=cutoff, parse=parse), "page-stops")
    kind, pos = items.schema["page"].dataType, items.schema["pos"].dataType
    at = [pages.filter("first is not null").select("page", F.col("first").alias("pos"))]
    if page_gap:
        after = pages.select((F.col("page") + 1).cast(kind).alias("page")).join(pages.select("page"), "page", "left_anti")
        missing = F.when(F.count_if(F.col("page") == start_page) == 0, F.lit(start_page).cast(kind))
        start = pages.agg(missing.alias("page")).filter("page is not null")
        at += [x.select("page", F.lit(-1).cast(pos).alias("pos")) for x in (after, start)]
    return reduce(DataFrame.unionByName, at).agg(F.min(position())).scalar()


def crawl_window(items: DataFrame, *, known: DataFrame | None = None, as_of=None,
                 lookback_days: int | None = None, start_page: int = 1,
                 max_pages: int | None = None, single_page: bool = False,
                 mode: str = "prefix", dedup: bool = True, page_gap: bool = True) -> DataFrame:
    """New items of one crawl (PIP1's selection step).

    ``items``: ``(page, pos, date, title, url, ...)`` as extracted.
    ``prefix`` mode reproduces the crawler's early exit; dates parse with the
    crawler's two layouts (Q15).  ``filter`` mode keeps every unknown item
    inside the lookback and parses all three layouts.
    ``dedup`` keeps the first occurrence of a URL repeated within the run (Q6).
    """
    its = page_range(complete_items(items), start_page, max_pages, single_page)
    cutoff = lookback_cutoff(as_of, lookback_days) if as_of is not None else None
    if mode == "prefix":
        stop = stop_position(its, known=known, cutoff=cutoff, page_gap=page_gap,
                             start_page=start_page)
        out = its if stop is None else its.filter(F.coalesce(position() < stop, F.lit(True)))
    elif mode == "filter":
        out = its
        if known is not None:
            out = out.join(known_hits(its, known), "url", "left_anti")
        if cutoff is not None:
            out = out.filter(~F.coalesce(older_than(parse_archive_date("date"), cutoff), F.lit(False)))
    else:
        raise ValueError(f"mode must be 'prefix' or 'filter', not {mode!r}")
    return _first_per_url(out) if dedup else out


def _first_per_url(df: DataFrame) -> DataFrame:
    """SET3 for items with a URL; items without one are all kept (a blank
    URL identifies nothing, and the crawler appends every such item)."""
    blank = F.coalesce(F.col("url"), F.lit("")) == ""
    own = F.concat(F.lit("\u0000"), F.col("page").cast("string"), F.lit(":"), F.col("pos").cast("string"))
    keyed = df.withColumn("__url", F.when(blank, own).otherwise(F.col("url")))
    return first_by(keyed, "__url", ("page", "pos")).select(*df.columns)


def new_items(items: DataFrame, known: DataFrame, dedup: bool = True) -> DataFrame:
    """JOIN1 + SET3: items whose URL isn't in the archive, first occurrence each."""
    out = items.join(known_hits(items, known), "url", "left_anti")
    return _first_per_url(out) if dedup else out


def run_metrics(items: DataFrame, window: DataFrame, known: DataFrame) -> DataFrame:
    """AGG10: one row of run counters (known set, items seen, items kept, pages)."""
    k = known.agg(F.count_distinct("url").alias("n_known"))
    seen = items.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_distinct("page").alias("p"))).scalar()
    kept = window.agg(F.count(F.lit(1))).scalar()
    return k.select(F.col("n_known"), seen["n"].alias("n_listed"), seen["p"].alias("n_pages"),
                    kept.alias("n_new"))


def page_counts(results: DataFrame, rows: DataFrame) -> DataFrame:
    """AGG10 per page: items found, items kept by the run, and why a page couldn't be read.

    ``results``: the extraction's row per page; ``rows``: what the run keeps.
    """
    found = results.select("page", F.size("items").cast("long").alias("n_found"), "error")
    kept = rows.groupBy("page").agg(F.count(F.lit(1)).alias("n_new"))
    return found.join(kept, "page", "left").select("page", "n_found", F.coalesce("n_new", F.lit(0).cast("long")).alias("n_new"), "error")
