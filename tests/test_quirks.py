"""Quirk register: each decision pinned by a case."""

import datetime as dt

import pytest
from pyspark.sql import functions as F


from offline import offline
from quarry.operators.annotate import annotate
from quarry.operators.crawl import crawl_window
from quarry.operators.filters import dashboard_filter, search
from quarry.plans.backfill import run_backfill_csv
from quarry.sources.archive import ARCHIVE_COLUMNS, read_archive_csv, to_silver, write_archive_csv

AS_OF = dt.datetime(2025, 12, 31, 12)
SCHEMA = ",".join(f"{c} string" for c in ARCHIVE_COLUMNS)


def silver(spark, rows):
    return to_silver(spark.createDataFrame(rows, SCHEMA))


def row(date="May 1, 2025", title="t", url="u", types="", desc=None, rel=None, full=None):
    return (date, title, url, types, None, desc, None, rel, full)


def test_q3_date_end_inclusive_and_compat(spark):
    s = silver(spark, [row("May 1, 2025", url="a"), row("May 2, 2025", url="b"), row("", url="c")])
    assert dashboard_filter(s, date_range=("2025-04-30", "2025-05-01")).count() == 1
    assert dashboard_filter(s, date_range=("2025-04-30", "2025-05-01"), compat=True).count() == 2


def test_q4_types_substring_and_exact(spark):
    s = silver(spark, [row(types="Presidential Memoranda", url="a"), row(types="Memoranda; X", url="b")])
    assert dashboard_filter(s, types=["Memoranda"]).count() == 2
    assert dashboard_filter(s, types=["Memoranda"], exact_types=True).count() == 1


def test_q5_regex_search_checked_on_driver(spark):
    with pytest.raises(ValueError):
        search("ab(")
    s = silver(spark, [row(title="A.B"), row(title="AxB", url="v")])
    assert dashboard_filter(s, query="a.b").count() == 2
    assert dashboard_filter(s, query="a.b", literal=True).count() == 1


def test_q6_repeated_url_kept_once(spark):
    items = spark.createDataFrame(
        [(1, 0, "May 3, 2025", "x", "dup", ["a"]), (1, 1, "May 3, 2025", "y", "u1", ["a"]),
         (2, 0, "May 2, 2025", "z", "dup", ["a"])],
        "page int, pos int, date string, title string, url string, types array<string>")
    out = crawl_window(items, as_of=AS_OF).orderBy("page", "pos").collect()
    assert [(r.page, r.pos, r.url) for r in out] == [(1, 0, "dup"), (1, 1, "u1")]
    assert crawl_window(items, as_of=AS_OF, dedup=False).count() == 3


def test_q7_max_pages_zero_means_one(spark):
    items = spark.createDataFrame([(p, 0, "May 3, 2025", "t", f"u{p}", ["a"]) for p in (1, 2, 3)],
                                  "page int, pos int, date string, title string, url string, types array<string>")
    assert crawl_window(items, max_pages=0).count() == 1
    assert crawl_window(items, max_pages=2).count() == 2
    assert crawl_window(items).count() == 3


def test_page_gap_and_known_stop(spark):
    items = spark.createDataFrame(
        [(1, 0, "May 9, 2025", "t", "a", ["x"]), (1, 1, "May 8, 2025", "t", "b", ["x"]),
         (2, 0, "May 7, 2025", "t", "c", ["x"]), (4, 0, "May 6, 2025", "t", "d", ["x"])],
        "page int, pos int, date string, title string, url string, types array<string>")
    assert sorted(r.url for r in crawl_window(items).collect()) == ["a", "b", "c"]   # page 3 missing
    assert crawl_window(items, start_page=3).count() == 0                           # start page empty
    known = spark.createDataFrame([("b",)], "url string")
    assert [r.url for r in crawl_window(items, known=known).collect()] == ["a"]
    # lookback: May 8 is older than May 9 12:00 - 1 day; unparseable dates never stop
    cut = crawl_window(items, as_of=dt.datetime(2025, 5, 9, 12), lookback_days=1)
    assert [r.url for r in cut.collect()] == ["a"]


def test_q8_sentinel_and_empty_never_annotated(spark):
    df = spark.createDataFrame([("a", ""), ("b", None), ("c", "Some text here.")], "url string, text string")
    out = {r.url: r for r in annotate(df, offline(), keys=("url",)).collect()}
    assert out["a"].response is None and out["b"].response is None and out["a"].error is None
    assert out["c"].response is not None
    assert out["c"].description == "A text of 3 words and 15 characters."


def test_q12_null_text_never_matches(spark):
    s = silver(spark, [row(desc=None, full=None, title="x")])
    assert dashboard_filter(s, query="nan").count() == 0


def test_q15_iso_dates_do_not_stop_prefix_mode(spark):
    items = spark.createDataFrame(
        [(1, 0, "2020-01-01", "t", "a", ["x"]), (1, 1, "May 8, 2025", "t", "b", ["x"])],
        "page int, pos int, date string, title string, url string, types array<string>")
    assert crawl_window(items, as_of=AS_OF, lookback_days=15).count() == 1           # ISO can't stop
    assert crawl_window(items, as_of=AS_OF, lookback_days=15, mode="filter").count() == 0


def test_backfill_csv_round_trip(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [row(url="u1", title="One", desc="done", rel="Yes"), row(url="u2", title="Two")]
    write_archive_csv(spark.createDataFrame(rows, SCHEMA).coalesce(1), src, mode="overwrite")
    content = spark.createDataFrame([("u1", "Text one."), ("u2", "Text two is here.")], "url string, text string")
    n = run_backfill_csv(spark, src, out, offline(), content=content, topic="Env")
    got = {r.url: r for r in read_archive_csv(spark, out).collect()}
    assert n == 1 and got["u1"].description == "done" and got["u1"].relevance_topic in (None, "")
    assert got["u2"].description == "A text of 4 words and 17 characters."
    assert got["u2"].relevance_topic == "Env"
    assert read_archive_csv(spark, src).filter(F.col("url") == "u2").first().description is None


def test_items_without_url_are_all_kept(spark):
    items = spark.createDataFrame(
        [(1, 0, "May 3, 2025", "x", "", ["a"]), (1, 1, "May 3, 2025", "y", "", ["a"]),
         (1, 2, "May 3, 2025", "z", "u", ["a"]), (1, 3, "May 3, 2025", "w", "u", ["a"])],
        "page int, pos int, date string, title string, url string, types array<string>")
    assert sorted(r.title for r in crawl_window(items).collect()) == ["x", "y", "z"]


def test_backfill_duplicate_rows_do_not_fan_out(spark):
    from quarry.plans.backfill import backfill_rows
    rows = [row(url="d", title="Dup"), row(url="d", title="Dup"), row(url="d", title="Other"),
            row(url="e", title="Done", desc="x", rel="Yes")]
    archive = spark.createDataFrame(rows, SCHEMA)
    content = spark.createDataFrame([("d", "One two three."), ("e", "Four.")], "url string, text string")
    out = backfill_rows(archive, offline(), content=content).collect()
    assert len(out) == 4
    updated = [r for r in out if r.updated]
    assert len(updated) == 3 and {r.description for r in updated} == {"A text of 3 words and 14 characters."}
    assert [r.description for r in out if r.url == "e"] == ["x"]
