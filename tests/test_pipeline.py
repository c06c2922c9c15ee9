"""Ingest and backfill jobs: idempotence, write-back, fallback and error isolation."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from table_paths import SF001
from offline import offline
from quarry.operators.annotate import annotate, latency_report, recorded
from quarry.operators.filters import missing_summary
from quarry.plans.backfill import backfill_rows, run_backfill
from quarry.plans.ingest import IngestParams, ingest_rows, run_ingest
from quarry.sources import landing as LD
from quarry.sources.archive import append_silver, read_silver, to_silver

AS_OF = dt.datetime(2025, 12, 31, 12, 0, 0)


@pytest.fixture(scope="module")
def pages(spark):
    return LD.listing_pages(LD.actions(spark, SF001)).cache()


def test_ingest_twice_adds_nothing(spark, pages, tmp_path):
    arch = str(tmp_path / "silver")
    p = IngestParams(as_of=AS_OF, lookback_days=None, topic="T")
    first = run_ingest(pages, arch, p, content=LD.content(spark, SF001),
                       answerer=offline())
    assert first == {"new": 198, "annotated": 198, "failed": 0, "fetched": 0, "updated": 0, "unreadable_pages": 0}
    second = run_ingest(pages, arch, p, content=LD.content(spark, SF001),
                        answerer=offline())
    assert second["new"] == 0
    s = spark.read.parquet(arch)
    assert s.count() == 198 and s.select("url").distinct().count() == 198
    assert s.filter("relevance_topic = 'T'").count() == 198
    assert set(r.topic_slug for r in s.select("topic_slug").distinct().collect()) == {"T"}


def test_two_topics_on_one_archive(spark, pages, tmp_path):
    arch = str(tmp_path / "silver")
    runs = [run_ingest(pages, arch, IngestParams(as_of=AS_OF, lookback_days=None, topic=t)) for t in ("A", "0075", "A")]
    assert [m["new"] for m in runs] == [198, 198, 0]
    from quarry.sources.archive import read_silver
    got = {r.topic_slug: r["count"] for r in read_silver(spark, arch).groupBy("topic_slug").count().collect()}
    assert got == {"A": 198, "0075": 198}      # rows without an answer stay in their topic


def test_repeated_content_does_not_multiply_rows(spark, pages):
    content = LD.content(spark, SF001)
    twice = content.unionByName(content.withColumn("text", F.concat("text", F.lit("x"))))
    rows = ingest_rows(pages, None, IngestParams(as_of=AS_OF, lookback_days=None), content=twice)
    assert rows.count() == 198 and rows.select("url").distinct().count() == 198


def test_ingest_lookback_and_pages(spark, pages):
    rows = ingest_rows(pages, None, IngestParams(as_of=AS_OF, lookback_days=15))
    # 15 days back from 2025-12-31 12:00 keeps the newest ~45 items; unannotated
    dates = [r.date for r in rows.collect()]
    assert 0 < len(dates) < 60
    assert rows.filter(F.col("description").isNotNull()).count() == 0
    one = ingest_rows(pages, None, IngestParams(as_of=AS_OF, lookback_days=None, start_page=2,
                                                single_page=True))
    assert set(r.page for r in one.collect()) == {2}


def test_prefix_is_subset_of_filter(spark, pages):
    known = LD.actions(spark, SF001).filter("doc_id >= 120").select("url")
    prefix = ingest_rows(pages, known, IngestParams(as_of=AS_OF, lookback_days=40))
    filt = ingest_rows(pages, known, IngestParams(as_of=AS_OF, lookback_days=40, mode="filter"))
    a = set(r.url for r in prefix.collect())
    b = set(r.url for r in filt.collect())
    assert a and a <= b


def test_backfill_leaves_complete_rows(spark, tmp_path):
    arch = LD.actions(spark, SF001).drop("page", "pos")
    out = backfill_rows(arch, offline(), content=LD.content(spark, SF001), today="2025-12-31")
    before = {r.url: r for r in arch.collect()}
    after = {r.url: r for r in out.collect()}
    assert len(after) == len(before)
    for url, b in before.items():
        a = after[url]
        if not a.updated:
            assert (a.description, a.relevant_eo, a.full_summary) == (b.description, b.relevant_eo,
                                                                       b.full_summary)
        else:
            assert a.description and a.relevant_eo in ("Yes", "No", "Maybe")
            assert a.relevance_topic == b.relevance_topic   # no topic given: keep the old one (Q1)
            assert a.text_file.endswith(".txt")
    assert out.filter("updated").count() == arch.filter(missing_summary()).count()


def _files(path):
    import os
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_backfill_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "silver")
    actions = LD.actions(spark, SF001).drop("doc_id", "page", "pos")
    append_silver(to_silver(actions), path, "b")
    # a row without a topic of its own that belongs to the dataset 0075
    from quarry.sources.archive import silver_of_topic
    append_silver(silver_of_topic(actions.limit(3).withColumn("relevance_topic", F.lit(None).cast("string")), "0075"), path, "odd")
    before, n = _files(path), read_silver(spark, path).filter(missing_summary()).filter("topic_slug = 'src1'").count()
    got = run_backfill(spark, path, offline(), dataset="src1", topic="Env", content=LD.content(spark, SF001))
    after = _files(path)
    assert got == n > 0
    assert {f for f in before if f.startswith("topic_slug=src1/")}.isdisjoint(after)
    assert {f: t for f, t in before.items() if not f.startswith("topic_slug=src1/")} == {
        f: t for f, t in after.items() if not f.startswith("topic_slug=src1/")}
    rows = read_silver(spark, path)
    assert rows.count() == 203 and rows.filter("topic_slug = 'src1'").filter(missing_summary()).count() == 0
    run_backfill(spark, path, offline(), dataset="0075", topic="Env", content=LD.content(spark, SF001))
    assert {r.topic_slug for r in read_silver(spark, path).filter("batch = 'odd'").collect()} == {"0075"}
    assert run_backfill(spark, path, offline(), dataset="src1", content=LD.content(spark, SF001)) == 0
    assert run_backfill(spark, str(tmp_path / "none"), offline()) == 0


@pytest.mark.parametrize("stop", ["before the note", "after the note"])
def test_killed_rewrite_blocks_nothing(spark, tmp_path, monkeypatch, stop):
    from quarry.sources import archive as A
    path = str(tmp_path / "silver")
    append_silver(to_silver(LD.actions(spark, SF001).drop("doc_id", "page", "pos")), path, "b")
    calls = []

    def answers(texts, keys, topic):
        calls.append(1)
        return offline()(texts, keys, topic)

    def dead(*_):
        raise RuntimeError("lost here")
    with monkeypatch.context() as m:
        m.setattr(A, "_overwrite_partitions" if stop == "after the note" else "_rewrite_note", dead)
        with pytest.raises(RuntimeError):
            from quarry.plans import backfill as B
            if stop == "before the note":
                m.setattr(B, "staged_rewrite", lambda *_: None)
            B.run_backfill(spark, path, answers, content=LD.content(spark, SF001), name="n")
    first = len(calls)
    n = run_backfill(spark, path, answers, content=LD.content(spark, SF001), name="n")
    assert n > 0 and read_silver(spark, path).filter(missing_summary()).count() == 0
    assert len(calls) == (first if stop == "after the note" else first + 1)
    append_silver(to_silver(LD.actions(spark, SF001).drop("doc_id", "page", "pos").limit(5)), path, "b")
    assert run_backfill(spark, path, answers, name="n") == n             # done: nothing is copied again
    assert read_silver(spark, path).filter("batch = 'b'").count() < 200


def test_run_again_after_any_write(spark, tmp_path, monkeypatch):
    """PIP1: a failure after each write, then the same run again: one copy of every row and text."""
    from quarry.plans import ingest as G
    listing, articles = _listing_over_pages(spark), LD.article_pages(spark, SF001)
    n = articles.count()
    for stop in ("append_content", "record_outcomes", "append_known", "append_silver"):
        base = str(tmp_path / stop)
        kw = dict(name="run", article_pages=articles, content_path=f"{base}/c", known_path=f"{base}/k", retry_path=f"{base}/r",
                  pages_path=f"{base}/p", answerer=offline())
        params = IngestParams(as_of=AS_OF, lookback_days=None, container="article")
        whole = getattr(G, stop)

        def broken(*a, _whole=whole, **k):
            _whole(*a, **k)
            raise RuntimeError("lost here")
        with monkeypatch.context() as m:
            m.setattr(G, stop, broken)
            with pytest.raises(RuntimeError):
                run_ingest(listing, f"{base}/a", params, **kw)
        assert run_ingest(listing, f"{base}/a", params, **kw)["new"] == n
        for x in "ackr":
            assert spark.read.parquet(f"{base}/{x}").count() == n, (stop, x)


def test_unreadable_listing_page_is_reported(spark, pages, tmp_path):
    broken = pages.withColumn("html", F.when(F.col("page") != 4, F.col("html")))
    path = str(tmp_path / "pages")
    m = run_ingest(broken, str(tmp_path / "silver"), IngestParams(as_of=AS_OF, lookback_days=None), pages_path=path)
    assert m["unreadable_pages"] == 1 and 0 < m["new"] < 40             # the crawl ends there, and says so
    got = {r.page: r for r in spark.read.parquet(path).collect()}
    assert got[4].error == "no page" and got[4].n_found == 0 and got[3].n_new == got[3].n_found > 0 and got[5].n_new == 0


def test_recorded_attempts(spark):
    texts = spark.createDataFrame([("a", "t"), ("b", "t"), ("c", "t"), ("d", "t"), ("e", ""), ("f", None)], "url string, text string")
    calls = spark.createDataFrame(
        [("a", 1, "m1", "Summary: A\nRelevant: yes", None, 1.0), ("a", 2, "m2", "late", None, 50.0),
         ("b", 1, "m1", None, "x1", 2.0), ("b", 2, "m2", "one line", None, 3.0),
         ("c", 1, "m1", None, "x1", 4.0), ("c", 2, "m2", None, "x2", 5.0), ("e", 1, "m1", "never sent", None, 9.0)],
        "url string, attempt int, model string, response string, error string, latency_ms double")
    got = {r.url: r for r in annotate(texts, recorded(calls)).collect()}
    pick = lambda u: (got[u].model_used, got[u].error, got[u].latency_ms, got[u].n_attempts, got[u].description, got[u].relevant_eo)
    assert pick("a") == ("m1", None, 1.0, 1, "A", "Yes")
    assert pick("b") == ("m2", None, 5.0, 2, "one line", "No")
    assert pick("c") == (None, "x2", 9.0, 2, None, None)
    assert pick("d") == (None, "no recorded answer", None, 0, None, None)
    assert pick("e") == pick("f") == (None, None, None, None, None, None)


def test_latency_quantiles(spark):
    rows = spark.range(1, 1001).selectExpr("cast(id as double) latency_ms", "'m' model_used", "cast(null as string) error", "1 n_attempts")
    r = latency_report(rows).first()
    assert (r.p50_ms, r.p90_ms, r.p99_ms, r.n_rows, r.n_retries) == (500.0, 900.0, 990.0, 1000, 0)


def test_retries_end(spark, tmp_path):
    from quarry.plans.retries import due, outcomes, record_outcomes, retry_round
    path = str(tmp_path / "r")
    texts = LD.content(spark, SF001).limit(20)
    dead = offline(("gpt-4o", "gpt-4o-mini"))
    record_outcomes(annotate(texts, dead, parse=False), path, "1")
    assert due(outcomes(spark, path)).count() == 20
    for name in ("2", "3"):
        assert retry_round(texts, path, dead, name).count() == 20
    assert retry_round(texts, path, offline(), "4").count() == 0          # six attempts each are used up
    assert retry_round(texts, path, offline(), "4", max_attempts=7).count() == 20
    assert due(outcomes(spark, path), 100).count() == 0


def test_fallback_and_error_isolation(spark):
    df = LD.content(spark, SF001).limit(20)
    fb = annotate(df, offline(("gpt-4o",)), keys=("url",))
    rows = fb.collect()
    assert {r.model_used for r in rows} == {"gpt-4o-mini"} and all(r.error is None for r in rows)
    dead = annotate(df, offline(("gpt-4o", "gpt-4o-mini")), keys=("url",))
    rows = dead.collect()
    assert len(rows) == 20
    assert all(r.response is None and r.description is None and "unavailable" in r.error for r in rows)


def test_concurrent_calls_same_answers(spark):
    df = LD.content(spark, SF001)
    a = annotate(df, offline(concurrency=4, partitions=3), keys=("url",))
    b = annotate(df, offline(), keys=("url",))
    cols = ["url", "description", "relevant_eo", "full_summary"]
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0


def _listing_over_pages(spark):
    """A listing whose items point at the landed article pages (10 per page)."""
    p = LD.article_pages(spark, SF001)
    li = F.concat(F.lit('<li class="wp-block-post"><h2 class="wp-block-post-title"><a href="'),
                  F.col("url"), F.lit('">Page '), F.col("page_id").cast("string"),
                  F.lit('</a></h2><div class="wp-block-post-date"><time>December 1, 2025</time></div></li>'))
    items = p.select((F.floor(F.col("page_id") / 10) + 1).cast("int").alias("page"),
                     F.col("page_id").alias("pos"), li.alias("li"))
    return items.groupBy("page").agg(F.concat_ws("", F.array_sort(F.collect_list(
        F.struct("pos", "li"))).getField("li")).alias("html"))


def test_ingest_fetches_pages_and_saves_content(spark, tmp_path):
    from quarry.operators.extract import article_text
    listing = _listing_over_pages(spark)
    arch, cont = str(tmp_path / "silver"), str(tmp_path / "content")
    m = run_ingest(listing, arch, IngestParams(as_of=AS_OF, lookback_days=None, container="article"),
                   article_pages=LD.article_pages(spark, SF001), content_path=cont,
                   answerer=offline())
    n_pages = LD.article_pages(spark, SF001).count()
    assert m["new"] == n_pages and m["fetched"] == n_pages and m["annotated"] == n_pages
    saved = spark.read.parquet(cont)
    exp = article_text(LD.article_pages(spark, SF001), container="article").select("url", "text")
    assert saved.select("url", "text").exceptAll(exp).count() == 0
    assert saved.filter(~F.col("text_file").endswith(".txt")).count() == 0


def test_dashboard_frames(spark, tmp_path):
    import csv
    import glob
    import os

    from quarry.plans.report import dashboard
    from quarry.sources.archive import export_csv
    s = to_silver(LD.actions(spark, SF001).drop("doc_id", "page", "pos"))
    d = dashboard(s, relevance="Yes", types=["en"])
    k = d["kpis"].first()
    b = {r.label: r.n_actions for r in d["relevance_breakdown"].collect()}
    assert k.total_actions == 200 == sum(b.values())          # AGG2 + Unlabeled = AGG1
    assert b.get("Yes", 0) == k.n_yes and b.get("No", 0) == k.n_no
    n = d["table"].count()
    assert n == s.filter("relevance = 'Yes' and types like '%en%'").count() > 0
    out = str(tmp_path / "export")
    export_csv(d["export"].coalesce(1), out)
    rows = []
    for f in glob.glob(os.path.join(out, "*.csv")):
        with open(f, newline="", encoding="utf-8") as fh:
            rows += list(csv.DictReader(fh))
    assert len(rows) == n and "date_dt" not in rows[0] and {"relevance", "relevant_eo"} <= set(rows[0])


def test_scheduled_preset(spark, pages, tmp_path):
    from quarry.plans.ingest import SCHEDULED_TOPIC, run_scheduled
    m = run_scheduled(pages, str(tmp_path / "silver"), AS_OF, content=LD.content(spark, SF001),
                      answerer=offline())
    s = spark.read.parquet(str(tmp_path / "silver"))
    # 15-day lookback from 2025-12-31 12:00, topic stamped on every annotated row
    assert 0 < m["new"] == s.count() < 60
    assert s.filter(F.col("relevance_topic") != SCHEDULED_TOPIC).count() == 0


def test_known_table_dedups_by_topic(spark, pages, tmp_path):
    from quarry.sources.archive import read_known
    arch, known = str(tmp_path / "silver"), str(tmp_path / "known")
    p = IngestParams(as_of=AS_OF, lookback_days=None)
    assert run_ingest(pages, arch, p, known_path=known)["new"] == 198
    assert run_ingest(pages, arch, p, known_path=known)["new"] == 0 and spark.read.parquet(arch).count() == 198
    assert read_known(spark, known).count() == 198 and read_known(spark, known, "other").count() == 0


def test_known_table_of_another_session(spark, tmp_path):
    """A session that hasn't declared the table finds its partitions."""
    from quarry.sources.archive import append_known, known_table, read_known
    path = str(tmp_path / "it's known")
    append_known(spark.range(5).selectExpr("concat('u', id) as url"), path, "a topic", "b1")
    spark.sql(f"DROP TABLE {known_table(spark, path)}")
    assert read_known(spark, path, "a topic").count() == 5


def test_content_table(spark, tmp_path):
    from quarry.plans.ingest import window_text
    from quarry.sources.archive import append_content, read_content
    path = str(tmp_path / "content")
    for _ in range(2):
        append_content(LD.content(spark, SF001).withColumn("text_file", F.lit("t.txt")), path, "b")
    window = LD.actions(spark, SF001).filter("page = 2").select("url")
    got = window_text(window, read_content(spark, path), None)
    exp = {r.url: r.text for r in LD.content(spark, SF001).join(window, "url").collect()}
    assert {r.url: r.text for r in got.collect()} == exp and len(exp) == 10
    assert read_content(spark, path, but="b").count() == 0
