"""Structured Streaming forms: daily counts (STM3) and incremental ingest (STM1/STM2)."""

import datetime as dt

from pyspark.sql import functions as F

from table_paths import SF001
from quarry.plans.ingest import IngestParams
from quarry.sources import landing as LD
from quarry.streaming.daily import daily_counts_stream_batch
from quarry.streaming.incremental import run_incremental


def test_stream_equals_batch_on_all_days(spark):
    got = {r.day: r.n_events for r in daily_counts_stream_batch(spark, SF001, glob="events.parquet").collect()}
    ev = LD.table(spark, SF001, "events")
    assert got == {r.day: r.n for r in ev.groupBy(F.col("ts").cast("date").alias("day"))
                   .agg(F.count(F.lit(1)).alias("n")).collect()}


def test_late_events_count(spark, tmp_path):
    from quarry.streaming.daily import read_daily_counts, run_daily_counts
    src, out, chk = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "chk")
    for days in ([1, 9], [2, 1]):          # the second file is days late
        (spark.createDataFrame([(dt.datetime(2025, 5, d),) for d in days], "ts timestamp_ntz")
         .write.mode("append").parquet(src))
        run_daily_counts(spark, src, out, chk).awaitTermination()
    got = {r.day.day: r.n_events for r in read_daily_counts(spark, out).collect()}
    assert got == {1: 2, 2: 1, 9: 1}


def test_batch_run_again_after_any_write(spark, tmp_path, monkeypatch):
    """A failure after each of the three writes, then the same batch again: one copy of every row."""
    from quarry.plans import ingest as G
    from quarry.streaming import incremental as I
    from test_pipeline import _listing_over_pages
    params = IngestParams(as_of=dt.datetime(2025, 12, 31, 12), lookback_days=None, container="article")
    pages, articles = _listing_over_pages(spark), LD.article_pages(spark, SF001)
    n = articles.count()
    for stop in ("append_content", "append_known", "append_silver"):
        arch, idx, cont = (str(tmp_path / f"{stop}-{x}") for x in ("a", "i", "c"))
        kw = dict(article_pages=articles, known_path=idx, content_path=cont, name="stream-x-0")
        whole = getattr(G, stop)

        def broken(*a, _whole=whole, **k):
            _whole(*a, **k)
            raise RuntimeError("lost here")
        with monkeypatch.context() as m:
            m.setattr(G, stop, broken)
            try:
                I.ingest_batch(pages, arch, params, **kw)
            except RuntimeError:
                pass
        I.ingest_batch(pages, arch, params, **kw)
        for path in (arch, idx, cont):
            assert spark.read.parquet(path).count() == n, (stop, path)


def test_incremental_ingest(spark, tmp_path):
    pages = LD.listing_pages(LD.actions(spark, SF001))
    land, arch, chk = str(tmp_path / "land"), str(tmp_path / "silver"), str(tmp_path / "chk")
    params = IngestParams(as_of=dt.datetime(2025, 12, 31, 12), lookback_days=None)
    pages.filter("page <= 10").write.parquet(land)
    run_incremental(spark, land, arch, chk, params)
    n1 = spark.read.parquet(arch).count()
    pages.filter("page > 10").write.mode("append").parquet(land)
    pages.filter("page <= 3").write.mode("append").parquet(land)   # re-landed pages
    run_incremental(spark, land, arch, chk, params)
    s = spark.read.parquet(arch)
    assert n1 == LD.actions(spark, SF001).filter("page <= 10 and date <> ''").count()
    assert s.count() == 198 and s.select("url").distinct().count() == 198
    run_incremental(spark, land, arch, chk, params)   # nothing new landed
    assert spark.read.parquet(arch).count() == 198


def test_stream_days_independent_of_session_zone(spark):
    base = {r.day: r.n_events for r in daily_counts_stream_batch(spark, SF001, glob="events.parquet").collect()}
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        other = {r.day: r.n_events for r in
                 daily_counts_stream_batch(spark, SF001, glob="events.parquet").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert other == base


def test_incremental_with_index_and_pages(spark, tmp_path):
    from test_pipeline import _listing_over_pages
    land, arch = str(tmp_path / "land"), str(tmp_path / "silver")
    idx, cont, chk = str(tmp_path / "known"), str(tmp_path / "content"), str(tmp_path / "chk")
    _listing_over_pages(spark).write.parquet(land)
    params = IngestParams(as_of=dt.datetime(2025, 12, 31, 12), lookback_days=None, container="article")
    run_incremental(spark, land, arch, chk, params, article_pages=LD.article_pages(spark, SF001),
                    known_path=idx, content_path=cont)
    n = LD.article_pages(spark, SF001).count()
    assert spark.read.parquet(arch).count() == n
    assert spark.read.parquet(idx).count() == n and spark.read.parquet(cont).count() == n


def test_statuses_of_listed_urls():
    from quarry.streaming.seen import statuses
    remembered = {"a": 10, "z": 3}
    rows = [("a", 12), ("b", 9), ("b", 9), ("c", 4), ("z", 4), (None, 9), ("", 1), ("d", None)]
    assert statuses(rows, remembered, 5) == ["repeat", "new", "repeat", "late", "late", "new", "new", "new"]
    assert remembered == {"a": 12, "b": 9, "z": 3}


def test_bounded_memory_over_three_landings(spark, tmp_path):
    """A URL is new once within the window; older rows are set aside, each of them; the archive holds every URL once."""
    from quarry.sources.archive import read_silver
    from quarry.streaming.incremental import ingest_late, late_items, run_deduplicated
    a = LD.actions(spark, SF001)
    land, arch, chk, late = (str(tmp_path / x) for x in ("land", "silver", "chk", "late"))
    params = IngestParams(as_of=dt.datetime(2025, 12, 31, 12), lookback_days=None)
    pages = LD.listing_pages(a)
    for cut in ("page <= 5", "page <= 8", "page > 3"):
        pages.filter(cut).coalesce(1).write.mode("append").parquet(land)
        run_deduplicated(spark, land, arch, chk, params, window_days=30, late_path=late)
    set_aside = {(r.page, r.url) for r in late_items(spark, late).collect()}
    before = {r.url for r in read_silver(spark, arch).collect()}
    items = {(r.page, r.url) for r in a.filter("date <> ''").collect()}
    # two items a day: after the first landing the watermark is 30 days, 15 items, back
    assert set_aside and before and before | {u for _, u in set_aside} == {u for _, u in items}
    ingest_late(spark, late, arch, params)
    ingest_late(spark, late, arch, params)                 # again under the same name
    got = [r.url for r in read_silver(spark, arch).collect()]
    assert sorted(got) == sorted(u for _, u in items)


def test_stream_metrics_of_each_micro_batch(spark, tmp_path):
    from quarry.streaming.metrics import read_metrics
    land, arch, chk, met = (str(tmp_path / x) for x in ("land", "silver", "chk", "metrics"))
    pages = LD.listing_pages(LD.actions(spark, SF001))
    pages.filter("page <= 4").coalesce(1).write.parquet(land)
    pages.filter("page > 4").withColumn("html", F.when(F.col("page") != 9, F.col("html"))).coalesce(1).write.mode("append").parquet(land)
    run_incremental(spark, land, arch, chk, IngestParams(as_of=dt.datetime(2025, 12, 31, 12), lookback_days=None),
                    files_per_batch=1, metrics_path=met)
    got = {r.number: (r.n_pages, r.n_empty) for r in read_metrics(spark, met).collect()}
    assert got == {0: (4, 0), 1: (16, 1)}
