"""Plan shape: the operators compile to the physical plans they promise."""

import datetime as dt

from pyspark.sql import functions as F

from table_paths import SF01
from offline import offline_client_factory
from quarry.operators.annotate import live
from quarry.operators.crawl import crawl_window
from quarry.operators.report import kpis
from quarry.plans import catalog as C
from quarry.sources import landing as LD


def plan(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def test_crawl_window_has_no_window_or_cross_join(spark, capsys):
    df = crawl_window(C.listing(spark, SF01), known=LD.known(spark, SF01),
                      as_of=dt.datetime(2025, 12, 31, 12), lookback_days=60)
    p = plan(df, capsys)
    assert "Subquery" in p                       # the stop is a scalar subquery
    assert "Window" not in p and "Cartesian" not in p and "NestedLoop" not in p
    assert df.count() == 149


def test_no_forced_broadcast(spark, capsys):
    from quarry.operators.crawl import new_items
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(new_items(C.listing(spark, SF01), LD.known(spark, SF01)), capsys)
        assert "BroadcastHashJoin" not in p and "SortMergeJoin" in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_model_calls_spread_by_key(spark, capsys):
    df = live(offline_client_factory(), partitions=6)(LD.content(spark, SF01), ("url",), None)
    p = plan(df, capsys)
    assert "hashpartitioning(xxhash64(url" in p and "MapInPandas" in p


def test_kpis_single_pass_with_partial_aggregate(spark, capsys):
    p = plan(kpis(C.silver(spark, SF01)), capsys)
    assert p.count(") Scan parquet") == 3        # documents, labels, and the largest id
    assert "ReadSchema: struct<doc_id:bigint>" in p   # text column pruned away
    assert "HashAggregate" in p and "partial_count" in p


def test_scans_are_pruned(spark, capsys):
    p = plan(C.q_daily_events(spark, SF01), capsys)
    assert "ReadSchema: struct<ts:timestamp_ntz>" in p


def test_known_urls_stay_where_they_are(spark, tmp_path, capsys):
    """JOIN1/JOIN2 against the known-URL table: only the listing is exchanged."""
    from quarry.operators.crawl import known_hits
    from quarry.sources.archive import append_known, read_known
    path = str(tmp_path / "known")
    append_known(LD.known(spark, SF01), path, "T", "b")
    append_known(LD.known(spark, SF01).limit(3), path, "U", "b")
    known = read_known(spark, path, "T")
    assert known.count() == LD.known(spark, SF01).count() > 100
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hits = known_hits(C.listing(spark, SF01).select("page", "pos", "url"), known)
        p = plan(hits, capsys)
        left = p[:p.index("Scan parquet")]          # the tree, down to the details
        assert p.count("Exchange hashpartitioning(url") == 0 or "Bucketed: true" in p
        tree = [line for line in left.splitlines() if "Exchange" in line or "Scan parquet" in line or "SortMergeJoin" in line]
        known_side = left[left.index("SortMergeJoin"):]
        assert "Exchange" not in known_side.split("+- Sort")[0].split(":- Sort")[-1], tree
        assert hits.count() == C.listing(spark, SF01).join(known, "url", "left_semi").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_row_numbers_without_a_window(spark, capsys):
    from quarry.operators.ranking import numbered
    rows = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5003).alias("k"), F.lit("x").alias("x"))
    got = numbered(rows, F.desc("k"))
    p = plan(got, capsys)
    assert "Window" not in p and "NestedLoop" not in p and "Cartesian" not in p
    order = [r.k for r in got.orderBy("rank").collect()]
    assert order == sorted(order, reverse=True) and [r["rank"] for r in got.orderBy("rank").collect()] == list(range(1, 5001))
    assert numbered(rows.limit(0), F.asc("k")).count() == 0
    ties = spark.createDataFrame([("a", 2), ("a", 1), ("a", 1), (None, 3)], "k string, v int").repartition(3)
    assert [(r.k, r.v, r.place) for r in numbered(ties, F.asc_nulls_last("k"), name="place").orderBy("place").collect()] == [
        ("a", 1, 1), ("a", 1, 2), ("a", 2, 3), (None, 3, 4)]
