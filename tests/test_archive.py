"""Archive I/O: CSV dialect round trip, normalisation, versions, topic catalogue."""

import csv
import glob
import os

from pyspark.sql import functions as F

from quarry.operators.topics import topic_catalogue
from quarry.sources.archive import (ARCHIVE_COLUMNS, header_columns, known_state, read_archive_csv, read_archive_dir,
                                    to_silver, write_archive_csv)

TRICKY = [
    ("May 1, 2025", 'He said "hi", then left', "https://x/1", "A; B", "", "line1\nline2", "T", "Yes", ""),
    ("01-May-25", " leading space", "https://x/2", "no types", None, "comma, inside", "", "No.", "x"),
]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(TRICKY, ",".join(f"{c} string" for c in ARCHIVE_COLUMNS))
    out = str(tmp_path / "arch")
    write_archive_csv(df.coalesce(1), out, mode="overwrite")
    back = read_archive_csv(spark, out)
    norm = lambda v: v or ""  # noqa: E731 - CSV has no NULL, only empty
    got = sorted(tuple(norm(r[c]) for c in ARCHIVE_COLUMNS) for r in back.collect())
    assert got == sorted(tuple(norm(v) for v in row) for row in TRICKY)
    # Python's csv module reads the same rows
    rows = []
    for f in glob.glob(os.path.join(out, "*.csv")):
        with open(f, newline="", encoding="utf-8") as fh:
            rows += [tuple(r[c] for c in ARCHIVE_COLUMNS) for r in csv.DictReader(fh)]
    assert sorted(rows) == got


def test_absent_archive_is_empty(spark, tmp_path):
    df = read_archive_csv(spark, str(tmp_path / "missing.csv"))
    assert df.count() == 0 and df.columns == ARCHIVE_COLUMNS


def test_missing_columns_added(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text("date,title,url\nMay 1, 2025,t,u\n".replace("May 1, 2025", '"May 1, 2025"'))
    df = to_silver(read_archive_csv(spark, str(p)))
    r = df.first()
    assert r.relevance == "" and r.types == "" and r.description is None
    assert str(r.date_dt) == "2025-05-01"


def test_known_state(spark):
    df = spark.createDataFrame([("u1", "May 1, 2025"), ("u1", "2025-06-01"), ("", "May 9, 2025"),
                                (None, None)], "url string, date string")
    r = known_state(df).first()
    # ISO dates aren't parsed by the crawler (Q15); blank URLs don't count
    assert r.n_known == 1 and str(r.latest_date) == "2025-05-09"


def test_headers_in_any_order(spark, tmp_path):
    d = tmp_path / "csvs"
    d.mkdir()
    (d / "a.csv").write_text("date,title,url\n\"May 1, 2025\",t1,u1\n", encoding="utf-8")
    (d / "b.csv").write_text("\ufeffurl,reviewer,title\nu2,r2,\"t\n2\"\n", encoding="utf-8")
    (d / "c.CSV").write_text("title,url,title\nt3,u3,other\n", encoding="utf-8")
    (d / "empty.csv").write_text("date,title,url\n", encoding="utf-8")
    (d / "none.txt").write_text("x", encoding="utf-8")
    got = {r.url: r for r in read_archive_dir(spark, str(d)).collect()}
    assert {u: (r.date, r.title, r.reviewer, r.file_name, r.description) for u, r in got.items()} == {
        "u1": ("May 1, 2025", "t1", None, "a.csv", None), "u2": (None, "t\n2", "r2", "b.csv", None), "u3": (None, "t3", None, "c.CSV", None)}
    assert header_columns('"a ", b,"c,d"') == ("a", "b", "c,d")


def test_a_column_that_only_some_batches_have(spark, tmp_path):
    from quarry.sources.archive import append_silver, read_silver, to_bronze
    path = str(tmp_path / "silver")
    nine = spark.createDataFrame(TRICKY[:1], ",".join(f"{c} string" for c in ARCHIVE_COLUMNS))
    append_silver(to_silver(nine), path, "a")
    append_silver(to_silver(nine.withColumn("reviewer", F.lit("r"))), path, "b")
    got = read_silver(spark, path)
    assert sorted((r.batch, r.reviewer) for r in got.collect()) == [("a", None), ("b", "r")]
    assert to_bronze(got, extra=True).columns == [*ARCHIVE_COLUMNS, "reviewer"] and to_bronze(got).columns == ARCHIVE_COLUMNS


def _write_csv(path, topics):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.DictWriter(f, fieldnames=ARCHIVE_COLUMNS)
        w.writeheader()
        for i, t in enumerate(topics):
            w.writerow({"date": "May 1, 2025", "title": f"t{i}", "url": f"u{i}", "relevance_topic": t})


def test_topic_catalogue_from_folder(spark, tmp_path):
    d = tmp_path / "csvs"
    d.mkdir()
    _write_csv(d / "archive.csv", ["", ""])
    _write_csv(d / "archive - Immigration.csv", ["Immigration", "Border", "Immigration"])
    _write_csv(d / "archive - Ed.csv", ["", None])
    _write_csv(d / "archive - Tie.csv", ["B", "A", "A", "B"])
    _write_csv(d / "archive - x.CSV", [" "])
    _write_csv(d / "other.csv", ["Other"])
    cat = topic_catalogue(read_archive_dir(spark, str(d)), "archive.csv").collect()
    assert [(r.file_name, r.label, r.is_base) for r in cat] == [
        ("archive.csv", "archive.csv", True),
        ("archive - Tie.csv", "B", False),          # tie -> first seen
        ("archive - Ed.csv", "Ed", False),           # no topic values -> file-name topic
        ("archive - Immigration.csv", "Immigration", False),
        ("archive - x.CSV", "x", False),
    ]


def test_silver_partition_and_pushdown(spark, tmp_path, capsys):
    from table_paths import SF001
    from quarry.operators.filters import dashboard_filter
    from quarry.sources import landing as LD
    from quarry.sources.archive import append_silver
    out = str(tmp_path / "silver")
    append_silver(to_silver(LD.actions(spark, SF001)), out)
    s = spark.read.parquet(out)
    f = dashboard_filter(s, date_range=("2025-11-01", "2025-11-30"), relevance="Yes").filter(
        F.col("topic_slug") == "src1")
    f.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(topic_slug" in plan
    assert "GreaterThanOrEqual(date_dt,2025-11-01)" in plan
    assert "EqualTo(relevance,Yes)" in plan
    assert f.count() == s.filter("topic_slug = 'src1' and relevance = 'Yes' and "
                                 "date_dt between '2025-11-01' and '2025-11-30'").count()


def test_topic_catalogue_reads_whole_files(spark, tmp_path):
    d = tmp_path / "csvs"
    d.mkdir()
    # in the first rows "A" leads, over the whole file "B" does
    _write_csv(d / "archive - s.csv", ["A", "A", "B", "B", "B", "B"])
    assert topic_catalogue(read_archive_dir(spark, str(d)), "archive.csv").first().label == "B"


def test_topic_that_looks_like_a_number(spark, tmp_path):
    from quarry.sources.archive import append_silver, known_in_topic, read_silver, silver_of_topic
    path = str(tmp_path / "silver")
    for topic in ("0075", None):
        rows = spark.createDataFrame([(f"u-{topic}",)], "url string")
        append_silver(silver_of_topic(rows, topic), path)
    assert {r.topic_slug for r in read_silver(spark, path).collect()} == {"0075", "_base"}
    assert [r.url for r in known_in_topic(spark, path, "0075").collect()] == ["u-0075"]
    assert [r.url for r in known_in_topic(spark, path, None).collect()] == ["u-None"]
    assert read_silver(spark, str(tmp_path / "none")) is None


def test_label_paths_keep_last(spark):
    from quarry.operators.topics import label_paths
    cat = spark.createDataFrame([("b.csv", "X", False), ("z.csv", "X", True), ("a.csv", "X", False), ("c.csv", "Y", False)],
                                "file_name string, label string, is_base boolean").repartition(3)
    got = {r.label: r.file_name for r in label_paths(cat).collect()}
    assert got == {"X": "b.csv", "Y": "c.csv"}
