"""Golden cases for text and date functions (STR1-STR11, DATE1-DATE4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarry.functions import dates as D
from quarry.functions import text as T

NBSP, EM, FS = "\u00a0", "\u2003", "\u001c"


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first().r


@pytest.mark.parametrize("value,expected", [
    ("  a \t b\n\nc  ", "a b c"),
    (NBSP + "x" + EM + EM + "y" + FS, "x y"),
    ("", ""),
    (None, None),
])
def test_clean_text(spark, value, expected):
    assert one(spark, T.clean_text("v"), value) == expected


def test_whitespace_set_is_pythons(spark):
    # every code point Python calls whitespace is stripped, nothing else is
    chars = "".join(chr(c) for c in range(0x3100))
    got = one(spark, F.regexp_replace("v", "(?U)" + T.WS_U, ""), chars)
    assert got == "".join(ch for ch in chars if not ch.isspace())
    got2 = one(spark, F.regexp_replace("v", T.WS, ""), chars)
    assert got2 == got


@pytest.mark.parametrize("value,n,expected", [
    ('a/b\\c:d*e?f"g<h>i|j', 120, "a_b_c_d_e_f_g_h_i_j"),
    ("abcdef/", 6, "abcdef"),       # truncation happens first
    ("x" * 130, 120, "x" * 120),
])
def test_safe_filename(spark, value, n, expected):
    assert one(spark, T.safe_filename("v", n), value) == expected


def test_topic_csv_name(spark):
    assert one(spark, T.topic_csv_name("data/archive.csv", "v"), " Immigration ") == \
        "data/archive - Immigration.csv"
    assert one(spark, T.topic_csv_name("archive", "v"), "A/B") == "./archive - A_B.csv"
    assert one(spark, T.topic_csv_name("archive.csv", "v"), "") == "archive.csv"
    assert one(spark, T.topic_csv_name("archive.csv", "v"), None) == "archive.csv"


def test_text_file_path(spark):
    df = spark.createDataFrame([("May 1, 2025", "T: x"), ("", "")], "d string, t string")
    got = [r.p for r in df.select(T.text_file_path("out", "d", "t", "2025-12-31").alias("p")).collect()]
    assert got == ["out/May 1, 2025 - T_ x.txt", "out/2025-12-31 - untitled.txt"]


def test_types_split_join_default(spark):
    assert one(spark, T.split_types("v"), "A; B; ; C ") == ["A", "B", "C"]
    assert one(spark, T.split_types("v"), None) == []
    df = spark.createDataFrame([([],), (["x", "y"],)], "a array<string>")
    got = [r.r for r in df.select(T.join_types(T.default_types("a")).alias("r")).collect()]
    assert got == ["no types", "x; y"]


@pytest.mark.parametrize("value,expected", [
    ("Yes", "Yes"), ("Maybe - see details", "Maybe"), ("No.", "No"), ("yes", ""),
    ("Nothing", ""), ("Unknown, No", "No"), (None, ""), ("", ""),
])
def test_grade_of(spark, value, expected):
    assert one(spark, T.grade_of("v"), value) == expected


def test_nonempty_lines(spark):
    assert one(spark, T.nonempty_lines("v"), " a \n\n" + NBSP + "\n b\r\n") == ["a", "b"]


@pytest.mark.parametrize("value,ingest,archive", [
    ("December 5, 2025", dt.date(2025, 12, 5), dt.date(2025, 12, 5)),
    ("december 05, 2025", dt.date(2025, 12, 5), dt.date(2025, 12, 5)),
    ("05-Dec-25", dt.date(2025, 12, 5), dt.date(2025, 12, 5)),
    ("5-dec-25", dt.date(2025, 12, 5), dt.date(2025, 12, 5)),
    ("05-Sep-69", dt.date(1969, 9, 5), dt.date(1969, 9, 5)),     # two-digit pivot
    ("05-Sep-68", dt.date(2068, 9, 5), dt.date(2068, 9, 5)),
    ("2025-12-05", None, dt.date(2025, 12, 5)),                  # ISO only in the archive parser
    ("May  5,  2025", dt.date(2025, 5, 5), dt.date(2025, 5, 5)),  # runs of spaces
    ("February 30, 2025", None, None),
    ("", None, None),
    (None, None, None),
    ("Dec 5, 2025", None, None),
])
def test_date_parsers(spark, value, ingest, archive):
    assert one(spark, D.parse_ingest_date("v"), value) == ingest
    assert one(spark, D.parse_archive_date("v"), value) == archive


def test_lookback_cutoff(spark):
    as_of = dt.datetime(2025, 12, 31, 12, 0, 0)
    assert D.lookback_cutoff(as_of, None) is None
    assert D.lookback_cutoff(as_of, 0) is None
    cut = D.lookback_cutoff(as_of, 15)
    df = spark.createDataFrame([(dt.date(2025, 12, 16),), (dt.date(2025, 12, 17),)], "d date")
    got = [r.o for r in df.select(D.older_than("d", cut).alias("o")).collect()]
    # an item dated exactly N days ago is older than the cutoff (Q2)
    assert got == [True, False]
