"""Every registered query equals its DuckDB oracle (sf0.001; sf0.01 for the crawl)."""

import datetime as dt
import re

import duckdb
import pytest

import __spark_entry__ as E
from table_paths import SF001, SF01

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _norm(v):
    return v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


def _compare(spark, con, name, sf):
    df = E.queries()[name](spark, sf)
    got = [r.asDict() for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    exp = [dict(zip(ocols, r)) for r in cur.fetchall()]
    assert sorted(df.columns) == sorted(ocols)
    cols = sorted(ocols)
    assert _rows(got, cols) == _rows(exp, cols)
    return len(got)


def _own(names):
    """Without the removable subpackage's queries; they are tested in tests/llm."""
    return {n for n in names if n != "pipeline" and not re.match(r"op\d+_", n)}


def test_every_query_has_an_oracle():
    assert _own(E.queries()) == _own(E.oracle_sql())


@pytest.fixture(scope="module")
def duck001():
    return _duck(SF001)


@pytest.mark.parametrize("name", sorted(_own(E.oracle_sql())))
def test_oracle_sf0001(spark, duck001, name):
    _compare(spark, duck001, name, SF001)


@pytest.fixture(scope="module")
def duck01():
    return _duck(SF01)


@pytest.mark.parametrize("name,rows", [("crawl_window_known", 453), ("crawl_window_lookback", 149)])
def test_crawl_stops_sf001(spark, duck01, name, rows):
    # the known-URL stop only bites at sf0.01 (sf0.001 has no known URLs)
    assert _compare(spark, duck01, name, SF01) == rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["label", "n_actions"]
    assert sum(r.n_actions for r in df.collect()) == 200
