"""Row predicates over the silver archive (survey IDs FIL6, FIL9-FIL14).

Each returns a ``Column`` (or applies one), so Catalyst merges them into a
single Filter that it pushes to the Parquet scan where the column is stored.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession, Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import strip_ws

# --- fixed values -----------------------------------------------------------
ANY = "Any"
SEARCH_COLUMNS = ("title", "description", "full_summary")
# ---------------------------------------------------------------------------


def _date(x) -> Column:
    if isinstance(x, (_dt.date, _dt.datetime)):
        x = x.strftime("%Y-%m-%d")
    return F.lit(str(x)).cast("date")


def date_between(start, end, compat: bool = False) -> Column:
    """FIL9: ``start <= date_dt <= end`` (NULL dates drop).

    ``compat=True`` keeps the dashboard's ``<= end + 1 day`` (Q3).
    """
    hi = F.date_add(_date(end), 1) if compat else _date(end)
    return (F.col("date_dt") >= _date(start)) & (F.col("date_dt") <= hi)


def relevance_is(choice: str | None) -> Column | None:
    """FIL10: grade equals the choice; ``Any``/None disables.

    Written without wrapping the column so Parquet statistics can skip row
    groups (a NULL grade counts as blank).
    """
    if choice is None or choice == ANY:
        return None
    r = F.col("relevance")
    return (r.isNull() | (r == "")) if choice == "" else (r == choice)


def types_any(choices, exact: bool = False) -> Column | None:
    """FIL11: any chosen type occurs in the joined types string (substring).

    ``exact=True`` compares whole types instead (Q4).
    """
    choices = [c for c in (choices or [])]
    if not choices:
        return None
    if exact:
        return F.arrays_overlap(F.col("types_list"), F.array(*[F.lit(c) for c in choices]))
    s = F.col("types")  # NULL types match nothing, like an empty string
    return reduce(lambda a, b: a | b, [s.contains(c) for c in choices])


def _check_pattern(query: str, pattern: str) -> None:
    spark = SparkSession.getActiveSession()
    try:
        spark.range(1).select(F.lit("").rlike(pattern)).first()
    except (PySparkException, Py4JJavaError) as e:
        raise ValueError(f"invalid search pattern {query!r}: {e}") from e


def search(query: str | None, literal: bool = False, columns=SEARCH_COLUMNS) -> Column | None:
    """FIL12: case-folded regex (or literal) search over title/summaries.

    The pattern is compiled on the driver first, by the engine that runs it,
    so a bad one fails there and not inside a task (Q5).  NULL text never
    matches (Q12).
    """
    if not query:
        return None
    q = query.lower()
    if not literal:
        q = "(?U)" + q  # Unicode letters and digits, as in the pattern language of the caller
        _check_pattern(query, q)
    def one(c):
        low = F.lower(F.col(c))
        return F.coalesce(low.contains(q) if literal else low.rlike(q), F.lit(False))
    return reduce(lambda a, b: a | b, [one(c) for c in columns])


def dashboard_filter(df: DataFrame, *, date_range=None, relevance: str | None = None,
                     types=None, query: str | None = None, exact_types: bool = False,
                     literal: bool = False, compat: bool = False) -> DataFrame:
    """FIL13: conjunction of the optional filters (one composed predicate)."""
    preds = []
    if date_range is not None and len(date_range) == 2:
        preds.append(date_between(date_range[0], date_range[1], compat))
    for p in (relevance_is(relevance), types_any(types, exact_types), search(query, literal)):
        if p is not None:
            preds.append(p)
    return df.filter(reduce(lambda a, b: a & b, preds)) if preds else df


def missing_summary() -> Column:
    """FIL6: the row lacks a description or a grade (after stripping)."""
    d = strip_ws(F.coalesce(F.col("description"), F.lit("")))
    r = strip_ws(F.coalesce(F.col("relevant_eo"), F.lit("")))
    return ~((d != "") & (r != ""))
