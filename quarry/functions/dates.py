"""Date column functions (survey IDs DATE1-DATE5).

Archive dates are free text in three layouts.  Parsing uses the ``try_``
forms so a bad value is NULL, never a task failure under ANSI mode.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import collapse_ws

# --- fixed values -----------------------------------------------------------
# Layouts of the archive's date strings, in the order they are tried.
LONG_FORM = "MMMM d, yyyy"      # "December 5, 2025"
SHORT_FORM = "d-MMM-yy"         # "05-Dec-25"
ISO_FORM = "yyyy-M-d"           # "2025-12-05"
# Two-digit years 69..99 belong to the 1900s, 00..68 to the 2000s.
PIVOT_YEAR = 2069
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _try(c: Column, fmt: str) -> Column:
    return F.try_to_date(c, fmt)


def _short_year(c: Column) -> Column:
    d = _try(c, SHORT_FORM)
    return F.add_months(d, F.when(F.year(d) >= PIVOT_YEAR, -1200).otherwise(0))


def parse_ingest_date(c) -> Column:
    """DATE1: long form, then short form; anything else is NULL."""
    s = collapse_ws(_c(c))
    return F.coalesce(_try(s, LONG_FORM), _short_year(s))


def parse_archive_date(c) -> Column:
    """DATE2: long form, ISO, then short form; anything else is NULL."""
    s = collapse_ws(_c(c))
    return F.coalesce(_try(s, LONG_FORM), _try(s, ISO_FORM), _short_year(s))


def as_of_literal(as_of) -> Column:
    """A run's reference instant as TIMESTAMP_NTZ (UTC wall clock)."""
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S")
    elif isinstance(as_of, _dt.date):
        as_of = as_of.strftime("%Y-%m-%d 00:00:00")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def lookback_cutoff(as_of, days) -> Column | None:
    """DATE3: ``as_of - days``, time of day kept; None/<=0 disables."""
    if days is None or int(days) <= 0:
        return None
    return as_of_literal(as_of) - F.make_dt_interval(F.lit(int(days)))


def older_than(date_col, cutoff: Column) -> Column:
    """A parsed date (midnight) strictly before the cutoff instant."""
    return _c(date_col).cast("timestamp_ntz") < cutoff
