"""The dashboard's frames in one call (survey ID PIP3).

KPIs, the grade breakdown, daily counts and the type options describe the
whole archive; the table, detail records and export describe the filtered
rows (as the dashboard did).  Every value is a lazy DataFrame: nothing runs
until the caller writes or collects one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from quarry.operators.filters import dashboard_filter
from quarry.operators.report import (daily_counts, detail_view, export_projection, kpis,
                                     relevance_breakdown, results_table, type_options)


def dashboard(silver: DataFrame, *, date_range=None, relevance: str | None = None, types=None,
              query: str | None = None, exact_types: bool = False, literal: bool = False,
              compat: bool = False, undated: bool = False) -> dict[str, DataFrame]:
    """Without a date range the archive's whole span is the range, as in the
    dashboard: rows without a date are in the table only with ``undated``."""
    ranged = silver if undated or date_range is not None else silver.filter("date_dt is not null")
    filtered = dashboard_filter(ranged, date_range=date_range, relevance=relevance, types=types,
                                query=query, exact_types=exact_types, literal=literal,
                                compat=compat)
    return {
        "kpis": kpis(silver),
        "relevance_breakdown": relevance_breakdown(silver),
        "daily_counts": daily_counts(silver),
        "type_options": type_options(silver),
        "table": results_table(filtered),
        "details": detail_view(filtered),
        "export": export_projection(filtered),
    }
