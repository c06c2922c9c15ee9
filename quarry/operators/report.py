"""Archive reports (survey IDs AGG1-AGG7, SORT1-SORT3, COL2, COL3, COL5).

Every aggregate here is a hash aggregate with a map-side partial step, so a
hot key (one topic or grade holding a third of the rows) is combined inside
each task before the shuffle.  Sorting uses range partitioning; nothing is
collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import blank_label, display_or, split_types
from quarry.operators.ranking import numbered

# --- fixed values -----------------------------------------------------------
UNTITLED = "(untitled)"
# ---------------------------------------------------------------------------


def kpis(df: DataFrame) -> DataFrame:
    """AGG1-AGG4 in one pass: totals, grade counts, date range."""
    r = F.col("relevance")
    return df.agg(
        F.count(F.lit(1)).alias("total_actions"),
        F.count_if(r == "Yes").alias("n_yes"),
        F.count_if(r == "Maybe").alias("n_maybe"),
        F.count_if(r == "No").alias("n_no"),
        F.max("date_dt").alias("latest_date"),
        F.min("date_dt").alias("earliest_date"),
    )


def relevance_breakdown(df: DataFrame) -> DataFrame:
    """AGG5 + STR11 + SORT2: rows per grade, blank shown as ``Unlabeled``."""
    return (df.groupBy(blank_label("relevance").alias("label"))
            .agg(F.count(F.lit(1)).alias("n_actions")).orderBy("label"))


def ranked_breakdown(df: DataFrame) -> DataFrame:
    """SORT2 as data: the breakdown with each label's place."""
    return numbered(relevance_breakdown(df), F.asc("label"))


def daily_counts(df: DataFrame) -> DataFrame:
    """AGG6 + FIL14 + DATE4: rows per day; days without rows don't appear."""
    return (df.filter(F.col("date_dt").isNotNull())
            .groupBy(F.col("date_dt").cast("date").alias("day"))
            .agg(F.count(F.lit(1)).alias("n_actions")).orderBy("day"))


def type_options(df: DataFrame) -> DataFrame:
    """AGG7 + STR7 + SORT3: distinct types, ascending."""
    return (df.select(F.explode(split_types("types")).alias("type"))
            .distinct().orderBy("type"))


def ranked_types(df: DataFrame) -> DataFrame:
    """SORT3 as data: the types with their place, ascending by code point."""
    return numbered(type_options(df), F.asc("type"))


def _newest():
    return F.desc_nulls_last("date_dt"), F.asc_nulls_last("url")


def newest_first(df: DataFrame) -> DataFrame:
    """SORT1: newest first, undated last, URL as the deterministic tie-break."""
    return df.orderBy(*_newest())


def results_table(df: DataFrame) -> DataFrame:
    """SORT1 + COL2 + COL5: the display projection of the filtered rows."""
    return newest_first(df).select(*_display())


def _display():
    return [
        F.coalesce(F.col("date"), F.lit("")).alias("date"),
        display_or("title", UNTITLED).alias("title"),
        F.coalesce(F.col("types"), F.lit("")).alias("types"),
        F.coalesce(F.col("relevance"), F.lit("")).alias("relevance"),
        F.coalesce(F.col("description"), F.lit("")).alias("description"),
        F.col("url"),
    ]


def ranked_results(df: DataFrame) -> DataFrame:
    """SORT1 as data: the results table with each row's place, so that a page
    of the dashboard is a filter on ``rank`` (rows are ordered before the
    projection, dates as dates)."""
    rows = df.select("date_dt", *_display())
    return numbered(rows, *_newest()).drop("date_dt")


def detail_view(df: DataFrame) -> DataFrame:
    """COL5: one detail record per row (blank optional fields become NULL)."""
    blank_null = lambda c: F.nullif(F.col(c), F.lit(""))
    return newest_first(df).select(
        F.coalesce(F.col("date"), F.lit("")).alias("date"),
        display_or("title", UNTITLED).alias("title"),
        blank_null("url").alias("url"),
        blank_null("text_file").alias("text_file"),
        F.coalesce(F.col("types"), F.lit("")).alias("types"),
        F.coalesce(F.col("relevance"), F.lit("")).alias("relevance"),
        blank_null("description").alias("summary"),
        blank_null("full_summary").alias("full_summary"),
    )


def export_projection(df: DataFrame) -> DataFrame:
    """COL3: every column but ``date_dt`` (and the internal list/partition columns)."""
    return df.drop("date_dt", "types_list", "topic_slug")
