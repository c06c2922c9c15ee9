"""Topic dataset catalogue (survey IDs SRC7-SRC8, FIL15, STR9-STR10, AGG8, SET2, SORT4).

Input: archive rows with ``file_name`` (the dataset file), ``relevance_topic``
and ``ord`` (row order inside the file).  Output: one row per dataset,
``(file_name, label, is_base)``, base dataset first, then by lower-cased label.

The most frequent topic is two ordinary aggregates, both with map-side
partial steps: counts per (file, topic), then the arg-max per file.  A file
or topic holding a third of all rows is reduced inside each task first.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import strip_ws
from quarry.operators.ranking import numbered


def _root_ext(base_csv: str) -> tuple[str, str]:
    root, ext = os.path.splitext(os.path.basename(base_csv))
    return root, ext or ".csv"


def dataset_files(df: DataFrame, base_csv: str) -> DataFrame:
    """FIL15: the base file or ``"<root> - *"`` files, ``.csv`` any case."""
    root, ext = _root_ext(base_csv)
    n = F.col("file_name")
    return df.filter(F.lower(n).endswith(".csv") & ((n == root + ext) | n.startswith(root + " - ")))


def topic_catalogue(df: DataFrame, base_csv: str) -> DataFrame:
    """AGG8 + STR9 + STR10 + SORT4, over all rows of every dataset (SRC7, LIM2).

    A label taken from the first rows of a file would change with their order.
    """
    root, ext = _root_ext(base_csv)
    rows = dataset_files(df, base_csv)
    topic = strip_ws(F.col("relevance_topic"))
    t = rows.select("file_name", "ord", topic.alias("topic")).filter(
        F.col("topic").isNotNull() & (F.col("topic") != ""))
    per_topic = t.groupBy("file_name", "topic").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first"))
    # most frequent; ties -> first seen (smallest ord)
    best = per_topic.groupBy("file_name").agg(
        F.max_by("topic", F.struct(F.col("n"), F.struct(F.lit(0) - F.col("first._block"),
                                                       F.lit(0) - F.col("first._row")))
                 ).alias("mode_topic"))
    files = rows.select("file_name").distinct()
    name_topic = F.regexp_extract("file_name", r"(?i)^\Q" + root + r"\E - (.+)\.csv$", 1)
    out = files.join(best, "file_name", "left").select(
        "file_name",
        F.coalesce(F.nullif(F.col("mode_topic"), F.lit("")), F.nullif(name_topic, F.lit("")),
                   F.col("file_name")).alias("label"),
        (F.lower("file_name") == (root + ext).lower()).alias("is_base"))
    return out.orderBy(*catalogue_order())


def catalogue_order():
    """SORT4: the base dataset first, then by lower-cased label, then by file."""
    return F.desc("is_base"), F.asc(F.lower("label")), F.asc("file_name")


def ranked_catalogue(df: DataFrame, base_csv: str) -> DataFrame:
    """SORT4 as data: the catalogue with each dataset's place."""
    return numbered(topic_catalogue(df, base_csv), *catalogue_order())


def label_paths(catalogue: DataFrame) -> DataFrame:
    """SET2: label -> file; a label shared by several files keeps the last one in catalogue order.

    One aggregate per label over the columns that make the order; base files
    come first in the catalogue, so any other file is later.
    """
    place = F.struct(~F.col("is_base"), F.lower("label"), F.col("file_name"))
    return catalogue.groupBy("label").agg(F.max_by(F.struct("file_name", "is_base"), place).alias("last")).select(
        "label", "last.file_name", "last.is_base")
