"""The archive: bronze CSV boundary, silver Parquet table, rewrites of its partitions.

Survey IDs SRC1-SRC4, SRC8, SNK1-SNK5, COL1, COL3, COL4.

* Bronze is the CSV dialect the crawler writes (header once, ``"``-quoted,
  doubled quotes, embedded newlines).  It is read with every column as a
  string (never inferred) and normalised: missing columns are added as NULL.
  ``multiLine`` CSV can't be split inside a file, so bronze is a boundary
  format; analytics run on silver.
* Silver is Parquet partitioned by ``topic_slug`` and ``batch`` with
  ``date_dt`` and ``relevance`` materialised on write, so date and grade
  predicates reach Parquet statistics and topic predicates prune partitions.
  Columns beyond the nine are carried; batches may differ in them.
* A rewrite (backfill) replaces whole partitions, and only those it changes:
  their new rows are written in full to the shared folder first, then copied
  over the old partitions by a dynamic partition overwrite.  The path that is
  read is never written while it is read.
* Known URLs and article texts are catalog tables bucketed by URL (Spark's own
  ``CLUSTERED BY``), so a join on the URL moves only the listing.
"""

from __future__ import annotations

import csv
import re
import uuid
import zlib
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.dates import parse_archive_date, parse_ingest_date
from quarry.functions.text import grade_of, join_types, split_types, topic_slug
from quarry.session import checkpoint_dir

# --- fixed values -----------------------------------------------------------
# Bronze column order (the archive CSV header).
ARCHIVE_COLUMNS = ["date", "title", "url", "types", "text_file", "description",
                   "relevance_topic", "relevant_eo", "full_summary"]
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"',
               "encoding": "UTF-8", "mode": "PERMISSIVE"}
CSV_WRITE_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8",
                     "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
                     "emptyValue": "", "nullValue": ""}
BASE_SLUG = "_base"   # partition value of rows without a topic (an empty one reads back as NULL)
URL_BUCKETS = 32       # buckets of the tables that are clustered by URL
PARTITIONS = ("topic_slug", "batch")   # of silver
HEADER_START = 0       # a file's header is in the split that begins here
# ---------------------------------------------------------------------------

ARCHIVE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ARCHIVE_COLUMNS])


def empty_archive(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ARCHIVE_SCHEMA)


def ensure_columns(df: DataFrame, columns=ARCHIVE_COLUMNS) -> DataFrame:
    """COL1: add any missing archive column as a NULL string."""
    missing = [c for c in columns if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else df


def _absent(e: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e)


def read_archive_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC1-SRC3: read the bronze CSV (all strings); an absent path is empty."""
    try:
        df = spark.read.options(**CSV_OPTIONS).option("inferSchema", "false").csv(path)
    except AnalysisException as e:
        if _absent(e):
            return empty_archive(spark)
        raise
    return ensure_columns(df)


def _file_name() -> Column:
    """The file's name; it arrives URI-encoded and is decoded (a literal ``+`` is kept)."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def dataset_headers(spark: SparkSession, directory: str) -> DataFrame:
    """(path, header): the first line of every ``*.csv`` in a folder.

    One pass over the lines with an aggregate per file that combines in each
    task; a file's first line is the first row of the split that begins at 0.
    """
    lines = (spark.read.option("pathGlobFilter", "*.[cC][sS][vV]").text(directory)
             .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("at")))
    return (lines.filter(F.col("block") == HEADER_START).groupBy("path")
            .agg(F.min_by("value", "at").alias("header")))


def header_columns(header: str) -> tuple[str, ...]:
    """Column names of a header line; a byte order mark and blanks around names don't count."""
    return tuple(c.strip() for c in next(csv.reader([header.lstrip("\ufeff")]), []))


def read_archive_dir(spark: SparkSession, directory: str) -> DataFrame:
    """SRC8: every ``*.csv`` in a folder, with its file name and row order.

    Files may have different headers.  Spark takes all files of one read by
    position, so files are read in groups of one header each (as many groups
    as there are different headers) and united by name; a column that a file
    lacks is NULL, one that only some files have is carried.  ``ord`` orders
    rows within a file: the split's start offset, then the generated id, which
    increases in reading order inside a task.
    """
    shapes: dict[tuple[str, ...], list[str]] = {}
    for r in dataset_headers(spark, directory).collect():      # a row per dataset file
        # the path arrives URI-encoded, and is read as a pattern
        path = re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(r.path))
        shapes.setdefault(header_columns(r.header), []).append(path)
    parts = []
    for columns, paths in sorted(shapes.items()):
        # a name given twice is the first of them, like in a dictionary of a row's first values
        names = [c if c and c not in columns[:k] else f"__unnamed_{k}" for k, c in enumerate(columns)]
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        rows = (spark.read.schema(schema).options(**CSV_OPTIONS).option("enforceSchema", "true").csv(sorted(paths))
                .select(*[c for c in names if not c.startswith("__unnamed_")], _file_name().alias("file_name"),
                        F.struct(F.col("_metadata.file_block_start").alias("_block"),
                                 F.monotonically_increasing_id().alias("_row")).alias("ord")))
        parts.append(ensure_columns(rows))
    if not parts:
        return empty_archive(spark).withColumns({"file_name": F.lit(""), "ord": F.struct(F.lit(0).cast("long").alias("_block"), F.lit(0).cast("long").alias("_row"))})
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def to_silver(bronze: DataFrame) -> DataFrame:
    """SRC2: typed view of the archive (``date_dt``, ``relevance``, ``types_list``).

    Rows that already belong to a topic's dataset (``topic_slug``) stay in it,
    whatever their ``relevance_topic`` says.  Other columns are carried.
    """
    b = ensure_columns(bronze)
    return b.withColumns({
        "date_dt": parse_archive_date("date"),
        "relevance": grade_of("relevant_eo"),
        "types": F.coalesce(F.col("types"), F.lit("")),
        "types_list": split_types("types"),
        "topic_slug": F.col("topic_slug") if "topic_slug" in b.columns else slug_or_base(F.col("relevance_topic")),
    })


def slug_or_base(topic: Column) -> Column:
    """SNK5: the partition value of a topic; blank and missing topics share one."""
    return F.coalesce(F.nullif(topic_slug(topic), F.lit("")), F.lit(BASE_SLUG))


def silver_of_topic(rows: DataFrame, topic: str | None) -> DataFrame:
    """Silver rows of a run: they all belong to the run's dataset, annotated or not."""
    return to_silver(rows).withColumn("topic_slug", slug_or_base(F.lit(topic).cast("string")))


def read_silver(spark: SparkSession, path: str) -> DataFrame | None:
    """The silver archive; None if it does not exist (other errors are raised).

    Batches may have columns that others lack (COL1, Q16): the schemas of all
    files are merged, missing values are NULL.  The partition columns are
    declared: a topic that looks like a number or a date stays text.
    """
    try:
        found = spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as e:
        if _absent(e):
            return None
        raise
    parts = [T.StructField(n, T.StringType()) for n in PARTITIONS]
    declared = T.StructType([*(f for f in found.schema.fields if f.name not in PARTITIONS), *parts])
    return spark.read.schema(declared).parquet(path)


def known_in_topic(spark: SparkSession, path: str, topic: str | None, but: str | None = None) -> DataFrame | None:
    """Known URLs of one topic's dataset (FIL16), without those of batch ``but``; None without an archive.

    Topic and batch are partitions, so only their files are read, and the
    declared schema needs no file footer.
    """
    try:
        silver = spark.read.schema("url STRING, topic_slug STRING, batch STRING").parquet(path)
    except AnalysisException as e:
        if _absent(e):
            return None
        raise
    silver = silver.filter(F.col("topic_slug") == slug_or_base(F.lit(topic).cast("string")))
    return known_urls(silver.filter(F.col("batch") != but) if but else silver)


def to_bronze(df: DataFrame, extra: bool = False) -> DataFrame:
    """COL3/COL4: back to the nine archive columns, lists joined by ``"; "``.

    ``extra`` keeps further columns of the rows behind the nine.
    """
    d = df
    if "types" in d.columns and isinstance(d.schema["types"].dataType, T.ArrayType):
        d = d.withColumn("types", join_types("types"))
    derived = (*PARTITIONS, "date_dt", "relevance", "types_list", "updated")
    more = [c for c in d.columns if c not in ARCHIVE_COLUMNS and c not in derived] if extra else []
    return ensure_columns(d).select(*ARCHIVE_COLUMNS, *more)


def write_archive_csv(df: DataFrame, path: str, mode: str = "append", extra: bool = False) -> None:
    """SNK1/SNK4: CSV with the archive header (one file per partition)."""
    to_bronze(df, extra).write.mode(mode).options(**CSV_WRITE_OPTIONS).csv(path)


def export_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """SNK4: the filtered rows as CSV, every column but ``date_dt`` (COL3).

    Keeps both ``relevant_eo`` and the derived ``relevance``; lists are
    joined by ``"; "``.
    """
    d = df.drop("date_dt", "types_list", *PARTITIONS)
    if "types" in d.columns and isinstance(d.schema["types"].dataType, T.ArrayType):
        d = d.withColumn("types", join_types("types"))
    d.write.mode(mode).options(**CSV_WRITE_OPTIONS).csv(path)


def new_batch() -> str:
    return f"run-{uuid.uuid4().hex}"


def append_silver(df: DataFrame, path: str, batch: str | None = None, gathered: bool = False) -> None:
    """SNK1: add rows to silver under a batch name, partitioned by topic (SNK5) and batch.

    Only the partitions of this batch are overwritten, so a run that is
    repeated after a failure leaves one copy of its rows; without a name the
    rows are a batch of their own.  ``rebalance`` clusters rows by topic (few
    files per topic) and lets AQE split a hot topic over several tasks.  Rows
    that are ``gathered`` already (of one topic, read from a table) stay where
    they are.
    """
    rows = (df if "date_dt" in df.columns else to_silver(df)).withColumn("batch", F.lit(batch or new_batch()))
    _overwrite_partitions(rows, path, gathered)


def _overwrite_partitions(rows: DataFrame, path: str, gathered: bool = False) -> None:
    ((rows if gathered else rows.hint("rebalance", *PARTITIONS)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*PARTITIONS).parquet(path))


def _rewrite_note(spark: SparkSession, path: str, name: str) -> str:
    """Where the state of an archive's rewrite is noted; names count per archive."""
    return f"{checkpoint_dir(spark).rstrip('/')}/rewrite-{zlib.crc32(path.encode()):08x}-{name}-note"


def _noted(spark: SparkSession, path: str, name: str):
    """The rewrite's (folder, done); None if it hasn't staged its rows."""
    try:
        return spark.read.schema("folder STRING, done BOOLEAN").parquet(_rewrite_note(spark, path, name)).first()
    except AnalysisException as e:
        if _absent(e):
            return None
        raise


def staged_rewrite(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """The rows that the archive's rewrite of this name has staged in full; None if it hasn't come that far."""
    note = _noted(spark, path, name)
    return read_silver(spark, note.folder) if note else None


def rewrite_partitions(spark: SparkSession, path: str, rows: DataFrame | None, name: str,
                       but: tuple[str, ...] = (), gathered: bool = False) -> DataFrame:
    """SNK3: replace the partitions that ``rows`` fill (with all rows they are to hold); returns what was staged.

    Columns ``but`` are staged for the caller and don't go into the archive.
    Rows that are ``gathered`` by partition already are written where they are.

    First the rows are written to a folder of their own, then a note says
    where they are, then they replace the partitions, and the note says so.  A
    rewrite that was killed anywhere is repeated under its name: before the
    note it starts anew, after it the same rows are copied again (``rows`` may
    be None then), and one that is done changes nothing.  Nothing that a dead
    attempt left behind is ever read or stands in the way, and partitions not
    in ``rows`` keep their files.
    """
    def note(folder: str, done: bool) -> None:
        (spark.range(1).select(F.lit(folder).alias("folder"), F.lit(done).alias("done")).coalesce(1)
         .write.mode("overwrite").parquet(_rewrite_note(spark, path, name)))

    state = _noted(spark, path, name)
    if state is None:
        if rows is None:
            raise ValueError(f"nothing is staged for the rewrite {name!r}")
        folder = f"{checkpoint_dir(spark).rstrip('/')}/rewrite-{uuid.uuid4().hex}"
        ((rows if gathered else rows.hint("rebalance", *PARTITIONS)).write.mode("errorifexists")
         .partitionBy(*PARTITIONS).parquet(folder))
        note(folder, False)
        state = _noted(spark, path, name)
    staged = read_silver(spark, state.folder)
    if not state.done:
        _overwrite_partitions(staged.drop(*but), path, True)      # its files are by partition
        note(state.folder, True)
    return staged


def known_state(archive: DataFrame) -> DataFrame:
    """AGG9 + FIL16: distinct non-empty URLs and the latest ingest-parseable date.

    One row: ``n_known``, ``latest_date``.  Both aggregates combine map-side.
    """
    urls = F.when(F.coalesce(F.col("url"), F.lit("")) != "", F.col("url"))
    return archive.agg(F.count_distinct(urls).alias("n_known"),
                       F.max(parse_ingest_date("date")).alias("latest_date"))


def url_table(spark: SparkSession, path: str, columns: str, partitions: tuple[str, ...]) -> str:
    """The catalog table, bucketed by URL, whose files are at ``path``; declared if this session lacks it.

    Partitions that other sessions wrote are found again.
    """
    name = f"quarry_urls_{zlib.crc32(path.encode()):08x}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(partitions)}) "
              f"CLUSTERED BY (url) SORTED BY (url) INTO {URL_BUCKETS} BUCKETS LOCATION {_quoted(path)}")
    try:
        spark.read.schema("url STRING").parquet(path)
    except AnalysisException as e:
        if _absent(e):           # no batch yet
            return name
        raise
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _insert_batch(rows: DataFrame, table: str, **partition: str) -> None:
    """Replace one partition of a bucketed table (and no other)."""
    spark = rows.sparkSession
    columns = [c for c in spark.table(table).columns if c not in partition]
    spec = ", ".join(f"{k} = {_quoted(v)}" for k, v in partition.items())
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({spec}) SELECT {', '.join(columns)} FROM {{rows}}",
              rows=rows.select(*columns).repartition(URL_BUCKETS, "url"))


def known_table(spark: SparkSession, path: str) -> str:
    """Known URLs by topic and batch, bucketed by URL."""
    return url_table(spark, path, "url STRING, topic_slug STRING, batch STRING", PARTITIONS)


def append_known(urls: DataFrame, path: str, topic: str | None = None, batch: str | None = None) -> None:
    """Add a run's URLs to the known-URL table, under a batch name (which replaces its earlier rows)."""
    spark = urls.sparkSession
    slug = spark.range(1).select(slug_or_base(F.lit(topic).cast("string"))).first()[0]
    _insert_batch(urls.select("url").filter(F.coalesce(F.col("url"), F.lit("")) != ""), known_table(spark, path),
                  topic_slug=slug, batch=batch or new_batch())


def read_known(spark: SparkSession, path: str, topic: str | None = None, but: str | None = None) -> DataFrame:
    """URLs known in one topic, without those of batch ``but``.

    The table is bucketed by URL: joined with a listing it is read bucket by
    bucket, and only the listing is exchanged.
    """
    rows = spark.table(known_table(spark, path)).filter(F.col("topic_slug") == slug_or_base(F.lit(topic).cast("string")))
    return (rows.filter(F.col("batch") != but) if but else rows).select("url")


def content_table(spark: SparkSession, path: str) -> str:
    """Article texts by batch, bucketed by URL."""
    return url_table(spark, path, "url STRING, text STRING, text_file STRING, batch STRING", ("batch",))


def export_texts(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """SNK2 at the export boundary: ``(text_file, text)`` of every row.

    A text that couldn't be read is the sentinel here and only here (EXT3);
    inside the archive it is NULL.
    """
    from quarry.operators.extract import with_sentinel

    rows.select("text_file", with_sentinel(F.col("text")).alias("text")).write.mode(mode).parquet(path)


def append_content(df: DataFrame, path: str, batch: str | None = None) -> None:
    """SNK2: add article texts ``(url, text, text_file)`` to the content table, under a batch name."""
    _insert_batch(df.select("url", "text", "text_file"), content_table(df.sparkSession, path), batch=batch or new_batch())


def read_content(spark: SparkSession, path: str, but: str | None = None) -> DataFrame:
    """(url, text, text_file) of every stored text but those of batch ``but``, bucketed by URL."""
    rows = spark.table(content_table(spark, path))
    return (rows.filter(F.col("batch") != but) if but else rows).select("url", "text", "text_file")


def known_urls(archive: DataFrame) -> DataFrame:
    """The known-URL set (JOIN1/JOIN2 build side)."""
    return archive.select("url").filter(F.coalesce(F.col("url"), F.lit("")) != "").distinct()
