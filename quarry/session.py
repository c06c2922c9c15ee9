"""SparkSession helpers.

Library code never creates its own session; it takes the caller's.  The
builder here is for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "quarry") -> SparkSession:
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # raw HTML rows are large: bound Arrow batches by bytes, not only rows
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 * 1024 * 1024))
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for staged tables and checkpoints.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder;
    it is read from the session.  Only when it is unset and the master is
    local (tests) a scratch folder is created and registered.
    """
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share: "
                           "intermediate tables are written there")
    if not d:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-ckpt-"))
        d = spark.sparkContext.getCheckpointDir()
    return d


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quarry`` importable on executors (``addPyFile`` of a zip).

    UDFs and ``mapInPandas`` bodies reference this package, so Python
    workers must be able to import it; this is how code reaches a cluster.
    Done once per SparkContext.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="quarry-code-"), "quarry.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def materialize(df, name: str = "stage"):
    """Cut the lineage of ``df``: write it as a Parquet table in the shared
    checkpoint folder and read it back.

    Used where one expensive result (Python extraction, model answers) feeds
    several branches of a plan: each branch then reads the table instead of
    recomputing, also after an executor loss.  Unlike an eager
    ``checkpoint()``, the input is computed once (no separate count job).
    """
    import uuid

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
