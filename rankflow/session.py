"""Session helpers: a configured local session for tests/bench, UTC pinning,
and the shared scratch folder taken from ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "rankflow") -> SparkSession:
    """Local session used by tests and the benchmark.

    On a cluster the caller supplies its own session; nothing here is
    required by the operators except a UTC session time zone for the
    calendar columns (see :func:`ensure_utc`).
    """
    master = master or os.environ.get("RANKFLOW_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("RANKFLOW_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoint files of unreachable datasets are removed by the cleaner
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Calendar strings (year/month/date/weekday/hour) follow the session
    time zone, as in the reference; pin it to UTC so results are stable."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator of the cluster (a shared file
    system or object store).  Only when it is unset -- local tests and the
    benchmark -- do we create one of our own, and only in a single process.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="rankflow-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/rankflow-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Compute ``df`` once and cut its lineage: written as a parquet table in
    the shared checkpoint folder and read back.  Survives the loss of an
    executor (unlike a local checkpoint or a cache), and later readers scan
    only the columns they use.  The shuffle files of the write go when it has
    been committed, not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    path, before = scratch_path(spark, "table"), spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN)
        else:
            spark.conf.set(_CLEAN, before)
    table = spark.read.parquet(path)
    table.scratch_table = path
    return table


def remove(table) -> None:
    """Delete a table of :func:`materialize` that nothing reads any more."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.scratch_table)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
