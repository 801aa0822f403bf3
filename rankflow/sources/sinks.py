"""Writers: parquet fact tables, CSV exports, fitted mapping tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite", cluster_by: list[str] | None = None) -> None:
    """Parquet sink; partitioning the daily fact by (year, month) lets later
    trend queries prune whole directories.

    With ``cluster_by`` the rows are first range-partitioned on
    (partition columns, cluster columns): each task then writes a contiguous
    slice -- one or two partition folders instead of a file in every folder
    -- and a large folder is still split over several balanced tasks."""
    if partition_by and cluster_by:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        df = df.repartitionByRange(n, *partition_by, *cluster_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite", encoding: str = "UTF-8") -> None:
    """CSV sink (no index, quotes doubled, white space kept), one file per
    partition."""
    (df.write.mode(mode).option("header", header).option("encoding", encoding).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_single_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """One CSV file, as the conversion job writes.  ``coalesce(1)`` funnels
    the final write through one task -- only for small exports."""
    df.coalesce(1).write.mode("overwrite").option("header", header).option("escape", '"').csv(path)


def save_mapping(df: DataFrame, path: str) -> None:
    """Persist a fitted mapping (codes, vocabulary, target means, scaler)."""
    df.write.mode("overwrite").parquet(path)


def load_mapping(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str, sort_by: list[str] = ()) -> DataFrame:
    """``df`` as a table of the session catalog, stored under ``path`` in
    ``buckets`` buckets of ``key`` and sorted inside them by ``key`` and
    ``sort_by``: joins, groups and windows on ``key`` over such tables need no
    exchange.  One writing task per bucket, so one sorted file per bucket."""
    order = [key, *sort_by]
    (df.repartition(buckets, key).write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(*order)
     .option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str], cluster_by: list[str] | None = None) -> None:
    """Write ``df`` into a partitioned table folder, replacing exactly the
    partitions that ``df`` has rows for (dynamic overwrite); the folders of
    all others stay as they are."""
    keys = [*partition_by, *(cluster_by or [])]
    clustered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    (clustered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))
