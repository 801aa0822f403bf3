"""Driver tables and the stand-ins that give them the reference's shapes.

Mapping (see FIXTURES.md): lineitem x part is the rank history of books
(``l_partkey`` -> asin, ``l_shipdate`` -> time, ``l_extendedprice`` in cents
-> rank); part is the book metadata; events are per-user rank series
(``user_id`` -> asin, ``ts`` -> time, ``value`` in cents -> rank).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.operators.facts import daily_min_rank
from rankflow.operators.history import to_observations
from rankflow.session import ensure_utc

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read as it is stored."""
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cents(c: str):
    return F.round(F.col(c) * 100).cast("long")


def book_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> (asin, group_name, format, title, author, publisher, genre)."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("asin"),
        F.when(F.col("p_size") <= 25, F.lit("book")).otherwise(F.lit("kindle")).alias("group_name"),
        F.col("p_size").cast("string").alias("format"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("author"),
        F.element_at(F.split("p_name", " "), -1).alias("publisher"),
        F.lower("p_type").alias("genre"),
    )


def book_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> observations, passing through the epoch-text path of the
    ingest job (epoch seconds as text -> time string -> calendar parts)."""
    li = table(spark, sf_dir, "lineitem")
    raw = li.select(
        F.col("l_partkey").cast("string").alias("asin"),
        F.unix_timestamp(F.col("l_shipdate")).cast("string").alias("timestamp"),
        cents("l_extendedprice").alias("rank"),
    )
    return to_observations(raw)


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as ordered per-user series with the full timestamp kept."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("asin"),
        "event_id", "ts", "event_type",
        cents("value").alias("rank"),
    )


def book_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily fact table (minimum rank per book-day)."""
    return daily_min_rank(book_observations(spark, sf_dir), book_metadata(spark, sf_dir))
