"""Explicit schemas of the reference's data shapes and schema contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S = T.StringType()

OBSERVATIONS = T.StructType([T.StructField(n, t) for n, t in [
    ("asin", _S), ("timestamp", _S), ("rank", T.LongType()), ("year", _S), ("month", _S),
    ("date", _S), ("day", _S), ("hour", _S)]])

METADATA = T.StructType([T.StructField(n, _S) for n in
                         ["asin", "group_name", "format", "title", "author", "publisher", "genre"]])

DAILY_FACT = T.StructType([T.StructField(n, t) for n, t in [
    ("asin", _S), ("timestamp", _S), ("rank", T.LongType()), ("year", _S), ("month", _S),
    ("date", _S), ("day", _S), ("group_name", _S), ("format", _S), ("title", _S), ("author", _S),
    ("publisher", _S), ("genre", _S)]])

BOOK_DETAILS = T.StructType([T.StructField("title", _S), T.StructField("authors", _S),
                             T.StructField("ratings", _S)])


def require_columns(df: DataFrame, columns: list[str]) -> None:
    """Raise when required columns are missing (schema contract)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def missing_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Feature columns a model expects but the frame lacks (warning list)."""
    return [c for c in columns if c not in df.columns]


def move_last(df: DataFrame, column: str) -> DataFrame:
    """Reorder so ``column`` is last."""
    return df.select(*[F.col(c) for c in df.columns if c != column], F.col(column))


def features_excluding(df: DataFrame, exclude: list[str]) -> list[str]:
    """Feature list by exclusion."""
    return [c for c in df.columns if c not in set(exclude)]
