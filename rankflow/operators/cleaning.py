"""Metadata cleaning: whitespace strip, mojibake detection / repair /
removal, junk keys, null drops and column profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.functions.text import MOJIBAKE_PATTERN, has_match, repair_mojibake, strip_ws

# Literal junk keys removed from the metadata export.
JUNK_KEYS = ['M."', 'L"']


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def strip_all_strings(df: DataFrame) -> DataFrame:
    """Strip leading/trailing whitespace of every string column."""
    cols = set(string_columns(df))
    return df.select(*[strip_ws(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def repair_all_strings(df: DataFrame) -> DataFrame:
    """Mojibake repair of every string cell."""
    cols = set(string_columns(df))
    return df.select(*[repair_mojibake(c).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def rows_matching(df: DataFrame, column: str, pattern: str = MOJIBAKE_PATTERN) -> DataFrame:
    """Rows whose ``column`` contains a match; missing values never match."""
    return df.where(has_match(column, pattern))


def any_column_matches(df: DataFrame, columns: list[str] | None = None,
                       pattern: str = MOJIBAKE_PATTERN):
    """Row predicate: some string cell of the row matches."""
    columns = columns or string_columns(df)
    return reduce(lambda a, b: a | b, [has_match(c, pattern) for c in columns])


def flagged_union(df: DataFrame, columns: list[str], pattern: str = MOJIBAKE_PATTERN,
                  tag: str = "flagged_by") -> DataFrame:
    """Bag union of the rows flagged on each column (a row flagged on k
    columns appears k times), tagged with the column that flagged it.

    One scan: each row emits one copy per matching column (``explode`` of
    the matching column names) instead of a union of per-column scans."""
    hits = F.filter(F.array(*[F.when(has_match(c, pattern), F.lit(c)) for c in columns]),
                    lambda x: x.isNotNull())
    return df.withColumn(tag, F.explode(hits))


def drop_rows(df: DataFrame, rows: DataFrame, id_col: str) -> DataFrame:
    """Remove rows by identity (left-anti on the row id), not by value."""
    return df.join(rows.select(id_col).distinct(), id_col, "left_anti")


def drop_literal_keys(df: DataFrame, key: str, junk: list[str] = JUNK_KEYS) -> DataFrame:
    """pandas ``df[df.key != lit]``: drop the literal values, keep nulls."""
    cond = F.lit(True)
    for j in junk:
        cond = cond & ~F.col(key).eqNullSafe(F.lit(j))
    return df.where(cond)


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per column: distinct non-null values, non-null cells, null cells and
    the row count.  Every cell becomes a (column, 128-bit hash) pair; equal
    pairs are counted together before the shuffle, which carries no values,
    and the counts of the pairs give every figure in one pass.
    ``exact=False`` uses HyperLogLog distinct counts (no shuffle of pairs)."""
    if not exact:
        aggs = [F.count(F.lit(1)).alias("_rows")]
        for i, c in enumerate(df.columns):
            aggs += [F.approx_count_distinct(c).alias(f"_d{i}"), F.count(c).alias(f"_n{i}")]
        one = df.agg(*aggs)
        entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"_d{i}").cast("long").alias("n_distinct"),
                            F.col(f"_n{i}").alias("n_non_null")) for i, c in enumerate(df.columns)]
        found = one.select(F.explode(F.array(*entries)).alias("e"), "_rows").select("e.*", F.col("_rows").alias("n_rows"))
    else:
        cells = []
        for i, f in enumerate(df.schema.fields):
            c = F.col(f"`{f.name}`")
            # 0.0 and -0.0 are one value
            v = c + F.lit(0.0) if isinstance(f.dataType, T.DoubleType | T.FloatType) else c
            # two chained hashes with different starts
            cells.append(F.struct(F.lit(i).alias("i"), F.when(c.isNotNull(), F.xxhash64(F.lit(1), v)).alias("a"),
                                  F.when(c.isNotNull(), F.xxhash64(v, F.lit(2), v)).alias("b")))
        pairs = df.select(F.explode(F.array(*cells)).alias("p")).select("p.*").groupBy("i", "a", "b").agg(F.count(F.lit(1)).alias("n"))
        held = F.col("a").isNotNull()
        per = pairs.groupBy("i").agg(F.count("a").alias("n_distinct"), F.coalesce(F.sum(F.when(held, F.col("n"))), F.lit(0)).alias("n_non_null"),
                                     F.sum("n").alias("n_rows"))
        # an empty table has a row per column too
        names = df.sparkSession.createDataFrame(list(enumerate(df.columns)), "k int, column_name string")
        zero = F.lit(0).cast("long")
        found = names.join(per, F.col("k") == F.col("i"), "left").select(
            "column_name", *[F.coalesce(c, zero).cast("long").alias(c) for c in ("n_distinct", "n_non_null", "n_rows")])
    return found.select("column_name", "n_distinct", "n_non_null", (F.col("n_rows") - F.col("n_non_null")).alias("n_null"), "n_rows")


def total_nulls(df: DataFrame) -> DataFrame:
    """Number of null cells over the whole table."""
    return df.agg(reduce(lambda a, b: a + b,
                         [F.sum(F.col(c).isNull().cast("long")) for c in df.columns])
                  .alias("total_nulls"))
