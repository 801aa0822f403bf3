"""Trend operators: grouped mean ranks, weekday ordering, seeded key
sampling, systematic sampling and a centred moving mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.functions.calendar import weekday_index
from rankflow.operators.ordering import BUCKET_ROWS, halo_buckets, sorted_runs, with_position
from rankflow.session import materialize

_INTEGRAL = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)


def exact_mean(df: DataFrame, value: str, digits: int = 4) -> Column:
    """Mean as exact sum / count, rounded: integral values are summed as
    ``long``, fractional ones as ``decimal(38,6)``, so the result does not
    depend on the order in which partial sums meet."""
    dtype = df.schema[value].dataType
    if isinstance(dtype, _INTEGRAL):
        total = F.sum(F.col(value).cast("long"))
    else:
        total = F.sum(F.col(value).cast("decimal(38,6)"))
    return F.round(total.cast("double") / F.count(F.col(value)), digits)


def mean_by(df: DataFrame, keys: list[str], value: str = "rank",
            out: str = "mean_rank", digits: int = 4, sort: bool = True) -> DataFrame:
    """pandas ``groupby(keys)[value].mean()``: null keys dropped, null values
    skipped, groups returned in key order."""
    clean = df.where(_all_not_null(keys))
    res = clean.groupBy(*keys).agg(exact_mean(clean, value, digits).alias(out))
    return res.orderBy(*keys) if sort else res


def _all_not_null(keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def mean_by_weekday(df: DataFrame, day: str = "day", value: str = "rank",
                    out: str = "mean_rank") -> DataFrame:
    """Mean by weekday name, ordered Monday -> Sunday."""
    res = mean_by(df, [day], value, out, sort=False)
    return res.withColumn("day_index", weekday_index(day)).orderBy("day_index")


def sample_keys(df: DataFrame, key: str, n: int = 20, seed: str = "42") -> DataFrame:
    """Up to ``n`` distinct non-null keys chosen by a seeded hash: the same
    keys on every run and on every engine that has ``md5``."""
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)))
    return keys.orderBy(order, F.col(key)).limit(n)


def keep_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``df[df.key.isin(keys)]`` as a left-semi join."""
    return df.join(keys, key, "left_semi")


def every_nth(positioned: DataFrame, pos_col: str, n: int) -> DataFrame:
    """Systematic sample ``arr[::n]`` over a positioned table."""
    return positioned.where((F.col(pos_col) % F.lit(n)) == 0)


def centred_moving_mean(df: DataFrame, order_cols, value: str, half_width: int,
                        out: str = "smoothed", pos_col: str = "pos",
                        bucket_rows: int | None = None, digits: int = 4) -> DataFrame:
    """Mean of ``value`` over the rows ``half_width`` before to ``half_width``
    after each row in the global order, computed in bounded buckets (halo
    copies of neighbouring rows) rather than one un-partitioned window."""
    bucket_rows = bucket_rows or max(BUCKET_ROWS, half_width + 1)
    positioned = with_position(df, order_cols, pos_col)
    halo = halo_buckets(positioned, pos_col, half_width, half_width, bucket_rows)
    w = (Window.partitionBy("_rf_bucket").orderBy(pos_col)
         .rowsBetween(-half_width, half_width))
    dtype = df.schema[value].dataType
    v = F.col(value).cast("long") if isinstance(dtype, _INTEGRAL) else F.col(value).cast(
        "decimal(38,6)")
    smoothed = F.round(F.sum(v).over(w).cast("double") / F.count(F.col(value)).over(w), digits)
    return (halo.withColumn(out, smoothed).where(F.col("_rf_core"))
            .drop("_rf_bucket", "_rf_core"))


def prefix_sums(df: DataFrame, order_cols, values: list[str], pos_col: str = "pos") -> DataFrame:
    """Rows with their position and, per value, the exact sum (``<value>_sum``)
    and the number of non-null values (``<value>_n``) up to and including the
    row; ``rows_all`` is the number of rows.  Each sorted partition is summed
    up by itself and the totals of the partitions before it are carried over
    (one row per partition, so that broadcast is bounded by their number)."""
    tagged, offsets = sorted_runs(df, order_cols)
    inside = Window.partitionBy("_rf_part").orderBy("_rf_idx").rowsBetween(Window.unboundedPreceding, 0)
    exact = {v: F.col(v).cast("decimal(38,6)") for v in values}
    total = [F.sum(e).alias(f"_t_{v}") for v, e in exact.items()] + [F.count(v).alias(f"_c_{v}") for v in values]
    earlier = Window.orderBy("_rf_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = offsets.join(tagged.groupBy("_rf_part").agg(*total), "_rf_part").select(
        "_rf_part", "_rf_off", "_rf_all",
        *[F.coalesce(F.sum(f"_{k}_{v}").over(earlier), F.lit(0)).alias(f"_b{k}_{v}") for v in values for k in "tc"])
    out = tagged.join(F.broadcast(carried), "_rf_part")
    for v, e in exact.items():
        own = F.coalesce(F.sum(e).over(inside), F.lit(0).cast("decimal(38,6)"))
        out = (out.withColumn(f"{v}_sum", (own + F.col(f"_bt_{v}")).cast("decimal(38,6)"))
               .withColumn(f"{v}_n", (F.count(v).over(inside) + F.col(f"_bc_{v}")).cast("long")))
    return out.select(*df.columns, (F.col("_rf_off") + F.col("_rf_idx")).cast("long").alias(pos_col),
                      F.col("_rf_all").cast("long").alias("rows_all"), *[f"{v}_{k}" for v in values for k in ("sum", "n")])


def smooth_fraction(df: DataFrame, order_cols, values: list[str], fraction: float = 0.05, pos_col: str = "pos",
                    digits: int = 4) -> DataFrame:
    """Centred moving means (``smoothed_<value>``) over windows that span
    ``fraction`` of all rows: the sums up to a window's last row and up to the
    row before its first are looked up, so the span may be as wide as it likes.
    A window is cut at the ends of the table; nulls are skipped."""
    sums = materialize(prefix_sums(df, order_cols, values, pos_col))
    half = F.greatest(F.lit(1), F.floor(F.col("rows_all") * F.lit(fraction) / 2)).cast("long")
    last = F.least(F.col(pos_col) + half, F.col("rows_all") - 1)
    ends = [sums.select(F.col(pos_col).alias(f"_{e}"), *[F.col(f"{v}_{k}").alias(f"_{e}_{v}_{k}") for v in values for k in ("sum", "n")])
            for e in ("hi", "lo")]
    out = (sums.withColumn("_at", last).withColumn("_before", F.col(pos_col) - half - 1)
           .join(ends[0], F.col("_at") == F.col("_hi")).join(ends[1], F.col("_before") == F.col("_lo"), "left"))
    means = []
    for v in values:
        total, n = (F.col(f"_hi_{v}_{k}") - F.coalesce(F.col(f"_lo_{v}_{k}"), F.lit(0)) for k in ("sum", "n"))
        means.append(F.round(F.try_divide(total.cast("double"), n), digits).alias(f"smoothed_{v}"))
    return out.select(*df.columns, pos_col, *means)
