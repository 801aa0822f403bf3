"""Positional operators without single-partition windows.

pandas code in the reference relies on row positions after a sort
(``reset_index``, ``iloc[:split]``, ``range(len(df) - 10)``).  A Spark
``row_number()`` over an un-partitioned window moves every row into one
task, so positions are computed instead as:

1. range-partition on a *total* order and sort inside each partition
   (one shuffle; hot keys are split because the bounds include the
   tie-breaking columns);
2. ``monotonically_increasing_id`` encodes (partition, index-in-partition);
3. per-partition row counts -> cumulative offsets.  That table has one
   row per partition, so broadcasting it is bounded by the partition
   count, never by the data.

The range-sorted, tagged rows are cut from their lineage before they are
counted and joined, as a table in the shared ``spark.checkpoint.dir`` (a
reliable ``checkpoint()`` where the partitions must be read back as they are):
two independent range exchanges could draw different bounds when the sampler
re-samples an imbalanced input, and a lost executor must not re-derive a row's
index differently.  A table is compressed by column and read by column; a
checkpoint holds whole rows as they are.  Callers should project only the
columns they need first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.session import checkpoint_dir, materialize

_INDEX_BITS = 33  # monotonically_increasing_id: partition id in the upper 31 bits

# consecutive positions per halo bucket: what one window task holds at most
BUCKET_ROWS = 100_000


def _sort_cols(order_cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_cols]


def _default_partitions(df: DataFrame) -> int:
    spark = df.sparkSession
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def sorted_runs(df: DataFrame, order_cols, num_partitions: int | None = None,
                in_place: bool = True) -> tuple[DataFrame, DataFrame]:
    """``df`` range-partitioned and sorted, each row tagged with its partition
    ``_rf_part`` and place ``_rf_idx`` in it, and per non-empty partition its
    rows ``_rf_n``, the rows before it ``_rf_off`` and all rows ``_rf_all``.
    With ``in_place`` the partitions are read back as they are (checkpointed);
    without, the rows are a stored table and only their tags hold."""
    keys = _sort_cols(order_cols)
    n = num_partitions or _default_partitions(df)
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    mid = F.monotonically_increasing_id()
    tagged = ranged.select(
        "*",
        F.shiftright(mid, _INDEX_BITS).alias("_rf_part"),
        mid.bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)).alias("_rf_idx"),
    )
    if in_place:
        checkpoint_dir(df.sparkSession)
        tagged = tagged.checkpoint(eager=True)
    else:
        tagged = materialize(tagged)
    counts = tagged.groupBy("_rf_part").agg(F.count(F.lit(1)).alias("_rf_n"))
    # one row per partition: these single-partition windows are bounded by n
    offsets = counts.select(
        "_rf_part", "_rf_n",
        F.coalesce(
            F.sum("_rf_n").over(
                Window.orderBy("_rf_part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_rf_off"),
        F.sum("_rf_n").over(Window.partitionBy()).alias("_rf_all"),
    )
    return tagged, offsets


def with_position(df: DataFrame, order_cols, pos_col: str = "pos",
                  num_partitions: int | None = None,
                  total_col: str | None = None) -> DataFrame:
    """Append a 0-based global position of each row in ``order_cols`` order
    (and, if ``total_col`` is given, the total row count).

    ``order_cols`` must be a total order (append a unique tie-breaker);
    otherwise positions among tied rows are not reproducible.  One path for
    every size of input.
    """
    tagged, offsets = sorted_runs(df, order_cols, num_partitions, in_place=False)
    # the positions are read more than once: one row per partition is kept
    out = tagged.join(F.broadcast(materialize(offsets.coalesce(1))), "_rf_part", "inner")
    out = out.withColumn(pos_col, (F.col("_rf_off") + F.col("_rf_idx")).cast("long"))
    if total_col:
        out = out.withColumn(total_col, F.col("_rf_all").cast("long"))
    return out.drop("_rf_part", "_rf_idx", "_rf_off", "_rf_n", "_rf_all")


def dense_codes(values: DataFrame, value_col: str, code_col: str = "code",
                num_partitions: int | None = None) -> DataFrame:
    """0-based code of each distinct non-null value in lexicographic
    (binary / code-point) order -- a label encoder fitted on the distinct
    set, which is the only thing that is ordered."""
    distinct = values.select(value_col).where(F.col(value_col).isNotNull()).distinct()
    return with_position(distinct, [value_col], code_col, num_partitions)


def position_split(df: DataFrame, order_cols, train_fraction: float = 0.8,
                   split_col: str = "split", pos_col: str = "pos",
                   total_col: str | None = None) -> DataFrame:
    """First floor(fraction * n) rows in ``order_cols`` order are ``train``,
    the rest ``test`` -- the reference's ``iloc[:split]``."""
    positioned = with_position(df, order_cols, pos_col, total_col="_rf_total")
    cut = F.floor(F.col("_rf_total") * F.lit(train_fraction))
    out = positioned.withColumn(split_col, F.when(F.col(pos_col) < cut, F.lit("train"))
                                .otherwise(F.lit("test")))
    if total_col:
        return out.withColumnRenamed("_rf_total", total_col)
    return out.drop("_rf_total")


def halo_buckets(positioned: DataFrame, pos_col: str, before: int, after: int = 0,
                 bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Cut a globally positioned table into buckets of ``bucket_rows``
    consecutive positions and copy the ``before`` rows preceding (and
    ``after`` rows following) each bucket into it, flagged ``_rf_core=False``.

    A window partitioned by ``_rf_bucket`` and ordered by ``pos_col`` then
    sees every frame of up to ``before``/``after`` neighbours, while no task
    holds more than ``bucket_rows + before + after`` rows, however the data
    is keyed.
    """
    if before > bucket_rows or after > bucket_rows:
        raise ValueError("halo larger than a bucket")
    b = F.floor(F.col(pos_col) / F.lit(bucket_rows)).cast("long")
    off = F.col(pos_col) - b * F.lit(bucket_rows)
    parts = [F.struct(b.alias("bucket"), F.lit(True).alias("core"))]
    if before:
        parts.append(F.when(off >= F.lit(bucket_rows - before),
                            F.struct((b + 1).alias("bucket"), F.lit(False).alias("core"))))
    if after:
        parts.append(F.when((off < F.lit(after)) & (b > 0),
                            F.struct((b - 1).alias("bucket"), F.lit(False).alias("core"))))
    targets = F.filter(F.array(*parts), lambda x: x.isNotNull())
    return (positioned.withColumn("_rf_t", F.explode(targets))
            .withColumn("_rf_bucket", F.col("_rf_t.bucket"))
            .withColumn("_rf_core", F.col("_rf_t.core"))
            .drop("_rf_t"))


# The notebooks' "chronological" sort keys -- month, day of
# month, then the weekday *name* (year already dropped).
LITERAL_CHRONO_KEYS = ["month", "date", "day"]


def literal_chronological_order(df: DataFrame) -> DataFrame:
    """The reference's literal sort (month, date, weekday name), kept for
    parity; splits and windows use the true timestamp instead."""
    return df.orderBy(*[F.col(c) for c in LITERAL_CHRONO_KEYS])
