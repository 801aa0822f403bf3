"""Fixed-length history windows for sequence models.

For each row the ``length`` preceding rows (in time order, within the
same item when keyed) become its history and the row's own value its
target; rows with fewer than ``length`` predecessors emit nothing, so an
item with n rows yields max(n - length, 0) samples.

The table is sorted into range partitions once.  A partition's rows are
turned into windows in the order they lie there; only the last ``length``
rows before each partition travel to it (a broadcast of at most ``length``
rows per partition), so there is one full exchange and an item holding a
third of all rows is spread over as many partitions as its rows fill.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.operators.ordering import sorted_runs

# the window function goes to the Python workers by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _edges(tagged: DataFrame, offsets: DataFrame, columns: list[str], length: int) -> DataFrame:
    """Per partition the ``length`` rows before its first one, in order (they
    may come from several short partitions)."""
    tails = (tagged.join(F.broadcast(offsets), "_rf_part")
             .where(F.col("_rf_idx") >= F.col("_rf_n") - length)
             .select((F.col("_rf_off") + F.col("_rf_idx")).alias("_rf_pos"), *columns))
    needed = tails.withColumn("_rf_at", F.explode(F.sequence(F.col("_rf_pos") + 1, F.col("_rf_pos") + length)))
    starts = offsets.select(F.col("_rf_part").alias("_rf_to"), F.col("_rf_off").alias("_rf_at"))
    row = F.struct("_rf_pos", *columns)
    return (needed.join(F.broadcast(starts), "_rf_at").groupBy("_rf_to")
            .agg(F.array_sort(F.collect_list(row)).alias("_rf_edge")))


def history_windows(df: DataFrame, order_cols: list[str], features: list[str], target: str,
                    key: str | None = None, length: int = 10, history_col: str = "history",
                    bucket_rows: int | None = None) -> DataFrame:
    """Rows with their ``length`` predecessors as an ordered array of
    structs of ``features``.  With ``key`` the predecessors must belong to
    the same item (keyed windows); without, the whole table is one series.
    ``bucket_rows`` sets the partitions by their mean size (default: the
    session's shuffle partitions)."""
    keys = ([key] if key else []) + list(order_cols)
    parts = -(-df.count() // bucket_rows) if bucket_rows else None
    tagged, offsets = sorted_runs(df, keys, max(parts, 1) if parts is not None else None)
    used = list(dict.fromkeys(([key] if key else []) + features))
    edges = _edges(tagged, offsets, used, length)
    # an empty list, not null, where a row begins no partition: at every row Spark's
    # Arrow writer goes over all the null lists at the end of a batch
    none = F.array().cast(edges.schema["_rf_edge"].dataType)
    edge = F.coalesce(F.when(F.col("_rf_idx") == 0, F.col("_rf_edge")), none).alias("_rf_edge")
    rows = tagged.join(F.broadcast(edges), F.col("_rf_part") == F.col("_rf_to"), "left").select(*df.columns, edge)
    kept = [f for f in df.schema.fields if f.name not in (history_col, "target")]
    # a window leaves the worker as flat columns: a row of nested structs costs
    # many times as much to hand over, and a reader of single steps needs none
    flat = [(f, i, f"_rf_{f}_{i}") for i in range(length) for f in features]
    schema = T.StructType([*kept, *[T.StructField(c, df.schema[f].dataType) for f, _, c in flat],
                           T.StructField("target", df.schema[target].dataType)])
    names = [f.name for f in kept]

    def windows(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        before = None
        for b in batches:
            if not b.num_rows:
                continue
            if before is None:
                edge = b.column("_rf_edge")[0].values
                before = {c: edge.field(c) for c in used}
            both = {c: pa.concat_arrays([before[c], b.column(c)]) for c in used}
            n = len(both[used[0]])
            at = np.arange(max(n - b.num_rows, length), n)          # rows with enough predecessors
            if key and len(at):
                same = pc.equal(both[key].take(pa.array(at - length)), both[key].take(pa.array(at)))
                at = at[pc.fill_null(same, False).to_numpy(zero_copy_only=False)]
            own = pa.array(at - (n - b.num_rows))
            past = [pa.array(at - length + i) for i in range(length)]
            hist = [both[f].take(past[i]) for f, i, _ in flat]
            out = [b.column(c).take(own) for c in names] + hist + [b.column(target).take(own)]
            yield pa.RecordBatch.from_arrays(out, schema.names)
            before = {c: both[c].slice(max(n - length, 0)) for c in used}

    steps = [F.struct(*[F.col(f"_rf_{f}_{i}").alias(f) for f in features]) for i in range(length)]
    return rows.mapInArrow(windows, schema).select(*names, F.array(*steps).alias(history_col), "target")


def attach_static(samples: DataFrame, static: DataFrame, key: str, array_cols: dict[str, int],
                  scalar_defaults: dict[str, object] | None = None) -> DataFrame:
    """Per-item attributes joined onto every sample; missing arrays become
    zeros of their fixed length, missing scalars their default."""
    out = samples.join(static, key, "left")
    for c, n in array_cols.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.array_repeat(F.lit(0), n)))
    for c, v in (scalar_defaults or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out


def flatten_history(samples: DataFrame, history_col: str, features: list[str], length: int) -> DataFrame:
    """history[i].f -> columns ``f_lag{length - i}`` (lag 1 = most recent),
    for learners that take flat feature vectors."""
    cols = []
    for i in range(length):
        lag = length - i
        for f in features:
            cols.append(F.col(history_col)[i][f].alias(f"{f}_lag{lag}"))
    return samples.select("*", *cols)
