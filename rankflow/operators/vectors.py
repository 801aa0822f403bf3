"""Vector operators: cosine similarity and nearest prototype."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(F.transform(a, lambda x: x * x), F.lit(0.0), lambda acc, v: acc + v))


def as_double_array(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.transform(col, lambda x: x.cast("double"))


def cosine(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """a.b / (|a| |b|) in double precision."""
    na = norm(a) if norm_a is None else norm_a
    nb = norm(b) if norm_b is None else norm_b
    return F.try_divide(_dot(a, b), na * nb)


def _files(uri: str):
    """(file system, path) of a folder of the shared storage, inside a task."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _by_length(lists):
    """(length, rows, matrix) for every length of vectors in a list array."""
    import numpy as np
    import pyarrow as pa

    sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    for n in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == n)
        flat = lists.take(pa.array(rows)).flatten().cast(pa.float64())
        yield n, rows, flat.to_numpy(zero_copy_only=False).reshape(-1, n)


def nearest_prototype(df: DataFrame, vec_col: str, prototypes: DataFrame, label_col: str,
                      order_col: str, proto_vec_col: str = "embedding",
                      block_size: int = 1024) -> DataFrame:
    """Label of the most similar prototype (cosine), ties to the earlier
    prototype in ``order_col`` order (any sortable type).

    The prototypes are numbered in that order and written to the shared
    folder.  Every task reads them there block by block, once per batch of its
    vectors, multiplies two bounded matrices per block and keeps the best so
    far: the vectors are not shuffled, neither the plan nor a task's memory
    grows with the number of prototypes, and a product costs far more than the
    read.  A vector that is null, empty, zero or not finite, or of another
    length than all prototypes, has no similarity and no label."""
    from rankflow.operators.ordering import with_position
    from rankflow.session import scratch_path

    flat = prototypes.select(F.col(order_col).alias("given"), F.col(label_col).alias("label"),
                             as_double_array(proto_vec_col).alias("v"))
    path = scratch_path(df.sparkSession, "prototypes")
    placed = with_position(flat, ["given", "label", "v"], "ord")
    placed.select("ord", F.col("label").cast("string").alias("label"), "v").write.parquet(path)
    names = [c for c in df.columns if c not in ("predicted_label", "similarity")]
    schema = T.StructType([*[df.schema[c] for c in names], T.StructField("predicted_label", T.StringType()),
                           T.StructField("similarity", T.DoubleType())])

    def compare(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute  # noqa: F401
        import pyarrow.dataset as ds

        fs, folder = _files(path)
        files = [f for f in fs.get_file_info(_selector(folder)) if f.path.endswith(".parquet")]
        stored = ds.dataset([f.path for f in files], filesystem=fs, format="parquet") if files else None
        for b in batches:
            # the best so far of every vector, and its prototype's place and label
            best = np.full(b.num_rows, -np.inf)
            place = np.full(b.num_rows, np.iinfo(np.int64).max)
            label = np.full(b.num_rows, None, object)
            vectors = list(_by_length(b.column(vec_col)))
            for block in stored.to_batches(batch_size=block_size) if stored is not None else ():
                ords = block.column("ord").to_numpy()
                labels = np.array(block.column("label").to_pylist(), object)
                protos = {n: (rows, y) for n, rows, y in _by_length(block.column("v"))}
                for n, rows, x in vectors:
                    if n not in protos:
                        continue
                    own, y = protos[n]
                    order = np.argsort(ords[own], kind="stable")
                    own, y = own[order], y[order]
                    with np.errstate(all="ignore"):
                        sim = (x @ y.T) / np.outer(np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1)))
                    sim = np.where(np.isfinite(sim), sim, -np.inf)
                    at = sim.argmax(1)
                    top, ord_ = sim[np.arange(len(x)), at], ords[own[at]]
                    better = np.isfinite(top) & ((top > best[rows]) | ((top == best[rows]) & (ord_ < place[rows])))
                    some = rows[better]
                    best[some], place[some], label[some] = top[better], ord_[better], labels[own[at[better]]]
            none = ~np.isfinite(best)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in names], pa.array(label.tolist(), pa.string()), pa.array(best, pa.float64(), mask=none)],
                [*names, "predicted_label", "similarity"])

    return df.select(*names).mapInArrow(compare, schema)


def _selector(folder: str):
    from pyarrow import fs

    return fs.FileSelector(folder)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
