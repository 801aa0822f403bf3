"""Near-duplicate vectors by an epsilon grid order join.

Vectors of unit length with a cosine of ``c`` or more lie within
``eps = sqrt(2 - 2c)`` of each other, and so do their projections.  The
vectors are projected on the leading principal directions, sorted by label and
by the grid cell (side ``eps``) of the projection, dimension after dimension,
and the sorted sequence is cut into blocks.  Intervals of the sequence are
joined recursively, from the whole sequence down to pairs of blocks: a pair
whose labels do not meet or whose boxes are further apart than ``eps`` is
dropped with everything below it.  A pair of blocks that is left is halved on in
one task by the same rule; the parts that remain are compared in double
precision.  The directions only decide what is skipped, never what is linked.

Equal vectors of a label are one class, compared once; the links of a vector
are the other members of its class and those of the linked classes.  A task
reports a count and a spanning tree, so no pair becomes a row.  Blocks are
files in the shared folder; a task holds a few of them.

Rows: a vector that is null, empty, zero or holds null or non-finite
components, and one with a null label or id, links with nothing and is its own
component (a null id: a null component).  Vectors of different lengths are not
compared.  Rows that repeat an id are vectors of their own, each with its
result.  Extra columns are ignored.  Ties need no rule: components and counts
do not depend on order.  An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import attempt_name, file_system, ship, shuffle_partitions, written
from rankflow.llm.components import components
from rankflow.operators.ordering import with_position
from rankflow.session import scratch_path

BLOCK = 1024      # classes in a block
PART = 128        # classes in the smallest interval of a block
FAN = 8           # intervals joined to one on each level
LEADING = 8       # principal directions of the grid
HOT = 1000        # a class with more than 1/HOT of all rows is looked up by broadcast


def _rows(batch_column):
    """(length, is usable, flat values as doubles, offsets) of a list column."""
    import numpy as np
    import pyarrow as pa

    at = batch_column.offsets.to_numpy().astype(np.int64)
    flat = batch_column.values.cast(pa.float64())
    x = flat.to_numpy(zero_copy_only=False)
    bad = np.zeros(len(x) + 1, np.int64)
    bad[1:] = np.cumsum(~np.isfinite(x))          # a null component reads as NaN
    some = np.zeros(len(x) + 1, np.int64)
    some[1:] = np.cumsum(x != 0)
    ok = (bad[at[1:]] == bad[at[:-1]]) & (some[at[1:]] > some[at[:-1]])
    if batch_column.null_count:
        ok &= batch_column.is_valid().to_numpy(zero_copy_only=False)
    return np.diff(at), ok, x, at


def scaled(x):
    """Rows of a matrix, each divided by a power of two near its largest part."""
    import numpy as np

    top = np.abs(x).max(1, keepdims=True)
    return np.ldexp(x, -np.frexp(top)[1])


def _matrix(vectors: list, width: int):
    import numpy as np

    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        v = np.frombuffer(v, "<f8")
        out[i, :len(v)] = v
    return out


def _usable(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, label, key (digest of label and vector), vector (as bytes); the
    last two null where the row links with nothing."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                     F.col(vector_col).cast("array<double>").alias("v"))

    def clean(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        for b in batches:
            ids, labels = b.column(0), b.column(1)
            size, ok, x, at = _rows(b.column(2))
            ok &= ids.is_valid().to_numpy(zero_copy_only=False) & labels.is_valid().to_numpy(zero_copy_only=False)
            keys, vectors = [None] * len(ok), [None] * len(ok)
            names = labels.to_pylist()
            x = x + 0.0                            # -0.0 is 0.0
            for i in np.flatnonzero(ok).tolist():
                vectors[i] = x[at[i]:at[i + 1]].astype("<f8").tobytes()
                keys[i] = hashlib.blake2b(vectors[i] + names[i].encode(), digest_size=16,
                                          salt=int(size[i]).to_bytes(8, "little")).digest()
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())],
                                             ["id", "label", "key", "vector"])

    return rows.mapInArrow(clean, "id long, label string, key binary, vector binary")


def principal_directions(classes: DataFrame, width: int, k: int):
    """The ``k`` leading directions of the unit vectors (width x k).  To the
    driver comes one number per pair of dimensions."""
    import numpy as np

    def moments(batches):
        import pyarrow as pa

        total = np.zeros((width, width))
        for b in batches:
            x = scaled(_matrix(b.column(0).to_pylist(), width))
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            total += x.T @ x
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "m"])

    sums = classes.select("vector").mapInArrow(moments, "i long, j long, m double").groupBy("i", "j").agg(F.sum("m").alias("m"))
    m = np.zeros((width, width))
    for r in sums.collect():
        m[r.i, r.j] = m[r.j, r.i] = r.m
    return np.linalg.eigh(m)[1][:, ::-1][:, :k]


def coordinates(x, directions):
    """Projections of the unit rows of ``x``, and the length of what is left."""
    import numpy as np

    y = x @ directions
    return np.column_stack([y, np.sqrt(np.maximum(1 - (y * y).sum(1), 0))])


def _blocks(classes: DataFrame, directions, eps: float) -> DataFrame:
    """The classes sorted in grid order and packed into files; one row per
    block: number, place, labels and box."""
    spark = classes.sparkSession
    folder = scratch_path(spark, "grid")
    width, k = directions.shape

    def place(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            x = scaled(_matrix(b.column(b.schema.get_field_index("vector")).to_pylist(), width))
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            cells = np.floor(x @ directions / eps).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, cells.size + 1, k), pa.int32()), pa.array(cells.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], [*b.schema.names, "cells"])

    order = ["label", "size", "cells", "key"]
    ranged = (classes.select("label", F.octet_length("vector").alias("size"), "key", "vector", "n")
              .mapInArrow(place, "label string, size int, key binary, vector binary, n long, cells array<int>")
              .repartitionByRange(shuffle_partitions(classes), *order).sortWithinPartitions(*order)
              .select("label", "key", "vector", "n"))

    def pack(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, held, seq, out, name, at = TaskContext.get().partitionId(), [], 0, None, None, 0

        def flush(rows):
            nonlocal seq, out, name, at
            if out is None:
                fs, top = file_system(folder)
                fs.create_dir(top, recursive=True)
                name = attempt_name(".blocks")
                out = fs.open_output_stream(f"{top}/{name}", compression=None)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as w:
                w.write_table(rows)
            data = sink.getvalue()
            out.write(data)
            x = scaled(_matrix(rows.column("vector").to_pylist(), width))
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            y = coordinates(x, directions)
            labels = rows.column("label")
            row = {"part": part, "seq": seq, "file": f"{folder}/{name}", "offset": at, "length": data.size,
                   "first": labels[0].as_py(), "last": labels[-1].as_py()}
            for j in range(k + 1):
                row |= {f"lo{j}": float(y[:, j].min()), f"hi{j}": float(y[:, j].max())}
            at, seq = at + data.size, seq + 1
            return pa.RecordBatch.from_pylist([row])

        for b in batches:
            held.append(b)
            while sum(x.num_rows for x in held) >= BLOCK:
                t = pa.Table.from_batches(held)
                yield flush(t.slice(0, BLOCK).combine_chunks())
                held = t.slice(BLOCK).to_batches()
        if sum(x.num_rows for x in held):
            yield flush(pa.Table.from_batches(held).combine_chunks())
        if out is not None:
            out.close()

    boxes = "".join(f", lo{j} double, hi{j} double" for j in range(k + 1))
    made = written(ranged.mapInArrow(pack, "part long, seq long, file string, offset long, length long, first string, last string"
                                     + boxes), "grid-blocks")
    return written(with_position(made, ["part", "seq"], "node").drop("part", "seq"), "grid-order")


def _apart(x: str, y: str, dims: int) -> Column:
    """Squared distance of two boxes."""
    total = F.lit(0.0)
    for j in range(dims):
        gap = F.greatest(F.col(f"{x}.lo{j}") - F.col(f"{y}.hi{j}"), F.col(f"{y}.lo{j}") - F.col(f"{x}.hi{j}"), F.lit(0.0))
        total = total + gap * gap
    return total


def near_blocks(blocks: DataFrame, dims: int, eps2: float) -> DataFrame:
    """Pairs (a <= b) of blocks that may hold a link, found by joining the
    intervals of the sequence from the top down."""
    levels, n = [blocks.drop("file", "offset", "length")], blocks.count()
    while n > 1:
        up = levels[-1].withColumn("node", F.floor(F.col("node") / FAN).cast("long")).groupBy("node").agg(
            F.min("first").alias("first"), F.max("last").alias("last"),
            *[F.min(f"lo{j}").alias(f"lo{j}") for j in range(dims)], *[F.max(f"hi{j}").alias(f"hi{j}") for j in range(dims)])
        levels.append(written(up, "grid-intervals"))
        n = -(-n // FAN)
    pairs = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in reversed(levels[:-1]):
        halves = F.sequence(F.lit(0), F.lit(FAN - 1))
        below = (pairs.select((F.col("a") * FAN).alias("a"), "b", F.explode(halves).alias("i"))
                 .select((F.col("a") + F.col("i")).alias("a"), (F.col("b") * FAN).alias("b"))
                 .select("a", "b", F.explode(halves).alias("i")).select("a", (F.col("b") + F.col("i")).alias("b")).where("a <= b"))
        pairs = written(below.alias("p").join(level.alias("x"), F.col("p.a") == F.col("x.node"))
                        .join(level.alias("y"), F.col("p.b") == F.col("y.node"))
                        .where((F.col("x.last") >= F.col("y.first")) & (_apart("x", "y", dims) <= eps2))
                        .select("a", "b"), "grid-pairs")
    return pairs


def links_between(x, y, same, cosine: float):
    """Boolean matrix of the links of the rows of ``x`` and ``y``."""
    import numpy as np

    with np.errstate(invalid="ignore"):
        c = (x @ y.T) / np.outer(np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1)))
    return (c >= cosine) & same


def _roots(n: int, i, j):
    """Smallest member of the component of each of ``n`` nodes."""
    import numpy as np

    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(pairs: DataFrame, blocks: DataFrame, directions, cosine: float, eps2: float) -> DataFrame:
    """(node, root, links) of every class with a link, per pair of blocks; a
    node is block * BLOCK + place."""
    width = directions.shape[0]
    at = [blocks.select(F.col("node").alias(s), F.struct("file", "offset", "length").alias(f"{s}_at")) for s in "ab"]
    todo = pairs.join(at[0], "a").join(at[1], "b").repartition(shuffle_partitions(pairs), "a", "b").sortWithinPartitions("a", "b")

    def compare(batches):
        import numpy as np
        import pyarrow as pa

        cache = {}

        def load(node, where):
            if node not in cache:
                while len(cache) >= 8:
                    cache.pop(next(iter(cache)))
                fs, path = file_system(where["file"])
                with fs.open_input_file(path) as f:
                    t = pa.ipc.open_stream(f.read_at(where["length"], where["offset"])).read_all()
                v = t.column("vector").to_pylist()
                x = scaled(_matrix(v, width))
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                y = coordinates(unit, directions)
                cuts = np.arange(0, len(y), PART)
                kind = [(label, len(w)) for label, w in zip(t.column("label").to_pylist(), v)]
                cache[node] = (x, kind, t.column("n").to_numpy().astype(np.int64),
                               np.minimum.reduceat(y, cuts), np.maximum.reduceat(y, cuts))
            return cache[node]

        for batch in batches:
            for r in batch.to_pylist():
                a, b = r["a"], r["b"]
                x, kx, nx, lo, hi = load(a, r["a_at"])
                y, ky, ny, lo2, hi2 = load(b, r["b_at"])
                number = {k: i for i, k in enumerate(dict.fromkeys(kx + ky))}
                gx, gy = np.array([number[k] for k in kx]), np.array([number[k] for k in ky])
                found = []
                for i in range(len(lo)):
                    gap = np.maximum(np.maximum(lo[i] - hi2, lo2 - hi[i]), 0)
                    near = np.flatnonzero((gap * gap).sum(1) <= eps2)
                    if a == b:
                        near = near[near >= i]
                    if not len(near):
                        continue
                    rows = np.arange(i * PART, min((i + 1) * PART, len(x)))
                    cols = np.concatenate([np.arange(j * PART, min((j + 1) * PART, len(y))) for j in near.tolist()])
                    same = gx[rows][:, None] == gy[cols]
                    if a == b:
                        same &= rows[:, None] < cols
                    p, q = np.nonzero(links_between(x[rows], y[cols], same, cosine))
                    found.append((rows[p], cols[q]))
                p, q = (np.concatenate([f[s] for f in found]) for s in (0, 1)) if found else ([], [])
                if not len(p):
                    continue
                ids = np.concatenate([a * BLOCK + np.arange(len(x)), b * BLOCK + np.arange(len(y))]) if a != b else a * BLOCK + np.arange(len(x))
                other = q + (len(x) if a != b else 0)
                links = np.zeros(len(ids), np.int64)
                np.add.at(links, p, ny[q])
                np.add.at(links, other, nx[p])
                root = _roots(len(ids), p, other)
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(ids[root[some]]), pa.array(links[some])],
                                                 ["node", "root", "links"])

    return todo.select("a", "b", "a_at", "b_at").mapInArrow(compare, "node long, root long, links long")


def _members(blocks: DataFrame) -> DataFrame:
    """(node, key, n, least) of the classes, read from the blocks."""
    def read(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for r in b.to_pylist():
                fs, path = file_system(r["file"])
                with fs.open_input_file(path) as f:
                    t = pa.ipc.open_stream(f.read_at(r["length"], r["offset"])).read_all()
                node = pa.array(r["node"] * BLOCK + np.arange(t.num_rows))
                yield from pa.Table.from_arrays([node, t.column("key")], ["c_node", "c_key"]).combine_chunks().to_batches()

    return blocks.select("node", "file", "offset", "length").repartition(shuffle_partitions(blocks), "node").mapInArrow(
        read, "c_node long, c_key binary")


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 cosine: float = 0.93) -> DataFrame:
    """One row per vector: id, n_links (other vectors of its label with this
    cosine or more), component_id (smallest id reachable by links) and kept
    (id = component_id)."""
    rows = written(_usable(df, id_col, vector_col, label_col), "vectors")
    usable = rows.where("key is not null")
    classes = written(usable.groupBy("key").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"),
                                                F.first("label").alias("label"), F.first("vector").alias("vector")), "classes")
    bytes_, total = classes.agg(F.max(F.octet_length("vector")), F.sum("n")).first()
    width = (bytes_ or 8) // 8
    eps2 = 2 - 2 * cosine + 1e-9
    directions = principal_directions(classes, width, min(LEADING, width))
    blocks = _blocks(classes, directions, math.sqrt(eps2))
    pairs = near_blocks(blocks, directions.shape[1] + 1, eps2)
    found = written(_compare(pairs, blocks, directions, cosine, eps2), "links")
    roots = components(found.where("node <> root").select("node", "root"), "node", "root")
    links = found.groupBy("node").agg(F.sum("links").alias("links")).withColumnRenamed("node", "l_node")
    named = written(_members(blocks).join(classes.select(F.col("key").alias("k_key"), "least", "n"), F.col("c_key") == F.col("k_key"))
                    .join(links, F.col("c_node") == F.col("l_node"), "left")
                    .join(roots.select(F.col("node").alias("r_node"), "root"), F.col("c_node") == F.col("r_node"), "left")
                    .select("c_key", "least", "n", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "root"), "named")
    heads = named.where("root is not null").groupBy("root").agg(F.min("least").alias("head")).withColumnRenamed("root", "h_root")
    judged = written(named.join(heads, F.col("root") == F.col("h_root"), "left")
                     .select("c_key", "n", "links", F.coalesce("head", "least").alias("component")), "judged")
    # fewer than HOT classes can hold more than 1/HOT of all rows
    hot = F.broadcast(judged.where(F.col("n") * HOT > F.lit(total or 0)).drop("n"))
    on = F.col("key") == F.col("c_key")
    slim = rows.select("id", "key")
    answer = (slim.join(hot, on).select("id", "links", "component")
              .unionByName(slim.join(hot, on, "left_anti").join(judged.drop("n"), on, "left").select("id", "links", "component")))
    return answer.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                         F.coalesce("component", "id").alias("component_id"),
                         F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"))


ship(__name__)
