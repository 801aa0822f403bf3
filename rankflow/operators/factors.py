"""Factorisation machines trained on stored blocks of rows.

Spark's learner keeps every row as an object and goes over them once per
iteration and parameter map.  Here the rows are packed once into blocks of
arrays in the shared folder, and one pass per iteration gives the gradients of
all parameter maps.  Loss, start, optimiser (Adam with weight decay) and stop
are those of Spark's ``FMRegressor``, and so is the model that comes out.
"""

from __future__ import annotations

import math
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.ml.regression import FMRegressionModel, FMRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.session import materialize

# the functions of the passes go to the Python workers by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PLACE = "rows int, target binary, ids binary, dense int, dense_codes binary, dense_values binary, slots int, places binary, values binary"


# ---- blocks ------------------------------------------------------------------

def stored_blocks(rows: DataFrame, features: str, label: str) -> DataFrame:
    """The rows as a table of blocks, one per Arrow batch: the label, the
    columns that most rows of the block have as a matrix, and the other
    non-zero parts padded to the most of any row, named by their place among
    the block's own columns."""
    v = F.unwrap_udt(features)
    parts = rows.select(F.col(label).cast("double").alias("y"), v["size"].alias("size"),
                        F.coalesce(v["indices"], F.array().cast("array<int>")).alias("ids"), v["values"].alias("x"))
    return materialize(parts.mapInArrow(_packed, _PLACE))


def _packed(batches):
    import pyarrow as pa

    for b in batches:
        n = b.num_rows
        if not n:
            continue
        sizes = b.column("size")
        counts = np.diff(b.column("x").offsets.to_numpy())
        x = b.column("x").flatten().to_numpy(zero_copy_only=False)
        # a dense vector has no size and no indices: all of its parts count
        if sizes.null_count:
            own = b.column("ids").flatten().to_numpy(zero_copy_only=False)
            dense = np.asarray(sizes.is_null())
            ids, sparse = np.empty(len(x), np.int64), np.repeat(~dense, counts)
            ids[sparse] = own
            starts = np.repeat(np.cumsum(counts) - counts, counts)
            ids[~sparse] = (np.arange(len(x)) - starts)[~sparse]
        else:
            ids = b.column("ids").flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(n), counts)
        kept = x != 0
        ids, x, row = ids[kept].astype(np.int64), x[kept], row[kept]
        columns, place, seen = np.unique(ids, return_inverse=True, return_counts=True)
        full = seen * 2 > n
        order = np.concatenate([np.flatnonzero(full), np.flatnonzero(~full)])
        rank = np.empty(len(columns), np.int32)
        rank[order] = np.arange(len(columns))
        place, most = rank[place], int(full.sum())
        codes, tables = [], []
        matrix = np.zeros((most, n))
        own = place < most
        matrix[place[own], row[own]] = x[own]
        for c in matrix:
            u, k = np.unique(c, return_inverse=True)
            if len(u) <= 256:  # few values: one byte a row
                codes.append(k.astype(np.uint8).tobytes())
                tables.append(u)
            else:
                codes.append(b"")
                tables.append(c)
        place, row, x = place[~own], row[~own], x[~own]
        held = np.bincount(row, minlength=n)
        slots = int(held.max(initial=0))
        nth = np.arange(len(row)) - np.repeat(np.cumsum(held) - held, held)
        grid = np.full((slots, n), len(columns), np.int32)  # the place after the last has weight 0
        grid[nth, row] = place
        ones = bool((x == 1).all())
        vals = np.zeros((0, 0))
        if not ones:
            vals = np.zeros((slots, n))
            vals[nth, row] = x
        small = np.uint8 if len(columns) < 256 else np.uint16 if len(columns) < 65536 else np.int32
        lens = np.array([len(t) for t in tables], np.int64)
        yield pa.RecordBatch.from_pydict({
            "rows": pa.array([n], pa.int32()), "target": [b.column("y").to_numpy(zero_copy_only=False).tobytes()],
            "ids": [columns[order].tobytes()], "dense": pa.array([most], pa.int32()), "dense_codes": [b"".join(codes)],
            "dense_values": [lens.tobytes() + b"".join(t.tobytes() for t in tables)], "slots": pa.array([slots], pa.int32()),
            "places": [grid.astype(small).tobytes()], "values": [vals.tobytes()]})


def _unpacked(r: dict):
    """(labels, columns, matrix of the first columns, places, values or None)."""
    n, most, slots = r["rows"], r["dense"], r["slots"]
    y, ids = np.frombuffer(r["target"]), np.frombuffer(r["ids"], np.int64)
    lens, at, code = np.frombuffer(r["dense_values"], np.int64, most), 8 * most, 0
    matrix = np.empty((n, most))
    for j, k in enumerate(lens):
        t = np.frombuffer(r["dense_values"], np.float64, k, at)
        at += 8 * k
        if k <= 256 and len(r["dense_codes"]) >= code + n:
            matrix[:, j] = t[np.frombuffer(r["dense_codes"], np.uint8, n, code)]
            code += n
        else:
            matrix[:, j] = t
    small = np.uint8 if len(ids) < 256 else np.uint16 if len(ids) < 65536 else np.int32
    places = np.frombuffer(r["places"], small).reshape(slots, n)
    values = np.frombuffer(r["values"]).reshape(slots, n) if r["values"] else None
    return y, ids, matrix, places, values


# ---- one pass ------------------------------------------------------------------

def _gradients(widths: list[int], weights: np.ndarray, squares: np.ndarray, base: list[float]):
    """A pass over blocks: per machine of ``widths`` factors the sums of the
    gradient.  ``weights``: per feature the factors of all machines and then
    their linear weights; ``squares``: the factors' sums of squares."""
    m, ends = len(widths), np.cumsum([0, *widths])
    f = ends[-1]

    def run(batches):
        import pyarrow as pa

        total, total2 = np.zeros(weights.shape), np.zeros(squares.shape)
        errors, count = np.zeros(m), 0
        for b in batches:
            for i in range(b.num_rows):  # one block at a time
                r = {c: b.column(c)[i].as_py() for c in b.schema.names}
                y, ids, matrix, places, values = _unpacked(r)
                n, most = len(y), matrix.shape[1]
                w = np.vstack([weights[ids], np.zeros((1, f + m))])
                q = np.vstack([squares[ids], np.zeros((1, m))])
                s = matrix @ w[:most]
                q_rows = (matrix * matrix) @ q[:most]
                both = np.hstack([w, q])
                for k, p in enumerate(places):
                    if values is None:
                        took = both[p]
                        s += took[:, :f + m]
                        q_rows += took[:, f + m:]
                    else:
                        s += w[p] * values[k][:, None]
                        q_rows += q[p] * (values[k] ** 2)[:, None]
                back = np.empty((f + m, n))
                for k in range(m):
                    own = s[:, ends[k]:ends[k + 1]]
                    e = 2 * (base[k] + s[:, f + k] + 0.5 * ((own * own).sum(1) - q_rows[:, k]) - y)
                    back[ends[k]:ends[k + 1]] = own.T * e
                    back[f + k] = e
                e = back[f:]
                g, g2 = np.zeros((len(ids) + 1, f + m)), np.zeros((len(ids) + 1, m))
                g[:most], g2[:most] = (back @ matrix).T, (e @ (matrix * matrix)).T
                if len(places):
                    flat = places.ravel()
                    for c in range(f + m):
                        part = np.tile(back[c], len(places)) if values is None else (back[c] * values).ravel()
                        g[:, c] += np.bincount(flat, part, len(ids) + 1)
                    if values is None:
                        g2[most:] = g[most:, f:]
                    else:
                        for k in range(m):
                            g2[:, k] += np.bincount(flat, (e[k] * values ** 2).ravel(), len(ids) + 1)
                total[ids] += g[:-1]
                total2[ids] += g2[:-1]
                errors += e.sum(1)
                count += n
        yield pa.RecordBatch.from_pydict({"g": [total.tobytes()], "g2": [total2.tobytes()], "e": [errors.tobytes()],
                                          "n": pa.array([count], pa.int64())})

    return run


def _gaussians(seed: int, n: int) -> np.ndarray:
    """The first ``n`` numbers of ``java.util.Random(seed).nextGaussian()``."""
    state, mask, out = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1), (1 << 48) - 1, []
    while len(out) < n:
        u = []
        for _ in range(2):
            state = (state * 0x5DEECE66D + 0xB) & mask
            high = state >> 22
            state = (state * 0x5DEECE66D + 0xB) & mask
            u.append(2 * (((high << 27) + (state >> 21)) * 2.0 ** -53) - 1)
        s = u[0] * u[0] + u[1] * u[1]
        if 0 < s < 1:
            k = math.sqrt(-2 * math.log(s) / s)
            out += [u[0] * k, u[1] * k]
    return np.array(out[:n])


class _Machine:
    """One parameter map's weights and the state of its optimiser."""

    def __init__(self, fm: FMRegressor, size: int):
        self.fm, self.size, self.k = fm, size, fm.getFactorSize()
        start = _gaussians(fm.getSeed(), size * self.k) * fm.getInitStd()
        self.w = np.concatenate([start, np.zeros(size + 1)])
        self.m, self.v, self.t, self.done = np.zeros(len(self.w)), np.zeros(len(self.w)), 0, fm.getMaxIter() == 0

    @property
    def factors(self):
        return self.w[:self.size * self.k].reshape(self.size, self.k)

    @property
    def linear(self):
        return self.w[self.size * self.k:-1]

    def step(self, gradient: np.ndarray) -> None:
        self.t += 1
        self.m = 0.9 * self.m + (1 - 0.9) * gradient
        self.v = 0.999 * self.v + (1 - 0.999) * gradient * gradient
        mean, var = self.m / (1 - 0.9 ** self.t), self.v / (1 - 0.999 ** self.t)
        was = self.w
        self.w = was - (self.fm.getStepSize() * mean / (np.sqrt(var) + 1e-8) + self.fm.getRegParam() * was)
        near = self.t > 1 and np.linalg.norm(was - self.w) < self.fm.getTol() * max(np.linalg.norm(self.w), 1.0)
        self.done = near or self.t >= self.fm.getMaxIter()

    def model(self, spark) -> FMRegressionModel:
        sc = spark.sparkContext
        factors = DenseMatrix(self.size, self.k, self.factors.ravel(), True)
        java = sc._jvm.org.apache.spark.ml.regression.FMRegressionModel(
            self.fm.uid, float(self.w[-1]), _py2java(sc, Vectors.dense(self.linear)), _py2java(sc, factors))
        return self.fm._copyValues(FMRegressionModel(java))


def can_train(fm: FMRegressor) -> bool:
    """Whether the passes below are the estimator's own: Adam on all rows, with
    intercept and linear weights."""
    return (fm.getSolver() == "adamW" and fm.getMiniBatchFraction() == 1.0
            and fm.getFitIntercept() and fm.getFitLinear())


def fit_machines(machines: list[FMRegressor], train: DataFrame) -> list[FMRegressionModel]:
    """The fitted models of several machines over the same rows and columns."""
    spark, first = train.sparkSession, machines[0]
    v = F.unwrap_udt(first.getFeaturesCol())
    size = train.select(F.coalesce(v["size"], F.size(v["values"])).alias("n")).first()
    if size is None:
        return [fm.fit(train) for fm in machines]
    blocks = stored_blocks(train, first.getFeaturesCol(), first.getLabelCol())
    # a pass holds one block at a time, so tasks follow the cores, not the rows
    blocks = blocks.coalesce(max(2 * spark.sparkContext.defaultParallelism, 1))
    made = [_Machine(fm, size.n) for fm in machines]
    while open_ := [x for x in made if not x.done]:
        widths = [x.k for x in open_]
        weights = np.hstack([*[x.factors for x in open_], *[x.linear[:, None] for x in open_]])
        squares = np.stack([(x.factors ** 2).sum(1) for x in open_], 1)
        run = _gradients(widths, weights, squares, [float(x.w[-1]) for x in open_])
        sums = blocks.mapInArrow(run, "g binary, g2 binary, e binary, n long").collect()
        n = sum(r.n for r in sums)
        g = sum(np.frombuffer(r.g) for r in sums).reshape(weights.shape) / n
        g2 = sum(np.frombuffer(r.g2) for r in sums).reshape(squares.shape) / n
        e = sum(np.frombuffer(r.e) for r in sums) / n
        at, f = 0, sum(widths)
        for k, x in enumerate(open_):
            own = g[:, at:at + x.k] - x.factors * g2[:, k:k + 1]
            x.step(np.concatenate([own.ravel(), g[:, f + k], e[k:k + 1]]))
            at += x.k
    return [x.model(spark) for x in made]
