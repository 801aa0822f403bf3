"""Gradient-boosted regression trees grown on stored blocks of bins.

Spark's learner keeps every row as objects and writes what does not fit in
memory to the executors' disks.  Here a row is one byte per feature, its label
and the trees' prediction so far, packed into blocks of arrays in the shared
folder; a pass over the blocks counts one level of a tree, whatever the number
of rows, and a task holds one block.  Bins, split rule, leaves, shrinking and
the stop on validation rows are those of Spark's ``GBTRegressor`` for squared
error, and so is the model that comes out.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.session import materialize, remove

# the functions of the passes go to the Python workers by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BLOCK = "rows int, bins binary, label binary, held binary, made binary"
_EPSILON = 2.0 ** -52
# rows that are worth a task of their own in a pass
TASK_ROWS = 100_000


# ---- bins ----------------------------------------------------------------------

def thresholds(values: np.ndarray, rows: float, bins: int) -> np.ndarray:
    """Split points of one feature from a sample of ``rows`` rows: between all
    neighbours if they are few, else about every ``rows / bins`` rows."""
    # Spark drops zeros from the sample and puts back as many as are missing
    own = values[values != 0.0]
    u, n = np.unique(own, return_counts=True)
    n = n.astype(float)
    missing = rows - n.sum()
    if len(u) and missing > _EPSILON * len(own) * 100:
        at = np.searchsorted(u, 0.0)
        u, n = np.insert(u, at, 0.0), np.insert(n, at, missing)
    if len(u) < 2:
        return np.empty(0)
    between = (u[:-1] + u[1:]) / 2.0
    if len(between) <= bins - 1:
        return between
    stride = rows / bins
    out, before, goal = [], n[0], stride
    for i in range(1, len(u)):
        now = before + n[i]
        if abs(before - goal) < abs(now - goal):
            out.append(between[i - 1])
            goal += stride
        before = now
    return np.array(out)


def _sampled_thresholds(train: DataFrame, features: list[str], rows: int, gbt: GBTRegressor) -> list[np.ndarray]:
    """From about as many rows as Spark looks at (all, if there are fewer)."""
    bins = min(gbt.getMaxBins(), rows)
    wanted = max(bins * bins, 10_000)
    share = wanted / rows if wanted < rows else 1.0
    some = train.select(*features)
    some = some if share == 1.0 else some.sample(False, share, gbt.getSeed())
    x = np.array([list(r) for r in some.collect()], float).reshape(-1, len(features))
    return [thresholds(x[:, j], share * rows, bins) for j in range(len(features))]


def _binned(points: list[np.ndarray]):
    """Rows as blocks: a byte per feature (how many split points lie below)."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            x = [b.column(j).to_numpy(zero_copy_only=False) for j in range(len(points))]
            bins = np.stack([np.searchsorted(p, c).astype(np.uint8) for p, c in zip(points, x)])
            label = b.column(len(points)).to_numpy(zero_copy_only=False)
            held = np.asarray(b.column(len(points) + 1)).astype(np.uint8)
            yield pa.RecordBatch.from_pydict({"rows": pa.array([b.num_rows], pa.int32()), "bins": [bins.tobytes()],
                                              "label": [label.tobytes()], "held": [held.tobytes()],
                                              "made": [np.zeros(b.num_rows).tobytes()]})
    return run


def _block(b, i: int, features: int):
    n = b.column("rows")[i].as_py()

    def get(c, t):
        return np.frombuffer(b.column(c)[i].as_buffer(), t)

    return get("bins", np.uint8).reshape(features, n), get("label", float), get("held", np.uint8) == 1, get("made", float)


# ---- one tree --------------------------------------------------------------------

class _Node:
    def __init__(self, depth: int):
        self.depth, self.leaf, self.feature, self.bin, self.gain = depth, False, -1, -1, 0.0
        self.left = self.right = None
        self.n, self.s, self.q = 0.0, 0.0, 0.0  # rows, sum and sum of squares of the target

    @property
    def prediction(self) -> float:
        return self.s / self.n if self.n else 0.0

    @property
    def impurity(self) -> float:
        return (self.q - self.s * self.s / self.n) / self.n if self.n else 0.0


def _arrays(root: _Node):
    """(nodes in order, feature, bin, left, right): a node without children
    leads to itself."""
    nodes = [root]
    for x in nodes:
        nodes += [c for c in (x.left, x.right) if c]
    place = {id(x): k for k, x in enumerate(nodes)}
    inner = [x.left is not None for x in nodes]
    return nodes, (np.array([max(x.feature, 0) for x in nodes], np.int64), np.array([x.bin for x in nodes], np.int64),
                   np.array([place[id(x.left)] if i else k for k, (x, i) in enumerate(zip(nodes, inner))], np.int64),
                   np.array([place[id(x.right)] if i else k for k, (x, i) in enumerate(zip(nodes, inner))], np.int64))


def _reached(bins: np.ndarray, tree, depth: int) -> np.ndarray:
    """The node of every row after ``depth`` steps from the root."""
    feature, cut, left, right = tree
    at = np.zeros(bins.shape[1], np.int64)
    own = np.arange(bins.shape[1])
    for _ in range(depth):
        at = np.where(bins[feature[at], own] <= cut[at], left[at], right[at])
    return at


def _counted(tree, depth: int, open_: list[int], nodes: int, widths: list[int], first: bool, last: bool):
    """A pass: per open node, feature and bin the rows and the sum of the
    target (with ``last`` also of its squares, for the leaves below), and per
    node rows, sum and sum of squares."""
    slot = np.full(nodes, -1, np.int64)
    slot[open_] = np.arange(len(open_))
    w = max(widths)

    def run(batches):
        import pyarrow as pa

        sums = np.zeros((2 + last, len(widths), len(open_) * w))
        whole = np.zeros((3, nodes))
        for b in batches:
            for i in range(b.num_rows):
                bins, label, held, made = _block(b, i, len(widths))
                if held.any():
                    bins, label, made = bins[:, ~held], label[~held], made[~held]
                # the first tree learns the label, the others twice what is missing
                y = label if first else 2.0 * (label - made)
                at = _reached(bins, tree, depth)
                for k, part in enumerate((None, y, y * y)):
                    whole[k] += np.bincount(at, part, nodes)
                at = slot[at]
                if (at < 0).any():
                    own = at >= 0
                    bins, y, at = bins[:, own], y[own], at[own]
                at = at * w
                for j in range(len(widths)):
                    key = at + bins[j]
                    for k, part in enumerate((None, y, y * y)[:2 + last]):
                        sums[k, j] += np.bincount(key, part, sums.shape[2])
        yield pa.RecordBatch.from_pydict({"sums": [sums.tobytes()], "whole": [whole.tobytes()]})

    return run


def _added(tree, depth: int, predicted: np.ndarray, weight: float, features: int):
    """The blocks with a tree's part added to the prediction."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            made = []
            for i in range(b.num_rows):
                bins, _, _, before = _block(b, i, features)
                made.append((before + weight * predicted[_reached(bins, tree, depth)]).tobytes())
            columns = {c: b.column(c) for c in b.schema.names} | {"made": pa.array(made, pa.binary())}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _best_split(node: _Node, counts: np.ndarray, sums: np.ndarray, points: list[np.ndarray]):
    """(feature, bin, gain) of the first best split, None if there is none."""
    best = None
    for j, p in enumerate(points):
        if not len(p):
            continue
        n, s = np.cumsum(counts[j])[:len(p)], np.cumsum(sums[j])[:len(p)]
        m, r = node.n - n, node.s - s
        with np.errstate(divide="ignore", invalid="ignore"):
            # what the variance loses by the split
            gain = (s * s / n + r * r / m - node.s * node.s / node.n) / node.n
        gain[(n < 1) | (m < 1)] = -np.inf
        k = int(np.argmax(gain))
        if gain[k] > -np.inf and (best is None or gain[k] > best[2]):
            best = (j, k, float(gain[k]))
    return best


def _grow(blocks: DataFrame, points: list[np.ndarray], depth: int, first: bool) -> _Node:
    root, widths = _Node(0), [len(p) + 1 for p in points]
    w = max(widths)
    for level in range(depth):
        nodes, tree = _arrays(root)
        open_ = [k for k, x in enumerate(nodes) if x.depth == level and not x.leaf]
        if not open_:
            break
        last = level == depth - 1
        passed = blocks.mapInArrow(_counted(tree, level, open_, len(nodes), widths, first, last), "sums binary, whole binary").collect()
        sums, whole = (sum(np.frombuffer(r[c]) for r in passed) for c in ("sums", "whole"))
        sums, whole = sums.reshape(2 + last, len(points), len(open_), w), whole.reshape(3, -1)
        for i, k in enumerate(open_):
            x = nodes[k]
            x.n, x.s, x.q = whole[:, k]
            # what is left after rounding is a pure node, a leaf
            pure = level > 0 and abs(x.impurity) < _EPSILON
            best = None if pure else _best_split(x, sums[0, :, i], sums[1, :, i], points)
            x.leaf = best is None or best[2] <= 0
            if not x.leaf:
                x.feature, x.bin, x.gain = best
                x.left, x.right = _Node(level + 1), _Node(level + 1)
                below = sums[:, x.feature, i, :x.bin + 1].sum(1)
                for part, a, all_ in zip("nsq", below, (x.n, x.s, x.q)):
                    setattr(x.left, part, a)
                    setattr(x.right, part, all_ - a)
    return root


# ---- boosting ----------------------------------------------------------------------

def _java_node(java, x: _Node, points):
    """(Spark's node, whether it is a leaf); children that predict the same
    become one leaf."""
    stats = java["array"](3)
    for k, v in enumerate((x.n, x.s, x.q)):
        stats[k] = float(v)
    made = java["calculator"](stats, int(x.n))
    if x.left is not None:
        (left, one), (right, other) = _java_node(java, x.left, points), _java_node(java, x.right, points)
        if not (one and other and x.left.prediction == x.right.prediction):
            split = java["split"](x.feature, float(points[x.feature][x.bin]))
            return java["inner"](x.prediction, x.impurity, x.gain, left, right, split, made), False
    return java["leaf"](x.prediction, x.impurity, made), True


def _java_model(spark, gbt: GBTRegressor, roots: list[_Node], points, rate: float) -> GBTRegressionModel:
    sc = spark.sparkContext
    ml, tree, double = sc._jvm.org.apache.spark.ml.regression, sc._jvm.org.apache.spark.ml.tree, sc._jvm.double
    java = {"array": lambda k: sc._gateway.new_array(double, k), "leaf": tree.LeafNode, "inner": tree.InternalNode,
            "split": tree.ContinuousSplit, "calculator": sc._jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator}
    kind, n = ml.DecisionTreeRegressionModel, len(points)
    trees, weights = sc._gateway.new_array(kind, len(roots)), java["array"](len(roots))
    for k, root in enumerate(roots):
        trees[k] = kind(_java_node(java, root, points)[0], n)
        weights[k] = rate if k else 1.0
    return gbt._copyValues(GBTRegressionModel(ml.GBTRegressionModel(gbt.uid, trees, weights, n)))


def can_grow(gbt) -> bool:
    """Whether the steps below are the estimator's own."""
    return (isinstance(gbt, GBTRegressor) and gbt.getLossType() == "squared" and gbt.getSubsamplingRate() == 1.0
            and gbt.getFeatureSubsetStrategy() == "all" and gbt.getMinInstancesPerNode() == 1 and gbt.getMinInfoGain() == 0.0
            and gbt.getMinWeightFractionPerNode() == 0.0 and gbt.getMaxBins() <= 256 and not gbt.isDefined(gbt.weightCol))


def grow_trees(gbt: GBTRegressor, features: list[str], train: DataFrame) -> GBTRegressionModel:
    """The boosted trees over the numeric columns ``features`` of stored rows.
    Rows that the validation column marks are kept from the trees and end the
    rounds once their error stops falling."""
    spark, label = train.sparkSession, gbt.getLabelCol()
    marked = gbt.isDefined(gbt.validationIndicatorCol)
    held = F.col(gbt.getValidationIndicatorCol()) if marked else F.lit(False)
    rows = train.select(*[F.col(c).cast("double").alias(f"_x{j}") for j, c in enumerate(features)],
                        F.col(label).cast("double").alias("_y"), held.alias("_held"))
    names = rows.columns[:len(features)]
    learning = rows.where(~F.col("_held"))
    wrong = F.count_if(F.col("_y").isNull() | F.isnan("_y"))
    n, bad = learning.agg(F.count(F.lit(1)), wrong).first()
    if bad or not n:
        raise ValueError(f"{bad} of {n} training rows have no {label}")
    points = _sampled_thresholds(learning, names, n, gbt)
    # a row that is neither training nor held out is not read
    blocks = materialize(rows.where(F.col("_held").isNotNull()).mapInArrow(_binned(points), _BLOCK))
    # a pass holds one block at a time: its tasks follow the cores, not the rows
    tasks = min(max(2 * spark.sparkContext.defaultParallelism, 1), -(-n // TASK_ROWS))
    depth, rate = gbt.getMaxDepth(), gbt.getStepSize()
    roots, best, least = [], 1, None
    for m in range(gbt.getMaxIter()):
        roots.append(_grow(blocks.coalesce(tasks), points, depth, m == 0))
        if not marked and m + 1 == gbt.getMaxIter():
            break
        nodes, tree = _arrays(roots[m])
        run = _added(tree, depth, np.array([x.prediction for x in nodes]), rate if m else 1.0, len(points))
        last, blocks = blocks, materialize(blocks.coalesce(tasks).mapInArrow(run, _BLOCK))
        remove(last)
        if marked:
            error = _held_error(blocks.coalesce(tasks), len(points))
            if least is None:
                least = error
            elif least - error < gbt.getValidationTol() * max(error, 0.01):
                break
            elif error < least:
                least, best = error, m + 1
    remove(blocks)
    return _java_model(spark, gbt, roots[:best] if marked else roots, points, rate)


def _held_error(blocks: DataFrame, features: int) -> float:
    def run(batches):
        import pyarrow as pa

        error, n = 0.0, 0
        for b in batches:
            for i in range(b.num_rows):
                _, label, held, made = _block(b, i, features)
                error += float(((label - made)[held] ** 2).sum())
                n += int(held.sum())
        yield pa.RecordBatch.from_pydict({"error": [error], "n": pa.array([n], pa.int64())})

    sums = blocks.mapInArrow(run, "error double, n long").collect()
    return sum(r.error for r in sums) / max(sum(r.n for r in sums), 1)
