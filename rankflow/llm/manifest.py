"""Merkle manifest of a table: one hash tree per group of rows, a tree over the
roots of the groups, and a proof for every row.

Checkpoint-and-recompute: only every third level of a tree is stored (the rows'
own digests, then one node per 512 of the level stored before).  A proof needs
the levels between as well; each aligned subtree of 512 stored nodes makes them
again from those nodes, emits the siblings of every one of its nodes and drops
them.  Proofs grow downwards: a subtree takes the proof of its top from the
level stored above, so nothing of a tree beyond 512 digests is ever in one row,
however many rows a group has.

Rules: at each level every 8 consecutive nodes (the last run: fewer, even one)
become the SHA-256 of their concatenated hexadecimal digests, while more than
one node is left; a group of one row has that row's digest as its root.  The
roots of the groups, ordered by group (null first, UTF-8 bytewise), form the
tree above by the same rules.

Rows: nulls in any column have a digest of their own; a null group is a group,
a null id sorts first; rows equal in every hashed column are leaves each;
texts of any length are hashed whole; an empty table has no rows and no root;
columns that are not named are ignored, so their names cannot clash (names
beginning with ``_mk_`` are used inside and never read from the input).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import ship, shuffle_partitions, written
from rankflow.operators.ordering import with_position

RUN = 8           # nodes that become one
BETWEEN = 3       # levels from one stored level to the next
GROUP = RUN ** BETWEEN
PROOF = "proof array<struct<left:string,right:string>>"


def row_digest(columns: list[Column]) -> Column:
    """SHA-256 of the values: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return F.sha2(F.concat(*[part(c) for c in columns]), 256)


def climb(digests: list[str], last: bool) -> list[list[str]]:
    """A stored level of a subtree and the levels above it, up to the next
    stored one or, in the ``last`` subtree of a tree, up to the root."""
    levels = [digests]
    for _ in range(BETWEEN):
        below = levels[-1]
        if last and len(below) == 1:
            break
        levels.append([hashlib.sha256("".join(below[r:r + RUN]).encode()).hexdigest() for r in range(0, len(below), RUN)])
    return levels


def _subtrees(batches):
    """The rows of sorted batches, one table per (tree, top)."""
    import numpy as np
    import pyarrow as pa

    held, key = [], None
    for b in batches:
        tree, top = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("tree", "top"))
        cuts = np.flatnonzero((tree[1:] != tree[:-1]) | (top[1:] != top[:-1])) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(tree)]):
            if i == j:
                continue
            if held and (tree[i], top[i]) != key:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            key = (tree[i], top[i])
            held.append(b.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _in_order(nodes: DataFrame) -> DataFrame:
    """Every aligned subtree in one partition, its nodes in order."""
    return (nodes.repartition(shuffle_partitions(nodes), "tree", "top").sortWithinPartitions("tree", "top", "idx"))


def _top() -> Column:
    return F.floor(F.col("idx") / GROUP).cast("long").alias("top")


def _summits(nodes: DataFrame) -> DataFrame:
    """The top of every subtree: a node of the next stored level, or a root."""
    def make(batches):
        import pyarrow as pa

        for t in _subtrees(batches):
            n = t.column("n")[0].as_py()
            digest = climb(t.column("digest").to_pylist(), n <= GROUP)[-1][0]
            yield pa.RecordBatch.from_pylist([{"tree": t.column("tree")[0].as_py(), "idx": t.column("top")[0].as_py(),
                                               "n": -(-n // GROUP), "last": n <= GROUP, "digest": digest}])

    return _in_order(nodes.select("tree", _top(), "idx", "n", "digest")).mapInArrow(
        make, "tree long, idx long, n long, last boolean, digest string")


@dataclass
class Manifest:
    """The stored levels of the trees of all groups, and of the tree above."""
    groups: DataFrame                   # tree, n
    stored: list[DataFrame] = field(default_factory=list)   # tree, idx, n, digest (level 0: key columns too)
    roots: DataFrame | None = None      # tree, digest
    above: Manifest | None = None
    keys: list[str] = field(default_factory=list)


def _grow(found: Manifest, leaves: DataFrame, most: int) -> Manifest:
    """Fill ``stored`` and ``roots`` from the leaves (tree, idx, n, digest)."""
    found.stored = [leaves]
    roots = None
    while True:
        made = _summits(found.stored[-1])
        made = written(made, "manifest-level")
        ended = made.where("last").select("tree", "digest")
        roots = ended if roots is None else roots.unionByName(ended)
        if most <= GROUP:
            break
        most = -(-most // GROUP)
        found.stored.append(made.where("not last").select("tree", "idx", "n", "digest"))
    found.roots = roots
    return found


def build(rows: DataFrame, group_col: str, order_cols: list[str], digest_col: str, keys: list[str]) -> Manifest:
    """The manifest of ``rows``: a tree per value of ``group_col``, leaves in
    ``order_cols`` order (ties by digest), ``keys`` stored with the leaves.
    To the driver comes the size of the largest group only."""
    slim = rows.select(F.col(group_col).alias("_mk_name"), F.col(digest_col).alias("_mk_digest"),
                       *[F.col(c).alias(f"_mk_o{k}") for k, c in enumerate(order_cols)],
                       F.struct(*[F.col(c).alias(f"k{j}") for j, c in enumerate(keys)]).alias("_mk_key"))
    placed = with_position(slim, ["_mk_name", *[f"_mk_o{k}" for k in range(len(order_cols))], "_mk_digest"], "_mk_pos")
    sizes = placed.groupBy("_mk_name").agg(F.min("_mk_pos").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = written(with_position(sizes.withColumnRenamed("_mk_name", "name"), ["name"], "tree"), "manifest-groups")
    g = groups.select(F.col("name").alias("_mk_group"), "tree", "first", "n")
    leaves = written(placed.join(g, F.col("_mk_name").eqNullSafe(F.col("_mk_group")))
                     .select("tree", (F.col("_mk_pos") - F.col("first")).alias("idx"), "n",
                             F.col("_mk_digest").alias("digest"),
                             *[F.col(f"_mk_key.k{j}").alias(f"_mk_k{j}") for j in range(len(keys))]), "manifest-leaves")
    count, most = groups.agg(F.count(F.lit(1)), F.max("n")).first()
    found = _grow(Manifest(groups.select("tree", "name", "n"), keys=list(keys)), leaves, most or 0)
    tops = found.roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"),
                              F.lit(count).cast("long").alias("n"), "digest")
    one = rows.sparkSession.range(1).select(F.col("id").alias("tree"), F.lit(count).cast("long").alias("n"))
    found.above = _grow(Manifest(one), tops, count)
    return found


def _ends_at(level: int) -> Column:
    """Whether a tree of ``n`` leaves has its root above this stored level."""
    wide = F.col("n") > GROUP ** level if level else F.lit(True)
    return wide & (F.col("n") <= GROUP ** (level + 1))


def _descend(m: Manifest, above: DataFrame) -> DataFrame:
    """Proofs of all leaves; ``above`` holds, per tree, the proof of its root
    and what is carried down with it (tree, proof, carry)."""
    found = None
    for level in reversed(range(len(m.stored))):
        bottom = level == 0
        extra = [f"_mk_k{j}" for j in range(len(m.keys))] if bottom else []
        ups = (m.groups.where(_ends_at(level)).select("tree").join(above, "tree")
               .select("tree", F.lit(0).cast("long").alias("top"), "proof", "carry"))
        if found is not None:
            ups = ups.unionByName(found.select("tree", F.col("idx").alias("top"), "proof", "carry"))
        # the proof of a subtree's top comes first among its rows
        rows = m.stored[level].select("tree", _top(), "idx", "n", "digest", *extra)
        both = rows.unionByName(ups.withColumn("idx", F.lit(-1).cast("long")), allowMissingColumns=True)
        schema = "tree long, idx long, digest string, " + PROOF + ", carry " + above.schema["carry"].dataType.simpleString()
        schema += "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in extra)
        found = _in_order(both).mapInArrow(_emitter(extra), schema)
        if not bottom:
            found = written(found, "manifest-proofs")
    return found


def _emitter(extra: list[str]):
    def emit(batches):
        import pyarrow as pa

        for t in _subtrees(batches):
            if t.num_rows < 2:          # an empty table has no nodes
                continue
            upper, carry = t.column("proof")[0].as_py(), t.column("carry").slice(0, 1).combine_chunks()
            t = t.slice(1)
            levels = climb(t.column("digest").to_pylist(), t.column("n")[0].as_py() <= GROUP)
            proofs = []
            for i in range(t.num_rows):
                steps, at = [], i
                for level in levels[:-1]:
                    first = at - at % RUN
                    steps.append({"left": "".join(level[first:at]), "right": "".join(level[at + 1:first + RUN])})
                    at //= RUN
                proofs.append(steps + upper)
            one = carry.chunk(0) if isinstance(carry, pa.ChunkedArray) else carry
            cols = [t.column("tree"), t.column("idx"), t.column("digest"), pa.array(proofs, t.schema.field("proof").type),
                    one.take(pa.array([0] * t.num_rows)), *[t.column(c) for c in extra]]
            yield from pa.Table.from_arrays(cols, ["tree", "idx", "digest", "proof", "carry", *extra]).combine_chunks().to_batches()

    return emit


def proofs(m: Manifest) -> DataFrame:
    """One row per leaf: the keys, ``leaf``, ``subroot``, ``root`` and
    ``proof``, the siblings (left, right) of each level up to the root."""
    root = m.above.roots.select(F.col("digest").alias("root"))
    empty = F.array().cast("array<struct<left:string,right:string>>")
    start = root.select(F.lit(0).cast("long").alias("tree"), empty.alias("proof"), F.struct("root").alias("carry"))
    tops = _descend(m.above, start)
    per_tree = written(tops.select(F.col("idx").alias("tree"), "proof",
                                   F.struct(F.col("digest").alias("subroot"), F.col("carry.root").alias("root")).alias("carry")),
                       "manifest-tops")
    found = _descend(m, per_tree)
    return found.select(*[F.col(f"_mk_k{j}").alias(c) for j, c in enumerate(m.keys)], F.col("digest").alias("leaf"),
                        "carry.subroot", "carry.root", "proof")


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings of a proof, upwards, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


ship(__name__)
