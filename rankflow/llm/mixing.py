"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words; a document of that source should
appear ``target / source size`` times, a whole number of copies and a
fraction.  The fractions are rounded dependently: two documents with open
fractions meet, and words are moved from one to the other, by a random choice
that leaves each one's expectation unchanged, until one of them is integral.
The sum over a source never changes by such a step, so what a source
contributes ends within one document of its target.

The pairing is a reduction tree.  A leaf is a hash bucket of documents of one
source (a large source has many leaves), streamed in sorted order with one
open document in hand; each leaf hands up one residual, ``ARITY`` leaves meet
in a node, until one residual per source is left, which is settled by chance.
Leaves are streamed, never collected, so neither a hot source nor a repeated
id can outgrow a task's memory.  Only sums over sources reach the driver.

Targets: ``share`` of all words, split by the sources' weights; a source
stops at ``cap`` times its own size and what it cannot use goes to the others
by weight, until none is above.

Defined cases: a null text has size 0 and is never taken; a null source is a
source of its own (last in order); rows with equal or null ids are rounded
one by one; an empty table gives an empty result; a source without words has
target 0.  All random choices are hashes of ids, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import fresh, ship, shuffle_partitions, whole_row, word_count, written
from rankflow.operators.ordering import with_position

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
LEAF_ROWS = 20_000
ARITY = 64


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """source, source_pos, source_size, weight, target: one row per source of
    ``sized`` (source, size).  The common level (words per unit of weight) is
    raised until the sources below their cap use up the budget; each step
    brings two sums to the driver."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # null last: order by the flag first
    ranked = with_position(totals.withColumn("no_source", F.col("source").isNull()),
                           ["no_source", "source"], "source_pos").drop("no_source")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("source_pos") % len(weights) + 1).cast("int"))
    sources = written(ranked.withColumn("weight", w), "sources")
    limit = F.col("source_size") * F.lit(float(cap))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget, level, before = share * total, 0.0, -1.0
    while level != before:
        before = level
        full = F.col("weight") * F.lit(level) > limit
        got = sources.agg(F.sum(F.when(full, limit)).alias("used"), F.sum(F.when(~full, F.col("weight"))).alias("w")).first()
        if not got.w:
            break
        level = (budget - (got.used or 0.0)) / got.w
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), limit))


def _pivot(seed: int, last: bool):
    """Stream rows sorted by node: pair, settle, hand up one residual."""

    def run(batches):
        import struct

        import pyarrow as pa
        import xxhash

        def draw(a, b):
            key = struct.pack("<qqq", seed, a if a is not None else -1, b if b is not None else -1)
            return (xxhash.xxh3_64_intdigest(key) >> 11) / float(1 << 53)

        node = hand = None  # hand: [row as list] with an open fraction
        names = None

        def out(rows):
            return pa.RecordBatch.from_pydict({n: [r[k] for r in rows] for k, n in enumerate(names)}, schema=schema)

        def close(row):
            if last:
                row[P] = 1.0 if draw(row[ID], None) < row[P] else 0.0
                row[DONE] = True
            return row

        for b in batches:
            if names is None:
                names, schema = b.schema.names, b.schema
                ID, SIZE, P, DONE = (names.index(x) for x in ("doc_id", "size", "part", "done"))
                POS, LEAF = names.index("source_pos"), names.index("leaf")
            rows = []
            for row in map(list, zip(*(c.to_pylist() for c in b.columns))):
                here = (row[POS], row[LEAF])
                if here != node:
                    if hand is not None:
                        rows.append(close(hand))
                    node, hand = here, None
                if hand is None:
                    hand = row
                    continue
                sa, sb = hand[SIZE], row[SIZE]
                a, c = sa * hand[P], sb * row[P]
                up, down = min(sa - a, c), min(a, sb - c)
                if draw(hand[ID], row[ID]) * (up + down) < down:  # to the one in hand
                    full = sa - a <= c
                    a, c = (sa, c - up) if full else (a + up, 0.0)
                else:
                    full = a > sb - c
                    a, c = (a - down, sb) if full else (0.0, c + down)
                hand[P], row[P] = a / sa, c / sb
                if hand[P] in (0.0, 1.0):
                    hand, row = row, hand
                row[DONE] = True
                rows.append(row)
                if hand[P] in (0.0, 1.0):
                    hand[DONE] = True
                    rows.append(hand)
                    hand = None
            yield out(rows)
        if hand is not None:
            yield out([close(hand)])

    return run


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 17,
        leaf_rows: int = LEAF_ROWS, arity: int = ARITY, key_col: str | None = None) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken
    (words), and with ``key_col`` also source and that column as row_key."""
    cols = [F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size")]
    if key_col:
        cols.append(F.col(f"`{key_col}`").alias("row_key"))
    sized = written(docs.select(*cols), "sized")
    targets = written(source_targets(sized.select("source", "size"), weights, share, cap), "targets")
    n = sized.count()
    leaves = -(-n // leaf_rows) if n else 1
    t = targets.select(F.col("source").alias("t_source"), "source_pos", "source_size", "target")
    ratio = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(cap)))).otherwise(F.lit(0.0))
    rows = (sized.join(t, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
            .withColumn("whole", F.floor(ratio)).withColumn("part", ratio - F.col("whole"))
            .withColumn("part", F.when(F.col("size") > 0, F.col("part")).otherwise(F.lit(0.0)))
            .withColumn("done", F.col("part") == 0)
            .withColumn("mixed", F.xxhash64("doc_id", "size", F.lit(seed)))
            .withColumn("leaf", F.pmod(F.col("mixed"), F.lit(leaves))))
    rows = written(rows, "fractions")
    parts, level = [rows.where("done")], rows.where("not done")
    schema = rows.schema
    parallel = shuffle_partitions(docs)
    depth = 0
    while True:
        last = leaves == 1
        order = ["source_pos", "leaf", "mixed", "doc_id", "size"]
        nodes = max(1, min(parallel, leaves * 64))
        settled = written(level.repartition(nodes, "source_pos", "leaf").sortWithinPartitions(*order)
                          .mapInArrow(_pivot(seed + depth, last), schema), f"rounded-{depth}")
        parts.append(settled.where("done"))
        if last:
            break
        level = settled.where("not done").withColumn("leaf", F.floor(F.col("leaf") / F.lit(arity)))
        leaves = -(-leaves // arity)
        depth += 1
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    copies = (F.col("whole") + F.col("part")).cast("long")
    extra = ["source", "row_key"] if key_col else []
    return out.select("doc_id", "size", "source_size", "target", copies.alias("copies"),
                      (F.col("size") * copies).alias("taken"), *extra)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                    text_col: str = "text", **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as :func:`mix` takes it.
    Rows equal in every column stand for one document whose copies add up;
    rows that share an id and a text but differ elsewhere are documents of
    their own.  Any column names are allowed."""
    names = docs.columns
    key, copies, number = (fresh(c, names) for c in ("mix_key", "mix_copies", "mix_copy"))
    keyed = docs.withColumn(key, whole_row(docs))
    plan = mix(keyed, id_col, source_col, text_col, key_col=key, **options)
    plan = plan.groupBy("doc_id", "source", "row_key").agg(F.sum("copies").alias("n")).where("n > 0").alias("plan")
    keyed = keyed.dropDuplicates([id_col, source_col, key]).alias("rows")
    on = (F.col(f"rows.`{id_col}`").cast("long").eqNullSafe(F.col("plan.doc_id"))
          & F.col(f"rows.`{source_col}`").eqNullSafe(F.col("plan.source")) & (F.col(f"rows.`{key}`") == F.col("plan.row_key")))
    taken = keyed.join(plan, on).select("rows.*", F.col("plan.n").alias(copies))
    return (taken.withColumn(number, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(*[f"`{c}`" for c in names]))


ship(__name__)
