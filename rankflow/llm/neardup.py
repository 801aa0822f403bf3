"""MinHash near-duplicates by an inverted join of signature coordinates.

A document is the set of its distinct 5-word shingles.  Its signature has
``COORDINATES`` minimum hashes; a *posting* is a (coordinate, value) pair.
Two documents are linked when the intersection of their sets is at least
``PERCENT`` % of the union; such a pair agrees in about that share of its
coordinates, and a pair that agrees in fewer than ``MATCHES`` of them is not
looked at (at 75 % a true pair falls below 32 of 64 twice in a million).

Prefix and skip: only values that at least two documents share can match, so
the others are skipped, and with them every document with fewer than
``MATCHES`` shared values.  Of the rest each document posts, rarest first, as
many as are needed for two documents with ``MATCHES`` common values to meet in
at least one posting.  Documents that meet are merged (all common values are
counted), those with enough matches are confirmed on their full sets.

Dense groups: documents with equal sets are one class from the start.  Under
a posting, documents are first compared with one pivot only (in ``STARS``
rounds, another one each), and what is found to be connected is contracted.
Documents that still meet others outside their component are filtered once
more, by a prefix of their rarest shingles that no link can escape, and the
last round takes up every such pair between components, found within a cell
and not listed as a row.  So a group of
thousands of near copies costs a few comparisons per document, and yet no pair
that could connect two components is left out: the components are those of all
links.  Pairs are compared in cells of two blocks of documents with the same
most common posting (a block holds 2,048 documents or 262,144 shingles, or one
longer document), so a set is sent to a cell once for all of its pairs there.

Scale: postings are counted with map-side partial sums and joined by plain
equi-joins; pairs arise only between components.  Full sets are kept (in the
shared folder) only for documents that can match at all.  No links or
components reach the driver.

Defined cases: null and empty texts have no shingles and are linked with
nothing; shorter texts have their whole word sequence as one shingle; rows
that repeat an id count as one document; a null id is its own component (null)
and is kept; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import bytes_of, discard, fresh, hash_words, in_parts, mixed, ship, shuffle_partitions, whole_row, written
from rankflow.llm.components import components

SHINGLE = 5
COORDINATES = 64
MATCHES = 32
PERCENT = 75
STARS = 2
BLOCK_SHINGLES = 1 << 18
BLOCK_NODES = 2048
_COLUMNS = 1 << 13


def shingle_sets(texts: list, shingle: int = SHINGLE) -> list:
    """Sorted distinct 64-bit shingle hashes of each text of a part."""
    import numpy as np

    np.seterr(over="ignore")
    h, _, _, counts = hash_words(texts, lower=True)
    n = max(len(h) - shingle + 1, 0)
    roll = np.zeros(n, np.uint64)
    for k in range(shingle):
        roll = mixed((roll ^ h[k:k + n]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    out, at = [], 0
    for c in counts.tolist():
        if c >= shingle:
            out.append(np.unique(roll[at:at + c - shingle + 1]))
        elif c:
            one = np.full(1, c, np.uint64)
            for k in range(c):
                one = mixed((one ^ h[at + k:at + k + 1]) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(c))
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
        at += c
    return out


def signature(values, coordinates: int = COORDINATES):
    """One posting (a hash of coordinate and minimum) per coordinate."""
    import numpy as np

    k = np.arange(1, coordinates + 1, dtype=np.uint64)
    factor = mixed(k * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    mask = mixed(k + np.uint64(0x51ED270B7A3F2C11))
    low = None
    for at in range(0, len(values), 8192):
        part = ((values[at:at + 8192, None] ^ mask) * factor).min(axis=0)
        low = part if low is None else np.minimum(low, part)
    return mixed(low ^ k)


def _profile(docs: DataFrame, shingle: int, coordinates: int) -> DataFrame:
    """doc_id, n_shingles, two hashes of the whole set, and the signature."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            n, k1, k2, sig = [], [], [], []
            for part in in_parts(bytes_of(b.column(1))):
                for s in shingle_sets(part, shingle):
                    n.append(len(s))
                    k1.append(int(s.sum(dtype=np.uint64).view(np.int64)))
                    k2.append(int(mixed(s + np.uint64(7)).sum(dtype=np.uint64).view(np.int64)))
                    sig.append(signature(s, coordinates).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                 pa.array(sig, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "key1", "key2", "signature"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, key1 long, key2 long, signature array<long>")


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    """node, the full set and the shared postings (sorted u64, binary)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            sets = [s.tobytes() for part in in_parts(bytes_of(b.column(1))) for s in shingle_sets(part, shingle)]
            shared = [np.sort(np.array(x, np.int64).view(np.uint64)).tobytes() for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary()), pa.array(shared, pa.binary())],
                                             ["node", "full", "shared"])

    return docs.mapInArrow(run, "node long, full binary, shared binary")


def common_counts(sets: list, left, right):
    """Number of common values of sets ``left[k]`` and ``right[k]`` (sorted
    distinct u64 arrays, never a set with itself).  Few pairs are merged one by one; for many, the
    values of several sets become columns of a bit matrix."""
    import numpy as np

    out = np.zeros(len(left), np.int64)
    if len(left) < 8:
        for k, (i, j) in enumerate(zip(left.tolist(), right.tolist())):
            both = np.concatenate([sets[i], sets[j]])
            both.sort(kind="stable")
            out[k] = (both[1:] == both[:-1]).sum()
        return out
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, which, counts = np.unique(values, return_inverse=True, return_counts=True)
    several = counts > 1
    some = several[which]
    column, owner = (np.cumsum(several) - 1)[which[some]], owner[some]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for first in range(0, int(several.sum()), _COLUMNS):
        a, z = np.searchsorted(column, [first, first + _COLUMNS])
        grid = np.zeros((len(sets), _COLUMNS), bool)
        grid[owner[a:z], column[a:z] - first] = True
        bits = np.packbits(grid, axis=1).view(np.uint64)
        for at in range(0, len(left), _COLUMNS):
            both = bits[left[at:at + _COLUMNS]] & bits[right[at:at + _COLUMNS]]
            out[at:at + _COLUMNS] += np.bitwise_count(both).sum(axis=1, dtype=np.int64)
    return out


def linked(full: list, shared: list, left, right, matches: int, percent: int):
    """Which of the pairs (places of sets) are links, as places in ``left``."""
    import numpy as np

    ok = np.flatnonzero(common_counts(shared, left, right) >= matches)
    left, right = left[ok], right[ok]
    size = np.array([len(x) for x in full], np.int64)
    both = common_counts(full, left, right)
    return ok[100 * both >= percent * (size[left] + size[right] - both)]


def _links(pairs: DataFrame, sets: DataFrame, matches: int, percent: int) -> DataFrame:
    """The linked ones of pairs (cell, a, b): enough matching coordinates, and
    enough of the full sets in common.  A set travels once to each cell in
    which one of its pairs lies, not once per pair."""
    met = written(pairs, "met")
    asked = met.select("cell", F.col("a").alias("node")).union(met.select("cell", "b")).distinct()
    given = asked.join(sets, "node").select("cell", F.col("node").alias("a"), F.lit(None).cast("long").alias("b"), "full", "shared")
    empty = F.lit(None).cast("binary")
    rows = given.unionByName(met.select("cell", "a", "b", empty.alias("full"), empty.alias("shared")))
    # the sets of a cell come before its pairs
    rows = rows.repartition(shuffle_partitions(sets), "cell").sortWithinPartitions("cell", F.col("b").asc_nulls_first(), "a")

    def confirm(batches):
        import numpy as np
        import pyarrow as pa

        cell, nodes, full, shared = None, [], [], []
        for batch in batches:
            cells = batch.column(0).to_numpy()
            begin = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
            found_a, found_b = [], []
            for lo, hi in zip(begin.tolist(), np.append(begin[1:], len(cells)).tolist()):
                if cell != cells[lo]:
                    cell, nodes, full, shared = cells[lo], [], [], []
                part = batch.slice(lo, hi - lo)
                n_sets = part.column(2).null_count
                nodes += part.column(1)[:n_sets].to_pylist()
                full += [np.frombuffer(x, np.uint64) for x in part.column(3)[:n_sets].to_pylist()]
                shared += [np.frombuffer(x, np.uint64) for x in part.column(4)[:n_sets].to_pylist()]
                if n_sets == len(part):
                    continue
                a, b = (part.column(k)[n_sets:].to_numpy() for k in (1, 2))
                ids = np.array(nodes, np.int64)  # ascending
                left, right = np.searchsorted(ids, a), np.searchsorted(ids, b)
                ok = linked(full, shared, left, right, matches, percent)
                found_a.append(ids[left[ok]])
                found_b.append(ids[right[ok]])
            if found_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (found_a, found_b)], ["a", "b"])

    links = written(rows.mapInArrow(confirm, "a long, b long"), "links")
    discard(met)
    return links


def meeting_pairs(node, left, begin, size, label, block, percent: int):
    """Pairs of places (in parts of bounded size) that meet under a shingle:
    ``node`` and ``left`` list its nodes and what is left of them from there,
    ``begin`` says where each shingle's list begins."""
    import numpy as np

    m = len(size)
    meets = np.zeros((m, m), bool)
    for a, z in zip(begin.tolist(), np.append(begin[1:], len(node)).tolist()):
        own, rest, n = node[a:z], left[a:z], size[node[a:z]]
        for at in range(0, z - a, 256):
            some = slice(at, at + 256)
            meets[np.ix_(own[some], own)] |= ((100 + percent) * np.minimum(rest[some, None], rest) >= percent * (n[some, None] + n))
    two = len(np.unique(block)) > 1
    for at in range(0, m, 512):
        x = slice(at, at + 512)
        ok = meets[x] & (label[x, None] != label) & (np.arange(m)[x, None] < np.arange(m))
        ok &= 100 * np.minimum(size[x, None], size) >= percent * np.maximum(size[x, None], size)
        if two:  # pairs within a block belong to that block's own cell
            ok &= block[x, None] != block
        i, j = np.nonzero(ok)
        if len(i):
            yield i + at, j


def _rare_links(nodes: DataFrame, sets: DataFrame, matches: int, percent: int) -> DataFrame:
    """The links among nodes of different labels that share one of their rarest
    shingles.  A linked pair has at least ``percent`` % of either set in
    common, and only shingles of several nodes can be common; so a node with
    fewer of those has no link at all, and of two linked nodes the rarest ones
    meet (again a prefix, now of the full sets).  Where two linked nodes meet
    first, enough shared shingles are left in both.  No link is lost.
    """
    full = sets.join(nodes.select("node"), "node").select("node", "full")

    def spread(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for node, data in zip(*(c.to_pylist() for c in b.columns)):
                v = np.frombuffer(data, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), node)), pa.array(v)], ["node", "shingle"])

    rows = written(full.mapInArrow(spread, "node long, shingle long"), "shingles")
    counted = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("n_nodes")).where("n_nodes > 1").withColumnRenamed("shingle", "c_shingle")
    need = F.ceil(F.col("n") * F.lit(percent) / F.lit(100)).cast("int")
    size = F.size("by_rarity")
    rare = (rows.join(counted, F.col("shingle") == F.col("c_shingle")).groupBy("node")
            .agg(F.array_sort(F.collect_set(F.struct("n_nodes", "shingle"))).alias("by_rarity"))
            .join(nodes, "node").where(size >= need)
            .select("node", "label", "n", "block", size.alias("size"),
                    F.posexplode(F.slice(F.col("by_rarity.shingle"), F.lit(1), size - need + 1)).alias("pos", "shingle"))
            .withColumn("left", F.col("size") - F.col("pos")).drop("size", "pos"))
    rare = written(rare, "rare")
    discard(rows)
    several = (rare.groupBy("shingle").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
               .select(F.col("shingle").alias("s_shingle")))
    left = written(rare.join(several, F.col("shingle") == F.col("s_shingle"), "left_semi"), "meetings")
    # a node goes to the cell of its block and each block that shares a shingle with it
    other = left.groupBy("shingle", "block").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).select(
        F.col("shingle").alias("o_shingle"), F.col("block").alias("o_block"), "lo", "hi")
    asked = left.join(other, (F.col("shingle") == F.col("o_shingle")) & ((F.col("lo") != F.col("label")) | (F.col("hi") != F.col("label"))))
    asked = written(asked.select(_cell(), "node", "label", "block", "shingle", "left"), "asked")
    given = asked.select("cell", "node", "label", "block").distinct().join(sets, "node")
    cols = ["cell", "node", "label", "block", "shingle", "left", "full", "shared"]
    given = given.withColumn("shingle", F.lit(None).cast("long")).withColumn("left", F.lit(None).cast("int")).select(*cols)
    empty = F.lit(None).cast("binary")
    rows = given.unionByName(asked.withColumn("full", empty).withColumn("shared", empty).select(*cols))
    # the sets of a cell come before the lists of its shingles
    rows = (rows.repartition(shuffle_partitions(sets), "cell")
            .sortWithinPartitions("cell", F.col("shingle").asc_nulls_first(), "node"))

    def confirm(batches):
        import numpy as np
        import pyarrow as pa

        def found(parts):
            col = lambda k, kind: np.concatenate([p.column(k).to_numpy(zero_copy_only=False) for p in parts]).astype(kind)
            ids, label, block = (col(k, np.int64) for k in (1, 2, 3))
            is_set = np.concatenate([p.column(6).is_valid().to_numpy(zero_copy_only=False) for p in parts])
            full, shared = ([np.frombuffer(x, np.uint64) for p in parts for x in p.column(k).drop_null().to_pylist()] for k in (6, 7))
            shingle = np.concatenate([p.column(4).drop_null().to_numpy() for p in parts])
            rest = np.concatenate([p.column(5).drop_null().to_numpy() for p in parts]).astype(np.int64)
            places = np.searchsorted(ids[is_set], ids[~is_set])
            begin = np.flatnonzero(np.append(True, shingle[1:] != shingle[:-1]))
            size = np.array([len(x) for x in full], np.int64)
            ids, label, block = ids[is_set], label[is_set], block[is_set]
            for i, j in meeting_pairs(places, rest, begin, size, label, block, percent):
                ok = linked(full, shared, i, j, matches, percent)
                yield pa.RecordBatch.from_arrays([pa.array(ids[i[ok]]), pa.array(ids[j[ok]])], ["a", "b"])

        cell, parts = None, []
        for batch in batches:
            cells = batch.column(0).to_numpy()
            begin = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
            for lo, hi in zip(begin.tolist(), np.append(begin[1:], len(cells)).tolist()):
                if parts and cell != cells[lo]:
                    yield from found(parts)
                    parts = []
                cell = cells[lo]
                parts.append(batch.slice(lo, hi - lo))
        if parts:
            yield from found(parts)

    links = written(rows.mapInArrow(confirm, "a long, b long"), "links")
    discard(rare, left, asked)
    return links


def _similar_size(percent: int):
    return F.lit(100) * F.least("n", "o_n") >= F.lit(percent) * F.greatest("n", "o_n")


def _cell():
    """The cell of two blocks."""
    return F.xxhash64(F.least("block", "o_block"), F.greatest("block", "o_block")).alias("cell")


def _pairs(met: DataFrame) -> DataFrame:
    """Distinct pairs and the cell of their blocks."""
    return met.select(_cell(), F.least("node", "o_node").alias("a"), F.greatest("node", "o_node").alias("b")).distinct()


def _with_block(shared: DataFrame) -> DataFrame:
    """Adds ``block``: nodes with the same most common posting lie in as many
    blocks as keep each at about ``BLOCK_SHINGLES`` and ``BLOCK_NODES``."""
    total = (shared.groupBy("common").agg(F.sum("n").alias("t_n"), F.count(F.lit(1)).alias("t_nodes"))
             .withColumnRenamed("common", "t_common"))
    blocks = F.ceil(F.greatest(F.col("t_n") / F.lit(BLOCK_SHINGLES), F.col("t_nodes") / F.lit(BLOCK_NODES)))
    return (shared.join(total, F.col("common") == F.col("t_common"))
            .withColumn("block", F.xxhash64("common", F.pmod(F.xxhash64("node"), blocks)))
            .drop("t_common", "t_n", "t_nodes", "common"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT, coordinates: int = COORDINATES, matches: int = MATCHES,
                    stars: int = STARS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest
    id reachable by links), kept (whether that is its own).  Each text of an
    id with several texts is a document of its own, linked by what it says."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    said = F.xxhash64("text")
    several = written(base.where("doc_id is not null").groupBy("doc_id").agg(F.min(said).alias("lo"), F.max(said).alias("hi"))
                      .where("lo < hi").select(F.col("doc_id").alias("s_id")), "several-texts")
    if several.isEmpty():
        return _components(base, shingle, percent, coordinates, matches, stars)
    # texts of such ids are found under names of their own; then the smallest
    # true id of a component names it
    named = (base.join(several, F.col("doc_id") == F.col("s_id"), "left")
             .withColumn("row_id", F.when(F.col("s_id").isNotNull(), F.xxhash64("doc_id", "text")).otherwise(F.col("doc_id"))))
    found = written(_components(named.select(F.col("row_id").alias("doc_id"), "text"), shingle, percent, coordinates, matches,
                                stars).drop("kept"), "found")
    names = named.where("s_id is not null").select("row_id", F.col("doc_id").alias("own")).distinct()
    found = (found.join(names, F.col("doc_id") == F.col("row_id"), "left")
             .withColumn("doc_id", F.coalesce("own", "doc_id")).drop("own", "row_id"))
    smallest = (found.where("component_id is not null").groupBy(F.col("component_id").alias("c_id"))
                .agg(F.min("doc_id").alias("smallest")))
    out = found.join(smallest, F.col("component_id") == F.col("c_id"), "left")
    return out.select("doc_id", "n_shingles", F.col("smallest").alias("component_id"),
                      F.coalesce(F.col("doc_id") == F.col("smallest"), F.lit(True)).alias("kept"))


def _components(base: DataFrame, shingle: int, percent: int, coordinates: int, matches: int, stars: int) -> DataFrame:
    """:func:`near_duplicates` of (doc_id, text) where equal ids mean equal
    texts."""
    profile = written(_profile(base, shingle, coordinates), "profile")
    some = profile.where("n_shingles > 0 and doc_id is not null")
    classes = written(some.groupBy("key1", "key2", "n_shingles").agg(
        F.min("doc_id").alias("node"), F.first("signature").alias("signature")), "classes")
    posted = classes.select("node", F.col("n_shingles").alias("n"), F.explode("signature").alias("posting"))
    counted = (posted.groupBy("posting").agg(F.count(F.lit(1)).alias("n_docs")).where("n_docs > 1")
               .withColumnRenamed("posting", "c_posting"))
    shared = (posted.join(counted, F.col("posting") == F.col("c_posting"))
              .groupBy("node", "n").agg(F.array_sort(F.collect_set(F.struct("n_docs", "posting"))).alias("by_rarity"))
              .where(F.size("by_rarity") >= matches)
              .select("node", "n", F.col("by_rarity.posting").alias("shared"), F.element_at("by_rarity", -1)["posting"].alias("common")))
    unblocked = written(shared, "shared")
    shared = written(_with_block(unblocked), "blocks")
    discard(unblocked)
    sets = written(_sets(base.join(shared, F.col("doc_id") == F.col("node")).select("doc_id", "text", "shared"), shingle), "sets")
    posts = written(shared.select("node", "n", "block", F.explode(
        F.slice("shared", F.lit(1), F.size("shared") - matches + 1)).alias("posting")), "posts")
    discard(shared)
    links = None
    for turn in range(stars):
        pivot = (posts.groupBy("posting").agg(F.min_by(F.struct("node", "n", "block"), F.xxhash64("node", F.lit(turn))).alias("p"))
                 .select(F.col("posting").alias("o_posting"), F.col("p.node").alias("o_node"), F.col("p.n").alias("o_n"),
                         F.col("p.block").alias("o_block")))
        met = posts.join(pivot, (F.col("posting") == F.col("o_posting")) & (F.col("node") != F.col("o_node")) & _similar_size(percent))
        found = _links(_pairs(met), sets, matches, percent)
        links = found if links is None else links.union(found)
    labels = components(links)
    # what the pivots left: documents under a posting with several components
    l = labels.select(F.col("node").alias("l_node"), "root")
    now = (posts.join(l, F.col("node") == F.col("l_node"), "left")
           .select("posting", "node", "n", "block", F.coalesce("root", "node").alias("label")))
    now = written(now, "labelled")
    discard(posts)
    several = (now.groupBy("posting").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
               .select(F.col("posting").alias("s_posting")))
    rest = now.join(several, F.col("posting") == F.col("s_posting"), "left_semi")
    rest = written(rest.select("node", "n", "block", "label").distinct(), "rest")
    discard(now)
    found = _rare_links(rest, sets, matches, percent)
    discard(rest, sets)
    if not found.isEmpty():
        # links between the components found so far, and nodes seen for the first time
        a, b = (labels.select(F.col("node").alias(f"{k}_node"), F.col("root").alias(f"{k}_root")) for k in "ab")
        between = (found.join(a, F.col("a") == F.col("a_node"), "left").join(b, F.col("b") == F.col("b_node"), "left")
                   .select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")))
        upper = components(between).withColumnRenamed("node", "u_node").withColumnRenamed("root", "u_root")
        joined = labels.join(upper, F.col("root") == F.col("u_node"), "full")
        labels = written(joined.select(F.coalesce("node", "u_node").alias("node"), F.coalesce("u_root", "root").alias("root"))
                         .unionByName(upper.select(F.col("u_node").alias("node"), F.col("u_root").alias("root"))).distinct(), "labels")
    of_class = (classes.join(labels.withColumnRenamed("node", "r_node"), F.col("node") == F.col("r_node"), "left")
                .select(F.col("key1").alias("k1"), F.col("key2").alias("k2"), F.col("n_shingles").alias("k_n"),
                        F.coalesce("root", "node").alias("component")))
    mine = (F.col("key1") == F.col("k1")) & (F.col("key2") == F.col("k2")) & (F.col("n_shingles") == F.col("k_n"))
    out = (profile.select("doc_id", "n_shingles", "key1", "key2").join(of_class, mine & (F.col("n_shingles") > 0), "left")
           .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stand for their component, one per id and
    text (of several the one whose columns have the smallest hash), and every
    row without an id."""
    mark, place = fresh("kept_id", docs.columns), fresh("copy_no", docs.columns)
    kept = near_duplicates(docs, id_col, text_col, **options).where("kept").select(F.col("doc_id").alias(mark))
    named = docs.join(kept, F.col(id_col).cast("long") == F.col(mark), "left_semi")
    same = Window.partitionBy(id_col, F.md5(F.col(text_col).cast("binary"))).orderBy(whole_row(docs))
    named = named.withColumn(place, F.row_number().over(same)).where(F.col(place) == 1).drop(place)
    return named.unionByName(docs.where(F.col(id_col).isNull()))


ship(__name__)
