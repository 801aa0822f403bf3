"""Substring dedup by recompression.

Every text is parsed in rounds.  A round names runs of an equal symbol, or
pairs of neighbours whose left symbol falls into the left class and whose
right one into the right class.  Classes and names are hashes of the symbols
themselves, so they are global: equal substrings receive equal symbols
everywhere, except near their ends, where a symbol could belong to something
outside.  What is certain inside a substring is tracked exactly: the first
symbol is dropped if its class would let it join a left neighbour, the last
one if it could join a right neighbour, and runs at the ends always.

A window of ``window`` words is represented by the longest certain symbol
inside it (the smallest hash among equals).  A window that occurs in two
documents has the same representative in both, so documents that share no
symbol share no window:

1. texts equal as a whole are one symbol; the smallest id stands for them;
2. each stretch of windows with one representative is posted as (symbol,
   document, place); symbols that occur in at least two documents are revealed;
3. windows with a revealed representative are verified by two independent
   64-bit hashes of all their words, and the smallest document of each is
   found;
4. a document loses the words of its windows that also start in a document
   with a smaller id.

Scale: texts are shuffled by document only; symbols and windows are counted
with map-side partial sums before they are joined back, so a passage in a
third of all documents costs one row per task there, and the joins back are
plain equi-joins whose large keys Spark can split.  A task holds one batch of
texts; what is gathered per document is bounded by its length.

Defined cases: a null or empty text has no words; texts shorter than a window
lose nothing; rows that repeat a document id count as one document with that
id (each row is returned, and each of its texts is cut on its own); rows with a null id are neither compared nor
changed; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import bytes_of, discard, hash_words, in_parts, mixed, ship, written

WINDOW = 13
ROUNDS = 4
_FIRST = 2  # symbols of the first rounds are too common to stand for a window


def window_hashes(h, window: int):
    """Hash of the words of the window at each place of an array of hashes."""
    import numpy as np

    n = len(h) - window + 1
    out = np.zeros(n, np.uint64)
    for k in range(window):
        out = (out ^ h[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return mixed(out)


def second_hashes(h, window: int):
    """Another hash of the same windows: a polynomial of the words' hashes.
    Different windows agree in both hashes with a chance of 2**-128, as long as
    their words' hashes differ."""
    import numpy as np

    n = len(h) - window + 1
    out = h[:n].copy()
    for k in range(1, window):
        out *= np.uint64(0xD1342543DE82EF95)
        out += h[k:k + n]
    return mixed(out)


def representatives(h, doc, window: int = WINDOW, rounds: int = ROUNDS):
    """(window starts, symbol of each window).  A window without a certain
    symbol gets symbol 0."""
    import numpy as np

    n = len(h)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts = np.flatnonzero(doc[:n - window + 1] == doc[window - 1:])
    lo, hi = starts.copy(), starts + window
    best = np.full(len(starts), np.iinfo(np.uint64).max, np.uint64)
    name = np.zeros(len(starts), np.uint64)
    sym, own, span = h, doc, np.ones(n, np.int64)
    for r in range(rounds + 1):
        if r == 0:  # runs
            begin = np.ones(len(sym), bool)
            begin[1:] = (sym[1:] != sym[:-1]) | (own[1:] != own[:-1])
            number = np.cumsum(begin) - 1
            lo, hi = number[lo] + 1, number[hi - 1]
        else:  # pairs
            right = (mixed(sym + np.uint64(r)) & np.uint64(1)).astype(bool)
            joins = ~right[:-1] & right[1:] & (own[1:] == own[:-1])
            begin = np.ones(len(sym), bool)
            begin[1:] = ~joins
            number = np.cumsum(begin) - 1
            some = lo < hi
            a, z = lo[some], hi[some]
            a = a + right[a]
            z = z - ~right[z - 1]
            full = a < z
            lo, hi = np.zeros_like(lo), np.zeros_like(hi)
            at = np.flatnonzero(some)[full]
            lo[at], hi[at] = number[a[full]], number[z[full] - 1] + 1
        at = np.flatnonzero(begin)
        size = np.diff(np.append(at, len(sym)))
        width = np.add.reduceat(span, at)
        if r == 0:
            new = np.where(size > 1, mixed(sym[at] + size.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), sym[at])
        else:
            two = size > 1
            new = sym[at].copy()
            new[two] = mixed((sym[at[two]] * np.uint64(0x9E3779B97F4A7C15) + sym[at[two] + 1]) ^ np.uint64(r))
        sym, own, span = new, own[at], width
        if r >= _FIRST:
            rank = ((np.uint64(63) - np.minimum(span, 63).astype(np.uint64)) << np.uint64(58)) | (mixed(sym) >> np.uint64(6))
            for t in range(int((hi - lo).max(initial=0))):
                k = lo + t
                ok = np.flatnonzero(k < hi)
                k = k[ok]
                better = rank[k] < best[ok]
                ok, k = ok[better], k[better]
                best[ok], name[ok] = rank[k], sym[k]
    return starts, name


def _batches(batch, text_at: int):
    """(rows of the batch, word hashes, document of each word, words per
    text) for parts of an Arrow batch."""
    import numpy as np

    texts = bytes_of(batch.column(text_at))
    at = 0
    for part in in_parts(texts):
        h, _, _, counts = hash_words(part)
        yield slice(at, at + len(part)), h, np.repeat(np.arange(len(part)), counts), counts
        at += len(part)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (the kept
    words joined by single spaces)."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    keyed = base.withColumn("whole", F.unhex(F.md5("text")))
    # equal texts: the smallest id stands for all of them; an id with several
    # texts is told apart by ``version``, which is 0 for all other ids
    ids = keyed.where("doc_id is not null").select("doc_id", "whole", F.xxhash64("whole").alias("v"))
    stands = ids.groupBy("whole").agg(F.min("doc_id").alias("least")).withColumnRenamed("whole", "l_whole")
    several = (ids.groupBy("doc_id").agg(F.min("v").alias("a"), F.max("v").alias("z")).where("a <> z")
               .select(F.col("doc_id").alias("s_id")))
    texts = written(ids.distinct().join(stands, F.col("whole") == F.col("l_whole"))
                    .join(several, F.col("doc_id") == F.col("s_id"), "left")
                    .select("doc_id", "whole", F.when(F.col("s_id").isNotNull(), F.col("v")).otherwise(F.lit(0)).alias("version"),
                            (F.col("doc_id") > F.col("least")).alias("copy")), "texts")
    c = texts.where("copy or version <> 0").select(F.col("doc_id").alias("c_id"), F.col("whole").alias("c_whole"), "version", "copy")
    first = (keyed.where("doc_id is not null").join(c, (F.col("doc_id") == F.col("c_id")) & (F.col("whole") == F.col("c_whole")), "left")
             .where(~F.coalesce("copy", F.lit(False)))
             .select("doc_id", F.coalesce("version", F.lit(0)).cast("long").alias("version"), "text"))

    def post(batches):
        import numpy as np
        import pyarrow as pa

        np.seterr(over="ignore")
        for b in batches:
            ids, versions = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for rows, h, doc, counts in _batches(b, 2):
                starts, name = representatives(h, doc, window, rounds)
                if not len(starts):
                    continue
                begin = np.ones(len(starts), bool)
                begin[1:] = (name[1:] != name[:-1]) | (starts[1:] != starts[:-1] + 1) | (doc[starts[1:]] != doc[starts[:-1]])
                at = np.flatnonzero(begin)
                n = np.diff(np.append(at, len(starts)))
                own = doc[starts[at]]
                place = starts[at] - (np.cumsum(counts) - counts)[own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name[at].view(np.int64)), pa.array(ids[rows][own], pa.int64()),
                     pa.array(versions[rows][own], pa.int64()), pa.array(place.astype(np.int32)), pa.array(n.astype(np.int32))],
                    ["symbol", "doc_id", "version", "place", "n"])

    posts = written(first.mapInArrow(post, "symbol long, doc_id long, version long, place int, n int"), "posts")
    # symbol 0 marks windows that are one long run: always verified
    named = posts.where("symbol <> 0")
    shared = written(named.groupBy("symbol").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z"))
                     .where("a < z").select(F.col("symbol").alias("s_symbol")), "shared")
    revealed = (named.join(shared, F.col("symbol") == F.col("s_symbol")).select("doc_id", "version", "place", "n")
                .unionByName(posts.where("symbol = 0").select("doc_id", "version", "place", "n")))
    ranges = written(revealed.groupBy("doc_id", "version").agg(F.collect_list(F.struct("place", "n")).alias("ranges")), "revealed")
    discard(posts, shared)

    def verify(batches):
        import numpy as np
        import pyarrow as pa

        np.seterr(over="ignore")
        for b in batches:
            ids, versions = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            lists = b.column(3)
            ends = lists.offsets.to_numpy()
            flat = lists.values
            places, sizes = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for rows, h, doc, counts in _batches(b, 2):
                if len(h) < window:
                    continue
                a, z = ends[rows.start], ends[rows.stop]
                own = np.repeat(np.arange(len(counts)), np.diff(ends[rows.start:rows.stop + 1]))
                base = np.cumsum(counts) - counts
                p, n = places[a:z].astype(np.int64) + base[own], sizes[a:z].astype(np.int64)
                at = np.repeat(p - (np.cumsum(n) - n), n) + np.arange(n.sum())
                who = np.repeat(own, n)
                # a window repeated within its document is one row with all its places
                w, w2 = window_hashes(h, window)[at], second_hashes(h, window)[at]
                order = np.lexsort((at, w2, w, who))
                w, w2, who, at = w[order], w2[order], who[order], at[order]
                begin = np.ones(len(at), bool)
                begin[1:] = (w[1:] != w[:-1]) | (w2[1:] != w2[:-1]) | (who[1:] != who[:-1])
                k = np.flatnonzero(begin)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w[k].view(np.int64)), pa.array(w2[k].view(np.int64)), pa.array(ids[rows][who[k]], pa.int64()),
                     pa.array(versions[rows][who[k]], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.append(k, len(at)), pa.int32()),
                                              pa.array((at - base[who]).astype(np.int32)))], ["hash", "hash2", "doc_id", "version", "places"])

    r = ranges.select(F.col("doc_id").alias("r_id"), F.col("version").alias("r_version"), "ranges")
    seen = written(first.join(r, (F.col("doc_id") == F.col("r_id")) & (F.col("version") == F.col("r_version")))
                   .select("doc_id", "version", "text", "ranges")
                   .mapInArrow(verify, "hash long, hash2 long, doc_id long, version long, places array<int>"), "windows")
    discard(ranges)
    owner = written(seen.groupBy("hash", "hash2").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a < z")
                    .select(F.col("hash").alias("o_hash"), F.col("hash2").alias("o_hash2"), F.col("a").alias("owner")), "owners")
    gone = (seen.join(owner, (F.col("hash") == F.col("o_hash")) & (F.col("hash2") == F.col("o_hash2"))
                      & (F.col("doc_id") > F.col("owner")))
            .groupBy("doc_id", "version").agg(F.flatten(F.collect_list("places")).alias("places")))
    # a text that is not the first of its kind is covered by its own windows
    changed = written(texts.join(gone, ["doc_id", "version"], "left").where("copy or places is not null")
                      .select(F.col("doc_id").alias("x_id"), F.col("whole").alias("x_whole"), "places", "copy"), "removed")
    discard(seen, owner)
    marked = (keyed.join(changed, (F.col("doc_id") == F.col("x_id")) & (F.col("whole") == F.col("x_whole")), "left")
              .select("doc_id", "text", "places", F.coalesce("copy", F.lit(False)).alias("copy")))

    def cut(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            n_words, n_gone, kept = [], [], []
            for text, places, copy in zip(b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()):
                words = text.split()
                if copy and len(words) >= window:
                    words, removed = [], len(words)
                    total = removed
                else:
                    total, removed = len(words), 0
                    if places.is_valid:
                        p = places.values.to_numpy()
                        depth = np.zeros(total + 1, np.int64)
                        np.add.at(depth, p, 1)
                        np.add.at(depth, p + window, -1)
                        out = np.cumsum(depth)[:total] > 0
                        removed = int(out.sum())
                        words = [words[k] for k in np.flatnonzero(~out)]
                n_words.append(total)
                n_gone.append(removed)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    return marked.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_text string")


ship(__name__)
