"""Operators that SQL cannot express, against plain versions of their own."""

import base64
import struct

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from rankflow.llm import bpe, mixing, quality, recompress, separators
from rankflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# ---- op9: the pivotal tree ------------------------------------------------

def draw(seed, a, b):
    key = struct.pack("<qqq", seed, -1 if a is None else a, -1 if b is None else b)
    return (xxhash.xxh3_64_intdigest(key) >> 11) / 2.0 ** 53


def meet(x, y, seed):
    """Two documents [id, size, fraction]: words move from one to the other
    until one of them is taken wholly or not at all."""
    (_, sx, px), (_, sy, py) = x, y
    wx, wy = sx * px, sy * py
    to_x, to_y = min(sx - wx, wy), min(wx, sy - wy)
    if draw(seed, x[0], y[0]) * (to_x + to_y) < to_y:
        wx, wy = (sx, wy - to_x) if sx - wx <= wy else (wx + to_x, 0.0)
    else:
        wx, wy = (wx - to_y, sy) if wx > sy - wy else (0.0, wy + to_y)
    x[2], y[2] = wx / sx, wy / sy


def tree(docs, leaf_of, place, leaves, arity, seed):
    """{key: 0 or 1} of [key, id, size, fraction] of one source; a node meets
    its documents by ``place``."""
    level = {}
    for key, doc_id, size, part in docs:
        level.setdefault(leaf_of[key], []).append((key, [doc_id, size, part]))
    out, depth = {}, 0
    while True:
        last, residual = leaves == 1, {}
        for leaf, members in sorted(level.items()):
            held = None
            for key, doc in sorted(members, key=lambda m: place[m[0]]):
                if held is None:
                    held = (key, doc)
                    continue
                meet(held[1], doc, seed + depth)
                if held[1][2] in (0.0, 1.0):
                    out[held[0]] = int(held[1][2])
                    held = (key, doc)
                else:
                    out[key] = int(doc[2])
                if held[1][2] in (0.0, 1.0):
                    out[held[0]] = int(held[1][2])
                    held = None
            if held is not None and last:
                out[held[0]] = int(draw(seed + depth, held[1][0], None) < held[1][2])
            elif held is not None:
                residual.setdefault(leaf // arity, []).append(held)
        if last:
            return out
        level, leaves, depth = residual, -(-leaves // arity), depth + 1


@pytest.mark.parametrize("leaf_rows, arity, share", [(1000, 4, 0.7), (6, 3, 0.7), (3, 2, 1.3)])
def test_mix_equals_a_plain_tree(spark, leaf_rows, arity, share):
    rng = np.random.default_rng(4)
    rows = [(k, " ".join(["x"] * int(rng.integers(0, 40))), "abc"[int(rng.integers(0, 12)) // 5]) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    seed = 17
    got = {r.doc_id: r for r in mixing.mix(df, share=share, leaf_rows=leaf_rows, arity=arity, seed=seed).collect()}
    assert len(got) == 300
    hashed = {r.doc_id: r.h for r in df.select("doc_id", F.size(F.regexp_extract_all("text", F.lit("(x)"), 1)).cast("long").alias("size"))
              .select("doc_id", F.xxhash64("doc_id", "size", F.lit(seed)).alias("h")).collect()}
    leaves = -(-300 // leaf_rows)
    for source in "abc":
        mine = [(k, len(t.split())) for k, t, s in rows if s == source]
        total = sum(n for _, n in mine)
        assert all(got[k].source_size == total for k, _ in mine)
        ratio = min(got[mine[0][0]].target / total, 2.0)
        whole, part = int(ratio // 1), ratio - ratio // 1
        order = sorted((hashed[k] % leaves, hashed[k], k, n) for k, n in mine if n)
        one = tree([(k, k, n, part) for _, _, k, n in order], {k: leaf for leaf, _, k, _ in order},
                   {k: (h, k) for _, h, k, _ in order}, leaves, arity, seed)
        for k, n in mine:
            assert got[k].copies == whole + one.get(k, 0), k


def test_mean_copies_equal_the_fractions():
    """Over many seeds each document is taken as often as its fraction says,
    and the words taken stay within one document of the sum."""
    import pyarrow as pa

    rng = np.random.default_rng(8)
    size, part = rng.integers(1, 60, 40), rng.uniform(0.05, 0.95, 40)
    batch = pa.RecordBatch.from_pydict({
        "doc_id": pa.array(range(40), pa.int64()), "size": pa.array(size, pa.int64()), "part": pa.array(part),
        "done": pa.array([False] * 40), "source_pos": pa.array([0] * 40, pa.int64()), "leaf": pa.array([0] * 40, pa.int64())})
    runs, mean = 2000, np.zeros(40)
    for seed in range(runs):
        rows = [r for b in mixing._pivot(seed, True)([batch]) for r in b.to_pylist()]
        assert len(rows) == 40 and all(r["done"] and r["part"] in (0.0, 1.0) for r in rows)
        taken = np.zeros(40)
        taken[[r["doc_id"] for r in rows]] = [r["part"] for r in rows]
        assert abs(float((taken * size).sum() - (part * size).sum())) <= size.max()
        mean += taken / runs
    # five standard deviations of a mean of draws
    assert (np.abs(mean - part) < 5 * np.sqrt(part * (1 - part) / runs)).all()


def test_mix_does_not_depend_on_partitions(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    first, second = (sorted(map(tuple, mixing.mix(df.repartition(n), leaf_rows=20, arity=3).collect())) for n in (1, 7))
    assert first == second


# ---- op8: flat files ------------------------------------------------------

@pytest.mark.parametrize("block", [97, 1 << 20])
def test_separator_scan_equals_a_plain_scan_of_every_file(spark, block):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3, "doc_id").select("doc_id", "text")
    docs = spark.createDataFrame(docs.collect(), docs.schema).repartitionByRange(3, "doc_id").sortWithinPartitions("doc_id")
    files, dtype = separators.write_flat(docs)
    got = sorted(tuple(r) for r in separators.count_tokens(separators.with_length(files), dtype, block=block).collect())
    want, held = [], []
    for f in files.collect():
        fs, path = separators.file_system(f.path)
        with fs.open_input_file(path) as src:
            ids = np.frombuffer(src.read(), dtype)
        ends = np.flatnonzero(ids == separators.SEPARATOR).tolist()
        assert len(ends) == f.n_docs and ends[-1] == len(ids) - 1
        starts = [0] + [e + 1 for e in ends[:-1]]
        want += [(f.path, k, s, e - s, True) for k, (s, e) in enumerate(zip(starts, ends))]
        held.append([ids[s:e].tolist() for s, e in zip(starts, ends)])
    assert got == sorted(want)
    # each file holds the texts of one partition, in their order
    plain = Tokenizer.from_file(bpe.default_path())
    plain.encode_special_tokens = True
    parts = {}
    for r in docs.select(F.spark_partition_id().alias("p"), "doc_id", "text").collect():
        parts.setdefault(r.p, []).append((r.doc_id, r.text))
    expected = [[plain.encode(t or "", add_special_tokens=False).ids for _, t in sorted(v)] for v in parts.values()]
    assert sorted(held) == sorted(expected)


# ---- op10: bands ----------------------------------------------------------

def plain_verdict(text, failed):
    pack = zstandard.ZstdCompressor(level=3).compress
    b = (text or "").encode()
    if failed:
        return False
    least, most = next((low, high) for below, low, high in quality.BANDS if len(b) < below)
    cuts = list(range(0, len(b), 4096))
    if len(cuts) > 1 and len(b) - cuts[-1] < 2048:
        cuts.pop()
    elif len(cuts) == 1 and len(b) < 2048:
        cuts = []
    pieces = [b[a:z] for a, z in zip(cuts, cuts[1:] + [len(b)])]
    low, high = quality.CHUNK_BAND
    bad = [p for p in pieces if not low <= len(p) / len(pack(p)) <= high]
    return least <= len(b) / len(pack(b)) <= most and 4 * len(bad) <= len(pieces)


def test_quality_verdict_equals_a_plain_one(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op10_quality"](spark, sf).collect()
    assert len(rows) == len(texts)
    assert all(r.kept == plain_verdict(texts[r.doc_id], r.base_failed) for r in rows)
    assert any(not r.kept and not r.base_failed for r in rows)


def test_bands_are_those_fitted_to_the_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    assert quality.fit_bands(docs, labels) == quality.BANDS


def test_fitted_bands_separate_texts_of_any_other_table(spark):
    """Fitted anew to a table of its own: plain texts stay, repetition and
    noise go, bands without labels follow the growth or stay open."""
    rng = np.random.default_rng(3)
    vocabulary = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(3000)]

    def text(n):
        return " ".join(vocabulary[min(2999, int(k))] for k in rng.exponential(400, n))

    rows = [(k, text(int(rng.integers(60, 500)))) for k in range(400)] + [(400, None), (401, ""), (None, text(99))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("quality", F.lit("clash"))
    labels = spark.createDataFrame([(k, 1) for k in range(0, 400, 2)] + [(0, 1), (400, 1), (401, 1), (None, 1), (1, None)],
                                   "doc_id long, quality int")
    bands = quality.fit_bands(docs, labels)
    assert [b[0] for b in bands] == list(quality.EDGES) and bands[0][1:] == (0.0, float("inf"))
    assert sum(0 < low < high < float("inf") for _, low, high in bands) > 5
    held_out = [t.encode() for k, t in rows[1:400:2]]
    assert all(r[-1] for r in quality.assess_all(held_out, bands=bands, chunk_band=(0, 99)))
    noise = base64.b64encode(rng.bytes(3000))
    pack = zstandard.ZstdCompressor(level=3).compress
    stutter = (text(25) + "\n").encode() * 30
    for t in (noise, stutter):
        assert not quality.in_band(len(t), len(t) / len(pack(t)), bands)
    empty = quality.fit_bands(docs.limit(0), labels)
    assert all(b[1:] == (0.0, float("inf")) for b in empty)


# ---- op6: windows that agree in one hash ----------------------------------

@pytest.mark.parametrize("lost", ["window_hashes", "second_hashes"])
def test_windows_of_other_words_are_told_apart_by_either_hash(spark, monkeypatch, lost):
    """With one of the two hashes useless the other one still decides."""
    monkeypatch.setattr(recompress, lost, lambda h, window: np.zeros(len(h) - window + 1, np.uint64))
    rng = np.random.default_rng(6)
    passage = [f"p{k}" for k in range(40)]
    docs = []
    for d in range(30):
        w = [f"w{k}" for k in rng.integers(0, 300, int(rng.integers(0, 90)))]
        at = int(rng.integers(0, len(w) + 1))
        w[at:at] = passage[:int(rng.integers(5, 40))] if d % 2 else []
        docs.append((d, w))
    first = {}
    for d, w in docs:
        for i in range(len(w) - 12):
            first.setdefault(tuple(w[i:i + 13]), d)
    want = {d: len({i + j for i in range(len(w) - 12) if first[tuple(w[i:i + 13])] < d for j in range(13)}) for d, w in docs}
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in recompress.substring_dedup(df).collect()} == want
    assert sum(want.values()) > 0
