"""Grid order join, Merkle manifest and periodic runs against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankflow.llm import gridjoin, manifest, runs
from rankflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# -- vectors -------------------------------------------------------------------

def brute_links(rows, cosine=0.93):
    """(id, links, component, kept) of (id, vector, label) rows, sorted."""
    def usable(v, label, i):
        return (i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v)
                and any(x != 0 for x in v))

    n = len(rows)
    near = [set() for _ in rows]
    for i in range(n):
        for j in range(i):
            (a, x, lx), (b, y, ly) = rows[i], rows[j]
            if usable(x, lx, a) and usable(y, ly, b) and lx == ly and len(x) == len(y):
                x, y = np.array(x, float), np.array(y, float)
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= cosine:
                    near[i].add(j)
                    near[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(near[i]), least, rows[i][0] == least))
    return sorted(out, key=str)


def run_vectors(spark, rows, schema="vec_id long, embedding array<double>, label int"):
    got = gridjoin.near_vectors(spark.createDataFrame(rows, schema))
    return sorted(map(tuple, got.collect()), key=str)


def test_vectors_against_brute_force_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(gridjoin, "BLOCK", 16)
    monkeypatch.setattr(gridjoin, "PART", 4)
    rng = np.random.default_rng(5)
    rows = []
    for c in range(30):
        centre = rng.normal(size=6)
        for _ in range(8):
            rows.append((len(rows), (centre + rng.normal(size=6) * 0.25).tolist(), c % 3))
    rows += [(len(rows) + k, rows[3][1], 0) for k in range(40)]          # a hot class
    random.Random(1).shuffle(rows)
    got = run_vectors(spark, rows)
    assert got == brute_links(rows)
    assert sum(r[1] for r in got) > 1000


def test_vectors_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1),
            (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (None, [1.0, 0.0], 1),
            (11, [1e300, 1e298], 1), (12, [1e-300, 0.0], 1), (13, [1.0, 0.0, 0.0], 1), (14, [-1.0, -0.0], 1),
            (2, [0.0, 1.0], 1), (1, [1.0, 0.0], 1)]
    got = run_vectors(spark, rows)
    assert got == brute_links([(i, None if v is None else [None if x is None else x * 1e-150 * (1e150 if abs(x) < 1e200 else 1)
                                                         for x in v] if i != 12 else [1.0, 0.0], lb) for i, v, lb in rows])


def test_vectors_empty_table_and_extra_columns(spark):
    assert run_vectors(spark, []) == []
    df = spark.createDataFrame([(1, [1.0], 1, "x"), (2, [2.0], 1, "y")], "vec_id long, embedding array<float>, label int, key string")
    assert sorted(map(tuple, gridjoin.near_vectors(df).collect())) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_distant_blocks_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(gridjoin, "BLOCK", 16)
    rows = [(k, [np.cos(k / 300), np.sin(k / 300)], 1) for k in range(900)]
    df = spark.createDataFrame([(i, [float(x) for x in v], lb) for i, v, lb in rows], "vec_id long, embedding array<double>, label int")
    classes = gridjoin._usable(df, "vec_id", "embedding", "label").withColumn("n", F.lit(1).cast("long"))
    eps2 = 2 - 2 * 0.999
    blocks = gridjoin._blocks(classes, np.eye(2), eps2 ** 0.5)
    n, pairs = blocks.count(), gridjoin.near_blocks(blocks, 3, eps2).count()
    assert n > 50 and pairs < 5 * n


# -- manifest --------------------------------------------------------------------

def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(levels, at):
    out = []
    for lv in levels[:-1]:
        r = at - at % 8
        out.append(("".join(lv[r:at]), "".join(lv[at + 1:r + 8])))
        at //= 8
    return out


def plain_manifest(rows):
    """{id: (subroot, root, siblings)} of (id, group, digest) rows."""
    groups = {}
    for i, g, h in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(g, []).append((i, h))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [levels_of([h for _, h in groups[g]]) for g in order]
    top = levels_of([t[-1][0] for t in trees])
    return {i: (trees[k][-1][0], top[-1][0], siblings(trees[k], j) + siblings(top, k))
            for k, g in enumerate(order) for j, (i, _) in enumerate(groups[g])}


def run_manifest(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, lang string, leaf string")
    m = manifest.build(df, "lang", ["doc_id"], "leaf", keys=["doc_id", "lang"])
    return manifest.proofs(m).withColumn("folded", manifest.fold(F.col("leaf"), F.col("proof"))).collect()


def test_manifest_of_every_shape(spark):
    sizes = {None: 513, "a": 1, "b": 8, "é": 9, "z": 64, "zz": 65, "big": 4097}
    rows = [(i, g, H(f"{g}{i}")) for i, g in enumerate(g for g, n in sizes.items() for _ in range(n))]
    random.Random(2).shuffle(rows)
    expected = plain_manifest(rows)
    got = run_manifest(spark, rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.subroot, r.root, [tuple(s) for s in r.proof]) == expected[r.doc_id]
        assert r.folded == r.root


def test_manifest_of_many_groups_one_row_and_none(spark):
    rows = [(i, f"g{i:04d}", H(str(i))) for i in range(600)]
    expected = plain_manifest(rows)
    assert {r.doc_id: (r.subroot, r.root, [tuple(s) for s in r.proof]) for r in run_manifest(spark, rows)} == expected
    (one,) = run_manifest(spark, [(5, "x", H("x"))])
    assert (one.leaf, one.subroot, one.root, one.proof, one.folded) == (H("x"), H("x"), H("x"), [], H("x"))
    assert run_manifest(spark, []) == []


def test_manifest_repeated_rows_and_null_ids(spark):
    rows = [(None, "a", H("n")), (1, "a", H("b")), (1, "a", H("b")), (1, "a", H("a"))]
    got = run_manifest(spark, rows)
    assert sorted(r.leaf for r in got) == sorted(h for _, _, h in rows)
    assert {r.root for r in got} == {H(H("n") + "".join(sorted([H("a"), H("b"), H("b")])))}
    assert all(r.folded == r.root for r in got)


def test_row_digest_and_tampering(spark):
    df = spark.createDataFrame([(1, "é", None), (None, "", "x:1")], "a long, b string, c string")
    got = [r[0] for r in df.select(manifest.row_digest([F.col(c) for c in "abc"])).collect()]
    assert got == [H("1:12:é-"), H("-0:3:x:1")]
    rows = run_manifest(spark, [(i, "a", H(str(i))) for i in range(20)])
    bad = spark.createDataFrame([(H("other"), [tuple(s) for s in rows[3].proof])], "leaf string, " + manifest.PROOF)
    assert bad.select(manifest.fold(F.col("leaf"), F.col("proof"))).first()[0] != rows[3].root


# -- runs --------------------------------------------------------------------------

def brute_runs(w, shortest):
    found = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j - i >= p and (i, j + p) not in found and j + p - i >= shortest:
                found[(i, j + p)] = p
            i = max(j, i) + 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


pieces = st.lists(st.tuples(st.text("abc", min_size=1, max_size=9), st.integers(1, 30)), max_size=6)


@settings(max_examples=150, deadline=None)
@given(st.lists(pieces, min_size=1, max_size=4), st.sampled_from([2, 12]))
def test_runs_against_brute_force(docs, shortest):
    words = [[c for s, k in d for c in s * k] for d in docs]
    with np.errstate(over="ignore"):
        counts, got = runs.runs_of([" ".join(w).encode() for w in words], shortest)
    assert counts.tolist() == [len(w) for w in words]
    for w, g in zip(words, got):
        assert sorted(map(tuple, g.tolist())) == brute_runs(w, shortest)


def test_runs_of_touching_regions_and_fibonacci_words():
    a, b = "a", "ab"
    while len(b) < 600:
        a, b = b, b + a
    words = [list(b[:600]), list("ab" * 60 + "ba" * 50), list("bab" + "bab" * 25 + "abb" * 30), list("a" * 500), []]
    with np.errstate(over="ignore"):
        _, got = runs.runs_of([" ".join(w).encode() for w in words])
    for w, g in zip(words, got):
        assert sorted(map(tuple, g.tolist())) == brute_runs(w, 12)


def test_runs_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(50_000)) + " x y" * 50_000
    rows = [(1, None, 1), (2, "", 2), (None, " \t\n", 3), (4, "a a a", 4), (4, "b " * 12, 5), (5, long, 6), (6, "ä ö " * 6, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, period int")
    got = {r.n_words: r for r in runs.periodic_runs(df).collect()}
    assert runs.periodic_runs(df).count() == len(rows)
    assert [got[n].n_runs for n in (0, 3, 12, 150_000)] == [0, 0, 1, 1]
    assert (got[150_000].start, got[150_000].length, got[150_000].period) == (50_000, 100_000, 2)
    assert got[12].collapsed_text in ("b", "ä ö") and got[0].start is None
    assert runs.periodic_runs(df.limit(0)).count() == 0


def test_runs_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = {}
    for d in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", d.text or "")
        n, h = len(w), zlib.crc32(str(d.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = brute_runs(w, 12)
        gone = {i for s, m, q in found for i in range(s + q, s + m)}
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        expected[d.doc_id] = (len(found), *best, 1000 * best[1] // best[2] if found else None, H(lines),
                              H(" ".join(x for i, x in enumerate(w) if i not in gone)))
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_runs"](spark, SF).collect()}
    assert got == expected
    assert sum(1 for v in expected.values() if v[0]) >= 5
