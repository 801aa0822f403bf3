"""Every corpus query against its DuckDB SQL, or a brute-force version, on the
small tables."""

import zlib

import duckdb
import numpy as np
import pytest

from rankflow.llm import bpe, quality
from rankflow.llm.queries import ORACLE, QUERIES
from rankflow.plans.catalog import TABLES
from scripts.check_oracle import digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def documents(con):
    return con.execute("SELECT doc_id, text, source FROM documents ORDER BY doc_id").fetchall()


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    r = con.execute(ORACLE[name])
    names, expected = [d[0] for d in r.description], r.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert len(rows) == len(expected)
    assert digest(df.columns, rows)[0] == digest(names, expected)[0]


def test_tokens_match_the_library(spark, documents):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.default_path())
    start, expected = 0, []
    for doc_id, text, _ in documents:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = QUERIES["op1_repair_tokens"](spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == expected


def test_separator_scan_matches_the_library(spark, documents):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.default_path())
    expected = sorted(len(t.encode(x or "", add_special_tokens=False).ids) for _, x, _ in documents)
    rows = QUERIES["op8_token_counts"](spark, SF).collect()
    assert sorted(r.n_tokens for r in rows) == expected
    assert all(r.complete for r in rows)


def test_mix_hits_the_targets(spark, documents):
    size = {}
    for doc_id, text, source in documents:
        size.setdefault(source, []).append(len((text or "").encode().split()))
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total = {s: sum(v) for s, v in size.items()}
    left, full, target = 1.5 * sum(total.values()), set(), {}
    while True:
        w = sum(weight[s] for s in names if s not in full)
        target = {s: 2 * total[s] if s in full else left * weight[s] / w for s in names}
        over = {s for s in names if s not in full and target[s] > 2 * total[s]}
        if not over:
            break
        full |= over
        left -= sum(2 * total[s] for s in over)
    query = QUERIES["op9_mix"]
    rows = query(spark, SF).collect()
    source = {d: s for d, _, s in documents}
    taken = dict.fromkeys(names, 0)
    for r in rows:
        s = source[r.doc_id]
        assert r.source_size == total[s] and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= max(size[s]) for s in names)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, query(spark, SF).collect()))


def test_quality_counts_match_brute_force(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op10_quality"](spark, SF).collect()}
    assert len(rows) == len(documents)
    for doc_id, text, _ in documents:
        b = (text or "").encode()
        words = b.split()
        tri = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
        seen = {}
        for k, g in enumerate(tri):
            seen.setdefault(g, []).append(k)
        hit = {k + j for at in seen.values() if len(at) > 1 for k in at for j in range(3)}
        lines = [x for x in b.split(b"\n") if x.split()]
        failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
        r = rows[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(hit), failed)
        assert not (r.kept and r.base_failed)


def test_quality_keeps_labelled_good_documents(spark, con):
    good = {r[0] for r in con.execute("SELECT doc_id FROM labels WHERE quality = 1").fetchall()}
    rows = [r for r in QUERIES["op10_quality"](spark, SF).collect() if r.doc_id in good and not r.base_failed]
    assert rows and all(r.kept for r in rows)


def test_quality_rejects_repetition_and_noise():
    rng = np.random.default_rng(1)
    noise = bytes(rng.integers(33, 127, 6000, np.uint8)).replace(b"<", b" ")
    assert not quality.in_band(6000, 1.1)
    rows = quality.assess_all([b"spam and eggs with ham " * 400, noise])
    assert [r[-1] for r in rows] == [False, False]


def test_pipeline_stages(spark, documents):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        rows = out.count()
        assert rows > 0, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns, name
        docs = out
    first = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, first, SF).select("doc_id").collect()}
    verdict = {r.doc_id for r in QUERIES["op10_quality"](spark, SF).where("kept").collect()}
    assert kept == verdict


def test_decontaminated_texts_hold_no_window(spark):
    import corpus_pipeline
    from rankflow.llm.decontaminate import contamination

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    before = contamination(docs, bench).where("contaminated").count()
    out = corpus_pipeline.decontamination(spark, docs, SF)
    assert before > 0
    assert contamination(out, bench).where("contaminated").count() == 0
    changed = {r.doc_id for r in contamination(docs, bench).where("contaminated").collect()}
    clean = {r.doc_id: r.text for r in out.collect()}
    for doc_id, text, _ in [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]:
        if doc_id not in changed:
            assert clean[doc_id] == text
