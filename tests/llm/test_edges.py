"""Nulls, empty and long texts, ties, repeated rows, empty tables and extra
columns, for every operator; and each method against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankflow.llm import (bpe, chat, components, decontaminate, lines, mixing, neardup, quality,
                          recompress, repair, separators, warc)

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{k}" for k in range(400)]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


LONG = prose(99, 60_000)


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with every awkward case, and columns named like results."""
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, prose(3, 120), "en", "a", 1),
        (4, prose(3, 120), "en", "b", 1), (5, prose(5, 120), None, None, None), (5, prose(5, 120), None, None, None),
        (None, prose(3, 120), "en", "a", 1), (None, None, None, None, None), (7, "one two", "en", "c", 7),
        (8, "one two", "en", "c", 7), (9, LONG, "en", "a", 1), (10, "ha " * 300, "en", "b", 2),
        (11, " \t\n ", "en", "b", 2), (12, "x" * 9000, "en", "d", 3)]
    df = spark.createDataFrame(rows, DOC)
    return df.withColumn("kept", F.lit("mine")).withColumn("n_words", F.lit("clash")).withColumn("component_id", F.lit(-1))


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, prose(3, 30)), (1, prose(3, 30)), (2, None), (3, ""), (None, prose(5, 20)), (4, "one two")],
                                 "item_id long, text string")


def test_quality(odd, none):
    rows = quality.quality(odd).collect()
    assert len(rows) == 14 and quality.quality(none).count() == 0
    kept = quality.quality_filter(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 3, 4, 5, 5, 9]


def test_decontamination(spark, odd, none, bench):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(odd, empty).where("contaminated").count() == 0
    assert decontaminate.contamination(none, bench).count() == 0
    rows = {r.doc_id: r for r in decontaminate.contamination(odd, bench).collect()}
    assert rows[3].n_hit == 30 and rows[3].n_items == 1
    assert rows[5].n_hit == 20 and rows[5].n_items == 0  # the item has no id
    assert rows[7].n_hit == 2 and rows[1].n_words == 0
    out = decontaminate.decontaminate(odd, bench, chars_col="n_chars")
    got = {r.doc_id: r for r in out.collect()}
    assert out.columns == odd.columns and 7 not in got and got[9].text == LONG
    assert got[3].text == prose(3, 120).split(" ", 30)[30].join(["\n", ""]) and got[3].n_chars == len(got[3].text)
    assert decontaminate.decontaminate(none, bench).count() == 0


def brute_hits(words, items, window):
    hit, found = set(), set()
    for item, w in items:
        k = min(window, len(w))
        grams = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if k else set()
        for i in range(len(words) - k + 1):
            if k and tuple(words[i:i + k]) in grams:
                hit |= set(range(i, i + k))
                found.add(item)
    return hit, found


def test_automaton_against_brute_force():
    r = random.Random(4)
    for trial in range(150):
        alphabet = [b"a", b"b", b"c", b"d"][:r.randint(2, 4)]
        items = [(str(k), [r.choice(alphabet) for _ in range(r.randint(0, 9))]) for k in range(r.randint(0, 5))]
        window = r.randint(2, 5)
        a = decontaminate.Automaton(window).fit(items)
        words = [r.choice(alphabet + [b"z"]) for _ in range(r.randint(0, 40))]
        spans, found = a.scan(words)
        hit, expected = brute_hits(words, items, window)
        assert {p for s, e in spans for p in range(s, e)} == hit and found == expected


def test_several_automata_find_the_same(odd, bench, monkeypatch):
    one = decontaminate.contamination(odd, bench).collect()
    many = decontaminate.contamination(odd, bench, block_words=5).collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_near_duplicates(odd, none):
    rows = neardup.near_duplicates(odd).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == 14 and neardup.near_duplicates(none).count() == 0
    assert got[4].component_id == 3 and not got[4].kept and got[8].component_id == 7
    assert got[1].n_shingles == got[2].n_shingles == 0 and got[1].kept and got[2].kept and got[7].n_shingles == 1
    assert all(r.kept and r.component_id is None for r in rows if r.doc_id is None)
    left = neardup.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    assert sorted(r.doc_id or -1 for r in left.collect()) == [-1, -1, 1, 2, 3, 5, 7, 9, 10, 11, 12]


@pytest.mark.parametrize("nodes_per_block, stars", [(neardup.BLOCK_NODES, neardup.STARS), (5, 1)])
def test_near_duplicates_against_brute_force(spark, monkeypatch, nodes_per_block, stars):
    monkeypatch.setattr(neardup, "BLOCK_NODES", nodes_per_block)
    r = random.Random(8)
    rows = []
    for group in range(6):
        base = prose(group, 90).split()
        for _ in range(12):
            w = list(base)
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = r.choice(WORDS)
            rows.append((len(rows), " ".join(w)))
    sets = [{tuple(t.split()[i:i + 5]) for i in range(86)} for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), stars=stars).collect()}
    assert got == {k: find(k) for k in range(len(rows))}
    assert 6 < len(set(got.values())) < len(rows)


def test_common_counts_and_meetings_against_brute_force(monkeypatch):
    monkeypatch.setattr(neardup, "_COLUMNS", 64)
    r = np.random.default_rng(4)
    sets = [np.unique(r.integers(0, 400, r.integers(0, 150))).astype(np.uint64) for _ in range(30)]
    left = r.integers(0, 30, 200)
    right = (left + r.integers(1, 30, 200)) % 30  # pairs of different sets
    want = [len(np.intersect1d(sets[i], sets[j])) for i, j in zip(left, right)]
    assert neardup.common_counts(sets, left, right).tolist() == want
    assert neardup.common_counts(sets, left[:5], right[:5]).tolist() == want[:5]
    size = np.array([len(s) for s in sets])
    rows = sorted((v, k, len(s) - at) for k, s in enumerate(sets) for at, v in enumerate(s.tolist()))
    value, node, rest = (np.array(c) for c in zip(*rows))
    begin = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    label, block = np.arange(30) // 2, np.arange(30) % 2
    got = {(a, b) for i, j in neardup.meeting_pairs(node, rest, begin, size, label, block, 20) for a, b in zip(i.tolist(), j.tolist())}
    met = {(i, j) for i in range(30) for j in range(i + 1, 30) if label[i] != label[j] and block[i] != block[j]}
    linked = {(i, j) for i, j in met
              if 100 * len(np.intersect1d(sets[i], sets[j])) >= 20 * len(np.union1d(sets[i], sets[j])) > 0}
    assert linked and linked <= got <= met


def test_components_of_a_chain_and_of_nothing(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 90), (90, 90)], "a long, b long")
    got = {r.node: r.root for r in components.components(links).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 90: 90, 100: 90}
    assert components.components(links.limit(0)).count() == 0


def brute_removed(docs, window):
    first = {}
    for d, w in docs:
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            first[g] = min(first.get(g, d), d)
    out = {}
    for d, w in docs:
        gone = {i + j for i in range(len(w) - window + 1) if first[tuple(w[i:i + window])] < d for j in range(window)}
        out[d] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def test_substrings_against_brute_force(spark):
    r = random.Random(5)
    passage = prose(77, 60).split()
    docs = []
    for d in range(40):
        w = [r.choice(WORDS[:r.choice([3, 30, 400])]) for _ in range(r.randint(0, 150))]
        if r.random() < 0.5:
            at, a = r.randint(0, len(w)), r.randint(0, 40)
            w[at:at] = passage[a:a + r.randint(5, 40)]
        if r.random() < 0.3:
            at = r.randint(0, len(w))
            w[at:at] = ["ha"] * r.randint(1, 30)
        docs.append((d, w))
    docs.append((40, docs[3][1]))
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in recompress.substring_dedup(df).collect()}
    assert got == brute_removed(docs, 13)
    assert sum(v[1] for v in got.values()) > 0


def test_representatives_do_not_depend_on_what_surrounds_a_window():
    r = random.Random(6)
    for trial in range(60):
        core = [r.randrange(r.choice([2, 6, 50])) for _ in range(13)]
        seen = set()
        for _ in range(4):
            w = [r.randrange(6) for _ in range(r.randint(0, 9))]
            at = len(w)
            w += core + [r.randrange(6) for _ in range(r.randint(0, 9))]
            h = recompress.mixed(np.array(w, np.uint64) + np.uint64(1))
            starts, name = recompress.representatives(h, np.zeros(len(h), np.int64))
            seen.add(int(name[starts.tolist().index(at)]))
        assert len(seen) == 1


def test_substring_edges(odd, none):
    rows = recompress.substring_dedup(odd).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == 14 and recompress.substring_dedup(none).count() == 0
    assert got[4].n_removed == 120 and got[4].kept_text == "" and got[3].n_removed == 0 and got[5].n_removed == 0
    assert got[8].n_removed == 0 and got[1].n_words == 0 and got[10].n_removed == 0


def test_mix(odd, none):
    rows = mixing.mix(odd, leaf_rows=3, arity=2).collect()
    assert len(rows) == 14 and mixing.mix(none).count() == 0
    assert all(0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size for r in rows)
    by = {}
    for r in rows:
        by.setdefault((r.source_size, r.target), []).append(r)
    assert all(abs(sum(r.taken for r in v) - t) <= max(r.size for r in v) for (_, t), v in by.items())
    out = mixing.mixed_documents(odd)
    plan = mixing.mix(odd)
    assert out.columns == odd.columns and out.count() == plan.agg(F.sum("copies")).first()[0]


def test_mix_tree_of_many_levels(spark):
    rows = [(k, prose(k, 1 + k % 7), "s" if k % 3 else "t") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, weights=(1, 1), share=0.7, leaf_rows=5, arity=3).collect()
    assert len(got) == 400
    for source in ("s", "t"):
        mine = [r for r in got if rows[r.doc_id][2] == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 7


def test_tokens(odd, none):
    shards = repair.write_tokens(odd, shard=500)
    rows = repair.read_tokens(shards).orderBy("start").collect()
    assert shards.count() > 1 and len(rows) == 14
    assert [r.doc_id for r in rows] == [None, None, 1, 2, 3, 4, 5, 5, 7, 8, 9, 10, 11, 12]
    assert [r.start for r in rows] == list(np.cumsum([0] + [r.n_tokens for r in rows])[:-1])
    encode = bpe.Encoder(bpe.default_path(), "<u4")
    text = dict(odd.where("doc_id is not null").select("doc_id", "text").collect())
    for r in rows:
        if r.doc_id is not None:
            assert r.ids == np.frombuffer(encode([text[r.doc_id]])[0], "<u4").tolist() + [0]
    assert repair.read_tokens(repair.write_tokens(none)).count() == 0


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(3)
    for ids in (rng.integers(0, 50, 20_000), np.repeat(7, 5000), np.zeros(0), rng.integers(0, 50_000, 3000), np.array([5])):
        ids = ids.astype(np.uint32)
        shard = repair.Shard(repair.pack([1, None], [len(ids) // 2, len(ids) - len(ids) // 2], ids, 50_257, min_count=4))
        assert (shard.ids() == ids).all() and len(shard.ids()) == len(ids)
        for a in (0, 1, len(ids) // 3, len(ids)):
            for b in (0, 1, len(ids) // 2, len(ids)):
                assert shard.ids(a, b).tolist() == ids[a:b].tolist()
        assert np.concatenate([shard.document(0), shard.document(1)]).tolist() == ids.tolist()
    packed = repair.pack([1], [5000], np.tile(np.arange(10, dtype=np.uint32), 500), 50_257)
    assert len(packed) < 2000


def test_piecewise_encoding_equals_the_library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.default_path())
    t.encode_special_tokens = True
    encode, r = bpe.Encoder(bpe.default_path(), "<u2"), random.Random(0)
    parts = list("ab '!.,\n\t é9_😀\x1c ") + ["'s", "'re", " ", " ", "\n", "<|endoftext|>"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 16))) for _ in range(4000)]
    for text, got in zip(texts, encode(texts)):
        assert np.frombuffer(got, "<u2").tolist() == t.encode(text, add_special_tokens=False).ids


def test_separator_scan(spark, odd, none):
    files, dtype = separators.write_flat(odd)
    sizes = separators.with_length(files)
    whole = separators.count_tokens(sizes, dtype).collect()
    cut = separators.count_tokens(sizes, dtype, block=7).collect()
    assert sorted(map(str, whole)) == sorted(map(str, cut)) and len(whole) == 14
    assert separators.count_tokens(separators.with_length(separators.write_flat(none)[0])).count() == 0
    listed = separators.list_files(spark, files.first().path.rsplit("/", 1)[0])
    assert sorted(r.length for r in listed.collect()) == sorted(r.length for r in sizes.collect())


def test_separator_scan_of_an_unfinished_file(spark, tmp_path):
    ids = np.array([9, 9, 0, 0, 5, 5, 5], "<u2")
    (tmp_path / "a.ids").write_bytes(ids.tobytes())
    (tmp_path / "b.ids").write_bytes(b"")
    files = spark.createDataFrame([(str(tmp_path / "a.ids"), 14), (str(tmp_path / "b.ids"), 0)], "path string, length long")
    for block in (1, 2, 3, 100):
        rows = separators.count_tokens(files, separator=0, block=block).orderBy("doc_no").collect()
        assert [(r.doc_no, r.start, r.n_tokens, r.complete) for r in rows] == [(0, 0, 2, True), (1, 3, 0, True), (2, 4, 3, False)]


PAGE = "page_id long, url string, html string, record_type string"


def test_warc(spark):
    rows = [(1, "http://a.b/x", "<p>é</p>", None), (2, None, "<p>é</p>", None), (3, "http://a.b/\r\ny", None, None), (4, "u", "", "z"),
            (1, "http://a.b/x", "<p>é</p>", None), (None, "u", "<p>é</p>", None), (5, "u", "y" * 500_000, None)]
    index = warc.write_warc(spark.createDataFrame(rows, PAGE), file_bytes=400)
    got = warc.read_warc(index, segment=1000).collect()
    kind = {(r.page_id, r.record_type, r.refers_to) for r in got}
    assert len(got) == 7 and kind == {(1, "response", None), (2, "revisit", 1), (3, "response", None), (4, "revisit", 3),
                                      (None, "response", None), (5, "response", None)}
    assert {r.page_id: r.payload.decode() for r in got if r.payload is not None}[5] == "y" * 500_000
    some = warc.read_warc(index.where("page_id = 5")).collect()
    assert [r.payload_bytes for r in some] == [500_000]
    assert warc.read_warc(warc.write_warc(spark.createDataFrame([], PAGE))).count() == 0
    small = warc.write_warc(spark.createDataFrame(rows, PAGE), min_bytes=100)
    assert small.where("record_type = 'revisit'").count() == 0


def test_site_lines(spark):
    rows = [(k, "http://User@Site.Org:80/p", f"<p>menu</p><p>text {k}</p>\nfoot", "x") for k in range(12)]
    rows += [(20, None, "<p>menu</p>", "x"), (21, "nonsense", "a\n\n b ", "x"), (22, "http://one.org", "menu", "x"), (23, "http://one.org", None, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in lines.drop_site_lines(df).collect()}
    assert got[0].kept_text == "text 0" and got[0].host == "site.org" and (got[0].n_lines, got[0].n_dropped) == (3, 2)
    assert got[20].kept_text == "menu" and got[21].kept_text == "a\nb" and got[22].kept_text == "menu" and got[23].n_lines == 0
    assert lines.drop_site_lines(df.limit(0)).count() == 0


def test_site_lines_of_small_hosts(spark):
    rows = [(k, f"http://nine.org/{k}", f"menu\ntext {k}") for k in range(9)] + [(20, "http://two.org/a", "menu\na"), (21, "http://two.org/b", "menu\nb")]
    rows += [(30, "http://one.org/a", "menu\nmenu")]
    got = {r.page_id: r.kept_text for r in lines.drop_site_lines(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{k: f"text {k}" for k in range(9)}, 20: "a", 21: "b", 30: "menu\nmenu"}


def test_mixing_keeps_rows_that_differ_elsewhere(spark):
    rows = [(1, "en", "a b", "s", 0), (1, "fr", "a b", "s", 1), (1, "fr", "a b", "s", 1), (2, "en", "c", "s", 0), (None, "en", "c", "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, mix_copies string, text string, source string, mix_hash0 int")
    out = mixing.mixed_documents(df, share=2.0).collect()
    assert sorted(map(str, out)) == sorted(str(r) for r in df.collect() for _ in range(2))
    other = df.toDF("doc_id", "mix_key", "text", "source", "mix_copy")
    assert mixing.mixed_documents(other, share=2.0).columns == other.columns
    assert mixing.mixed_documents(other.limit(0)).count() == 0


def test_near_duplicates_with_any_column_names(spark):
    rows = [(1, "a b c d e f", 1, 2), (2, "a b c d e f", 3, 4), (3, "other words in this one here", 5, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept_id int, copy_no int")
    out = neardup.drop_near_duplicates(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 3]


def test_chat(spark):
    tricky = "a\\|b <|im_end|>\n<|im_start|>assistant \\ <\\| "
    rows = [(1, 0, "user", tricky, 0), (1, 1, "assistant", tricky, 0), (1, 1, "assistant", "", 0), (1, None, None, None, 0),
            (2, 5, "user", None, 0), (None, 0, "assistant", "x", 0), (1, 2, "a\nb <|", "t", 0), (1, 3, "assistant", "end", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, example long")
    turns = chat.format_turns(df)
    role, text = chat.parse(F.col("segment"))
    back = turns.withColumn("r", role).withColumn("t", text).orderBy("conv_id", "seq").collect()
    assert [(r.conv_id, r.seq, r.r, r.t) for r in back] == [
        (None, 0, "assistant", "x"), (1, 0, "", ""), (1, 1, "user", tricky), (1, 2, "assistant", ""), (1, 3, "assistant", tricky),
        (1, 4, "a\nb <|", "t"), (1, 5, "assistant", "end"), (2, 0, "user", "")]
    shots = chat.examples(turns)
    full = {(r.conv_id, r.example): r for r in chat.render(turns, shots).collect()}
    segment = {(r.conv_id, r.seq): r.segment for r in back}
    target = {(r.conv_id, r.example): r for r in shots.collect()}
    assert set(full) == set(target) == {(None, 0), (1, 2), (1, 3), (1, 5)}
    for (conv, k), r in full.items():
        assert r.text == "".join(segment[conv, j] for j in range(k + 1))
        assert r.text[r.loss_start:r.loss_end] == target[conv, k].target
        assert target[conv, k].context_chars == sum(len(segment[conv, j]) for j in range(k))
    assert chat.format_turns(df.limit(0)).count() == 0


def test_near_duplicates_of_an_id_with_two_texts(spark):
    """Each text keeps its links; the smallest true id names a component."""
    a = " ".join(f"w{k}" for k in range(60))
    b = " ".join(f"v{k}" for k in range(60))
    rows = [(5, a), (5, b), (7, a + " more"), (3, b + " other"), (8, a), (9, "alone it stands here today"), (None, a)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [
        (-1, -1, True), (3, 3, True), (5, 3, False), (5, 5, True), (7, 5, False), (8, 5, False), (9, 9, True)]


def test_quality_chunks_cover_the_whole_text():
    """No byte is left out; a short rest is part of the last chunk."""
    seen = []

    def pack(x):
        seen.append(len(x))
        return x

    for n, want in ((3, []), (4, [4]), (8, [8]), (11, [11]), (12, [8, 4]), (19, [8, 11]), (24, [8, 8, 8])):
        seen.clear()
        assert quality.assess(b"x" * n, np.zeros(1, np.uint64), pack, chunk=8)[7] == len(want)
        assert seen[1:] == want
