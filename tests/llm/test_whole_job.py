"""Cases in which an operator once did less than its whole job."""

import base64
import random

import numpy as np

from rankflow.llm import bpe, neardup, quality, recompress, repair, separators
from rankflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"  # enough labelled documents


def test_quality_ratio_rejects_labelled_bad_documents_and_keeps_good_ones(spark):
    rows = {r.doc_id: r for r in QUERIES["op10_quality"](spark, SF).collect()}
    label = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect()
    good, bad = ([rows[d] for d, q in label if q == want and not rows[d].base_failed] for want in (1, 0))
    assert len(good) > 300 and all(r.kept for r in good)
    assert len(bad) > 20 and 2 * sum(r.kept for r in bad) < len(bad)


def test_quality_chunks_reject_encoded_data_within_a_text(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    text = max((r.text for r in docs.join(labels.where("quality = 1"), "doc_id").collect()), key=len).encode()
    data = base64.encodebytes(np.random.default_rng(2).bytes(len(text)))
    plain, mixed = (quality.assess_all([t], bands=())[0] for t in (text, text + b"\n" + data[:len(text)]))
    assert plain[-2] == 0 and plain[-1]
    assert not mixed[5] and 4 * mixed[-2] > mixed[-3] and not mixed[-1]


def test_near_duplicates_keep_rows_without_an_id_and_other_texts_of_an_id(spark):
    rows = [(None, f"text {k} without an id", "a") for k in range(5)] + [(None, None, "a"), (None, "text 0 without an id", "b")]
    rows += [(1, "the first text", "a"), (1, "another text under that id", "a"), (1, "the first text", "a"), (2, "alone", "b"), (2, "alone", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [sorted(map(str, neardup.drop_near_duplicates(df.repartition(n)).collect())) for n in (1, 3, 7)]
    assert got[0] == got[1] == got[2] and len(got[0]) == 10
    left = neardup.drop_near_duplicates(df).collect()
    assert sorted(str(r.text) for r in left if r.doc_id is None) == sorted(str(t) for d, t, _ in rows if d is None)
    assert sorted(r.text for r in left if r.doc_id == 1) == ["another text under that id", "the first text"]


def test_substrings_of_an_id_with_texts_of_different_length(spark):
    r = random.Random(11)
    prose = lambda n: [f"w{r.randrange(400)}" for _ in range(n)]
    passage, other, short = prose(40), prose(30), prose(20)
    rows = [(1, prose(50) + passage), (2, prose(5) + other), (3, short),
            (5, prose(300) + passage + prose(10) + short), (5, short[:6] + prose(14)), (5, prose(9) + other),
            (7, prose(25)), (8, passage), (5, passage), (2, prose(5) + other)]
    rows.append((9, rows[4][1] + prose(3)))  # begins with a whole text of id 5
    rows += [(6, rows[6][1]), (None, passage), (9, prose(4))]
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    first = {}
    for d, w in rows:
        for i in range(len(w) - 12):
            if d is not None:
                g = tuple(w[i:i + 13])
                first[g] = min(first.get(g, d), d)
    want = []
    for d, w in rows:
        gone = {i + j for i in range(len(w) - 12) if d is not None and first[tuple(w[i:i + 13])] < d for j in range(13)}
        want.append((d, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    for n in (1, 4):
        got = recompress.substring_dedup(df.repartition(n)).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_tokens_of_an_added_token_are_those_of_the_plain_call(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.default_path())
    texts = ["a<|endoftext|>b", "<|endoftext|>", "one two <|endoftext|> three\nfour<|endoftext|>", "a<|endoftext|", "<|endoftext|><|endoftext|>\n\nx", "plain text"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in repair.read_tokens(repair.write_tokens(df)).collect()}
    assert got == {k: t.encode(x, add_special_tokens=False).ids + [0] for k, x in enumerate(texts)}
    files, dtype = separators.write_flat(df)
    rows = separators.count_tokens(separators.with_length(files), dtype).collect()
    assert len(rows) == len(texts) and all(r.complete for r in rows)


def test_grammar_ends_only_when_no_pair_is_frequent():
    rng = np.random.default_rng(5)
    one = rng.integers(0, 50_000, 700)
    for ids in (np.tile(one, 900), rng.integers(0, 12, 60_000), np.repeat(7, 9000), np.tile([1, 2, 1], 5000)):
        left, right, length, seq = repair.compress(ids.astype(np.uint32), 50_257)
        shard = repair.Shard(repair.pack([1], [len(ids)], ids.astype(np.uint32), 50_257))
        assert (shard.ids() == ids).all() and len(left) == len(right) == len(length)
        pairs = np.unique(np.stack([seq[:-1], seq[1:]]), axis=1, return_counts=True)[1]
        assert pairs.max(initial=0) < repair.MIN_COUNT
