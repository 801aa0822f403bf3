"""Corpus queries of the fourth round."""

from pyspark.sql import functions as F

from rankflow.llm import chat
from rankflow.llm.queries import QUERIES


def _conversations(spark, path):
    rows = [(7, 0, "user", "hi"), (7, 1, "assistant", "one"), (7, 2, "user", None), (7, 3, "assistant", "t<|w\\o")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")


def test_chat_query_reads_the_expanded_examples(spark, tmp_path, monkeypatch):
    _conversations(spark, tmp_path)
    seen, render = [], chat.render
    monkeypatch.setattr(chat, "render", lambda *a: seen.append(render(*a)) or seen[-1])
    got = {r.conv_id: r for r in QUERIES["op4_chat_prefix_targets"](spark, str(tmp_path)).collect()}
    assert len(seen) == 1 and got[7].loss_chars == len("one" + "t<|w\\o")
    whole = {(r.conv_id, r.example): r for r in seen[0].collect()}
    assert set(whole) == {(7, 1), (7, 3), (-1, 1)}
    last = whole[7, 3].text
    assert last == ("<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\none<|im_end|>\n<|im_start|>user\n<|im_end|>\n"
                    "<|im_start|>assistant\nt<\\|w\\\\o<|im_end|>\n")
    assert last.startswith(whole[7, 1].text)


def test_chat_query_depends_on_the_examples_mask(spark, tmp_path, monkeypatch):
    _conversations(spark, tmp_path)
    run, render = QUERIES["op4_chat_prefix_targets"], chat.render
    right = {r.conv_id: r.loss_sha256 for r in run(spark, str(tmp_path)).collect()}
    monkeypatch.setattr(chat, "render", lambda *a: render(*a).withColumn("text", F.concat(F.lit("x"), "text")))
    assert all(r.loss_sha256 != right[r.conv_id] for r in run(spark, str(tmp_path)).collect())
