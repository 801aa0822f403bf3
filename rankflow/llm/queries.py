"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm import (chat, decontaminate, gridjoin, lines, manifest, mixing, neardup, oracles, quality, recompress,
                          repair, runs, separators, warc)
from rankflow.llm.common import WORD, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_query("op1_repair_tokens")
def op1(spark, sf_dir):
    """Every text as token ids in compressed files, read back."""
    shards = repair.write_tokens(_table(spark, sf_dir, "documents"))
    return repair.read_tokens(shards, keep_ids=False)


@_query("op2_warc", oracles.WARC)
def op2(spark, sf_dir):
    """Every page written as a WARC record and read back."""
    index = warc.write_warc(_table(spark, sf_dir, "pages"))
    return warc.read_warc(index, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op3_decontaminate", oracles.DECONTAMINATE)
def op3(spark, sf_dir):
    """Hits of benchmark windows in every document."""
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("longest_span")


@_query("op4_chat_prefix_targets", oracles.CHAT)
def op4(spark, sf_dir):
    """All conversations formatted, exploded into examples, and read back."""
    table = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], table.schema)
    turns = written(chat.format_turns(table.unionByName(extra)), "chat-turns")
    # every example whole: the turns before its reply, the reply, the mask
    shots = written(chat.render(turns, chat.examples(turns)), "chat-examples")
    role, text = chat.parse(F.col("segment"))
    said = turns.select("conv_id", "seq", F.concat(role, F.lit("\n"), text, F.lit("\n")).alias("said"),
                        F.lit(None).cast("string").alias("reply"), F.char_length("segment").alias("size"))
    # what the mask covers of each example's text
    masked = F.substring("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    learnt = shots.select("conv_id", F.col("example").alias("seq"), F.lit(None).cast("string").alias("said"),
                          chat.unescape(masked).alias("reply"), F.lit(0).alias("size"))

    def joined(c):
        rows = F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("seq", c))))
        return F.array_join(F.transform(rows, lambda r: r[c]), "")

    both = said.unionByName(learnt).groupBy("conv_id").agg(
        F.count("said").alias("n_turns"), joined("said").alias("turns"), joined("reply").alias("replies"),
        F.sum("size").cast("long").alias("formatted_chars"))
    return both.select(
        "conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"),
        F.char_length("replies").cast("long").alias("loss_chars"), F.sha2("replies", 256).alias("loss_sha256"),
        "formatted_chars")


@_query("op5_near_duplicates", oracles.NEAR_DUPLICATES)
def op5(spark, sf_dir):
    """Components of near-duplicate documents."""
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


@_query("op6_substrings", oracles.SUBSTRINGS)
def op6(spark, sf_dir):
    """Repeated 13-word passages removed from every later document."""
    out = recompress.substring_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@_query("op7_site_lines", oracles.SITE_LINES)
def op7(spark, sf_dir):
    """Boilerplate lines of each site dropped from its pages."""
    out = lines.drop_site_lines(_table(spark, sf_dir, "pages"))
    return out.select("page_id", "host", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@_query("op8_token_counts")
def op8(spark, sf_dir):
    """Documents found in flat token files of all texts, with their lengths."""
    files, dtype = separators.write_flat(_table(spark, sf_dir, "documents"))
    found = separators.count_tokens(separators.with_length(files), dtype)
    return found.withColumn("path", F.regexp_extract("path", "part-[0-9]+", 0)).withColumnRenamed("path", "file")


@_query("op9_mix")
def op9(spark, sf_dir):
    """All documents mixed to source weights 3, 1, 2 at 150% of their size."""
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("copies")


@_query("op10_quality")
def op10(spark, sf_dir):
    """Counts, compression bands and verdict for every document."""
    return quality.quality(_table(spark, sf_dir, "documents"))


@_query("op11_near_vectors", oracles.NEAR_VECTORS)
def op11(spark, sf_dir):
    """Components of vectors of one label with a cosine of 0.93 or more."""
    return gridjoin.near_vectors(_table(spark, sf_dir, "embeddings"))


@_query("op12_manifest", oracles.MANIFEST)
def op12(spark, sf_dir):
    """Every document's place in a hash tree per language, its proof, and the
    root that the proof gives for a tampered row."""
    docs = _table(spark, sf_dir, "documents")

    def digest(text):
        return manifest.row_digest([*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text])

    text, name = F.col("text"), F.col("doc_id").cast("string")
    upper = "".join(map(chr, range(65, 91)))
    changed = F.when(F.crc32(name) % 3 == 0, digest(F.translate(text, upper, upper.lower()))).otherwise(digest(text))
    leaves = docs.select("doc_id", "lang", digest(text).alias("leaf"), changed.alias("changed"))
    proofs = manifest.proofs(manifest.build(leaves, "lang", ["doc_id"], "leaf", keys=["doc_id", "changed"]))
    folded = manifest.fold(F.col("changed"), F.col("proof"))
    return proofs.select("doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("proof")).alias("proof_sha256"),
                         folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


@_query("op13_runs")
def op13(spark, sf_dir):
    """Periodic runs of every document, after the contract's repeats have been
    written into one document in ten."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string"))
    words, g = F.col("words"), F.floor(h / 10).cast("long")
    n = F.size(words)
    a = F.col("a")
    p = F.lit(1) + F.floor((n - a) / (3 + g % 8)).cast("int")
    # words read once, from one document in ten
    planted = (docs.withColumn("words", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), 1)))
               .withColumn("a", F.when(n > 0, (g % n).cast("int"))).withColumn("p", p))
    copied = F.transform(F.sequence(F.lit(0), n - a - 1), lambda i: F.get(words, a + i % F.col("p")))
    text = F.when(a.isNotNull(), F.array_join(F.concat(F.slice(words, F.lit(1), a), copied), " ")).otherwise(F.col("text"))
    out = runs.periodic_runs(planted.select("doc_id", text.alias("text")))
    return out.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                      F.sha2("collapsed_text", 256).alias("collapsed_sha256"))
