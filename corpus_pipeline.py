"""The corpus pipeline: quality rules, near-duplicates, decontamination,
mixing, token files.  ``STAGES`` lists (name, function); each function takes
``(spark, docs, sf_dir)`` and its result is written as Parquet and read again
as the next one's ``docs``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankflow.llm.common import written
from rankflow.llm.decontaminate import decontaminate
from rankflow.llm.mixing import mixed_documents
from rankflow.llm.neardup import drop_near_duplicates
from rankflow.llm.quality import quality_filter
from rankflow.llm.repair import read_tokens, write_tokens

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# encoded pieces that a worker keeps besides what the other stages hold
PIECES = 500_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_filter(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return drop_near_duplicates(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut; documents that are mostly benchmark text go."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate(docs.select(*COLUMNS), benchmark, chars_col="n_chars")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source weights take them."""
    return mixed_documents(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids written to compressed files and read back:
    one row per document with its place, length and checksum."""
    return read_tokens(write_tokens(docs.select(*COLUMNS), pieces=PIECES), keep_ids=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("tokens", tokens),
]

# compression, minimum hashes, hashed rounding and tokenisation are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
