"""Readers for the reference's inputs, each with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.operators.history import RANK_MAP

PAYLOAD_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("body", T.StringType()),
])


def read_rank_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text scan over a glob of rank documents (one JSON object per line)
    with the source path of every line: ``(value, file_name)``."""
    df = spark.read.text(path)
    return df.select("value", F.col("_metadata.file_path").alias("file_name"))


def read_rank_documents_whole(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Multi-line documents: one whole file per row, parsed as a rank map;
    one rank that is no integer makes the whole map null."""
    df = spark.read.text(path, wholetext=True)
    return df.select(F.from_json("value", RANK_MAP).alias("ranks"),
                     F.col("_metadata.file_path").alias("file_name"))


def read_documents_variant(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Multi-line documents: one whole file per row as a VARIANT, with its
    path: ``(doc, file_name)``.  Keys are data, so nothing is inferred and no
    column is made for one; a file that is no JSON has a null document."""
    df = spark.read.text(path, wholetext=True)
    return df.select(F.try_parse_json("value").alias("doc"), F.col("_metadata.file_path").alias("file_name"))


def document_entries(docs: DataFrame, doc_col: str = "doc", value_type: str = "long") -> DataFrame:
    """One row per key of each document: the other columns, ``key`` and
    ``value``, null where it is not a ``value_type``.  Documents that are null
    or no object have no rows."""
    others = [c for c in docs.columns if c != doc_col]
    entries = docs.sparkSession.tvf.variant_explode(F.col(doc_col).outer())
    rows = docs.lateralJoin(entries).where(F.col("key").isNotNull())
    return rows.select(*others, "key", F.try_variant_get("value", "$", value_type).alias("value"))


def read_csv_strings(spark: SparkSession, path: str, header: bool = True,
                     encoding: str | None = None, columns: list[str] | None = None,
                     multi_line: bool = False) -> DataFrame:
    """CSV with a header where every column is a string (no inference).
    ``encoding`` e.g. ``ISO-8859-1`` for legacy exports.  A quote inside a
    quoted field is doubled.  ``multi_line`` allows line breaks inside quoted
    fields; such a file cannot be split, so it is off by default."""
    reader = (spark.read.option("header", header).option("inferSchema", False)
              .option("escape", '"').option("multiLine", multi_line))
    if encoding:
        reader = reader.option("encoding", encoding)
    if columns:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        reader = reader.schema(schema)
    return reader.csv(path)


def read_csv_skip_long_rows(spark: SparkSession, path: str, columns: list[str],
                            header: bool = True, multi_line: bool = False) -> DataFrame:
    """pandas ``on_bad_lines='skip'``: rows with *more* fields than the header
    are dropped, shorter rows are kept and padded with nulls.

    A line whose number of fields differs comes with its raw text; it is
    over-long when it has at least as many separators outside quotes as there
    are columns, whether or not the extra fields are empty.  Pruning is off in
    the parser, so the test does not depend on what a later projection keeps."""
    raw = "_rf_raw_line"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, raw]])
    df = (spark.read.option("header", header).option("mode", "PERMISSIVE").option("escape", '"')
          .option("multiLine", multi_line).option("columnPruning", False)
          .option("columnNameOfCorruptRecord", raw).schema(schema).csv(path))
    # a quote opens a field at its start only
    outside = F.regexp_replace(F.col(raw), r'(^|,)"(?:[^"]|"")*"(?=,|$)', "$1")
    separators = F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit("")))
    # a query must name a column of the file besides the raw line
    named = F.length(F.concat(F.coalesce(F.col(columns[0]), F.lit("")), F.lit("."))) > 0
    return df.where((F.col(raw).isNull() | (separators < len(columns))) & named).drop(raw)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Stored catalogue-lookup responses ``(title, status, body)``."""
    return spark.read.schema(PAYLOAD_SCHEMA).parquet(path)
