"""Shape, vocabulary-size, preview and null-count queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankflow.operators.cleaning import total_nulls
from rankflow.operators.features import fit_label_codes, fit_word_index
from rankflow.plans import catalog as C
from rankflow.plans.registry import query
from rankflow.schemas import move_last, require_columns
from rankflow.functions.text import TOKEN_FILTERS


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_TOK = ("list_filter(string_split(translate(lower(p_name), " + _lit(TOKEN_FILTERS) + ", "
        + _lit(" " * len(TOKEN_FILTERS)) + "), ' '), lambda x: x <> '')")


@query("vocab_sizes", f"""
SELECT (SELECT CAST(count(DISTINCT p_brand) AS BIGINT) FROM part) AS author_vocab,
       (SELECT CAST(count(DISTINCT p_type) + 1 AS BIGINT) FROM part) AS genre_vocab,
       (SELECT CAST(count(DISTINCT word) + 1 AS BIGINT) FROM (SELECT unnest({_TOK}) AS word FROM part))
         AS title_vocab,
       (SELECT CAST(count(DISTINCT p_size) AS BIGINT) FROM part) AS format_count""")
def vocab_sizes(spark, sf_dir):
    """Embedding input sizes: max code + 1, distinct + 1, vocabulary + 1,
    distinct count (A14 A17)."""
    p = C.table(spark, sf_dir, "part")
    author = fit_label_codes(p, "p_brand").agg((F.max("code") + 1).cast("long").alias("author_vocab"))
    genre = p.agg((F.countDistinct("p_type") + 1).cast("long").alias("genre_vocab"))
    title = fit_word_index(p, "p_name").agg((F.count(F.lit(1)) + 1).cast("long").alias("title_vocab"))
    fmt = p.select("p_size").distinct().agg(F.count(F.lit(1)).cast("long").alias("format_count"))
    return author.select(
        "author_vocab",
        genre.select("genre_vocab").scalar().alias("genre_vocab"),
        title.select("title_vocab").scalar().alias("title_vocab"),
        fmt.select("format_count").scalar().alias("format_count"))


@query("shape_columns", """
SELECT c_custkey AS key, CAST(c_nationkey AS VARCHAR) AS nation, c_mktsegment AS segment,
       c_custkey AS key_copy,
       CAST(('2024-01-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0')) AS TIMESTAMP) AS signup_ts,
       c_name AS name
FROM customer""")
def shape_columns(spark, sf_dir):
    """Column contract check, drop, positional rename, copy, casts, string
    to timestamp and moving a column last (P3 P4 P5 P7 P9 X14 X15)."""
    c = C.table(spark, sf_dir, "customer")
    require_columns(c, ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    c = c.drop("c_acctbal").toDF("key", "name", "nation", "segment")
    c = c.withColumn("key_copy", F.col("key"))
    c = c.withColumn("signup_ts", F.to_timestamp(F.concat(
        F.lit("2024-01-"), F.lpad((F.col("nation") + 1).cast("string"), 2, "0"))).cast("timestamp_ntz"))
    c = c.withColumn("nation", F.col("nation").cast("string"))
    return move_last(c, "name")


@query("preview_sorted", """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
ORDER BY s_nationkey, s_acctbal DESC, s_suppkey LIMIT 10""")
def preview_sorted(spark, sf_dir):
    """Multi-key sort and the first n rows (O1 O5 S15): a top-k, planned as
    TakeOrderedAndProject (no full sort)."""
    s = C.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    return s.orderBy("s_nationkey", F.col("s_acctbal").desc(), "s_suppkey").limit(10)


@query("null_total", """
SELECT CAST(sum((d.text IS NULL)::INT + (d.lang IS NULL)::INT + (l.quality IS NULL)::INT
                + (l.toxic IS NULL)::INT) AS BIGINT) AS total_nulls
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def null_total(spark, sf_dir):
    """Null cells over a whole table."""
    d = C.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    j = d.join(C.table(spark, sf_dir, "labels"), "doc_id", "left").select("text", "lang", "quality", "toxic")
    return total_nulls(j)
