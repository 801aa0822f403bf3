"""Source / sink round trips and the stored-response enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankflow.operators.enrich import enrich_titles, rated_only
from rankflow.plans import catalog as C
from rankflow.plans.registry import query
from rankflow.session import materialize, scratch_path
from rankflow.sources.readers import (read_csv_skip_long_rows, read_csv_strings, read_payloads)
from rankflow.sources.sinks import write_csv, write_parquet


@query("roundtrip_parquet", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment, CAST(c_nationkey AS INTEGER) AS c_nationkey FROM customer")
def roundtrip_parquet(spark, sf_dir):
    """Partitioned parquet sink, then scan back."""
    path = scratch_path(spark, "customer-parquet")
    write_parquet(C.table(spark, sf_dir, "customer"), path, partition_by=["c_nationkey"])
    back = spark.read.parquet(path)
    return back.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", F.col("c_nationkey").cast("int"))


_QUOTED = "'say \"' || coalesce(text, '-') || '\", ' || lang"


@query("roundtrip_csv", f"SELECT doc_id, md5(text) AS text_md5, md5({_QUOTED}) AS quoted_md5, lang FROM documents")
def roundtrip_csv(spark, sf_dir):
    """Whole document texts with their line breaks, and once more between
    quotes and a comma, exported as CSV with a header (one file per task),
    read back as all-string columns and typed again (S11 S3 S6)."""
    path = scratch_path(spark, "documents-csv")
    d = C.table(spark, sf_dir, "documents")
    quoted = F.concat(F.lit('say "'), F.coalesce("text", F.lit("-")), F.lit('", '), "lang")
    write_csv(d.select("doc_id", "text", quoted.alias("quoted"), "lang"), path)
    back = read_csv_strings(spark, path, multi_line=True)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("text_md5"),
                       F.md5("quoted").alias("quoted_md5"), "lang")


_LEGACY = "c_name || ' café, \"dit ' || c_mktsegment || '\"'"


@query("roundtrip_csv_latin1", f"SELECT CAST(c_custkey AS BIGINT) AS c_custkey, {_LEGACY} AS c_name, c_mktsegment FROM customer")
def roundtrip_csv_latin1(spark, sf_dir):
    """CSV with accents, quotes and commas written and read in ISO-8859-1."""
    path = scratch_path(spark, "customer-latin1")
    c = C.table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat("c_name", F.lit(' café, "dit '), "c_mktsegment", F.lit('"')).alias("c_name"), "c_mktsegment")
    write_csv(c, path, encoding="ISO-8859-1")
    back = read_csv_strings(spark, path, encoding="ISO-8859-1")
    return back.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "c_mktsegment")


_BAD_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer WHERE c_custkey % 11 <> 0"""


@query("csv_skip_bad_lines", _BAD_SQL)
def csv_skip_bad_lines(spark, sf_dir):
    """CSV with over-long lines (dropped) and short lines (kept, padded with
    null), whatever columns are selected afterwards (S4)."""
    c = C.table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    line = (F.when(F.col("c_custkey") % 11 == 0, F.concat_ws(",", key, "c_name", "c_mktsegment",
                                                            F.lit("EXTRA")))
            .when(F.col("c_custkey") % 13 == 0, F.concat_ws(",", key, "c_name"))
            .otherwise(F.concat_ws(",", key, "c_name", "c_mktsegment")))
    path = scratch_path(spark, "customer-bad-csv")
    c.select(line.alias("value")).write.mode("overwrite").text(path)
    return read_csv_skip_long_rows(spark, path, ["c_custkey", "c_name", "c_mktsegment"],
                                   header=False)


def _payloads(spark, sf_dir):
    """Stored lookup responses for every distinct part title (S14): some
    404s, some empty result lists, some items without authors, rating or
    title.  Written once to the shared folder and read back."""
    titles = C.table(spark, sf_dir, "part").select(F.col("p_name").alias("title")).distinct()
    n = F.length("title")
    info = F.struct(
        F.when(n % 6 != 0, F.upper("title")).alias("title"),
        F.when(n % 3 != 0, F.split("title", " ")).alias("authors"),
        F.when(n % 4 != 0, (n % 5 + 1).cast("string")).alias("averageRating"))
    items = F.when(n % 7 == 0, F.array().cast("array<struct<volumeInfo:struct<title:string,"
                                              "authors:array<string>,averageRating:string>>>")
                   ).otherwise(F.array(F.struct(info.alias("volumeInfo"))))
    body = F.to_json(F.struct(items.alias("items")), {"ignoreNullFields": "true"})
    status = F.when(n % 5 == 0, F.lit(404)).otherwise(F.lit(200))
    out = titles.select("title", status.alias("status"),
                        F.when(status == 200, body).alias("body"))
    path = scratch_path(spark, "payloads")
    out.write.mode("overwrite").parquet(path)
    return read_payloads(spark, path)


def _details(spark, sf_dir):
    books = C.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("asin"),
                                                  F.col("p_name").alias("TITLE"))
    enriched = materialize(enrich_titles(books, _payloads(spark, sf_dir), "TITLE"))
    return enriched.select("asin", F.col("TITLE").alias("input_title"), "book_details.title",
                           "book_details.authors", "book_details.ratings")


_DETAILS_SQL = """
WITH t AS (SELECT p_partkey AS asin, p_name AS input_title, length(p_name) AS n FROM part),
d AS (SELECT asin, input_title,
  CASE WHEN n % 5 = 0 OR n % 7 = 0 THEN input_title
       WHEN n % 6 = 0 THEN 'No Title' ELSE upper(input_title) END AS title,
  CASE WHEN n % 5 = 0 OR n % 7 = 0 OR n % 3 = 0 THEN 'No Author'
       ELSE array_to_string(string_split(input_title, ' '), ', ') END AS authors,
  CASE WHEN n % 5 = 0 OR n % 7 = 0 OR n % 4 = 0 THEN 'No Rating'
       ELSE CAST(n % 5 + 1 AS VARCHAR) END AS ratings
  FROM t)
"""


@query("rating_enrich", _DETAILS_SQL + "SELECT * FROM d")
def rating_enrich(spark, sf_dir):
    """Per-title lookup responses parsed into (title, authors, ratings) with
    defaults, joined back to every book (E1 X28 X29 P2)."""
    return _details(spark, sf_dir)


@query("rating_filter", _DETAILS_SQL + "SELECT * FROM d WHERE ratings IS NOT NULL AND ratings <> 'No Rating'")
def rating_filter(spark, sf_dir):
    """Keep rows with a real rating (F2)."""
    return rated_only(_details(spark, sf_dir))


@query("sql_view_filter", _DETAILS_SQL + "SELECT * FROM d WHERE ratings <> 'No Rating'")
def sql_view_filter(spark, sf_dir):
    """The same filter through a temp view and Spark SQL."""
    _details(spark, sf_dir).createOrReplaceTempView("books_details")
    return spark.sql("SELECT * FROM books_details WHERE ratings != 'No Rating'")
