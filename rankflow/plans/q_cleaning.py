"""Cleaning queries over documents, part and customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankflow.functions.text import MOJIBAKE_PATTERN, MOJIBAKE_PATTERN_ROW_SCAN, STRIP_PATTERN, mojibake
from rankflow.operators.cleaning import (any_column_matches, drop_literal_keys, drop_rows,
                                         flagged_union, profile, repair_all_strings, rows_matching,
                                         strip_all_strings)
from rankflow.plans import catalog as C
from rankflow.plans.registry import query


def _sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


@query("trim_strings", "SELECT p_partkey, p_name, p_brand, p_type FROM part")
def trim_strings(spark, sf_dir):
    """Strip every string column (X19) of part padded in-query with tabs,
    newlines, no-break and ideographic spaces; gives back the original."""
    p = C.table(spark, sf_dir, "part")
    padded = p.select(
        "p_partkey",
        F.concat(F.lit("\t "), "p_name", F.lit(" \n")).alias("p_name"),
        F.concat(F.lit(" "), "p_brand", F.lit("　 ")).alias("p_brand"),
        "p_type")
    return strip_all_strings(padded)


@query("trim_documents",
       f"SELECT doc_id, regexp_replace(text, {_sql_lit(STRIP_PATTERN)}, '', 'g') AS text FROM documents")
def trim_documents(spark, sf_dir):
    """Strip whole document texts."""
    d = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    return strip_all_strings(d)


# The driver's texts hold no mojibake: French documents get 'é' written as
# its two-character mojibake, identically in Spark and in the oracle.
_DOCS_SQL = ("(SELECT doc_id, lang, source, n_chars, CASE WHEN lang = 'fr' "
             "THEN replace(text, 'é', 'Ã©') ELSE text END AS text FROM documents)")


def _docs(spark, sf_dir):
    d = C.table(spark, sf_dir, "documents")
    text = F.when(F.col("lang") == "fr", F.replace("text", F.lit("é"), F.lit("Ã©"))).otherwise(
        F.col("text"))
    return d.select("doc_id", "lang", "source", "n_chars", text.alias("text"))


@query("regex_flag", f"SELECT doc_id, lang, source FROM {_DOCS_SQL} "
       f"WHERE coalesce(regexp_matches(text, {_sql_lit(MOJIBAKE_PATTERN)}), false)")
def regex_flag(spark, sf_dir):
    """Rows whose text contains a mojibake marker."""
    d = _docs(spark, sf_dir).select("doc_id", "lang", "source", "text")
    return rows_matching(d, "text", MOJIBAKE_PATTERN).drop("text")


_ANY = " OR ".join(f"coalesce(regexp_matches({c}, {_sql_lit(MOJIBAKE_PATTERN_ROW_SCAN)}), false)"
                   for c in ("text", "lang", "source"))


@query("regex_flag_any", f"SELECT doc_id FROM {_DOCS_SQL} WHERE {_ANY}")
def regex_flag_any(spark, sf_dir):
    """Rows where any string cell matches."""
    d = _docs(spark, sf_dir).select("doc_id", "text", "lang", "source")
    return d.where(any_column_matches(d, ["text", "lang", "source"],
                                      MOJIBAKE_PATTERN_ROW_SCAN)).select("doc_id")


@query("mojibake_repair", "SELECT doc_id, text, lang FROM documents")
def mojibake_repair(spark, sf_dir):
    """Every document corrupted in-query (UTF-8 read as Windows-1252), then
    every string cell repaired (X21 E2): the original text comes back."""
    d = C.table(spark, sf_dir, "documents")
    corrupted = d.select("doc_id", mojibake("text").alias("text"), mojibake("lang").alias("lang"))
    return repair_all_strings(corrupted)


_FLAG_COLS = ("text", "lang", "source")
_UNION_SQL = " UNION ALL ".join(
    f"SELECT doc_id, '{c}' AS flagged_by FROM {_DOCS_SQL} "
    f"WHERE coalesce(regexp_matches({c}, {_sql_lit(MOJIBAKE_PATTERN)}), false)" for c in _FLAG_COLS)


@query("flagged_union", _UNION_SQL)
def flagged_union_query(spark, sf_dir):
    """Bag union of rows flagged on each column."""
    d = _docs(spark, sf_dir).select("doc_id", *_FLAG_COLS)
    return flagged_union(d, list(_FLAG_COLS)).select("doc_id", "flagged_by")


@query("drop_flagged", "SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id NOT IN "
       f"(SELECT doc_id FROM ({_UNION_SQL}))")
def drop_flagged(spark, sf_dir):
    """Documents minus every flagged row, by row id."""
    d = _docs(spark, sf_dir)
    flagged = flagged_union(d, list(_FLAG_COLS))
    return drop_rows(d, flagged, "doc_id").drop("text")


_JUNK_KEY_SQL = """
WITH k AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 97 = 0 THEN 'M."' WHEN c_custkey % 89 = 0 THEN 'L"'
              WHEN c_custkey % 83 = 0 THEN NULL ELSE c_name END AS asin
  FROM customer)
SELECT c_custkey, asin FROM k WHERE asin IS NULL OR asin NOT IN ('M."', 'L"')"""


@query("drop_junk_keys", _JUNK_KEY_SQL)
def drop_junk_keys(spark, sf_dir):
    """Drop the literal junk keys but keep missing keys."""
    c = C.table(spark, sf_dir, "customer")
    key = (F.when(F.col("c_custkey") % 97 == 0, F.lit('M."'))
           .when(F.col("c_custkey") % 89 == 0, F.lit('L"'))
           .when(F.col("c_custkey") % 83 == 0, F.lit(None).cast("string"))
           .otherwise(F.col("c_name")))
    return drop_literal_keys(c.select("c_custkey", key.alias("asin")), "asin")


_PROFILE_COLS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
_PROFILE_SQL = "WITH j AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic " \
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)\n" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, count({c}) AS n_non_null, "
        f"count(*) - count({c}) AS n_null, count(*) AS n_rows FROM j" for c in _PROFILE_COLS)


@query("profile_columns", _PROFILE_SQL)
def profile_columns(spark, sf_dir):
    """Distinct / non-null / null counts per column and the row count
    (A9-A12) of documents left-joined to their labels."""
    d = C.table(spark, sf_dir, "documents")
    lab = C.table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id", "left").select(*_PROFILE_COLS)
    return profile(j)
