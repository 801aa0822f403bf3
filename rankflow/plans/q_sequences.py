"""Sequence-window, first-value, de-duplication and prototype queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankflow.operators.features import encode_columns, first_per_key, fit_word_index, token_sequences
from rankflow.operators.sequences import attach_static, history_windows
from rankflow.operators.vectors import nearest_prototype
from rankflow.plans import catalog as C
from rankflow.plans import sql as S
from rankflow.plans.registry import query
from rankflow.functions.text import TOKEN_FILTERS


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _tok(c: str) -> str:
    return ("list_filter(string_split(translate(lower(" + c + "), " + _lit(TOKEN_FILTERS) + ", "
            + _lit(" " * len(TOKEN_FILTERS)) + "), ' '), lambda x: x <> '')")
from rankflow.session import materialize


def _digest(df, *extra):
    return df.select(*extra, F.col("target"),
                     F.array_join(F.transform("history", lambda s: s["event_id"].cast("string")), ",")
                     .alias("hist_ids"),
                     F.array_join(F.transform("history", lambda s: s["rank"].cast("string")), ",")
                     .alias("hist_ranks"))


_WIN = "ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING"


@query("sequence_windows", S.with_(S.EVENTS) + f"""
SELECT asin, event_id, target, array_to_string(h_ids, ',') AS hist_ids,
       array_to_string(h_r, ',') AS hist_ranks FROM (
  SELECT asin, event_id, rank AS target,
         row_number() OVER (PARTITION BY asin ORDER BY ts, event_id) AS rn,
         list(event_id) OVER (PARTITION BY asin ORDER BY ts, event_id {_WIN}) AS h_ids,
         list(rank) OVER (PARTITION BY asin ORDER BY ts, event_id {_WIN}) AS h_r
  FROM ev) WHERE rn > 10""")
def sequence_windows(spark, sf_dir):
    """Per-user length-10 histories and next-step targets, sum of
    max(n - 10, 0) samples (W1 W2 O3)."""
    ev = C.event_series(spark, sf_dir).select("asin", "event_id", "ts", "rank")
    w = history_windows(ev, ["ts", "event_id"], ["event_id", "rank"], "rank", key="asin")
    return _digest(w, "asin", "event_id")


@query("sequence_global", S.with_(S.EVENTS) + f"""
SELECT event_id, target, array_to_string(h_ids, ',') AS hist_ids,
       array_to_string(h_r, ',') AS hist_ranks FROM (
  SELECT event_id, rank AS target, row_number() OVER (ORDER BY ts, event_id) AS rn,
         list(event_id) OVER (ORDER BY ts, event_id {_WIN}) AS h_ids,
         list(rank) OVER (ORDER BY ts, event_id {_WIN}) AS h_r
  FROM ev) WHERE rn > 10""")
def sequence_global(spark, sf_dir):
    """Un-keyed length-10 histories over the whole time-ordered table:
    n - 10 samples, computed in bounded buckets (W3 D13)."""
    ev = C.event_series(spark, sf_dir).select("event_id", "ts", "rank")
    w = history_windows(ev, ["ts", "event_id"], ["event_id", "rank"], "rank")
    return _digest(w, "event_id")


_FIRST_TITLE_SQL = S.with_(S.META, S.OBS, S.FACTS, S.DAILY) + """
SELECT asin, title FROM (
  SELECT asin, title, row_number() OVER (PARTITION BY asin ORDER BY timestamp, title) AS rn FROM daily)
WHERE rn = 1"""


@query("first_title", _FIRST_TITLE_SQL)
def first_title(spark, sf_dir):
    """First title per item (earliest time, then title)."""
    d = C.book_daily(spark, sf_dir)
    return first_per_key(d, "asin", ["timestamp", "title"], ["title"])


@query("dedupe_first", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1""")
def dedupe_first(spark, sf_dir):
    """Keep the first row of each key in a declared order."""
    o = C.table(spark, sf_dir, "orders")
    return first_per_key(o, "o_custkey", ["o_orderdate", "o_orderkey"],
                         ["o_orderkey", "o_orderdate", "o_totalprice"])


_STATIC_SQL = S.with_(S.META, S.OBS, S.FACTS, S.DAILY).rstrip() + f""",
codes AS (SELECT asin,
  CAST(dense_rank() OVER (ORDER BY author) - 1 AS INTEGER) AS author_code,
  CAST(dense_rank() OVER (ORDER BY genre) - 1 AS INTEGER) AS genre_code,
  CAST(dense_rank() OVER (ORDER BY group_name) - 1 AS INTEGER) AS group_code
  FROM (SELECT DISTINCT asin, author, genre, group_name FROM daily)),
w AS (SELECT asin, timestamp, rank AS target,
         row_number() OVER (PARTITION BY asin ORDER BY timestamp) AS rn,
         list(rank) OVER (PARTITION BY asin ORDER BY timestamp {_WIN}) AS h_r FROM daily),
titles AS (SELECT asin, title FROM (SELECT asin, title, row_number() OVER (PARTITION BY asin
           ORDER BY timestamp, title) AS rn FROM daily) WHERE rn = 1),
vocab AS (SELECT word, row_number() OVER (ORDER BY n DESC, word) AS idx FROM (
          SELECT word, count(*) AS n FROM (SELECT unnest({_tok('title')}) AS word FROM titles)
          GROUP BY word)),
toks AS (SELECT asin, unnest({_tok('title')}) AS word,
                generate_subscripts({_tok('title')}, 1) AS pos FROM titles),
seq AS (SELECT t.asin, list(v.idx ORDER BY t.pos) AS s FROM toks t JOIN vocab v ON t.word = v.word
        GROUP BY t.asin),
fixed AS (SELECT titles.asin, coalesce(seq.s, []) AS s FROM titles LEFT JOIN seq ON titles.asin = seq.asin),
tseq AS (SELECT asin, array_to_string(list_concat(list_transform(range(0, greatest(10 - len(s), 0)),
         lambda i: 0), s[greatest(len(s) - 9, 1):]), ',') AS title_seq FROM fixed)
SELECT w.asin, w.timestamp, w.target, array_to_string(w.h_r, ',') AS hist_ranks,
       c.author_code, c.genre_code, c.group_code, coalesce(t.title_seq, '0,0,0,0,0,0,0,0,0,0') AS title_seq
FROM w JOIN codes c ON w.asin = c.asin LEFT JOIN tseq t ON w.asin = t.asin WHERE w.rn > 10"""


@query("sequence_static", _STATIC_SQL)
def sequence_static(spark, sf_dir):
    """Per-book daily histories with the book's static codes and its padded
    first-title token sequence attached, zeros when missing (W1 J7 A15 X24)."""
    d = materialize(C.book_daily(spark, sf_dir))
    w = history_windows(d, ["timestamp"], ["rank"], "rank", key="asin")
    static = d.select("asin", "author", "genre", "group_name").distinct()
    static, _ = encode_columns(static, ["author", "genre", "group_name"])
    static = static.withColumnRenamed("group_name_code", "group_code")
    titles = first_per_key(d, "asin", ["timestamp", "title"], ["title"])
    vocab = fit_word_index(titles, "title")
    seqs = token_sequences(titles, "asin", "title", vocab, 10)
    static = static.join(seqs, "asin", "left").select("asin", "author_code", "genre_code",
                                                     "group_code", "title_seq")
    out = attach_static(w, static, "asin", {"title_seq": 10})
    return out.select("asin", "timestamp", "target",
                      F.array_join(F.transform("history", lambda s: s["rank"].cast("string")), ",")
                      .alias("hist_ranks"),
                      F.col("author_code").cast("int"), F.col("genre_code").cast("int"),
                      F.col("group_code").cast("int"),
                      F.array_join("title_seq", ",").alias("title_seq"))


@query("nearest_prototype", """
WITH protos AS (SELECT label AS plabel, CAST(embedding AS DOUBLE[]) AS pe FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM embeddings) WHERE rn = 1),
e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT e.vec_id, e.label, p.plabel,
             list_inner_product(e.v, p.pe) / (sqrt(list_inner_product(e.v, e.v)) * sqrt(list_inner_product(p.pe, p.pe)))
               AS sim
      FROM e, protos p),
b AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, plabel) AS rn FROM s)
SELECT vec_id, label, plabel AS predicted_label, round(sim, 6) AS similarity FROM b WHERE rn = 1""")
def nearest_prototype_query(spark, sf_dir):
    """Each vector's nearest prototype by cosine, prototype = lowest id of
    each label, ties to the lower label (J5 X27 W9 M10)."""
    emb = C.table(spark, sf_dir, "embeddings")
    protos = first_per_key(emb, "label", ["vec_id"], ["embedding"])
    res = nearest_prototype(emb.select("vec_id", "label", "embedding"), "embedding", protos,
                            "label", "label")
    return res.select("vec_id", "label", "predicted_label", F.round("similarity", 6).alias("similarity"))
