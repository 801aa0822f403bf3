"""Feature queries: codes, lookups, cyclic time, scaling, one-hot, title
vocabulary, k-fold target encoding, splits, shapes and de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankflow.functions.calendar import cyclic_features, weekday_index
from rankflow.operators.features import (apply_minmax, encode_columns, first_token_index,
                                         fit_label_codes,
                                         fit_minmax, fit_word_index, hash_split,
                                         kfold_target_encode, lookup, one_hot, token_sequences)
from rankflow.operators.ordering import position_split
from rankflow.plans import catalog as C
from rankflow.plans import sql as S
from rankflow.plans.registry import query
from rankflow.functions.text import TOKEN_FILTERS


def _sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


@query("dictionary_lookup", """
WITH m AS (SELECT c_custkey, c_nationkey FROM customer WHERE c_acctbal > 0)
SELECT o.o_orderkey, o.o_custkey, CAST(coalesce(m.c_nationkey, -1) AS INTEGER) AS nation_code
FROM orders o LEFT JOIN m ON o.o_custkey = m.c_custkey""")
def dictionary_lookup(spark, sf_dir):
    """Many-to-one lookup with default -1 for unmapped keys."""
    orders = C.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = C.table(spark, sf_dir, "customer")
    mapping = cust.where(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").alias("value"), F.col("c_nationkey").alias("code"))
    return lookup(orders, "o_custkey", mapping, "nation_code").select(
        "o_orderkey", "o_custkey", F.col("nation_code").cast("int"))


_GROUP = "CASE WHEN p_size <= 25 THEN 'book' ELSE 'kindle' END"


@query("label_encode", f"""
SELECT p_partkey,
  CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS author_code,
  CAST(dense_rank() OVER (ORDER BY lower(p_type)) - 1 AS INTEGER) AS genre_code,
  CAST(dense_rank() OVER (ORDER BY {_GROUP}) - 1 AS INTEGER) AS group_code,
  CAST(dense_rank() OVER (ORDER BY CAST(p_size AS VARCHAR)) - 1 AS INTEGER) AS format_code
FROM part""")
def label_encode(spark, sf_dir):
    """Label codes fitted on the distinct values, then joined back."""
    meta = C.book_metadata(spark, sf_dir)
    out, _ = encode_columns(meta, ["author", "genre", "group_name", "format"])
    out = out.withColumnRenamed("group_name_code", "group_code")
    return out.select(F.col("asin").cast("long").alias("p_partkey"), "author_code", "genre_code",
                      "group_code", "format_code")


_CYC_SQL = """
WITH e AS (SELECT event_id, strftime(ts, '%A') AS day, CAST(strftime(ts, '%m') AS INTEGER) AS month,
                  CAST(strftime(ts, '%d') AS INTEGER) AS date FROM events),
f AS (SELECT *, CAST(list_position(['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday',
                 'Sunday'], day) - 1 AS INTEGER) AS day_index FROM e)
SELECT event_id, day, day_index,
  round(sin(2 * pi() * month / 12), 6) AS month_sin, round(cos(2 * pi() * month / 12), 6) AS month_cos,
  round(sin(2 * pi() * date / 31), 6) AS date_sin, round(cos(2 * pi() * date / 31), 6) AS date_cos,
  round(sin(2 * pi() * day_index / 7), 6) AS day_sin, round(cos(2 * pi() * day_index / 7), 6) AS day_cos
FROM f"""


@query("weekday_cyclic", _CYC_SQL)
def weekday_cyclic(spark, sf_dir):
    """Weekday name -> 0..6 (Monday = 0) and sin/cos of month, date and
    weekday (X17 X18)."""
    ev = C.table(spark, sf_dir, "events")
    base = ev.select("event_id", F.date_format("ts", "EEEE").alias("day"),
                     F.month("ts").alias("month"), F.dayofmonth("ts").alias("date"))
    base = base.withColumn("day_index", weekday_index("day"))
    feats = cyclic_features("month", "date", "day_index")
    return base.select("event_id", "day", "day_index",
                       *[F.round(v, 6).alias(k) for k, v in feats.items()])


@query("minmax_scale", """
WITH s AS (SELECT min(p_retailprice) AS lo_p, max(p_retailprice) AS hi_p,
                  min(p_size) AS lo_s, max(p_size) AS hi_s FROM part)
SELECT p_partkey,
  round(coalesce((p_retailprice - lo_p) / nullif(hi_p - lo_p, 0), 0), 6) AS p_retailprice,
  round(coalesce((p_size - lo_s) / nullif(hi_s - lo_s, 0), 0), 6) AS p_size,
  CAST(0.0 AS DOUBLE) AS constant
FROM part, s""")
def minmax_scale(spark, sf_dir):
    """Min-max scaling with the fitted minima / maxima; a constant column
    scales to 0 (A19 X26)."""
    p = C.table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size",
                                              F.lit(3.0).alias("constant"))
    cols = ["p_retailprice", "p_size", "constant"]
    return apply_minmax(p, fit_minmax(p, cols), cols, digits=6)


@query("one_hot", """
WITH c AS (SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS segment_code
           FROM customer),
k AS (SELECT count(DISTINCT c_mktsegment) AS n FROM customer)
SELECT c_custkey, segment_code,
  array_to_string(list_transform(range(0, n), lambda i: CASE WHEN i = segment_code THEN 1 ELSE 0 END), ',')
    AS one_hot
FROM c, k""")
def one_hot_query(spark, sf_dir):
    """One-hot vectors of the label-coded market segment."""
    cust = C.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    codes = fit_label_codes(cust, "c_mktsegment")
    coded = lookup(cust, "c_mktsegment", codes, "segment_code")
    size = int(codes.count())  # number of distinct segments: the vector length
    return coded.select("c_custkey", F.col("segment_code").cast("int"),
                        F.array_join(one_hot("segment_code", size), ",").alias("one_hot"))


_TOK_T = ("list_filter(string_split(translate(lower(@C@), " + _sql_lit(TOKEN_FILTERS) + ", "
          + _sql_lit(" " * len(TOKEN_FILTERS)) + "), ' '), lambda x: x <> '')")


def _tok(c: str) -> str:
    return _TOK_T.replace("@C@", c)


def _vocab_sql(table: str, col: str) -> str:
    return f"""vocab AS (
  SELECT word, n, CAST(row_number() OVER (ORDER BY n DESC, word) AS INTEGER) AS idx FROM (
    SELECT word, count(*) AS n FROM (SELECT unnest({_tok(col)}) AS word FROM {table})
    GROUP BY word))"""


@query("word_index", "WITH " + _vocab_sql("part", "p_name") + " SELECT word, n, idx FROM vocab")
def word_index(spark, sf_dir):
    """Title vocabulary: word counts, index 1 = most frequent."""
    return fit_word_index(C.table(spark, sf_dir, "part"), "p_name")


@query("word_index_documents", "WITH " + _vocab_sql("documents", "text") +
       " SELECT word, n, idx FROM vocab")
def word_index_documents(spark, sf_dir):
    """The same vocabulary fit over whole document texts."""
    return fit_word_index(C.table(spark, sf_dir, "documents"), "text")


@query("first_token", "WITH " + _vocab_sql("part", "p_name") + f"""
SELECT p.p_partkey, CAST(coalesce(v.idx, 0) AS INTEGER) AS title_code
FROM part p LEFT JOIN vocab v ON v.word = {_tok('p.p_name')}[1]""")
def first_token(spark, sf_dir):
    """Index of each title's first token, 0 for none."""
    p = C.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    vocab = fit_word_index(p, "p_name")
    return first_token_index(p, "p_name", vocab, "title_code").select(
        "p_partkey", F.col("title_code").cast("int"))


@query("title_sequence", "WITH " + _vocab_sql("part", "p_name") + f""",
toks AS (SELECT p_partkey, unnest({_tok('p_name')}) AS word,
                generate_subscripts({_tok('p_name')}, 1) AS pos FROM part),
seq AS (SELECT t.p_partkey, list(v.idx ORDER BY t.pos) AS s
        FROM toks t JOIN vocab v ON t.word = v.word GROUP BY t.p_partkey),
fixed AS (SELECT p.p_partkey, coalesce(seq.s, []) AS s FROM part p LEFT JOIN seq USING (p_partkey))
SELECT p_partkey, array_to_string(list_concat(list_transform(range(0, greatest(10 - len(s), 0)), lambda i: 0),
       s[greatest(len(s) - 9, 1):]), ',') AS title_seq
FROM fixed""")
def title_sequence(spark, sf_dir):
    """Title -> token indices, pre-truncated / pre-padded to 10."""
    p = C.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    vocab = fit_word_index(p, "p_name")
    seq = token_sequences(p, "p_partkey", "p_name", vocab, 10)
    return seq.select("p_partkey", F.array_join("title_seq", ",").alias("title_seq"))


_KFOLD_BASE = S.with_(S.EVENTS).rstrip() + """,
f AS (SELECT event_id, asin, rank, event_id % 5 AS fold FROM ev),
per AS (SELECT asin, fold, sum(CAST(rank AS DECIMAL(38,6))) AS s, count(rank) AS n FROM f GROUP BY 1, 2),
tot AS (SELECT asin, sum(s) AS s_all, sum(n) AS n_all FROM per GROUP BY 1),
comp AS (SELECT per.asin, per.fold,
                CASE WHEN n_all - n > 0 THEN CAST(s_all - s AS DOUBLE) / CAST(n_all - n AS DOUBLE) END AS oof
         FROM per JOIN tot USING (asin)),
g AS (SELECT CAST(sum(CAST(rank AS DECIMAL(38,6))) AS DOUBLE) / count(rank) AS gm FROM f)
"""


@query("kfold_target_encode", _KFOLD_BASE + """
SELECT f.event_id, f.asin, f.fold, round(coalesce(comp.oof, g.gm), 4) AS asin_te
FROM f LEFT JOIN comp ON f.asin = comp.asin AND f.fold = comp.fold, g""")
def kfold_target_encode_query(spark, sf_dir):
    """5-fold out-of-fold target mean per user, global-mean fallback
    (T4 A13 A21 J6); fold = event_id mod 5."""
    ev = C.event_series(spark, sf_dir).select("event_id", "asin", "rank").withColumn(
        "fold", F.col("event_id") % 5)
    enc, _ = kfold_target_encode(ev, "asin", "rank", "fold", "asin_te")
    return enc.select("event_id", "asin", "fold", "asin_te")


@query("kfold_mapping", _KFOLD_BASE + """
SELECT tot.asin, round(CAST(s_all AS DOUBLE) / n_all, 4) AS mean_all,
       round(coalesce(c.oof, CAST(s_all AS DOUBLE) / n_all), 4) AS mean_last_fold
FROM tot LEFT JOIN (SELECT * FROM comp WHERE fold = 4) c ON tot.asin = c.asin""")
def kfold_mapping(spark, sf_dir):
    """The saved target-encoding mapping: all-rows mean and the literal
    last-fold value (T4 D12)."""
    ev = C.event_series(spark, sf_dir).select("event_id", "asin", "rank").withColumn(
        "fold", F.col("event_id") % 5)
    _, mapping = kfold_target_encode(ev, "asin", "rank", "fold", "asin_te")
    return mapping


@query("position_split", """
SELECT o_orderkey, pos, CASE WHEN pos < floor(0.8 * n) THEN 'train' ELSE 'test' END AS split FROM (
  SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pos,
         count(*) OVER () AS n FROM orders)""")
def position_split_query(spark, sf_dir):
    """Sort by (date, key); first 80% of positions train."""
    o = C.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return position_split(o, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "pos", "split")


@query("hash_split", """
SELECT o_orderkey, CASE WHEN CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '42'), 1, 8))
                                  AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END AS split
FROM orders""")
def hash_split_query(spark, sf_dir):
    """Seeded 80/20 split that does not depend on partitioning (M2)."""
    o = C.table(spark, sf_dir, "orders").select("o_orderkey")
    return hash_split(o, "o_orderkey")
