"""Ingest queries: daily fact, JSON rank maps, melt, ids from paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankflow.operators.history import explode_rank_map, item_id_from_path, melt, to_observations
from rankflow.plans import catalog as C
from rankflow.plans import sql as S
from rankflow.plans.registry import query

DAILY_SQL = S.with_(S.META, S.OBS, S.FACTS, S.DAILY) + "SELECT * FROM daily"


@query("daily_min_rank", DAILY_SQL)
def daily_min_rank(spark, sf_dir):
    """Observations x metadata -> dropna -> min rank per item-day."""
    return C.book_daily(spark, sf_dir)


def _event_documents(spark, sf_dir):
    """One rank document per event: ``{"<epoch>": rank, "<epoch+60>": k}``.
    Error events carry a non-integer rank, so their whole map parses to null."""
    ev = C.table(spark, sf_dir, "events")
    epoch = F.unix_timestamp("ts")
    rank = F.when(F.col("event_type") == "error", F.lit('"x"')).otherwise(
        C.cents("value").cast("string"))
    k = F.regexp_extract("props", r":\s*(\d+)", 1)
    text = F.concat(F.lit('{"'), epoch.cast("string"), F.lit('": '), rank,
                    F.lit(', "'), (epoch + 60).cast("string"), F.lit('": '), k, F.lit("}"))
    return ev.select(F.col("user_id").cast("string").alias("asin"), text.alias("value"))


_EVENT_DOCS_SQL = """
WITH e AS (
  SELECT CAST(user_id AS VARCHAR) AS asin, event_type,
         CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS ep,
         CAST(round(value * 100) AS BIGINT) AS rank,
         CAST(regexp_extract(props, ':\\s*(\\d+)', 1) AS BIGINT) AS k
  FROM events),
kv AS (
  SELECT asin, ep AS e, rank FROM e WHERE event_type <> 'error'
  UNION ALL
  SELECT asin, ep + 60 AS e, k AS rank FROM e WHERE event_type <> 'error'),
t AS (SELECT asin, make_timestamp(e * 1000000) AS t, rank FROM kv)
SELECT asin, strftime(t, '%Y-%m-%d %H:%M:%S') AS timestamp, rank,
       strftime(t, '%Y') AS year, strftime(t, '%m') AS month, strftime(t, '%d') AS date,
       strftime(t, '%A') AS day, strftime(t, '%H') AS hour
FROM t"""


@query("history_json_explode", _EVENT_DOCS_SQL)
def history_json_explode(spark, sf_dir):
    """JSON rank maps -> rows -> epoch text -> time string + calendar parts
    (X1 X2 X7-X13 P8)."""
    docs = _event_documents(spark, sf_dir)
    return to_observations(explode_rank_map(docs, "value", keep=("asin",)))


@query("roundtrip_json_history", _EVENT_DOCS_SQL)
def roundtrip_json_history(spark, sf_dir):
    """The file-based ingest: rank documents are written as text files, one
    folder per item, then scanned back as a glob with the source path of
    every line; the item id is taken from the path (S1 S7 S8 X1-X13)."""
    from rankflow.operators.history import observations_from_documents
    from rankflow.session import scratch_path
    from rankflow.sources.readers import read_rank_documents

    path = scratch_path(spark, "rank-docs")
    # one folder per item, one file per folder (cluster the rows by item first)
    docs_out = _event_documents(spark, sf_dir)
    # an explicit count: AQE would otherwise coalesce this small shuffle into a
    # couple of writer tasks that then create every folder
    writers = spark.sparkContext.defaultParallelism
    docs_out.repartition(writers, "asin").write.mode("overwrite").partitionBy("asin").text(path)
    docs = read_rank_documents(spark, f"{path}/*/*.txt")
    return observations_from_documents(docs, "value", "file_name", id_rule="folder")


@query("roundtrip_json_whole", """
SELECT event_type || '-' || strftime(ts, '%Y%m%d') AS doc, epoch_us(ts) AS key,
       min(CASE WHEN event_type <> 'error' THEN CAST(round(value * 100) AS BIGINT) END) AS rank
FROM events WHERE ts IS NOT NULL GROUP BY 1, 2""")
def roundtrip_json_whole(spark, sf_dir):
    """Multi-line documents, one per event type and day: written as files of
    one JSON object with a line per moment, read back whole as VARIANT and
    taken apart key by key; a rank that is no number is null (S2 X1 X2 X6)."""
    from rankflow.session import scratch_path
    from rankflow.sources.readers import document_entries, read_documents_variant

    ev = C.table(spark, sf_dir, "events").where("ts IS NOT NULL")
    doc = F.concat_ws("-", "event_type", F.date_format("ts", "yyyyMMdd")).alias("doc")
    moments = ev.groupBy("event_type", doc, F.unix_micros(F.col("ts").cast("timestamp")).alias("key")).agg(F.min(C.cents("value")).alias("rank"))
    line = F.concat(F.lit('  "'), F.col("key").cast("string"), F.lit('": '),
                    F.when(F.col("event_type") == "error", F.lit('"x"')).otherwise(F.col("rank").cast("string")))
    text = F.concat(F.lit("{\n"), F.array_join(F.collect_list(line), ",\n"), F.lit("\n}"))
    path = scratch_path(spark, "whole-docs")
    moments.groupBy("doc").agg(text.alias("value")).write.partitionBy("doc").text(path)
    docs = read_documents_variant(spark, f"{path}/*/*.txt")
    rows = document_entries(docs)
    return rows.select(F.regexp_extract("file_name", "/doc=([^/]+)/", 1).alias("doc"), F.col("key").cast("long").alias("key"),
                       F.col("value").alias("rank"))


_MELT_SQL = """
WITH counts AS (
  SELECT o_custkey, o_orderpriority AS priority, count(*) AS n_orders
  FROM orders GROUP BY 1, 2),
keys AS (SELECT DISTINCT o_custkey FROM orders),
cols AS (SELECT DISTINCT o_orderpriority AS priority FROM orders)
SELECT k.o_custkey, c.priority, n.n_orders
FROM keys k CROSS JOIN cols c
LEFT JOIN counts n ON n.o_custkey = k.o_custkey AND n.priority = c.priority"""


# The order priorities, which become the columns of the wide form.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("history_melt", _MELT_SQL)
def history_melt(spark, sf_dir):
    """Wide -> long with a row for every (key, column), null when absent (X3):
    order counts pivoted by priority, then melted back."""
    orders = C.table(spark, sf_dir, "orders")
    wide = orders.groupBy("o_custkey").pivot("o_orderpriority", PRIORITIES).count()
    return melt(wide, ["o_custkey"], key_name="priority", value_name="n_orders")


_PATH_SQL = """
SELECT page_id,
       string_split(url, '/')[-1] AS base_name,
       string_split(string_split(url, '/')[-1], '_')[1] AS id_prefix,
       regexp_extract(url || '_com_norm.json', '.*/([^/]+)_com_norm\\.json', 1) AS id_suffix,
       string_split(string_split(url, '/')[4], '_')[1] AS id_depth3
FROM pages"""


@query("item_id_from_path", _PATH_SQL)
def item_id_from_path_query(spark, sf_dir):
    """Split, element access and regex capture on source paths."""
    pages = C.table(spark, sf_dir, "pages")
    doc_path = F.concat(F.col("url"), F.lit("_com_norm.json"))
    return pages.select(
        "page_id",
        F.element_at(F.split("url", "/"), -1).alias("base_name"),
        item_id_from_path("url", "prefix").alias("id_prefix"),
        item_id_from_path(doc_path, "suffix").alias("id_suffix"),
        item_id_from_path("url", "depth3").alias("id_depth3"),
    )


@query("daily_partitioned_read", DAILY_SQL.replace("SELECT * FROM daily",
       "SELECT * FROM daily WHERE year = '2000' AND month IN ('01', '02')"))
def daily_partitioned_read(spark, sf_dir):
    """The batch job's output: the daily fact written as parquet partitioned
    by (year, month), then read with a filter that prunes whole partition
    folders (S9, partition pruning)."""
    from rankflow.session import scratch_path
    from rankflow.sources.sinks import write_parquet

    path = scratch_path(spark, "daily")
    write_parquet(C.book_daily(spark, sf_dir), path, partition_by=["year", "month"],
                  cluster_by=["asin", "timestamp"])
    back = (spark.read.option("basePath", path)
            .schema("asin string, timestamp string, rank bigint, date string, day string, "
                    "group_name string, format string, title string, author string, "
                    "publisher string, genre string, year string, month string")
            .parquet(path))
    return back.where((F.col("year") == "2000") & F.col("month").isin("01", "02")).select(
        "asin", "timestamp", "rank", "year", "month", "date", "day", "group_name", "format",
        "title", "author", "publisher", "genre")


@query("bucketed_item_facts", S.with_(S.META, S.OBS, S.FACTS) + """
SELECT asin, title, count(*) AS n_rows, min(rank) AS best_rank, max(rank) AS worst_rank, count(DISTINCT year) AS n_years
FROM facts GROUP BY 1, 2""")
def bucketed_item_facts(spark, sf_dir):
    """Observations and books stored in buckets of the item, then joined and
    aggregated per item without an exchange of either (S9 J1)."""
    from rankflow.operators.facts import join_metadata
    from rankflow.session import scratch_path
    from rankflow.sources.sinks import write_bucketed
    import uuid

    tag, buckets = uuid.uuid4().hex[:10], int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "buckets")
    obs = write_bucketed(C.book_observations(spark, sf_dir).select("asin", "timestamp", "rank", "year"), f"observations_{tag}",
                         "asin", buckets, f"{path}/observations", ["timestamp"])
    books = write_bucketed(C.book_metadata(spark, sf_dir).select("asin", "title"), f"books_{tag}", "asin", buckets, f"{path}/books")
    facts = join_metadata(obs, books)
    return facts.groupBy("asin", "title").agg(F.count(F.lit(1)).alias("n_rows"), F.min("rank").alias("best_rank"),
                                              F.max("rank").alias("worst_rank"), F.countDistinct("year").alias("n_years"))


@query("daily_reingest_month", S.with_(S.META, S.OBS, S.FACTS, S.DAILY) + """
SELECT asin, timestamp, CASE WHEN year = '2000' AND month = '02' THEN rank + 1 ELSE rank END AS rank, year, month, date, day
FROM daily""")
def daily_reingest_month(spark, sf_dir):
    """The stored daily fact, then a new batch for one month (every rank one
    higher): only that month's folder is replaced (S9, dynamic overwrite)."""
    from rankflow.session import scratch_path
    from rankflow.sources.sinks import replace_partitions, write_parquet

    path = scratch_path(spark, "daily")
    columns = ["asin", "timestamp", "rank", "year", "month", "date", "day"]
    write_parquet(C.book_daily(spark, sf_dir).select(*columns), path, partition_by=["year", "month"], cluster_by=["asin", "timestamp"])
    stored = spark.read.schema("asin string, timestamp string, rank bigint, date string, day string, year string, month string").parquet(path)
    month = stored.where("year = '2000' AND month = '02'").withColumn("rank", F.col("rank") + 1)
    # the batch is read in full before its folder is replaced
    from rankflow.session import materialize
    replace_partitions(materialize(month), path, ["year", "month"], ["asin", "timestamp"])
    return spark.read.schema(stored.schema).parquet(path).select(*columns)
