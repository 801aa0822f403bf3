"""A key holding a third of all rows: positional work stays balanced and
exact."""

import pandas as pd
from pyspark.sql import functions as F

from rankflow.operators.sequences import history_windows

SF = "/root/testdata/sf0.01"


def _skewed(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    asin = F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("user_id").cast("string"))
    return ev.select(asin.alias("asin"), "ts", "event_id", F.round(F.col("value") * 100).cast("long").alias("rank"))


def test_range_partitions_split_the_hot_key(spark):
    df = _skewed(spark)
    n = df.count()
    sizes = [r["count"] for r in df.repartitionByRange(8, "asin", "ts", "event_id")
             .groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == n and max(sizes) <= 2 * n / 8


def test_windows_on_hot_key_match_brute_force(spark):
    df = _skewed(spark)
    got = history_windows(df, ["ts", "event_id"], ["rank"], "rank", key="asin", length=10,
                          bucket_rows=700)
    spark_rows = {(r.asin, r.event_id): [h["rank"] for h in r.history] for r in
                  got.select("asin", "event_id", "history").collect()}
    pdf = df.toPandas().sort_values(["asin", "ts", "event_id"])
    expected = {}
    for asin, g in pdf.groupby("asin", sort=False):
        ranks, ids = g["rank"].tolist(), g["event_id"].tolist()
        for i in range(10, len(ranks)):
            expected[(asin, ids[i])] = ranks[i - 10:i]
    assert spark_rows == expected
    assert sum(1 for k in expected if k[0] == "hot") > 3000


def test_windows_over_partitions_shorter_than_the_history(spark):
    """Partitions of about three rows: a history of ten spans several."""
    rows = [("a" if i % 3 else None, i, float(i) if i % 7 else None) for i in range(60)] + [("b", i, 1.0) for i in range(11)]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    got = {(r.k, r.t): (r.target, [h.v for h in r.history])
           for r in history_windows(df, ["t"], ["v"], "v", key="k", length=10, bucket_rows=3).collect()}
    expected = {}
    for k in ("a", "b"):
        own = sorted((t, v) for kk, t, v in rows if kk == k)
        expected |= {(k, own[i][0]): (own[i][1], [v for _, v in own[i - 10:i]]) for i in range(10, len(own))}
    assert got == expected
    assert history_windows(df.limit(0), ["t"], ["v"], "v", key="k").count() == 0
    assert history_windows(df, ["t", "k"], ["v"], "v", length=71).count() == 0


def test_windows_need_one_exchange_of_the_rows(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS t", "id * 2 AS v")
    plan = history_windows(df, ["t"], ["v"], "v", key="k")._jdf.queryExecution().executedPlan().toString()
    # the rows are read from the sorted checkpoint; only edges and counts move
    assert "rangepartitioning" not in plan and "Window [collect_list" not in plan
    assert plan.index("MapInArrow") < plan.index("BroadcastHashJoin")
