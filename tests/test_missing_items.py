"""Smoothing by prefix sums, column profiles, the bucketed store, partition
replacement, prototypes, and rows that earlier readers got wrong."""

import math
import random

import pytest
from pyspark.sql import functions as F

from rankflow.operators.cleaning import profile
from rankflow.operators.enrich import enrich_titles
from rankflow.operators.features import first_token_index, token_sequences
from rankflow.operators.trends import prefix_sums, smooth_fraction
from rankflow.operators.vectors import nearest_prototype
from rankflow.sources.readers import read_csv_skip_long_rows
from rankflow.sources.sinks import replace_partitions, write_bucketed, write_parquet


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("fraction", [0.05, 0.9, 2.0])
def test_smoothing_over_a_fraction_of_all_rows(spark, fraction):
    rng = random.Random(1)
    rows = [(i, rng.randint(-50, 50) if i % 9 else None, rng.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "t int, a int, p double").repartition(5)
    half = max(1, math.floor(300 * fraction / 2))
    got = {r.t: r for r in smooth_fraction(df, ["t"], ["a", "p"], fraction).collect()}
    for i in range(300):
        part = rows[max(0, i - half):i + half + 1]
        a, p = [x[1] for x in part if x[1] is not None], [round(x[2], 6) for x in part]
        assert got[i].smoothed_a == pytest.approx(sum(a) / len(a), abs=1e-4)
        assert got[i].smoothed_p == pytest.approx(sum(p) / len(p), abs=1e-4) and got[i].pos == i
    assert smooth_fraction(df.limit(0), ["t"], ["a"]).count() == 0


def test_prefix_sums_carry_over_partitions(spark):
    df = spark.range(1000).select((F.lit(999) - F.col("id")).alias("t"), F.col("id").alias("v"))
    got = {r.t: (r.pos, int(r.v_sum), r.v_n, r.rows_all) for r in prefix_sums(df, ["t"], ["v"]).collect()}
    total, expected = 0, {}
    for t in range(1000):
        total += 999 - t
        expected[t] = (t, total, t + 1, 1000)
    assert got == expected


def test_profile_counts_distinct_values_without_shuffling_them(spark):
    rows = [(1, "x", 0.0, [1]), (2, "x", -0.0, [1]), (None, None, float("nan"), None), (1, "", float("nan"), [])]
    df = spark.createDataFrame(rows, "a int, b string, c double, d array<int>")
    got = {r.column_name: (r.n_distinct, r.n_non_null, r.n_null, r.n_rows) for r in profile(df).collect()}
    assert got == {"a": (2, 3, 1, 4), "b": (2, 3, 1, 4), "c": (2, 4, 0, 4), "d": (2, 3, 1, 4)}
    assert {r.n_rows for r in profile(df.limit(0)).collect()} == {0}
    plan = _plan(profile(df))
    keys = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "hashpartitioning(" in line]
    # by column number, or by number and the two hashes
    assert any(k.startswith("i#") and "a#" in k for k in keys) and all(k[:2] in ("i#", "k#") for k in keys)
    assert "Expand" not in plan


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    obs = spark.range(500).selectExpr("cast(id % 40 as string) AS asin", "cast(id as string) AS ts", "id AS rank")
    books = spark.range(40).selectExpr("cast(id as string) AS asin", "concat('t', id) AS title")
    a = write_bucketed(obs, "t_obs", "asin", 4, str(tmp_path / "obs"), ["ts"])
    b = write_bucketed(books, "t_books", "asin", 4, str(tmp_path / "books"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = a.join(b, "asin").groupBy("asin").agg(F.count(F.lit(1)).alias("n"))
        assert "Exchange" not in _plan(joined) and joined.count() == 40
        windows = a.selectExpr("asin", "lag(rank) OVER (PARTITION BY asin ORDER BY ts) AS before")
        assert "Exchange" not in _plan(windows) and windows.count() == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE t_obs")
        spark.sql("DROP TABLE t_books")


def test_only_the_months_of_the_batch_are_replaced(spark, tmp_path):
    path = tmp_path / "fact"
    df = spark.range(60).selectExpr("cast(id as string) AS asin", "id AS rank", "'2000' AS year", "lpad(cast(id % 3 + 1 as string), 2, '0') AS month")
    write_parquet(df, str(path), ["year", "month"], cluster_by=["asin"])
    before = {p: p.stat().st_mtime_ns for p in path.glob("year=*/month=0[13]/*.parquet")}
    replace_partitions(df.where("month = '02' AND rank < 10").withColumn("rank", F.col("rank") * -1), str(path), ["year", "month"], ["asin"])
    assert before and {p: p.stat().st_mtime_ns for p in path.glob("year=*/month=0[13]/*.parquet")} == before
    got = spark.read.parquet(str(path))
    assert got.where("month = 2").agg(F.max("rank"), F.count("*")).first()[:] == (-1, 3)
    assert got.where("month <> 2").count() == 40


def test_prototypes_plan_and_odd_vectors(spark):
    def run(n, rows, block=1024):
        protos = spark.createDataFrame([(k, f"l{k}", [float(k + 1), 1.0]) for k in range(n)], "o int, name string, embedding array<double>")
        df = spark.createDataFrame(rows, "id int, v array<double>")
        return nearest_prototype(df, "v", protos, "name", "o", block_size=block)

    rows = [(1, [1.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [1.0]), (6, [float("nan"), 1.0]), (7, [100.0, 1.0])]
    got = {r.id: (r.predicted_label, r.similarity) for r in run(50, rows, 7).collect()}
    assert got[1] == ("l0", pytest.approx(1.0)) and got[7][0] == "l49"
    assert all(got[k] == (None, None) for k in (2, 3, 4, 5, 6))
    assert {r.predicted_label for r in run(0, rows).collect()} == {None}
    few, many = _plan(run(2, rows)), _plan(run(300, rows, 3))
    assert len(few.splitlines()) == len(many.splitlines()) and "Exchange" not in many


def test_a_quote_inside_a_field_hides_no_separator(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b,c\n5" disk,a 7" disk,x,extra\n1,"two, ""quoted""",3\n4" nail,b,c\n"q,1",2,3,4\n')
    df = read_csv_skip_long_rows(spark, str(path), ["a", "b", "c"])
    assert sorted(map(tuple, df.collect())) == [("1", 'two, "quoted"', "3"), ('4" nail', "b", "c")]


def test_a_response_with_a_body_comes_before_one_without(spark):
    body = '{"items":[{"volumeInfo":{"title":"T","authors":["A"],"averageRating":"4"}}]}'
    pay = spark.createDataFrame([("T", 200, None), ("T", 200, body), ("T", 500, body)], "title string, status int, body string")
    got = enrich_titles(spark.createDataFrame([("T",)], "TITLE string"), pay).first()
    assert got.book_details.authors == "A"


def test_the_first_known_token_counts(spark):
    vocab = spark.createDataFrame([("war", 3, 1), ("peace", 2, 2)], "word string, n int, idx int")
    df = spark.createDataFrame([("The War",), ("peace war",), ("none",), (None,), ("The War",)], "title string")
    got = sorted((r.title or "", r.code) for r in first_token_index(df, "title", vocab, "code").collect())
    assert got == [("", 0), ("The War", 1), ("The War", 1), ("none", 0), ("peace war", 2)]


def test_target_maps_serve_unknown_values(spark, tmp_path):
    from rankflow.operators.features import apply_target_maps, target_maps
    from rankflow.sources.sinks import load_mapping, save_mapping
    rows = [("a", 10.0, 0), ("a", 20.0, 1), ("a", 30.0, 1), ("b", 100.0, 0), (None, 7.0, 2)]
    df = spark.createDataFrame(rows, "who string, y double, fold int")
    enc, maps = target_maps(df, ["who"], "y", "fold", n_folds=3)
    got = sorted((r.who or "", r.y, r.who_te) for r in enc.collect())
    mean = round(167 / 5, 4)
    # b occurs in one fold only; a null category has the mean of all rows
    assert got == [("", 7.0, mean), ("a", 10.0, 25.0), ("a", 20.0, 10.0), ("a", 30.0, 10.0), ("b", 100.0, mean)]
    save_mapping(maps, str(tmp_path / "m"))
    loaded = load_mapping(spark, str(tmp_path / "m"))
    asked = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "who string")
    served = {r.who: r.who_te for r in apply_target_maps(asked, loaded, ["who"]).collect()}
    assert served == {"a": 20.0, "b": 100.0, "z": mean, None: mean}


def test_target_encoded_rows_train_a_better_model_than_the_mean(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from rankflow.operators.features import apply_target_maps, target_maps
    rng = random.Random(6)
    rows = [(f"a{k % 12}", 100.0 * (k % 12) + rng.gauss(0, 40), k % 5) for k in range(1500)]
    train = spark.createDataFrame(rows[:1200], "who string, y double, fold int")
    test = spark.createDataFrame(rows[1200:], "who string, y double, fold int")
    enc, maps = target_maps(train, ["who"], "y", "fold")
    model = Pipeline(stages=[VectorAssembler(inputCols=["who_te"], outputCol="features"), LinearRegression(labelCol="y")]).fit(enc)
    r = model.transform(apply_target_maps(test, maps, ["who"])).agg(F.avg(F.pow(F.col("y") - F.col("prediction"), 2)), F.var_pop("y")).first()
    assert r[0] < 0.05 * r[1]


def test_csv_round_trip_keeps_edges_of_text(spark, tmp_path):
    from rankflow.sources.readers import read_csv_strings
    from rankflow.sources.sinks import write_csv
    rows = [("1", "  led and trailed \t"), ("2", '"'), ("3", ",\n\n,"), ("4", None), ("5", "a\\"), ("6", '\\"x"')]
    out = str(tmp_path / "o")
    write_csv(spark.createDataFrame(rows, "id string, t string"), out)
    assert sorted(map(tuple, read_csv_strings(spark, out, multi_line=True).collect())) == rows


def test_token_sequences_gather_the_last_tokens_only(spark):
    """Long texts, unknown words and texts without a known word; earlier
    tokens are cut on both sides of the shuffle."""
    r = random.Random(7)
    vocab = {f"w{k}": k + 1 for k in range(30)}
    texts = {k: " ".join(f"w{r.randrange(45)}" for _ in range(n)) for k, n in enumerate((0, 1, 9, 10, 11, 40, 6000))}
    texts[7], texts[8] = "nothing known here", None
    df = spark.createDataFrame(list(texts.items()), "id int, t string").repartition(3)
    words = spark.createDataFrame(list(vocab.items()), "word string, idx int")
    out = token_sequences(df, "id", "t", words, 10)
    for k, seq in ((x.id, x.title_seq) for x in out.collect()):
        known = [vocab[w] for w in (texts.pop(k) or "").split() if w in vocab][-10:]
        assert seq == [0] * (10 - len(known)) + known, k
    assert not texts
    assert "WindowGroupLimit" in _plan(out)
