"""Statistics, CSV, enrichment and the daily minimum outside the fixtures."""

import csv

import numpy as np
import pytest

from rankflow.operators.enrich import enrich_titles
from rankflow.operators.facts import daily_min_rank
from rankflow.operators.stats import anova, error_metrics, pearson, with_anova_p, with_pearson_p
from rankflow.operators.vectors import nearest_prototype
from rankflow.sources.readers import read_csv_skip_long_rows, read_csv_strings
from rankflow.sources.sinks import write_csv


def _f(groups):
    n, k = sum(map(len, groups)), len(groups)
    mean = np.concatenate(groups).mean()
    between = sum(len(g) * (g.mean() - mean) ** 2 for g in groups) / (k - 1)
    within = sum(((g - g.mean()) ** 2).sum() for g in groups) / (n - k)
    return between / within


def test_anova_far_from_zero(spark):
    rng = np.random.default_rng(2)
    groups = [np.round(rng.normal(m, 1, 2000), 4) for m in (0, 0.05, 0.1, 0.2)]
    rows = [(f"g{k}", float(x) + 1e9) for k, g in enumerate(groups) for x in g]
    got = anova(spark.createDataFrame(rows, "g string, v double"), "v", ["g"]).first()
    assert got.f_stat == pytest.approx(_f(groups), rel=1e-4)


def test_anova_without_variance_and_raw_f(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 2.0), ("b", 2.0)], "g string, v double")
    r = with_anova_p(anova(df, "v", ["g"], digits=None)).first()
    assert r.f_stat is None and r.p_value is None and r.status is None
    groups = [np.array([1.0, 1.001, 1.002]), np.array([3.0, 3.001, 3.0025])]
    df = spark.createDataFrame([(f"g{k}", float(x)) for k, g in enumerate(groups) for x in g], "g string, v double")
    assert with_anova_p(anova(df, "v", ["g"], digits=None)).first().f_stat == pytest.approx(_f(groups), abs=6e-4)


def test_perfect_and_undefined_correlation(spark):
    df = spark.createDataFrame([(float(k), 2.0 * k, 1.0) for k in range(5)], "a double, b double, c double")
    got = {r.column_name: r for r in with_pearson_p(pearson(df, "a", ["b", "c"])).collect()}
    assert got["b"].p_value == 0 and got["b"].status == "Correlation"
    assert got["c"].p_value is None and got["c"].status is None


def test_error_metrics_of_a_constant_and_of_nothing(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "a double, p double")
    r = error_metrics(df, "a", "p").first()
    assert r.r2 is None and r.mae == 1.0
    assert error_metrics(df.limit(0), "a", "p").first().mae is None


def test_csv_reads_like_pandas(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b,c\n1,"He said ""hi"", ok",x\n1,2,3,\n1,2,3,,\n4,5\n6,"7,8",9\n1,2,3,4\n')
    df = read_csv_skip_long_rows(spark, str(path), ["a", "b", "c"])
    expected = [("1", 'He said "hi", ok', "x"), ("4", "5", None), ("6", "7,8", "9")]
    assert sorted(map(tuple, df.collect())) == expected
    assert sorted(r.a for r in df.select("a").collect()) == ["1", "4", "6"]
    assert df.count() == 3


def test_csv_round_trip_with_quotes_commas_and_line_breaks(spark, tmp_path):
    rows = [("1", 'a "quoted" word', "x,y"), ("2", "two\nlines", None), ("3", "back\\slash", "plain")]
    out = str(tmp_path / "out")
    write_csv(spark.createDataFrame(rows, "id string, t string, u string"), out)
    back = read_csv_strings(spark, out, multi_line=True)
    assert sorted(map(tuple, back.collect())) == rows
    files = [list(csv.reader(p.open(newline=""))) for p in (tmp_path / "out").glob("part-*.csv")]
    assert sorted(r[1] for f in files for r in f[1:]) == sorted(r[1] for r in rows)


def test_one_row_per_book_with_several_responses(spark):
    body = '{"items":[{"volumeInfo":{"title":"T","authors":["%s"],"averageRating":"4"}}]}'
    pay = spark.createDataFrame([("T", 404, None), ("T", 200, body % "B"), ("T", 200, body % "A")],
                                "title string, status int, body string")
    got = enrich_titles(spark.createDataFrame([("T",), ("T",), ("U",)], "TITLE string"), pay).collect()
    assert len(got) == 3
    assert sorted(r.book_details.authors for r in got) == ["A", "A", "No Author"]


def test_daily_minimum_of_very_large_ranks(spark):
    obs = spark.createDataFrame([("i", "2020-01-02 03:04:05", 2 * 10**14), ("i", "2020-01-02 01:00:00", 2**63 - 1),
                                 ("j", "2020-01-02 01:00:00", -5)], "asin string, timestamp string, rank long")
    cols = ["group_name", "format", "title", "author", "publisher", "genre"]
    meta = spark.createDataFrame([(a, *"123456") for a in "ij"], ["asin", *cols])
    got = {r.asin: (r["rank"], r.timestamp) for r in daily_min_rank(obs, meta).collect()}
    assert got == {"i": (2 * 10**14, "2020-01-02 03:04:05"), "j": (-5, "2020-01-02 01:00:00")}


def test_prototypes_in_blocks_and_with_a_string_order(spark):
    rng = np.random.default_rng(0)
    protos = [(f"k{k:03d}", f"label{k}", [float(x) for x in rng.normal(size=4)]) for k in range(20)]
    protos.append(("k0005", "twin", protos[1][2]))  # ordered before k001
    p = spark.createDataFrame(protos, "ord string, name string, embedding array<double>")
    vecs = [[float(x) for x in rng.normal(size=4)] for _ in range(30)] + [protos[1][2]]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(vecs)], "id long, embedding array<double>")
    one = nearest_prototype(df, "embedding", p, "name", "ord").orderBy("id").collect()
    many = nearest_prototype(df, "embedding", p, "name", "ord", block_size=3).orderBy("id").collect()
    assert [(r.predicted_label, r.similarity) for r in one] == [(r.predicted_label, r.similarity) for r in many]
    assert one[-1].predicted_label == "twin"
    assert one[0].similarity is not None


@pytest.mark.parametrize("scale", [1e-8, 1.0, 1e33])
def test_anova_at_any_magnitude(spark, scale):
    rng = np.random.default_rng(3)
    groups = [rng.normal(m, 1, 500) * scale for m in (0, 0.2, 0.5)]
    rows = [(f"g{k}", float(x)) for k, g in enumerate(groups) for x in g]
    rows += [("g0", float("nan")), ("g1", float("inf")), ("g2", None), (None, 1.0)]
    r = anova(spark.createDataFrame(rows, "g string, v double"), "v", ["g"]).first()
    assert r.f_stat == pytest.approx(_f(groups), rel=1e-5) and r.n == 1500


def test_anova_computes_its_input_once(spark):
    df = spark.range(100).selectExpr("cast(id % 3 as string) AS g", "cast(id as double) AS v")
    plan = anova(df, "v", ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "Range (" not in plan and "Subquery" not in plan


def test_error_metrics_with_zero_mean_and_zero_maximum(spark):
    df = spark.createDataFrame([(-1.0, 0.0), (1.0, 0.0)], "a double, p double")
    r = error_metrics(df, "a", "p").first()
    assert r.mae_pct_mean is None and r.rmse_pct_mean is None and r.mae_pct_max == 100 and r.mse_pct_max_sq == 100
    r = error_metrics(spark.createDataFrame([(-1.0, 0.0), (0.0, 0.0)], "a double, p double"), "a", "p").first()
    assert r.mae_pct_max is None and r.mse_pct_max_sq is None and r.mae == 0.5
