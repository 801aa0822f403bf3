"""Tail probabilities against closed forms."""

import math

import pytest
from pyspark.sql import functions as F

from rankflow.functions.distributions import f_pvalue, log_gamma, t_pvalue


def _t(spark, pairs):
    df = spark.createDataFrame([(k, float(t), float(d)) for k, (t, d) in enumerate(pairs)], "k int, t double, d double")
    return [r.p for r in df.select("k", t_pvalue(F.col("t"), F.col("d")).alias("p")).orderBy("k").collect()]


def _f(spark, rows):
    df = spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(rows)], "k int, f double, a double, b double")
    return [r.p for r in df.select("k", f_pvalue(F.col("f"), F.col("a"), F.col("b")).alias("p")).orderBy("k").collect()]


def test_t_one_and_two_degrees_of_freedom(spark):
    values = (0.1, 0.5, 1.0, 2.0, 7.5, 40.0)
    for t, p in zip(values, _t(spark, [(t, 1) for t in values])):
        assert math.isclose(p, 1 - 2 / math.pi * math.atan(t), rel_tol=1e-9)
    for t, p in zip(values, _t(spark, [(t, 2) for t in values])):
        assert math.isclose(p, 1 - t / math.sqrt(2 + t * t), rel_tol=1e-9)


def test_t_of_many_degrees_is_normal(spark):
    for t, p in zip((0.3, 1.96, 3.5), _t(spark, [(0.3, 1e7), (1.96, 1e7), (3.5, 1e7)])):
        assert math.isclose(p, math.erfc(t / math.sqrt(2)), rel_tol=1e-5)


def test_f_two_numerator_degrees(spark):
    cases = [(f, 2, d2) for f in (0.2, 1.0, 3.0, 12.0) for d2 in (3, 10, 57, 400, 600_000)]
    for (f, _, d2), p in zip(cases, _f(spark, cases)):
        assert math.isclose(p, (1 + 2 * f / d2) ** (-d2 / 2), rel_tol=1e-7)


def test_f_of_many_groups_swaps_its_tails(spark):
    # P(F(a, b) > f) + P(F(b, a) > 1 / f) = 1
    cases = [(0.98, 58_000, 1_600), (1.03, 300, 900_000), (2.5, 7, 3)]
    one, two = _f(spark, cases), _f(spark, [(1 / f, b, a) for f, a, b in cases])
    assert [p + q for p, q in zip(one, two)] == pytest.approx([1.0] * 3, abs=1e-8)


def test_log_gamma(spark):
    values = [0.5, 1.0, 1.5, 3.0, 10.25, 1e6]
    df = spark.createDataFrame([(v,) for v in values], "z double")
    got = [r[0] for r in df.select(log_gamma(F.col("z"))).collect()]
    assert got == pytest.approx([math.lgamma(v) for v in values], rel=1e-11, abs=1e-11)


def test_edges(spark):
    assert _t(spark, [(0.0, 10), (float("nan"), 10)]) == [1.0, None]
    assert _f(spark, [(1.0, 0, 5), (0.0, 3, 5)]) == [None, 1.0]
    plan = spark.range(1).select(t_pvalue(F.col("id"), F.lit(5.0)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
