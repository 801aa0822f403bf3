"""Statistics queries: Pearson with label codes, ANOVA both ways, error
metrics and the residual histogram."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankflow.operators.features import encode_columns
from rankflow.operators.stats import (anova, anova_by_target, error_metrics, histogram, pearson,
                                      with_anova_p, with_pearson_p)
from rankflow.plans import catalog as C
from rankflow.plans import sql as S
from rankflow.plans.registry import query
from rankflow.session import materialize

_D = S.with_(S.META, S.OBS, S.FACTS, S.DAILY)


def _sig(expr: str, digits: int = 6) -> str:
    return f"CAST(printf('%.{digits - 1}e', {expr}) AS DOUBLE)"


def _p_sql(f: str, d1: str, d2: str) -> str:
    """Upper tail of F by integration of its density: with x = sin^2, I_x(d2/2,
    d1/2) is the integral of sin^(d2-1) cos^(d1-1), taken by Simpson's rule
    where the integrand is not negligible."""
    lo, hi = "g.lo", "g.hi"
    height = ("exp((g.d2 - 1) * ln(greatest(sin(th), 1e-300)) + (g.d1 - 1) * ln(greatest(cos(th), 1e-300)) "
              "+ lgamma((g.d1 + g.d2) / 2) - lgamma(g.d1 / 2) - lgamma(g.d2 / 2))").replace("th", "TH")
    height = height.replace("TH", f"({lo} + i * ({hi} - {lo}) / 20000)")
    return f"""(SELECT greatest(least(2 * ({hi} - {lo}) / 60000 * list_sum(list_transform(range(0, 20001),
      lambda i: CASE WHEN i = 0 OR i = 20000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * {height})), 1), 0)
    FROM (SELECT greatest(least(th, peak) - 40 / sqrt(d1 + d2), 0) AS lo, least(th, peak + 40 / sqrt(d1 + d2)) AS hi, d1, d2
          FROM (SELECT CAST({d1} AS DOUBLE) AS d1, CAST({d2} AS DOUBLE) AS d2, atan2(sqrt({d2}), sqrt({d1} * ({f}))) AS th,
                       atan2(sqrt({d2} - 1), sqrt({d1} - 1)) AS peak)) g)"""


_TESTED_SQL = f""",
tested AS (SELECT *, {_p_sql('f_stat', 'df_between', 'df_within')} AS p FROM raw)
SELECT column_name, k, n, round(f_stat, 3) AS f_stat, df_between, df_within, round(p, 5) AS p_value,
       CASE WHEN round(p, 5) <= 0.05 THEN 'Columns correlated' ELSE 'Columns not correlated' END AS status
FROM tested"""


_CODE_COLS = ["title", "author", "publisher"]


def _coded_daily(spark, sf_dir):
    # read twice (code fit, correlation pass): computed once
    d = materialize(C.book_daily(spark, sf_dir))
    coded, _ = encode_columns(d, _CODE_COLS)
    return coded


_PEARSON_SQL = _D.rstrip() + ",\ncoded AS (SELECT rank, " + ", ".join(
    f"dense_rank() OVER (ORDER BY {c}) - 1 AS {c}_code" for c in _CODE_COLS) + " FROM daily)\n" + \
    " UNION ALL ".join(
        f"SELECT '{c}_code' AS column_name, {_sig(f'corr(CAST(rank AS DOUBLE), CAST({c}_code AS DOUBLE))')} AS r, "
        f"count(*) AS n, {_sig(f'corr(rank, {c}_code) * sqrt((count(*) - 2) / (1 - corr(rank, {c}_code) ** 2))')}"
        " AS t_stat FROM coded" for c in _CODE_COLS)


@query("pearson_codes", _PEARSON_SQL)
def pearson_codes(spark, sf_dir):
    """Pearson r (and t) between rank and the label codes of title, author
    and publisher (T1 W4 D19)."""
    res = pearson(_coded_daily(spark, sf_dir), "rank", [f"{c}_code" for c in _CODE_COLS])
    from rankflow.operators.stats import sig_round
    return res.select("column_name", sig_round(F.col("r")).alias("r"), "n",
                      sig_round(F.col("t_stat")).alias("t_stat"))


def _pearson_test_sql() -> str:
    r = "SELECT column_name, count(*) AS n, corr(CAST(rank AS DOUBLE), CAST(code AS DOUBLE)) AS r FROM long GROUP BY 1"
    long = " UNION ALL ".join(f"SELECT '{c}_code' AS column_name, rank, dense_rank() OVER (ORDER BY {c}) - 1 AS code FROM daily"
                              for c in _CODE_COLS)
    return _D.rstrip() + f""",
long AS ({long}), r AS ({r}),
p AS (SELECT *, {_p_sql('r * r * (n - 2) / (1 - r * r)', '1', '(n - 2)')} AS p FROM r)
SELECT column_name, round(r, 4) AS r, round(p, 5) AS p_value,
       CASE WHEN p < 0.05 THEN 'Correlation' ELSE 'No Correlation' END AS status FROM p"""


@query("pearson_test", _pearson_test_sql())
def pearson_test(spark, sf_dir):
    """Pearson with the two-sided p-value and the notebook's wording (T1 X31
    X32)."""
    res = pearson(_coded_daily(spark, sf_dir), "rank", [f"{c}_code" for c in _CODE_COLS])
    return with_pearson_p(res).select("column_name", F.round("r", 4).alias("r"),
                                      F.round("p_value", 5).alias("p_value"), "status")


def _anova_sql(source: str, tests: list[tuple[str, str, str]], tested: bool = False) -> str:
    """CTEs and SELECT of the test; ``tested`` adds p and the wording."""
    unions = " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, CAST({g} AS VARCHAR) AS grp, "
        f"CAST({v} AS DECIMAL(38,6)) AS v FROM {source}" for name, v, g in tests)
    return f""",
x AS ({unions}),
per AS (SELECT column_name, grp, count(v) AS n, sum(v) AS s, sum(v * v) AS ss FROM x
        WHERE v IS NOT NULL AND grp IS NOT NULL GROUP BY 1, 2),
col AS (SELECT column_name, count(*) AS k, sum(n) AS n_total, sum(s) AS s_total, sum(ss) AS ss_total,
               sum(CAST(s AS DOUBLE) * CAST(s AS DOUBLE) / n) AS between_raw FROM per GROUP BY 1),
raw AS (SELECT column_name, CAST(k AS BIGINT) AS k, CAST(n_total AS BIGINT) AS n,
  ((between_raw - CAST(s_total AS DOUBLE) * CAST(s_total AS DOUBLE) / n_total) / (k - 1)) /
    ((CAST(ss_total AS DOUBLE) - between_raw) / (n_total - k)) AS f_stat,
  CAST(k - 1 AS BIGINT) AS df_between, CAST(n_total - k AS BIGINT) AS df_within
FROM col WHERE k > 1)""" + (_TESTED_SQL if tested else f"""
SELECT column_name, k, n, {_sig("f_stat")} AS f_stat, df_between, df_within FROM raw""")


_CAT = ["group_name", "format", "genre"]


@query("anova_by_category", _D.rstrip() + _anova_sql("daily", [(c, "rank", c) for c in _CAT]))
def anova_by_category(spark, sf_dir):
    """One-way ANOVA of rank by group, format and genre (T2); one shuffle
    for all three."""
    return anova(C.book_daily(spark, sf_dir), "rank", _CAT)


@query("anova_events", S.with_(S.EVENTS).rstrip() + _anova_sql("ev", [("event_type", "rank", "event_type")]))
def anova_events(spark, sf_dir):
    """ANOVA of event value by event type."""
    return anova(C.event_series(spark, sf_dir), "rank", ["event_type"])


@query("anova_test", _D.rstrip() + _anova_sql("daily", [(c, "rank", c) for c in _CAT], tested=True))
def anova_test(spark, sf_dir):
    """ANOVA with F rounded to 3, p to 5 digits and the notebook's status
    wording (T2 X31 X32)."""
    return with_anova_p(anova(C.book_daily(spark, sf_dir), "rank", _CAT, digits=None))


_NUM = ["year", "month"]


_NUM_SQL = _D.rstrip() + (",\nnum AS (SELECT CAST(year AS INTEGER) AS year, "
                          "CAST(month AS INTEGER) AS month, rank FROM daily)")


@query("anova_by_target", _NUM_SQL + _anova_sql("num", [(c, c, "rank") for c in _NUM]))
def anova_by_target_query(spark, sf_dir):
    """Reverse ANOVA: year and month grouped by rank value."""
    d = C.book_daily(spark, sf_dir).select(F.col("year").cast("int").alias("year"),
                                           F.col("month").cast("int").alias("month"), "rank")
    return anova_by_target(d, "rank", _NUM)


@query("anova_by_target_test", _NUM_SQL + _anova_sql("num", [(c, c, "rank") for c in _NUM], tested=True))
def anova_by_target_test(spark, sf_dir):
    """Reverse ANOVA with rounded F, p and status wording."""
    d = C.book_daily(spark, sf_dir).select(F.col("year").cast("int").alias("year"),
                                           F.col("month").cast("int").alias("month"), "rank")
    return with_anova_p(anova_by_target(d, "rank", _NUM, digits=None))


# values far from zero: the same test on prices moved up by a thousand million
_FAR_SQL = "WITH far AS (SELECT o_totalprice + 1000000000 AS v, o_orderpriority AS g, o_totalprice AS v0 FROM orders)" + \
    _anova_sql("far", [("v", "v0", "g")])


@query("anova_offset", _FAR_SQL)
def anova_offset(spark, sf_dir):
    """ANOVA of order prices with a large offset: F does not depend on it."""
    o = C.table(spark, sf_dir, "orders").select(
        (F.col("o_totalprice") + F.lit(1_000_000_000)).alias("v"), F.col("o_orderpriority").alias("g"))
    return anova(o, "v", ["g"]).withColumn("column_name", F.lit("v"))


def _order_predictions(spark, sf_dir):
    """actual = order price, predicted = mean price of the customer's orders."""
    o = C.table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    # the mean is an exact decimal sum divided by the count; no rounding
    cm = o.groupBy("o_custkey").agg(
        (F.sum(F.col("o_totalprice").cast("decimal(38,6)")).cast("double")
         / F.count("o_totalprice")).alias("predicted"))
    return o.join(cm, "o_custkey").select(F.col("o_totalprice").alias("actual"), "predicted")


_PRED_SQL = """
WITH cm AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(38,6))) AS DOUBLE) / count(o_totalprice)
                   AS predicted FROM orders GROUP BY 1),
p AS (SELECT o.o_totalprice AS actual, cm.predicted FROM orders o JOIN cm ON o.o_custkey = cm.o_custkey),
r AS (SELECT actual, predicted, actual - predicted AS e FROM p)
"""


@query("error_metrics", _PRED_SQL + f"""
SELECT count(e) AS n, {_sig('avg(abs(e))')} AS mae, {_sig('avg(e * e)')} AS mse,
  {_sig('sqrt(avg(e * e))')} AS rmse, {_sig('1 - avg(e * e) / var_pop(actual)')} AS r2,
  {_sig('avg(abs(e)) / avg(actual) * 100')} AS mae_pct_mean,
  {_sig('sqrt(avg(e * e)) / avg(actual) * 100')} AS rmse_pct_mean,
  {_sig('avg(abs(e)) / max(actual) * 100')} AS mae_pct_max,
  {_sig('avg(e * e) / (max(actual) * max(actual)) * 100')} AS mse_pct_max_sq,
  {_sig('(1 - avg(e * e) / var_pop(actual)) * 100')} AS r2_pct,
  {_sig('min(actual)')} AS min_actual, {_sig('max(actual)')} AS max_actual
FROM r""")
def error_metrics_query(spark, sf_dir):
    """MAE / MSE / RMSE / R^2 and percentage forms of a predictor (T5 T6
    X33 A13 A23 A24)."""
    return error_metrics(_order_predictions(spark, sf_dir), "actual", "predicted")


@query("error_histogram", _PRED_SQL + f""",
mm AS (SELECT min(e) AS lo, max(e) AS hi FROM r),
b AS (SELECT CAST(least(floor((e - lo) / ((hi - lo) / 30.0)), 29) AS INTEGER) AS bin, lo, hi FROM r, mm)
SELECT bin, count(*) AS n, {_sig('lo + bin * ((hi - lo) / 30.0)')} AS bin_start
FROM b GROUP BY bin, lo, hi""")
def error_histogram(spark, sf_dir):
    """30 equal-width bins of the residuals, maximum in the last bin."""
    r = _order_predictions(spark, sf_dir).withColumn("e", F.col("actual") - F.col("predicted"))
    return histogram(r, "e", 30)
