"""Statistics over the fact table: Pearson correlation with label codes,
one-way ANOVA (both directions), regression error metrics and an
equal-width residual histogram.

Every test is one Spark aggregation producing a row per tested column; the
tail probabilities are column expressions over those few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.functions.distributions import f_pvalue, t_pvalue
from rankflow.session import materialize

# rows that one task groups when the groups are many
GROUP_ROWS = 500_000

# Significance wording and thresholds of the analysis notebook.
PEARSON_YES, PEARSON_NO = "Correlation", "No Correlation"        # p < 0.05
ANOVA_YES, ANOVA_NO = "Columns correlated", "Columns not correlated"  # p <= 0.05
ALPHA = 0.05


def sig_round(c: Column, digits: int = 6) -> Column:
    """Round to ``digits`` significant digits (text round trip, so the
    result does not depend on the magnitude).  A null stays null."""
    return F.when(c.isNotNull(), F.format_string(f"%.{digits - 1}e", c).cast("double"))


def pearson(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """r between ``target`` and each numeric column, in one aggregation;
    n counts rows where both are present; t = r sqrt((n-2)/(1-r^2))."""
    aggs = []
    for i, c in enumerate(columns):
        both = F.col(target).isNotNull() & F.col(c).isNotNull()
        x, y = (F.when(both, F.col(k).cast("double")) for k in (target, c))
        # a constant column has no correlation (the built-in would raise)
        r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
        aggs += [F.when(r.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(-1.0), r))).alias(f"_r{i}"),
                 F.count(F.when(both, 1)).alias(f"_n{i}")]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_r{i}").alias("r"),
                                        F.col(f"_n{i}").alias("n"))
                               for i, c in enumerate(columns)]))
    res = one.select(rows.alias("e")).select("e.*")
    t = F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, 1 - F.col("r") * F.col("r")))
    return res.withColumn("t_stat", t)


def with_pearson_p(res: DataFrame) -> DataFrame:
    """p and the wording; a perfect correlation has p = 0, and where p cannot
    be computed (fewer than three rows, a constant column) both are null."""
    p = t_pvalue(F.col("t_stat"), (F.col("n") - 2).cast("double"))
    perfect = (F.abs("r") >= 1 - 1e-14) & (F.col("n") > 2)
    return (res.withColumn("p_value", F.when(perfect, F.lit(0.0)).when(F.col("t_stat").isNotNull(), p))
            .withColumn("status", F.when(F.col("p_value") < ALPHA, F.lit(PEARSON_YES))
                        .when(F.col("p_value").isNotNull(), F.lit(PEARSON_NO))))


def anova(df: DataFrame, value: str, groups: list[str], digits: int | None = 6) -> DataFrame:
    """One-way ANOVA of ``value`` by each column in ``groups``."""
    return anova_pairs(df, [(g, value, g) for g in groups], digits)


def anova_by_target(df: DataFrame, target: str, columns: list[str], digits: int | None = 6) -> DataFrame:
    """The reverse test: each numeric column grouped by the target's values.

    The groups can be nearly as many as the rows, so merging them in every
    task before the shuffle would hold them all: the rows, stored with the few
    columns that are needed, go by their group to tasks of about
    ``GROUP_ROWS`` rows each, and one aggregation there gives the numbers of
    all columns.  A group with more rows than that is one entry of its task."""
    key = F.col(target).cast("string").alias("grp")
    rows = materialize(df.where(F.col(target).isNotNull()).select(key, *columns))
    tasks = max(1, -(-rows.count() // GROUP_ROWS))
    aggs = [a.alias(f"_{k}{i}") for i, c in enumerate(columns) for k, a in zip(("n", "mean", "var"), _group_numbers(rows, c))]
    one = rows.repartition(tasks, "grp").groupBy("grp").agg(*aggs)
    numbers = F.array(*[F.struct(F.lit(c).alias("column_name"), "grp", *[F.col(f"_{k}{i}").alias(k) for k in ("n", "mean", "var")])
                        for i, c in enumerate(columns)])
    return _f_of_groups(materialize(one.select(F.explode(numbers).alias("p")).select("p.*").where("n > 0")), digits)


def _exact(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType | T.DecimalType)


def _numbers(e: Column, v: Column) -> tuple[Column, Column, Column]:
    """Number, mean and variance of the finite values ``v`` of a group; ``e``
    holds them as decimals where they are exact, else null."""
    ok = v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    e, v = F.when(ok, e), F.when(ok, v)
    return F.count(v), F.coalesce(F.try_divide(F.sum(e).cast("double"), F.count(e)), F.avg(v)), F.var_pop(v)


def _group_numbers(df: DataFrame, column: str) -> tuple[Column, Column, Column]:
    e = F.col(column) if _exact(df, column) else F.lit(None)
    return _numbers(e.cast("decimal(38,6)"), F.col(column).cast("double"))


def anova_pairs(df: DataFrame, tests: list[tuple[str, str, str]], digits: int | None = 6) -> DataFrame:
    """One-way ANOVA for every (name, value column, group column) test.

    All tests go through one shuffle: every row is expanded to one (test,
    group) pair per test and aggregated to the number, the mean and the
    variance of the group's values.  Means of integral and decimal values come
    from exact sums, others from sums in double; variances are merged around
    their means, so no magnitude is lost.  These few numbers per group are
    stored, the mean of each test is taken from them, and the sums of squares
    between and within follow around it.  Nulls, NaN and infinite values are
    left out, and so are tests with fewer than two groups, as the reference
    skips them; without variance inside the groups F is null.  ``digits=None``
    leaves F unrounded."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(g).cast("string").alias("grp"),
                 (F.col(v).cast("decimal(38,6)") if _exact(df, v) else F.lit(None).cast("decimal(38,6)")).alias("_e"),
                 F.col(v).cast("double").alias("_v"))
        for name, v, g in tests]))
    rows = df.select(pairs.alias("p")).select("p.*")
    numbers = [a.alias(k) for k, a in zip(("n", "mean", "var"), _numbers(F.col("_e"), F.col("_v")))]
    per = rows.where(F.col("grp").isNotNull()).groupBy("column_name", "grp").agg(*numbers)
    return _f_of_groups(materialize(per.where("n > 0")), digits)


def _f_of_groups(per: DataFrame, digits: int | None) -> DataFrame:
    """F and its degrees of freedom per test from a stored table of groups
    (column_name, grp, n, mean, var)."""
    # one row per test
    centre = per.groupBy("column_name").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("centre"))
    off = F.col("mean") - F.col("centre")
    col = per.join(F.broadcast(centre), "column_name").groupBy("column_name").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n_total"),
        F.sum(F.col("n") * off * off).alias("between"), F.sum(F.col("var") * F.col("n")).alias("within"))
    f = F.try_divide(F.try_divide(F.col("between"), F.col("k") - 1), F.try_divide(F.col("within"), F.col("n_total") - F.col("k")))
    return (col.where(F.col("k") > 1)
            .select("column_name", F.col("k").cast("long").alias("k"),
                    F.col("n_total").cast("long").alias("n"),
                    (f if digits is None else sig_round(f, digits)).alias("f_stat"),
                    (F.col("k") - 1).cast("long").alias("df_between"),
                    (F.col("n_total") - F.col("k")).cast("long").alias("df_within")))


def with_anova_p(res: DataFrame) -> DataFrame:
    """p (5 digits), F (3 decimals) and the wording; takes the unrounded F.
    Where F is null, p and the wording are null too."""
    p = f_pvalue(F.col("f_stat"), F.col("df_between").cast("double"), F.col("df_within").cast("double"))
    return (res.withColumn("p_value", F.when(F.col("f_stat").isNotNull(), F.round(p, 5)))
            .withColumn("f_stat", F.round("f_stat", 3))
            .withColumn("status", F.when(F.col("p_value") <= ALPHA, F.lit(ANOVA_YES))
                        .when(F.col("p_value").isNotNull(), F.lit(ANOVA_NO))))


def error_metrics(pred: DataFrame, actual: str, predicted: str, digits: int = 6) -> DataFrame:
    """MAE, MSE, RMSE, R^2 and the percentage forms of the notebooks
    (MAE and RMSE as % of the mean actual, MAE % of the max, MSE % of the
    max squared, R^2 x 100) from one aggregation pass.  A form whose divisor is
    zero is null."""
    e = F.col(actual).cast("double") - F.col(predicted).cast("double")
    a = F.col(actual).cast("double")
    agg = pred.agg(F.count(e).alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
                   F.avg(a).alias("mean_actual"), F.max(a).alias("max_actual"),
                   F.min(a).alias("min_actual"), F.var_pop(a).alias("var_actual"))
    rmse = F.sqrt("mse")
    r2 = 1 - F.try_divide(F.col("mse"), F.col("var_actual"))
    cols = {
        "n": F.col("n"),
        "mae": F.col("mae"), "mse": F.col("mse"), "rmse": rmse, "r2": r2,
        "mae_pct_mean": F.try_divide(F.col("mae"), F.col("mean_actual")) * 100,
        "rmse_pct_mean": F.try_divide(rmse, F.col("mean_actual")) * 100,
        "mae_pct_max": F.try_divide(F.col("mae"), F.col("max_actual")) * 100,
        "mse_pct_max_sq": F.try_divide(F.col("mse"), F.col("max_actual") * F.col("max_actual")) * 100,
        "r2_pct": r2 * 100,
        "min_actual": F.col("min_actual"), "max_actual": F.col("max_actual"),
    }
    return agg.select(*[(v if k == "n" else sig_round(v, digits)).alias(k) for k, v in cols.items()])


def histogram(df: DataFrame, value: str, bins: int = 30, digits: int = 6) -> DataFrame:
    """Equal-width histogram over [min, max]; the maximum falls in the last
    bin (closed on the right).  Empty bins are not emitted."""
    v = F.col(value).cast("double")
    rng = df.select(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"))).scalar()
    df = df.withColumn("_rng", rng)
    lo, hi = F.col("_rng.lo"), F.col("_rng.hi")
    width = (hi - lo) / F.lit(float(bins))
    b = F.least(F.floor(F.try_divide(v - lo, width)), F.lit(bins - 1))
    b = F.coalesce(b, F.lit(0)).cast("int")
    counted = df.where(v.isNotNull()).groupBy(b.alias("bin"), F.col("_rng")).agg(
        F.count(F.lit(1)).alias("n"))
    return counted.select("bin", "n", sig_round(lo + F.col("bin") * width, digits).alias("bin_start"))

