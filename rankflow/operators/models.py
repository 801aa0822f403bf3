"""Learned rank models on encoded tables.

Categories enter as sparse one-hot vectors, histories as one dense vector of
all steps and features, titles as one sparse indicator per token position.  A
factorisation machine learns a vector per category value (the place of an
embedding layer); the sequence model is an elastic-net regression over the
history and the item's vectors.  Models are chosen by their loss on marked
validation rows, and the best one is saved and loaded again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import FMRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.functions.calendar import cyclic_features, weekday_index
from rankflow.operators.factors import can_train, fit_machines
from rankflow.operators.features import (codes_for, first_per_key, fit_label_codes_multi, fit_word_index, lookup,
                                         token_sequences)
from rankflow.operators.learn import save_model
from rankflow.operators.recommend import CODED, CYCLIC, ServingMaps
from rankflow.operators.sequences import history_windows

DYNAMIC = ["rank", *CYCLIC]
STATIC = {"author": "author_code", "publisher": "publisher_code", "group_name": "group_code", "genre": "genre_code"}
TITLE_TOKENS = 10


# ---- samples -----------------------------------------------------------------

@dataclass
class ItemMaps:
    """Codes of the static attributes, sizes of their ranges and the title
    vocabulary, all fitted on one row per item."""
    codes: dict
    vocab: DataFrame
    sizes: dict[str, int]


def item_attributes(daily: DataFrame) -> DataFrame:
    """The static attributes of each item: those of its earliest row."""
    cols = ["title", *STATIC]
    return first_per_key(daily, "asin", ["timestamp", *cols], cols)


def fit_item_maps(items: DataFrame) -> ItemMaps:
    """To the driver come one number per attribute and the vocabulary's size."""
    multi = fit_label_codes_multi(items, list(STATIC))
    vocab = fit_word_index(items, "title")
    sizes = {r["column"]: r["n"] for r in multi.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = {c: sizes.get(c, 0) for c in STATIC}
    sizes["token"] = (vocab.agg(F.max("idx")).first()[0] or 0) + 1
    return ItemMaps({c: codes_for(multi, c) for c in STATIC}, vocab, sizes)


def item_vectors(items: DataFrame, maps: ItemMaps) -> DataFrame:
    """(asin, static codes, title_seq): the item's side of a sequence sample;
    an unknown value has code -1, a missing title ten zeros."""
    out = items
    for col, code in STATIC.items():
        out = lookup(out, col, maps.codes[col], code)
    seqs = token_sequences(items, "asin", "title", maps.vocab, TITLE_TOKENS)
    return out.join(seqs, "asin", "left").select("asin", *STATIC.values(), "title_seq")


def sequence_samples(daily: DataFrame, items: DataFrame, length: int = 10) -> DataFrame:
    """One row per item-day with ``length`` earlier days: asin, timestamp,
    target (the rank), ``dynamic`` (step by step the rank and the six cyclic
    features of the earlier days), the item's codes and title tokens.

    The item's side joins the days before the windows are made: a day has four
    numbers, a window forty.  The cyclic features are made from the windows'
    calendar parts, so the wide samples are never sorted, shuffled or stored."""
    days = daily.select("asin", "timestamp", F.col("rank").cast("double").alias("rank"), F.col("month").cast("int").alias("month"),
                        F.col("date").cast("int").alias("date"), weekday_index("day").alias("day"))
    zeros = F.array_repeat(F.lit(0), TITLE_TOKENS)
    whole = days.join(items, "asin", "left").withColumns(
        {**{c: F.coalesce(c, F.lit(-1)) for c in STATIC.values()}, "title_seq": F.coalesce("title_seq", zeros)})
    windows = history_windows(whole, ["timestamp"], ["rank", "month", "date", "day"], "rank", key="asin", length=length)

    def step(h: Column) -> Column:
        return F.array(h["rank"], *cyclic_features(h["month"], h["date"], h["day"]).values())

    dynamic = F.flatten(F.transform("history", step)).alias("dynamic")
    return windows.select("asin", "timestamp", "target", dynamic, *STATIC.values(), "title_seq")


# ---- vectors -----------------------------------------------------------------

def one_hot_stage(codes: dict[str, int], out: str, df: DataFrame) -> PipelineModel:
    """One-hot encoding of code columns with ``n`` values each into one sparse
    vector, a place more per column for other codes.  The sizes are those of
    the fitted maps, not of the rows at hand."""
    names = list(codes)
    # the encoder takes its sizes from the largest code it sees
    sizes = df.sparkSession.range(1).select(*[F.lit(float(max(codes[c], 1))).alias(c) for c in names])
    hot = OneHotEncoder(inputCols=names, outputCols=[f"{c}_hot" for c in names], dropLast=False)
    return PipelineModel([hot.fit(sizes), VectorAssembler(inputCols=[f"{c}_hot" for c in names], outputCol=out)])


def _valid(c: str, n: int) -> Column:
    """A code, or the place after the last one where it is none of them."""
    return F.when((F.col(c) >= 0) & (F.col(c) < n), F.col(c).cast("double")).otherwise(F.lit(float(n)))


def encode_static(df: DataFrame, codes: dict[str, int], out: str = "static", before: list[str] | None = None) -> DataFrame:
    """``out``: the one-hot parts of all code columns.  With ``before`` also
    ``features``: those columns and the same parts, put together in one go."""
    ready = df.withColumns({c: _valid(c, n) for c, n in codes.items()})
    made, hot = one_hot_stage(codes, out, df).transform(ready), [f"{c}_hot" for c in codes]
    if before:
        made = VectorAssembler(inputCols=[*before, *hot], outputCol="features").transform(made)
    return made.drop(*hot)


def sequence_vectors(samples: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """The samples with ``static`` (sparse: author, publisher, group, genre,
    ten title places) and ``features`` (history and static)."""
    tokens = {f"token_{i}": sizes["token"] for i in range(TITLE_TOKENS)}
    wide = samples.withColumns({c: F.get("title_seq", int(c.split("_")[1])) for c in tokens}
                               | {f"place_{code}": F.col(code) for code in STATIC.values()})
    codes = {f"place_{code}": sizes[col] for col, code in STATIC.items()} | tokens
    made = encode_static(wide.withColumn("history", array_to_vector("dynamic")), codes, before=["history"])
    return made.select(*samples.columns, "static", "features")


def active_places(vector: str) -> Column:
    """The places of the non-zero parts of a sparse vector, comma-joined."""
    return F.regexp_extract(F.col(vector).cast("string"), r"\[([0-9,]*)\]", 1)


def rank_sizes(maps: ServingMaps) -> dict[str, int]:
    """Values of each code column of the rank table."""
    sizes = {out: (maps.codes[c].agg(F.max("code")).first()[0] or 0) + 1 for c, out in CODED.items()}
    return sizes | {"title_code": (maps.vocab.agg(F.max("idx")).first()[0] or 0) + 1}


def rank_vectors(table: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """``static`` (sparse one-hot of the five codes and the title's token) and
    ``features`` (scaled cyclic features and static) of a rank feature table."""
    return encode_static(table, sizes, before=CYCLIC)


# ---- selection -----------------------------------------------------------------

@dataclass
class Selected:
    model: PipelineModel
    losses: list[float]
    best: int


def fitted(estimator, grid: list[dict], train: DataFrame):
    """The models of the parameter maps.  Factorisation machines go over the
    rows together."""
    stages = estimator.getStages() if isinstance(estimator, Pipeline) else [estimator]
    if len(stages) == 1 and isinstance(stages[0], FMRegressor):
        machines = [stages[0].copy(params) for params in grid]
        columns = {(m.getFeaturesCol(), m.getLabelCol()) for m in machines}
        if len(columns) == 1 and all(map(can_train, machines)):
            return [PipelineModel([m]) for m in fit_machines(machines, train)]
    return (estimator.fit(train, params) for params in grid)


def select_model(estimator, grid: list[dict], train: DataFrame, valid: DataFrame, label: str, path: str) -> Selected:
    """Fit every parameter map on ``train``, keep the one with the least RMSE
    on ``valid`` (the first of equals), save it to ``path`` and load it."""
    judge = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    losses, best = [], None
    for model in fitted(estimator, grid, train):
        losses.append(judge.evaluate(model.transform(valid)))
        if best is None or losses[-1] < losses[best[0]]:
            best = (len(losses) - 1, model)
    model = best[1] if isinstance(best[1], PipelineModel) else PipelineModel([best[1]])
    save_model(model, path)
    return Selected(PipelineModel.load(path), losses, best[0])


@dataclass
class Scale:
    """Mean and deviation of the training target."""
    mean: float
    std: float

    def scaled(self, c: str) -> Column:
        return (F.col(c).cast("double") - self.mean) / self.std

    def back(self, c: str) -> Column:
        return F.col(c) * self.std + self.mean


def fit_scale(train: DataFrame, target: str) -> Scale:
    r = train.agg(F.avg(target).alias("m"), F.stddev_pop(target).alias("s")).first()
    return Scale(r.m or 0.0, r.s or 1.0)


def factor_machine(iterations: int = 40, step: float = 0.1, seed: int = 7) -> FMRegressor:
    """A factorisation machine on ``features`` for the scaled target."""
    return FMRegressor(featuresCol="features", labelCol="scaled", maxIter=iterations, stepSize=step, seed=seed, initStd=0.05)


def elastic_net(mix: float = 0.5, iterations: int = 60) -> LinearRegression:
    """An elastic-net regression on ``features`` for the scaled target.  Up to
    4,096 features one pass over the rows gives their moments, and the
    iterations run on those; with more every iteration reads the rows."""
    return LinearRegression(featuresCol="features", labelCol="scaled", elasticNetParam=mix, maxIter=iterations, solver="auto")


def category_factors(model: PipelineModel, spark, sizes: dict[str, int], first: int) -> DataFrame:
    """The learned vector of every category value: (column, code, weight,
    factors).  ``first`` is the place of the first one-hot part."""
    fm = model.stages[-1]
    v, w = fm.factors.toArray(), fm.linear.toArray()
    rows, at = [], first
    for c, n in sizes.items():
        rows += [(c, k, float(w[at + k]), [float(x) for x in v[at + k]]) for k in range(n)]
        at += n + 1
    return spark.createDataFrame(rows, "column string, code int, weight double, factors array<double>")


def report(chosen: Selected, names: list[str], test: DataFrame, scale: Scale, target: str) -> DataFrame:
    """One row per candidate: its validation loss and whether it was kept; for
    the kept one the error on ``test``, that of predicting the training mean,
    and R^2 against the test mean."""
    spark = test.sparkSession
    e = F.col(target).cast("double") - scale.back("prediction")
    b = F.col(target).cast("double") - F.lit(scale.mean)
    m = chosen.model.transform(test).agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.sqrt(F.avg(b * b)).alias("base"),
                                         (1 - F.try_divide(F.avg(e * e), F.var_pop(target))).alias("r2")).first()
    rows = [(n, loss * scale.std, k == chosen.best, *((m.rmse, m.base, m.r2) if k == chosen.best else (None,) * 3))
            for k, (n, loss) in enumerate(zip(names, chosen.losses))]
    return spark.createDataFrame(rows, "candidate string, validation_rmse double, kept boolean, test_rmse double, "
                                       "mean_predictor_rmse double, test_r2 double")
