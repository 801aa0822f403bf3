"""Learning on tables: feature assembly, Spark ML pipelines for the rank
regressor and the sequence regressor, scoring, model save / load.

The reference trains Keras networks on one machine; here the same inputs
feed Spark ML's distributed ``GBTRegressor`` (trees handle the label codes
without embeddings)."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.operators.boosting import can_grow, grow_trees
from rankflow.operators.recommend import CODED, CYCLIC, ServingMaps, with_calendar_features
from rankflow.operators.features import apply_minmax, first_token_index, lookup

# rows of one training partition: the learners keep each partition as objects
TRAIN_ROWS = 100_000

RANK_FEATURES = [*CYCLIC, *CODED.values(), "title_code"]


def rank_feature_table(daily: DataFrame, maps: ServingMaps) -> DataFrame:
    """Six scaled cyclic features, five label codes and the title's first
    token index per daily row, plus the target ``rank``."""
    d = with_calendar_features(daily)
    d = apply_minmax(d, maps.scaler, CYCLIC)
    for col, out in CODED.items():
        d = lookup(d, col, maps.codes[col], out)
    return first_token_index(d, "title", maps.vocab, "title_code")


def rank_pipeline(features: list[str], label: str = "rank", max_iter: int = 10,
                  max_depth: int = 5, seed: int = 42,
                  validation_col: str | None = None) -> Pipeline:
    """Assembler + gradient-boosted trees.  With ``validation_col`` (a boolean
    column marking held-out training rows) boosting stops once the
    validation error stops improving -- the model keeps the best iteration,
    as the notebooks keep the epoch with the lowest validation loss."""
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    extra = {"validationIndicatorCol": validation_col, "validationTol": 0.001} if validation_col else {}
    gbt = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction",
                       maxIter=max_iter, maxDepth=max_depth, seed=seed, maxBins=64, **extra)
    return Pipeline(stages=[assembler, gbt])


def in_parts(rows: DataFrame, part_rows: int = TRAIN_ROWS) -> DataFrame:
    """Stored rows dealt to partitions of about ``part_rows`` rows, at least as
    many as they have: what a learner's task reads and keeps does not grow
    with the table, however well its files are packed."""
    parts = -(-rows.count() // part_rows)
    return rows.repartition(parts) if parts > rows.rdd.getNumPartitions() else rows


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """Fit on stored rows; only the columns that the learner reads go to it.
    Boosted trees grow on blocks of bins (:mod:`rankflow.operators.boosting`)."""
    assembler, gbt = pipeline.getStages()
    if can_grow(gbt) and assembler.getHandleInvalid() == "keep":
        return PipelineModel([assembler, grow_trees(gbt, assembler.getInputCols(), train)])
    marked = [gbt.getValidationIndicatorCol()] if gbt.isDefined(gbt.validationIndicatorCol) else []
    label = F.col(gbt.getLabelCol()).cast("double").alias(gbt.getLabelCol())
    used = [c for c in assembler.getInputCols() if c != gbt.getLabelCol()]
    return pipeline.fit(in_parts(train.select(*used, label, *marked)))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predictions(model: PipelineModel, df: DataFrame, id_cols: list[str], actual: str) -> DataFrame:
    """(ids..., actual, predicted) for every scored row."""
    return model.transform(df).select(*id_cols, F.col(actual).cast("double").alias("actual"),
                                      F.col("prediction").alias("predicted"))


def model_scorer(model: PipelineModel):
    """A fitted pipeline as the scorer of :func:`rankflow.operators.recommend.recommend`:
    the candidate feature columns carry the names the model was trained on."""
    def score(df: DataFrame) -> DataFrame:
        return model.transform(df).drop("features")
    return score
