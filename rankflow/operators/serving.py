"""Top titles for a table of requests, from stored maps.

Training writes what serving needs once: the coded catalogue (one row per
item, sorted by genre and group so that a request reads few row groups), the
label codes, the title vocabulary and the scaler.  Serving reads those tables
only; the fact table is never scanned.  Requests of equal content are scored
once, and each keeps its ``k`` best titles by a rank-limited window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.functions.calendar import cyclic_features
from rankflow.operators import models as M
from rankflow.operators.features import apply_minmax, first_token_index, lookup
from rankflow.operators.recommend import CODED, CYCLIC, ServingMaps, load_serving_maps, save_serving_maps

ITEM = ["asin", "title", *CODED]
SHAPE = ["day", "date", "month", "genre", "group_name"]

# wordings of a request's status
OK, NO_GENRE, NO_GROUP, NO_DATE, NO_TITLES = "ok", "unknown genre", "unknown group", "no such date", "no titles"


def coded_catalogue(daily: DataFrame, maps: ServingMaps) -> DataFrame:
    """One row per item and attributes, with its codes."""
    out = daily.select(*ITEM).distinct()
    for col, code in CODED.items():
        out = lookup(out, col, maps.codes[col], code)
    return first_token_index(out, "title", maps.vocab, "title_code")


def save_store(daily: DataFrame, maps: ServingMaps, path: str) -> None:
    """Write the coded catalogue and the maps under ``path``."""
    order = ["genre", "group_name", "asin", "title"]
    items = coded_catalogue(daily, maps)
    items.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{path}/catalogue")
    save_serving_maps(maps, f"{path}/maps")


def load_store(spark, path: str) -> tuple[DataFrame, ServingMaps]:
    return spark.read.parquet(f"{path}/catalogue"), load_serving_maps(spark, f"{path}/maps")


def _known(requests: DataFrame, maps: ServingMaps, column: str) -> DataFrame:
    codes = maps.codes[column].select(F.col("value").alias(f"_{column}"))
    return requests.join(codes, F.col(column) == F.col(f"_{column}"), "left")


def request_status(requests: DataFrame, maps: ServingMaps) -> DataFrame:
    """Requests with ``status``: what the form handler would refuse (an
    unknown genre or group, a day, date or month out of range), else ok."""
    def within(c: str, lo: int, hi: int) -> Column:
        return F.coalesce(F.col(c).between(lo, hi), F.lit(False))

    dated = within("day", 0, 6) & within("date", 1, 31) & within("month", 1, 12)
    checked = _known(_known(requests, maps, "genre"), maps, "group_name")
    return checked.withColumn("status", F.when(F.col("_genre").isNull(), NO_GENRE)
                              .when(F.col("_group_name").isNull(), NO_GROUP)
                              .when(~dated, NO_DATE).otherwise(OK)).drop("_genre", "_group_name")


def serve(requests: DataFrame, catalogue: DataFrame, maps: ServingMaps, scorer: Callable[[DataFrame], DataFrame],
          k: int = 10) -> DataFrame:
    """(request_id, status, position, title, predicted_rank): up to ``k`` rows
    per request (request_id, day, date, month, genre, group_name), one row
    with a null position for a request without titles."""
    checked = request_status(requests, maps)
    shapes = checked.where(F.col("status") == OK).select(*SHAPE).distinct()
    asked = apply_minmax(shapes.withColumns(cyclic_features(F.col("month"), F.col("date"), F.col("day"))), maps.scaler, CYCLIC)
    scored = scorer(asked.join(catalogue, ["genre", "group_name"]))
    ranked = scored.withColumn("predicted_rank", F.abs(F.col("prediction").cast("long")))
    # one row per title, then the k first of each shape; the least number, not
    # the least row, needs no sort of all scores (null where one is missing)
    least = F.when(F.count("predicted_rank") == F.count(F.lit(1)), F.min("predicted_rank"))
    best = ranked.groupBy(*SHAPE, "title").agg(least.alias("predicted_rank"))
    place = F.row_number().over(Window.partitionBy(*SHAPE).orderBy("predicted_rank", "title"))
    top = best.withColumn("position", place).where(F.col("position") <= k)
    answered = checked.join(top, SHAPE, "left")
    status = F.when((F.col("status") == OK) & F.col("position").isNull(), NO_TITLES).otherwise(F.col("status"))
    return answered.select("request_id", status.alias("status"), "position", "title", "predicted_rank")


def vector_scorer(model, sizes: dict[str, int], scale: M.Scale) -> Callable[[DataFrame], DataFrame]:
    """A model on the one-hot rank vectors as the scorer of :func:`serve`."""
    def score(df: DataFrame) -> DataFrame:
        made = model.transform(M.rank_vectors(df, sizes))
        return made.withColumn("prediction", scale.back("prediction")).drop("static", "features")
    return score
