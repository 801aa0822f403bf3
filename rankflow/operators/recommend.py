"""Top-k recommendation for a (weekday, date, month, genre, group) request
and the trends of the recommended titles -- one DataFrame plan each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankflow.functions.calendar import cyclic_features, weekday_index
from rankflow.operators.features import (apply_minmax, codes_for, first_token_index,
                                         fit_label_codes_multi, fit_minmax, fit_word_index, lookup)

CYCLIC = ["month_sin", "month_cos", "date_sin", "date_cos", "day_sin", "day_cos"]
CODED = {"author": "author_code", "publisher": "publisher_code", "format": "format_code",
         "genre": "genre_code", "group_name": "group_code"}


@dataclass
class Request:
    day: int      # 0..6, Monday = 0
    date: int     # 1..31
    month: int    # 1..12
    genre: str
    group: str


@dataclass
class ServingMaps:
    """Fitted mappings used at scoring time (all DataFrames)."""
    codes: dict          # column -> (value, code)
    vocab: DataFrame     # (word, n, idx)
    scaler: DataFrame    # one row of <feature>__min / __max


def with_calendar_features(daily: DataFrame) -> DataFrame:
    """Integer month / date, weekday index and the six cyclic features."""
    d = (daily.withColumn("month_i", F.col("month").cast("int"))
         .withColumn("date_i", F.col("date").cast("int"))
         .withColumn("day_index", weekday_index("day")))
    return d.withColumns(cyclic_features("month_i", "date_i", "day_index"))


def fit_serving_maps(daily: DataFrame) -> ServingMaps:
    """Label codes, title vocabulary (over every row's title) and the
    min-max scaler of the cyclic features, all fitted on ``daily``."""
    multi = fit_label_codes_multi(daily, list(CODED))
    codes = {c: codes_for(multi, c) for c in CODED}
    vocab = fit_word_index(daily, "title")
    scaler = fit_minmax(with_calendar_features(daily), CYCLIC)
    return ServingMaps(codes, vocab, scaler)


def save_serving_maps(maps: ServingMaps, path: str) -> None:
    """Mapping tables (codes of every column, vocabulary, scaler) as parquet."""
    from rankflow.sources.sinks import save_mapping
    codes = None
    for col, m in maps.codes.items():
        part = m.select(F.lit(col).alias("column"), "value", "code")
        codes = part if codes is None else codes.unionByName(part)
    save_mapping(codes, f"{path}/codes")
    save_mapping(maps.vocab, f"{path}/vocab")
    save_mapping(maps.scaler, f"{path}/scaler")


def load_serving_maps(spark, path: str) -> ServingMaps:
    from rankflow.sources.sinks import load_mapping
    codes = load_mapping(spark, f"{path}/codes")
    return ServingMaps({c: codes.where(F.col("column") == c).select("value", "code") for c in CODED},
                       load_mapping(spark, f"{path}/vocab"), load_mapping(spark, f"{path}/scaler"))


def validate_request(maps: ServingMaps, req: Request) -> None:
    """Unknown genre or group is an error, as in the web form handler."""
    for col, val in (("genre", req.genre), ("group_name", req.group)):
        if maps.codes[col].where(F.col("value") == F.lit(val)).isEmpty():
            raise ValueError(f"{col} {val!r} not found in label encodings")


def candidate_features(catalogue: DataFrame, maps: ServingMaps, req: Request) -> DataFrame:
    """Catalogue rows of the requested genre and group, with the request's
    scaled cyclic features as constants and looked-up codes (-1 when the
    value is unknown) -- the scoring input."""
    cand = catalogue.where((F.col("genre") == req.genre) & (F.col("group_name") == req.group))
    cand = cand.withColumns(cyclic_features(F.lit(req.month), F.lit(req.date), F.lit(req.day)))
    cand = apply_minmax(cand, maps.scaler, CYCLIC)
    for col, out in CODED.items():
        cand = lookup(cand, col, maps.codes[col], out)
    return first_token_index(cand, "title", maps.vocab, "title_code")


def linear_scorer(coefficients: dict[str, float], intercept: float):
    """A fixed linear model over the feature columns."""
    def score(df: DataFrame) -> DataFrame:
        pred = F.lit(float(intercept))
        for c, w in coefficients.items():
            pred = pred + F.lit(float(w)) * F.col(c).cast("double")
        return df.withColumn("prediction", pred)
    return score


def top_k(scored: DataFrame, k: int = 10) -> DataFrame:
    """Predicted rank = |int(prediction)|; one row per title (the first in
    (predicted rank, asin) order); the k best titles, numbered 1..k."""
    ranked = scored.withColumn("predicted_rank",
                               F.abs(F.col("prediction").cast("long")))
    best = ranked.groupBy("title").agg(F.min(F.struct("predicted_rank", "asin")).alias("_b"))
    top = best.select("title", F.col("_b.predicted_rank").alias("predicted_rank")).orderBy(
        "predicted_rank", "title").limit(k)
    # at most k rows: numbering them in one partition is bounded by k
    return top.select(F.row_number().over(Window.orderBy("predicted_rank", "title")).alias("position"),
                      "title", "predicted_rank")


def recommend(catalogue: DataFrame, maps: ServingMaps, req: Request, scorer, k: int = 10) -> DataFrame:
    validate_request(maps, req)
    return top_k(scorer(candidate_features(catalogue, maps, req)), k)


def title_trends(top: DataFrame, facts: DataFrame, by: str) -> DataFrame:
    """Mean rank of each recommended title by ``by`` (month or weekday)."""
    from rankflow.operators.trends import mean_by
    rows = facts.join(top.select("title"), "title", "left_semi")
    return mean_by(rows, ["title", by])
