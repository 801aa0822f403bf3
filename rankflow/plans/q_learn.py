"""Training and scoring queries (rows-only checks: model output has no SQL
equivalent)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankflow.operators.learn import (RANK_FEATURES, fit, load_model, predictions,
                                      rank_feature_table, rank_pipeline, save_model)
from rankflow.operators.ordering import position_split
from rankflow.operators.recommend import fit_serving_maps, load_serving_maps, save_serving_maps
from rankflow.operators.sequences import flatten_history, history_windows
from rankflow.plans import catalog as C
from rankflow.plans.registry import query
from rankflow.session import materialize, remove, scratch_path


@query("train_score_rank")
def train_score_rank(spark, sf_dir):
    """Chronological 80/20 split of the daily fact -> label codes, title
    vocabulary and scaler fitted on the training rows only (no leak, D11)
    and saved as mapping tables -> feature table -> GBT fit with the latest
    tenth of the training rows as validation (early stop) -> model saved and
    re-loaded with the mappings -> score test -> one row per title
    (M1 M3 M5 M6 M7 S13 A18)."""
    # stored first: the sort reads its rows twice, and their shuffles are gone before its own
    daily = materialize(C.book_daily(spark, sf_dir).drop("year"))
    split = position_split(daily, ["timestamp", "asin"], total_col="n")
    remove(daily)
    # the last tenth of the training positions validates the boosting rounds
    split = split.withColumn("is_val", F.col("pos") >= F.floor(F.col("n") * 0.8 * 0.9))
    maps = fit_serving_maps(split.where(F.col("split") == "train"))
    base = scratch_path(spark, "rank-model")
    save_serving_maps(maps, f"{base}/maps")
    maps = load_serving_maps(spark, f"{base}/maps")
    # stored are the columns that the learner and the scores read
    table = materialize(rank_feature_table(split, maps).select(
        "asin", "title", "timestamp", "rank", "split", "is_val", *RANK_FEATURES))
    train = table.where(F.col("split") == "train")
    test = table.where(F.col("split") == "test")
    model = fit(rank_pipeline(RANK_FEATURES, validation_col="is_val"), train)
    save_model(model, f"{base}/model")
    scored = predictions(load_model(f"{base}/model"), test, ["asin", "title", "timestamp"], "rank")
    best = scored.groupBy("title").agg(F.min(F.struct("timestamp", "asin", "actual", "predicted")).alias("b"))
    return best.select("title", F.col("b.actual").alias("actual_rank"),
                       F.col("b.predicted").alias("predicted_rank"))


@query("train_score_sequence")
def train_score_sequence(spark, sf_dir):
    """Per-book length-10 daily histories flattened to lag features -> GBT
    on a seeded hash split -> (asin, timestamp, actual, predicted) (M4 M2 M6)."""
    from rankflow.operators.features import hash_split
    daily = materialize(C.book_daily(spark, sf_dir))
    w = history_windows(daily.select("asin", "timestamp", "rank"), ["timestamp"], ["rank"], "rank", key="asin")
    flat = flatten_history(w, "history", ["rank"], 10)
    feats = [f"rank_lag{i}" for i in range(1, 11)]
    flat = hash_split(flat.withColumn("_k", F.concat_ws("|", "asin", "timestamp")), "_k")
    # the learner reads its rows several times: the windows are made once
    flat = materialize(flat.select("asin", "timestamp", "target", "split", *feats))
    train = flat.where(F.col("split") == "train")
    test = flat.where(F.col("split") == "test")
    model = fit(rank_pipeline(feats, label="target"), train)
    return predictions(model, test, ["asin", "timestamp"], "target")
