"""Golden cases on tiny literal frames (FIXTURES.md section 4)."""

import os

import pytest
from pyspark.sql import functions as F

from rankflow.functions.text import mojibake, repair_mojibake, strip_ws, title_tokens
from rankflow.operators.cleaning import drop_literal_keys
from rankflow.operators.enrich import enrich_titles
from rankflow.operators.facts import daily_min_rank
from rankflow.operators.features import (apply_minmax, first_token_index, fit_label_codes,
                                         fit_minmax, fit_word_index, kfold_target_encode, lookup,
                                         token_sequences)
from rankflow.operators.history import (explode_rank_map, item_id_from_path, melt,
                                        observations_from_documents, to_observations)
from rankflow.operators.recommend import top_k
from rankflow.operators.sequences import history_windows
from rankflow.operators.stats import histogram
from rankflow.operators.vectors import nearest_prototype
from rankflow.sources.readers import read_csv_skip_long_rows, read_rank_documents


def test_json_map_bad_values_give_no_rows(spark):
    df = spark.createDataFrame([('{"1":5,"2":"x"}',), ("{}",), ("bad",)], "value string")
    assert explode_rank_map(df, "value", keep=()).count() == 0
    ok = spark.createDataFrame([('{"1":5,"2":7}',)], "value string")
    assert sorted(r["rank"] for r in explode_rank_map(ok, "value", keep=()).collect()) == [5, 7]


def test_melt_missing_key(spark):
    wide = spark.createDataFrame([("a", 1, None)], "asin string, `100` int, `200` int")
    assert melt(wide, ["asin"]).count() == 2
    assert melt(wide, ["asin"], keep_missing=False).count() == 1


def test_id_rules(spark):
    df = spark.createDataFrame([("s3://b/B00_X_com_norm.json",)], "p string")
    r = df.select(item_id_from_path("p", "prefix").alias("a"), item_id_from_path("p", "suffix").alias("b"),
                  item_id_from_path("p", "depth3").alias("c")).first()
    assert (r.a, r.b, r.c) == ("B00", "B00_X", "B00")


def test_epoch_to_calendar(spark):
    df = spark.createDataFrame([("x", "1483228800", 3)], "asin string, timestamp string, rank bigint")
    r = to_observations(df).first()
    assert (r.timestamp, r.year, r.month, r.date, r.day, r.hour) == (
        "2017-01-01 00:00:00", "2017", "01", "01", "Sunday", "00")


def test_daily_minimum_tie_takes_earliest(spark):
    obs = spark.createDataFrame(
        [("a", "2017-01-01 10:00:00", 5), ("a", "2017-01-01 09:00:00", 5), ("a", "2017-01-01 08:00:00", 7)],
        "asin string, timestamp string, rank bigint")
    obs = obs.select("asin", "timestamp", "rank", F.lit("2017").alias("year"), F.lit("01").alias("month"),
                     F.lit("01").alias("date"), F.lit("Sunday").alias("day"), F.lit("00").alias("hour"))
    meta = spark.createDataFrame([("a", "book", "1", "T", "A", "P", "fiction")],
                                 "asin string, group_name string, format string, title string, "
                                 "author string, publisher string, genre string")
    r = daily_min_rank(obs, meta).collect()
    assert len(r) == 1 and r[0]["rank"] == 5 and r[0]["timestamp"] == "2017-01-01 09:00:00"
    assert r[0]["day"] == "Sunday"


def test_daily_minimum_drops_nulls_and_unmatched(spark):
    obs = spark.createDataFrame(
        [("a", "2017-01-01 10:00:00", None), ("a", None, 3), ("b", "2017-01-01 10:00:00", 4),
         ("c", "2017-01-02 10:00:00", 9)], "asin string, timestamp string, rank bigint")
    obs = obs.select("*", *[F.lit("x").alias(c) for c in ("year", "month", "date", "day", "hour")])
    meta = spark.createDataFrame([("a", "book", "1", "T", "A", "P", "g"), ("b", "book", "1", "T", "A", None, "g")],
                                 "asin string, group_name string, format string, title string, "
                                 "author string, publisher string, genre string")
    # a: every row has a null; b: metadata incomplete; c: no metadata
    assert daily_min_rank(obs, meta).count() == 0


def test_payload_defaults(spark):
    books = spark.createDataFrame([("T",), ("A",), ("Z",)], "TITLE string")
    payloads = spark.createDataFrame(
        [("T", 404, None), ("A", 200, '{"items":[{"volumeInfo":{"title":"A"}}]}'),
         ("Z", 200, '{"items":[{"volumeInfo":{"title":"Zed","authors":["x","y"],"averageRating":"4"}}]}')],
        "title string, status int, body string")
    got = {r.TITLE: tuple(r.book_details) for r in enrich_titles(books, payloads).collect()}
    assert got["T"] == ("T", "No Author", "No Rating")
    assert got["A"] == ("A", "No Author", "No Rating")
    assert got["Z"] == ("Zed", "x, y", "4")


def test_junk_keys_keep_nulls(spark):
    df = spark.createDataFrame([('M."',), ('L"',), (None,), ("B1",)], "asin string")
    assert sorted(r.asin or "" for r in drop_literal_keys(df, "asin").collect()) == ["", "B1"]


def test_trim_and_mojibake(spark):
    df = spark.createDataFrame([("\t x \n",), ("CafÃ©",), ("itâ€™s",), ("café",), ("日本",)], "t string")
    out = [r[0] for r in df.select(strip_ws("t")).collect()]
    assert out[0] == "x"
    rep = [r[0] for r in df.select(repair_mojibake("t")).collect()]
    assert rep[1:] == ["Café", "it’s", "café", "日本"]


def test_bad_csv_lines(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "bad.csv")
    with open(p, "w") as f:
        f.write("a,b,c\n1,2,3\n1,2\n1,2,3,4\n5,6,7\n")
    df = read_csv_skip_long_rows(spark, p, ["a", "b", "c"])
    rows = sorted(tuple(x or "" for x in r) for r in df.collect())
    assert rows == [("1", "2", ""), ("1", "2", "3"), ("5", "6", "7")]
    # the result does not depend on the projection
    assert df.select("a").count() == 3


def test_lookup_miss_and_label_codes(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("z",)], "v string")
    codes = fit_label_codes(df.where(F.col("v") != "z"), "v")
    got = [r.code for r in lookup(df, "v", codes, "code").orderBy(F.monotonically_increasing_id()).collect()]
    assert sorted(got) == [-1, 0, 1, 1]
    m = {r.value: r.code for r in codes.collect()}
    assert m == {"a": 0, "b": 1}


def test_minmax_constant_is_zero(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    out = apply_minmax(df, fit_minmax(df, ["x"]), ["x"]).collect()
    assert [r.x for r in out] == [0.0, 0.0]


def test_empty_title_tokens(spark):
    df = spark.createDataFrame([(1, ""), (2, "Hello, World! Hello")], "id int, t string")
    vocab = fit_word_index(df, "t")
    first = {r.id: r.code for r in first_token_index(df, "t", vocab, "code").collect()}
    assert first[1] == 0 and first[2] == 1
    seqs = {r.id: r.title_seq for r in token_sequences(df, "id", "t", vocab, 10).collect()}
    assert seqs[1] == [0] * 10
    assert seqs[2] == [0] * 7 + [1, 2, 1]
    toks = df.select(title_tokens(F.lit("It's a-b  c"))).first()[0]
    assert toks == ["it's", "a", "b", "c"]


def test_target_encoding_single_fold_category_gets_global_mean(spark):
    df = spark.createDataFrame([(1, "x", 10.0, 0), (2, "x", 20.0, 0), (3, "y", 30.0, 1), (4, "y", 50.0, 2)],
                               "id int, cat string, t double, fold int")
    enc, mapping = kfold_target_encode(df, "cat", "t", "fold", "te", n_folds=3)
    got = {r.id: r.te for r in enc.collect()}
    assert got[1] == got[2] == 27.5   # x only in fold 0: global mean
    assert got[3] == 50.0 and got[4] == 30.0
    m = {r.cat: (r.mean_all, r.mean_last_fold) for r in mapping.collect()}
    assert m["x"] == (15.0, 15.0) and m["y"] == (40.0, 30.0)


def test_prediction_truncates_then_abs(spark):
    df = spark.createDataFrame([("a", "t1", -3.7), ("b", "t2", 5.2)], "asin string, title string, prediction double")
    got = {r.title: r.predicted_rank for r in top_k(df, 10).collect()}
    assert got == {"t1": 3, "t2": 5}


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(31)], "e double")
    bins = {r.bin: r.n for r in histogram(df, "e", 30).collect()}
    assert bins[29] == 2 and sum(bins.values()) == 31


def test_sequence_lengths(spark):
    rows = [("a", i, float(i)) for i in range(10)] + [("b", i, float(i)) for i in range(11)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    w = history_windows(df, ["t"], ["v"], "v", key="k", length=10, bucket_rows=12)
    got = w.collect()
    assert len(got) == 1 and got[0].k == "b" and got[0].target == 10.0
    assert [s.v for s in got[0].history] == [float(i) for i in range(10)]


def test_prototype_tie_goes_to_earlier(spark):
    vecs = spark.createDataFrame([(1, [1.0, 1.0])], "id int, embedding array<double>")
    protos = spark.createDataFrame([(2, "b", [1.0, 0.0]), (1, "a", [0.0, 1.0])],
                                   "ord int, label string, embedding array<double>")
    r = nearest_prototype(vecs, "embedding", protos, "label", "ord").first()
    assert r.predicted_label == "a"


def test_rank_documents_from_files(spark, tmpdir_path):
    for asin, doc in (("B01", '{"1483228800": 7, "1483232400": 5}'), ("B02", '{"1483228800": 1}')):
        with open(os.path.join(tmpdir_path, f"{asin}_com_norm.json"), "w") as f:
            f.write(doc + "\n")
    docs = read_rank_documents(spark, os.path.join(tmpdir_path, "*.json"))
    obs = observations_from_documents(docs, id_rule="suffix")
    got = sorted((r.asin, r.hour, r["rank"]) for r in obs.collect())
    assert got == [("B01", "00", 7), ("B01", "01", 5), ("B02", "00", 1)]


def test_whole_file_json_readers(spark, tmpdir_path):
    from rankflow.sources.readers import document_entries, read_documents_variant, read_rank_documents_whole
    docs = {"B01": '{\n  "100": 7,\n  "200": 5\n}', "B02": '{\n  "100": 1,\n  "300": "x", "400": null, "500": 2.5\n}',
            "B03": "no json", "B04": "[1, 2]", "B05": "{}", "B06": ""}
    for asin, doc in docs.items():
        with open(os.path.join(tmpdir_path, f"{asin}_com_norm.json"), "w") as f:
            f.write(doc)
    whole = read_rank_documents_whole(spark, os.path.join(tmpdir_path, "B01*.json"))
    got = sorted((r.file_name.split("/")[-1][:3], k, v) for r in whole.collect() for k, v in r.ranks.items())
    assert got == [("B01", "100", 7), ("B01", "200", 5)]
    # keys never become columns, whatever the files hold
    read = read_documents_variant(spark, os.path.join(tmpdir_path, "*.json"))
    assert read.columns == ["doc", "file_name"]
    long = document_entries(read.withColumn("asin", item_id_from_path("file_name", "suffix")).drop("file_name"))
    assert sorted((r.asin, r.key, r.value) for r in long.collect() if r.key != "500") == [
        ("B01", "100", 7), ("B01", "200", 5), ("B02", "100", 1), ("B02", "300", None), ("B02", "400", None)]


def test_single_file_csv_export(spark, tmpdir_path):
    from rankflow.sources.readers import read_csv_strings
    from rankflow.sources.sinks import write_single_csv
    df = spark.createDataFrame([(i, f"n{i}") for i in range(20)], "k int, name string").repartition(4)
    out = os.path.join(tmpdir_path, "one")
    write_single_csv(df, out)
    assert len([f for f in os.listdir(out) if f.endswith(".csv")]) == 1
    back = read_csv_strings(spark, out)
    assert sorted((int(r.k), r.name) for r in back.collect()) == [(i, f"n{i}") for i in range(20)]


def test_public_helpers(spark):
    import datetime as dt

    from rankflow.functions.calendar import calendar_parts, weekday_of
    from rankflow.operators.cleaning import drop_any_null
    from rankflow.operators.facts import typed_facts
    from rankflow.schemas import features_excluding, missing_columns, require_columns

    df = spark.createDataFrame([(dt.datetime(2017, 1, 2, 13, 5, 0), "a", None), (dt.datetime(2017, 1, 1), "b", 1)],
                               "t timestamp, s string, n int")
    parts = df.select(*[v.alias(k) for k, v in calendar_parts("t").items()], weekday_of("t").alias("w"))
    got = sorted(tuple(r) for r in parts.collect())
    assert got == [("2017", "01", "01", "Sunday", "00", 6), ("2017", "01", "02", "Monday", "13", 0)]
    assert drop_any_null(df).count() == 1
    assert features_excluding(df, ["s"]) == ["t", "n"] and missing_columns(df, ["n", "x"]) == ["x"]
    with pytest.raises(ValueError):
        require_columns(df, ["x"])
    daily = spark.createDataFrame([("a", "2017-01-02 13:05:00", "01", "02")],
                                  "asin string, timestamp string, month string, date string")
    r = typed_facts(daily).first()
    assert r.timestamp == dt.datetime(2017, 1, 2, 13, 5) and r.month == 1 and r.date == 2


def test_recommend_with_trained_model(spark):
    from rankflow.operators.learn import RANK_FEATURES, fit, model_scorer, rank_feature_table, rank_pipeline
    from rankflow.operators.recommend import Request, fit_serving_maps, recommend
    from rankflow.plans import catalog as C
    daily = C.book_daily(spark, "/root/testdata/sf0.001")
    maps = fit_serving_maps(daily)
    model = fit(rank_pipeline(RANK_FEATURES, max_iter=3, max_depth=3), rank_feature_table(daily, maps))
    top = recommend(daily, maps, Request(2, 15, 6, "economy", "book"), model_scorer(model)).collect()
    assert 0 < len(top) <= 10 and [r.position for r in top] == list(range(1, len(top) + 1))
    ranks = [r.predicted_rank for r in top]
    assert ranks == sorted(ranks)


def test_literal_chronological_order(spark):
    from rankflow.operators.ordering import literal_chronological_order
    df = spark.createDataFrame([(2, 1, "Monday"), (1, 5, "Tuesday"), (1, 5, "Friday"), (1, 2, "Sunday")],
                               "month int, date int, day string")
    got = [tuple(r) for r in literal_chronological_order(df).collect()]
    assert got == [(1, 2, "Sunday"), (1, 5, "Friday"), (1, 5, "Tuesday"), (2, 1, "Monday")]
