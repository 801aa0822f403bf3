"""The learned models on tables with a known dependence, the vectors outside
the driver tables, and serving of a request table."""

import datetime as dt
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from rankflow.functions.calendar import calendar_parts
from rankflow.operators import models as M
from rankflow.operators import serving as V
from rankflow.operators.learn import rank_feature_table
from rankflow.operators.recommend import CYCLIC, fit_serving_maps, linear_scorer

AUTHORS = ["ann", "bob", "cy", "di"]


def _daily(spark, rows):
    """(asin, day number, rank, author, genre, group, title) as the daily fact."""
    start = dt.date(2022, 1, 1)
    raw = [(a, f"{start + dt.timedelta(days=d)} 00:00:00", r, g, "f" + g[:1], t, au, "pub" + au[:1], ge)
           for a, d, r, au, ge, g, t in rows]
    df = spark.createDataFrame(raw, "asin string, timestamp string, rank long, group_name string, format string, "
                                    "title string, author string, publisher string, genre string")
    parts = calendar_parts(F.to_timestamp("timestamp"))
    return df.withColumns({k: parts[k] for k in ("year", "month", "date", "day")})


@pytest.fixture(scope="module")
def daily(spark):
    """Ranks that follow the author, the pair (genre, group) and the days before."""
    rng = random.Random(4)
    rows = []
    for i in range(48):
        author, genre, group = AUTHORS[i % 4], ["econ", "poem", "life"][i % 3], ["book", "kindle"][i // 3 % 2]
        level = 1000 + 400 * AUTHORS.index(author) + (900 if (genre, group) in (("econ", "book"), ("poem", "kindle")) else 0)
        x = level
        for d in range(40):
            x = level + 0.8 * (x - level) + rng.gauss(0, 60)
            rows.append((f"i{i:02d}", d, int(x), author, genre, group, f"{author} {genre} tale"))
    return _daily(spark, rows).persist()


def test_factor_machine_learns_categories_and_their_pairs(spark, daily, tmp_path):
    maps = fit_serving_maps(daily)
    sizes = M.rank_sizes(maps)
    held = F.col("asin") >= "i36"
    table = M.rank_vectors(rank_feature_table(daily, maps), sizes)
    scale = M.fit_scale(table.where(~held), "rank")
    table = table.withColumn("scaled", scale.scaled("rank"))
    fm = M.factor_machine(iterations=60)
    grid = [{fm.factorSize: 4, fm.regParam: r} for r in (5.0, 0.001)]
    valid = F.col("date") == "07"
    chosen = M.select_model(Pipeline(stages=[fm]), grid, table.where(~held & ~valid), table.where(~held & valid), "scaled",
                            str(tmp_path / "fm"))
    rows = M.report(chosen, ["strong", "weak"], table.where(held), scale, "rank").collect()
    assert chosen.losses[chosen.best] == min(chosen.losses) and [r.kept for r in rows].count(True) == 1
    kept = next(r for r in rows if r.kept)
    assert kept.test_rmse < 0.6 * kept.mean_predictor_rmse and kept.test_r2 > 0.6
    factors = M.category_factors(chosen.model, spark, sizes, len(CYCLIC))
    assert factors.count() == sum(sizes.values())
    assert factors.where("column = 'author_code'").count() == 4 and len(factors.first().factors) == 4


def test_sequence_regression_beats_the_mean(spark, daily, tmp_path):
    items = M.item_attributes(daily)
    maps = M.fit_item_maps(items)
    samples = M.sequence_samples(daily, M.item_vectors(items, maps))
    assert samples.count() == 48 * 30
    one = samples.where("asin = 'i05'").orderBy("timestamp").first()
    days = daily.where("asin = 'i05'").orderBy("timestamp").limit(11).collect()
    assert [one.dynamic[7 * k] for k in range(10)] == [float(d["rank"]) for d in days[:10]] and one.target == days[10]["rank"]
    vectors = M.sequence_vectors(samples, maps.sizes)
    first = vectors.first()
    assert first.features.size == 70 + first.static.size
    assert first.static.size == sum(n + 1 for c, n in maps.sizes.items() if c != "token") + 10 * (maps.sizes["token"] + 1)
    held = F.col("asin") >= "i36"
    scale = M.fit_scale(vectors.where(~held), "target")
    vectors = vectors.withColumn("scaled", scale.scaled("target"))
    net = M.elastic_net()
    valid = F.col("asin") >= "i30"
    chosen = M.select_model(Pipeline(stages=[net]), [{net.regParam: r} for r in (5.0, 0.005)],
                            vectors.where(~valid), vectors.where(valid & ~held), "scaled", str(tmp_path / "net"))
    kept = next(r for r in M.report(chosen, ["a", "b"], vectors.where(held), scale, "target").collect() if r.kept)
    assert chosen.best == 1 and kept.test_rmse < 0.5 * kept.mean_predictor_rmse


def test_unknown_values_have_a_place_of_their_own(spark, daily):
    df = spark.createDataFrame([(0, 2), (-1, 3), (5, 0), (None, 1)], "a int, b int")
    got = [r[0] for r in M.encode_static(df, {"a": 2, "b": 3}).select(M.active_places("static")).collect()]
    assert got == ["0,5", "2,6", "2,3", "2,4"]
    maps = M.fit_item_maps(M.item_attributes(daily))
    strange = _daily(spark, [("new", d, 5, "nobody", "none", "book", "") for d in range(12)])
    samples = M.sequence_samples(strange, M.item_vectors(M.item_attributes(strange), maps)).collect()
    assert len(samples) == 2 and samples[0].author_code == -1 and samples[0].title_seq == [0] * 10


# -- serving -------------------------------------------------------------------

REQUESTS = [("r1", 2, 15, 6, "econ", "book"), ("r2", 2, 15, 6, "econ", "book"), ("r3", 0, 1, 1, "unlisted", "book"),
            ("r4", 0, 1, 1, "econ", "stone"), ("r5", 7, 1, 1, "econ", "book"), ("r6", 0, None, 1, "econ", "book"),
            ("r7", 0, 1, 1, "lone", "kindle"), ("r8", 0, 1, 1, None, None)]


@pytest.fixture(scope="module")
def store(spark, daily, tmp_path_factory):
    extra = _daily(spark, [("x1", 0, 9, "ann", "lone", "book", "single")])
    path = str(tmp_path_factory.mktemp("store"))
    both = daily.unionByName(extra)
    maps = fit_serving_maps(both)
    V.save_store(both, maps, path)
    return V.load_store(spark, path)


def test_requests_are_answered_or_refused(spark, store):
    catalogue, maps = store
    requests = spark.createDataFrame(REQUESTS, "request_id string, day int, date int, month int, genre string, group_name string")
    scorer = linear_scorer({"author_code": -10.0, "month_sin": 3.0}, 100.0)
    rows = V.serve(requests, catalogue, maps, scorer, k=3).collect()
    status = {r.request_id: r.status for r in rows}
    assert status == {"r1": V.OK, "r2": V.OK, "r3": V.NO_GENRE, "r4": V.NO_GROUP, "r5": V.NO_DATE, "r6": V.NO_DATE,
                      "r7": V.NO_TITLES, "r8": V.NO_GENRE}
    best = sorted((r.position, r.title, r.predicted_rank) for r in rows if r.request_id == "r1")
    assert [p for p, _, _ in best] == [1, 2, 3][:len(best)] and len({t for _, t, _ in best}) == len(best)
    assert [r for _, _, r in best] == sorted(r for _, _, r in best)
    assert best == sorted((r.position, r.title, r.predicted_rank) for r in rows if r.request_id == "r2")
    assert all(r.position is None for r in rows if r.status != V.OK)
    assert V.serve(requests.limit(0), catalogue, maps, scorer).count() == 0


def test_serving_reads_the_store_alone_and_limits_ranks(spark, store):
    catalogue, maps = store
    requests = spark.createDataFrame(REQUESTS, "request_id string, day int, date int, month int, genre string, group_name string")
    plan = V.serve(requests, catalogue, maps, linear_scorer({"author_code": 1.0}, 0.0))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    sources = [line for line in plan.splitlines() if "Location:" in line]
    assert sources and all("/store" in line for line in sources)


def test_a_learned_model_serves_requests(spark, daily, store, tmp_path):
    catalogue, maps = store
    sizes = M.rank_sizes(maps)
    table = M.rank_vectors(rank_feature_table(daily, maps), sizes)
    scale = M.fit_scale(table, "rank")
    table = table.withColumn("scaled", scale.scaled("rank"))
    fm = M.factor_machine(iterations=60)
    chosen = M.select_model(Pipeline(stages=[fm]), [{fm.regParam: 0.001}], table, table, "scaled", str(tmp_path / "fm"))
    requests = spark.createDataFrame(REQUESTS[:1], "request_id string, day int, date int, month int, genre string, group_name string")
    rows = V.serve(requests, catalogue, maps, V.vector_scorer(chosen.model, sizes, scale)).orderBy("position").collect()
    # the levels rise with the author
    assert [r.title.split()[0] for r in rows] == sorted(r.title.split()[0] for r in rows) and len(rows) >= 2
