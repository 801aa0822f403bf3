"""What a task holds, reads or repeats does not grow with the table."""

import time

import pytest
from pyspark.sql import functions as F

from rankflow.operators import serving, stats
from rankflow.operators.recommend import ServingMaps


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reverse_anova_in_tasks_of_few_rows(spark, monkeypatch):
    rows = [(float(i % 7), i % 3 if i % 11 else None, float("nan") if i % 13 == 0 else i % 5 + 0.5) for i in range(300)]
    df = spark.createDataFrame([*rows, (None, 1, 1.0)], "t double, a int, b double")
    want = {r.column_name: r for r in stats.anova_pairs(df, [("a", "a", "t"), ("b", "b", "t")], None).collect()}
    monkeypatch.setattr(stats, "GROUP_ROWS", 20)
    got = {r.column_name: r for r in stats.anova_by_target(df, "t", ["a", "b"], None).collect()}
    assert set(got) == set(want) == {"a", "b"}
    for c, r in got.items():
        assert r.k == 7 and r.n == want[c].n and r.df_within == want[c].df_within
        assert r.f_stat == pytest.approx(want[c].f_stat, rel=1e-9)


def test_served_titles_are_found_without_a_sort_of_all_scores(spark):
    codes = {c: spark.createDataFrame([(v, 0)], "value string, code int") for c, v in (("genre", "g"), ("group_name", "book"))}
    scaler = spark.range(1).select(*[F.lit(x).alias(f"{c}__{e}") for c in serving.CYCLIC for e, x in (("min", -1.0), ("max", 1.0))])
    maps = ServingMaps(codes, None, scaler)
    shelf = spark.createDataFrame([("1", "a", "g", "book", 5.0), ("2", "a", "g", "book", -3.0), ("3", "b", "g", "book", 4.0),
                                   ("4", "c", "g", "book", 1.0), ("5", "c", "g", "book", None)],
                                  "asin string, title string, genre string, group_name string, prediction double")
    asked = spark.createDataFrame([("r", 1, 2, 3, "g", "book")], "request_id string, day int, date int, month int, genre string, group_name string")
    out = serving.serve(asked, shelf, maps, lambda df: df)
    assert "SortAggregate" not in _plan(out)
    assert [(r.position, r.title, r.predicted_rank) for r in out.orderBy("position").collect()] == [(1, "c", None), (2, "a", 3), (3, "b", 4)]


def test_machines_share_their_passes_and_equal_sparks(spark):
    """Sparse and dense rows, parts that are not 1, two parameter maps."""
    import random

    from pyspark.ml.linalg import Vectors
    from rankflow.operators import models as M
    from rankflow.operators.factors import fit_machines

    rng, rows = random.Random(1), []
    for i in range(400):
        a, b, z = rng.randrange(7), rng.randrange(30), [rng.choice([0.0, 0.5, 1.0]), rng.random()]
        parts = [(0, z[0]), (1, z[1]), (2 + a, 1.0), (10 + b, rng.choice([1.0, 2.0]) if i % 2 else 1.0)]
        vector = Vectors.sparse(45, [p for p in parts if p[1]]) if i % 5 else Vectors.dense([1.0, 0.0] * 22 + [3.0])
        rows.append((0.1 * a + 0.02 * b + z[1] + rng.gauss(0, 0.1), vector))
    df = spark.createDataFrame(rows, ["scaled", "features"]).repartition(3)
    fm = M.factor_machine(iterations=6)
    machines = [fm.copy({fm.factorSize: k, fm.regParam: r}) for k, r in ((2, 0.01), (3, 0.1))]
    for got, want in zip(fit_machines(machines, df), [m.fit(df) for m in machines]):
        assert got.intercept == pytest.approx(want.intercept, abs=1e-9)
        assert got.linear.toArray() == pytest.approx(want.linear.toArray(), abs=1e-9)
        assert got.factors.toArray().ravel() == pytest.approx(want.factors.toArray().ravel(), abs=1e-9)


def test_positions_are_a_table_not_a_checkpoint(spark):
    from rankflow.operators.ordering import with_position

    placed = with_position(spark.range(50).select((F.col("id") * 7 % 50).alias("v"), F.lit("wide").alias("w")), ["v"], "at", 4)
    assert "ExistingRDD" not in _plan(placed)
    assert [(r["v"], r["at"]) for r in placed.orderBy("at").collect()] == [(i, i) for i in range(50)]


def test_trees_on_blocks_equal_sparks(spark):
    """Integers, halves, a column of one value; with and
    without rows held out."""
    import random

    from rankflow.operators import boosting
    from rankflow.operators.learn import fit, rank_pipeline

    rng, rows = random.Random(1), []
    for i in range(600):
        a, b, c, d = rng.randrange(7), rng.randrange(-30, 70), rng.choice([0.0, 0.5, 1.0]), rng.gauss(0, 1)
        rows.append((a, b, c, d, 5, float(a * (b > 10) + 10 * c * d + rng.gauss(0, 0.3)), i % 10 == 3))
    df = spark.createDataFrame(rows, "a int, b int, c double, d double, e int, y double, v boolean").repartition(3).persist()
    for held in (None, "v"):
        line = rank_pipeline(["a", "b", "c", "d", "e"], label="y", validation_col=held, max_iter=3, max_depth=3)
        assert boosting.can_grow(line.getStages()[1])
        got, want = fit(line, df), line.fit(df)
        assert got.stages[1].getNumTrees == want.stages[1].getNumTrees
        scored = got.transform(df).select("y", "d", F.col("prediction").alias("p")).join(
            want.transform(df).select("y", "d", F.col("prediction").alias("q")), ["y", "d"])
        assert scored.count() == 600 and scored.where(F.abs(F.col("p") - F.col("q")) > 1e-9).isEmpty()


def test_rows_without_an_edge_send_an_empty_list(spark):
    from rankflow.operators.sequences import history_windows

    days = spark.range(40).select((F.col("id") % 3).cast("string").alias("k"), F.col("id").alias("t"), (F.col("id") * 2).alias("v"))
    made = history_windows(days, ["t"], ["v"], "v", key="k", length=3)
    assert "coalesce(CASE WHEN (_rf_idx" in _plan(made)
    rows = made.orderBy("k", "t").collect()
    assert len(rows) == 40 - 9 and all([h.v for h in r.history] == [r.target - 18, r.target - 12, r.target - 6] for r in rows)


def test_a_stored_table_leaves_no_shuffle_files(spark):
    from rankflow.session import materialize, remove

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {n for n in disk.getAllFiles().mkString("|").split("|") if "/shuffle_" in n}

    before = shuffled()
    table = materialize(spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("g")).count())
    for _ in range(50):  # the files go in the background
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before and table.count() == 7
    remove(table)
