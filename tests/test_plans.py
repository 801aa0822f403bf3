"""Plan tests: no row-at-a-time Python UDF in any registered query, scans
pruned and filters pushed, no single-task window over the data."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
NAMES = sorted(E.queries())


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in NAMES if not n.startswith("train_")])
def test_no_row_python_udf(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "BatchEvalPython" not in plan


def test_daily_scan_is_pruned(spark):
    plan = _plan(E.queries()["daily_min_rank"](spark, SF))
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_filter_pushed_to_scan(spark):
    from pyspark.sql import functions as F
    df = spark.read.parquet(f"{SF}/orders.parquet").where(F.col("o_custkey") == 7).select("o_orderkey")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(o_custkey), EqualTo(o_custkey,7)]" in plan


@pytest.mark.parametrize("name", ["sequence_global", "trend_smoothed", "position_split",
                                  "label_encode", "word_index"])
def test_positional_queries_do_not_window_the_whole_table(spark, name, monkeypatch):
    """The only single-partition exchange is the one over the per-partition
    row counts (one row per partition).  What is handed to ``materialize`` is
    looked at as well, before it is written."""
    import rankflow.session as session
    import sys
    plans = []
    real = session.materialize

    def spy(df):
        plans.append(_plan(df))
        return real(df)

    for mod in list(sys.modules.values()):
        if getattr(mod, "__name__", "").startswith("rankflow.") and getattr(mod, "materialize", None) is real:
            monkeypatch.setattr(mod, "materialize", spy)
    plans.append(_plan(E.queries()[name](spark, SF)))
    for plan in plans:
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "SinglePartition" in line:
                below = "\n".join(lines[i:i + 4])
                assert "_rf_" in below, below
