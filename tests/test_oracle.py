"""Every registered query against its DuckDB oracle at sf0.001 (row count,
column names, order-insensitive values); queries without an oracle must run."""

import duckdb
import pytest

import __spark_entry__ as E
from rankflow.plans.catalog import TABLES
from scripts.check_oracle import digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert rows, name
        return
    r = con.execute(sql)
    ocols = [d[0] for d in r.description]
    orows = r.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(cols, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["asin", "timestamp", "rank", "year", "month", "date", "day", "group_name",
                          "format", "title", "author", "publisher", "genre"]
