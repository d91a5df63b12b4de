"""Every registered query against its SQL on the smallest tables, and the shape of its plan."""

import duckdb
import pytest

import __spark_entry__ as entry
from feedloom.workload.registry import QUERIES, TABLES
from tools.check_oracles import rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    answer = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, answer.fetchall())


def test_flagship(spark):
    assert entry.entry(spark).count() == 3
