"""Every registered query against its SQL on the smallest tables, and the shape of its plan."""

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check_oracle import TABLES, kinds, rows_of

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_oracle_names_are_registered():
    assert set(ORACLE) <= set(QUERIES)


def test_flagship_query(spark):
    df = contract.entry(spark)
    assert df.columns == ["value", "n"] and df.count() == 25


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                     "BroadcastNestedLoopJoin"):
        assert unwanted not in plan
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert kinds(got) == kinds(want)
    assert got == want
