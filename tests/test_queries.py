"""Every query against its SQL twin, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from ledgerloom.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


@pytest.fixture(scope="module")
def database():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, database, name):
    result = entry.queries()[name](spark, FOLDER)
    cursor = database.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    assert sorted(map(repr, cursor.fetchall())) == sorted(
        repr(tuple(r)) for r in result.select(*columns).collect()
    )


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert rows and {type(r["total_amount"]) for r in rows} == {float}


@pytest.mark.parametrize("name", ["monthly_revenue", "revenue_by_category", "top3_per_group", "daily_change", "running_total"])
def test_reports_scan_the_lines_once(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1 and plan.count("orders.parquet") == 1
