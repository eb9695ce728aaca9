"""Every registered query against its SQL on the smallest tables, and what its plan must not contain."""

import os

import duckdb
import pytest

import __spark_entry__
from workload import oracle, registry
from workload.binding import SCHEMAS

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), oracle.statements()
WRITES = {
    "load_overwrite", "load_report", "reviews_scored_csv", "recs_text", "findings_text", "text_report", "csv_rejects",
    "clean_customers", "clean_reviews", "clean_engagement", "clean_geography", "clean_products",
    "load_versions", "load_versions_report",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def reference():
    connection = duckdb.connect()
    for name in SCHEMAS:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return connection


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, reference, name):
    df = QUERIES[name](spark, SF_DIR)
    if name not in WRITES:
        plan = df._jdf.queryExecution().toString()
        for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
            assert unwanted not in plan
    found = df.collect()
    if name not in SQL:
        assert found
        return
    cursor = reference.execute(SQL[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(df.columns) == sorted(columns)

    def key(row):
        return [(value is None, str(type(value)), value if value is not None else 0) for value in row]

    expected = sorted((tuple(row[columns.index(c)] for c in df.columns) for row in cursor.fetchall()), key=key)
    assert sorted((tuple(row) for row in found), key=key) == expected


def test_reviewer_join_is_dropped_where_unread(spark):
    def scans_orders(name):
        return "orders.parquet" in QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()

    assert not scans_orders("lowest_rated_products")
    assert not scans_orders("geo_performance")
    assert scans_orders("clean_strip")


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
