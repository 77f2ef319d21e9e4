"""Every registered query against its DuckDB twin, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from conftest import TESTDATA
from tillroll.plans.catalog import QUERIES
from tillroll.plans.oracles import ORACLES

FOLDER = f"{TESTDATA}/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER",
         "boolean": "BOOLEAN"}
ORDERED = ["sales_by_status", "top_products", "score_distribution", "top_customers",
           "monthly_sales", "top_items_by_price", "top_orders", "profile_by_status"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def in_name_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(row[i] for i in order) for row in rows]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_values_equal_the_oracle(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    expected = duck.sql(ORACLES[name])
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {column: TYPES[kind] for column, kind in frame.dtypes} == types
    ours = in_name_order(frame.columns, frame.collect())
    theirs = in_name_order(expected.columns, expected.fetchall())
    assert len(ours) > 0
    if name not in ORDERED:
        ours, theirs = sorted(ours, key=repr), sorted(theirs, key=repr)
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_without_oracle_give_finite_rows(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    rows = frame.collect()
    assert len(rows) > 0
    assert all(math.isfinite(v) for row in rows for v in row if isinstance(v, float))


def test_entry(spark):
    assert entry_points.entry(spark).columns == [
        "order_status", "n_orders", "sales_total", "avg_price"
    ]
