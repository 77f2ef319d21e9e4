"""Filters and columns reach the scans, and no Python runs in the data path."""

import re

import pytest

from conftest import TESTDATA
from tillroll.plans.catalog import QUERIES

FOLDER = f"{TESTDATA}/sf0.001"
LAZY = [
    "map_price", "item_sales_pairs", "filter_premium", "flatmap_ids", "join_inner", "join_left",
    "consolidated", "product_counts", "order_sales", "price_stats", "distinct_products",
    "top_items_by_price", "sales_by_status", "top_products", "score_distribution",
    "top_customers", "monthly_sales", "order_metrics", "clean_order_metrics", "split_counts",
    "kmeans_assign_fixed", "profile_by_status",
]


def physical_plan(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_pairwise_join(spark, name):
    plan = physical_plan(spark, name)
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop", "Window"):
        assert word not in plan


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("filter_premium", "GreaterThan(l_extendedprice,50000.0)"),
        ("monthly_sales", "IsNotNull(o_orderdate)"),
        ("join_inner", "IsNotNull(l_orderkey)"),
        ("order_metrics", "IsNotNull(l_orderkey)"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in physical_plan(spark, name)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("map_price", [{"l_extendedprice"}]),
        ("distinct_products", [{"l_partkey"}]),
        ("top_products", [{"l_partkey", "l_extendedprice"}]),
        ("sales_by_status", [{"o_orderkey", "o_orderstatus"}, {"l_orderkey", "l_extendedprice"}]),
        ("score_distribution", [{"event_type", "value"}, set()]),
        ("table_counts", [set(), set(), set()]),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", physical_plan(spark, name))
    read = [{part.split(":")[0] for part in schema.split(",") if part} for schema in schemas]
    assert sorted(read, key=sorted) == sorted(columns, key=sorted)
