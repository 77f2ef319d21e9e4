"""The three retail tables as views of a star schema stored as Parquet.

``orders`` and ``items`` rename columns of the sales tables. ``reviews`` is read from the
event stream: every tenth event counts for the order after its own, which gives orders
with no, one and two reviews, and error events carry no score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Names and types of the stored columns that the views use. With the types
# given, building a view runs no job to find them.
STORED_ORDERS = """
    o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz
"""
STORED_ITEMS = """
    l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
    l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz
"""
STORED_EVENTS = "event_id bigint, ts timestamp_ntz, event_type string, value double"
STORED_VISITS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def orders_view(spark: SparkSession, folder: str) -> DataFrame:
    stored = spark.read.schema(STORED_ORDERS).parquet(f"{folder}/orders.parquet")
    return stored.selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "o_orderstatus AS order_status",
        "cast(o_orderdate AS string) AS order_purchase_timestamp",
    )


def items_view(spark: SparkSession, folder: str) -> DataFrame:
    stored = spark.read.schema(STORED_ITEMS).parquet(f"{folder}/lineitem.parquet")
    return stored.selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS order_item_id",
        "l_partkey AS product_id",
        "l_suppkey AS seller_id",
        "cast(l_shipdate AS string) AS shipping_limit_date",
        "l_extendedprice AS price",
        "l_quantity AS freight_value",
    )


def reviews_view(spark: SparkSession, folder: str) -> DataFrame:
    stored = spark.read.schema(STORED_EVENTS).parquet(f"{folder}/events.parquet")
    return stored.selectExpr(
        "event_id AS review_id",
        "if(event_id % 10 = 0, event_id + 1, event_id) AS order_id",
        "if(event_type = 'error', null, cast(floor(value) AS int) % 5 + 1) AS review_score",
        "cast(ts AS string) AS review_creation_date",
    )


def events_view(spark: SparkSession, folder: str) -> DataFrame:
    """The browsing events themselves."""
    return spark.read.schema(STORED_VISITS).parquet(f"{folder}/events.parquet")


def retail_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "orders": orders_view(spark, folder),
        "items": items_view(spark, folder),
        "reviews": reviews_view(spark, folder),
    }
