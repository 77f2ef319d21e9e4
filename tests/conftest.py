import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tillroll-tests")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as a sorted list of tuples, for comparison as a multiset."""

    def collect(frame, *columns):
        picked = frame.select(*columns) if columns else frame
        return sorted((tuple(row) for row in picked.collect()), key=repr)

    return collect


ORDERS = "order_id string, customer_id string, order_status string, order_purchase_timestamp string"
ITEMS = "order_id string, order_item_id int, product_id string, price double, freight_value double"
REVIEWS = "review_id string, order_id string, review_score int"


@pytest.fixture(scope="session")
def make(spark):
    """Frames with the columns the reports use, from plain tuples."""

    class Make:
        @staticmethod
        def orders(data):
            return spark.createDataFrame(data, ORDERS)

        @staticmethod
        def items(data):
            return spark.createDataFrame(data, ITEMS)

        @staticmethod
        def reviews(data):
            return spark.createDataFrame(data, REVIEWS)

        @staticmethod
        def frame(data, schema):
            return spark.createDataFrame(data, schema)

    return Make()


@pytest.fixture(scope="session")
def fanout(make):
    """One order with two items and two reviews, one unreviewed, one without items."""
    orders = make.orders(
        [
            ("a", "c1", "delivered", "2018-01-05 10:00:00"),
            ("b", "c1", "delivered", "2018-02-05 10:00:00"),
            ("c", "c2", "canceled", None),
            ("d", "c2", "shipped", "2018-02-06 10:00:00"),
        ]
    )
    items = make.items(
        [
            ("a", 1, "p1", 10.0, 1.0),
            ("a", 2, "p2", 20.0, 2.0),
            ("b", 1, "p1", 5.25, 0.5),
            ("d", 1, "p3", 7.0, 0.25),
        ]
    )
    reviews = make.reviews(
        [("r1", "a", 5), ("r2", "a", 2), ("r3", "d", None), ("r4", "zz", 1)]
    )
    return orders, items, reviews
