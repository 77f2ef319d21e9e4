import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillroll.operators.joins import Target
from tillroll.plans import reports


def plain_metrics(orders, items, reviews):
    """The plain three-way join with its fan-out, in floating point."""
    joined = orders.join(items, "order_id").join(reviews, "order_id", "left")
    return joined.groupBy("order_id", "customer_id", "order_status").agg(
        F.sum("price").alias("spend_total"),
        F.sum("freight_value").alias("freight_total"),
        F.count("order_item_id").cast("double").alias("item_count"),
        F.avg("review_score").alias("avg_score"),
    )


def exact_mean(amount):
    """Half cents are exact in decimals; the mean of doubles may fall to either side."""
    return F.expr(f"cast(round(avg(cast({amount} AS decimal(14, 2))), 2) AS double)")


def random_tables(make, seed, n_orders=30):
    """Repeated orders, null keys and values, hot orders, unmatched items and reviews."""
    rng = random.Random(seed)

    def order_id():
        return rng.choice([None, "o0", "o0", "o0", *(f"o{i}" for i in range(n_orders))])

    def maybe(value):
        return None if rng.random() < 0.15 else value

    orders = [
        (
            order_id(),
            maybe(f"c{rng.randrange(6)}"),
            maybe(rng.choice(["delivered", "shipped", "canceled"])),
            maybe(f"2018-{rng.randrange(1, 13):02d}-05 10:00:00"),
        )
        for _ in range(40)
    ]
    items = [
        (
            order_id(),
            maybe(rng.randrange(1, 5)),
            f"p{rng.randrange(8)}",
            maybe(rng.randrange(100_000) / 100),
            maybe(rng.randrange(5_000) / 100),
        )
        for _ in range(150)
    ]
    reviews = [(f"r{i}", order_id(), maybe(rng.randrange(1, 6))) for i in range(80)]
    return make.orders(orders), make.items(items), make.reviews(reviews)


def near(rows):
    return Counter(
        tuple(round(value, 4) if isinstance(value, float) else value for value in row)
        for row in rows
    )


def test_order_metrics_keep_the_fan_out(fanout, rows):
    metrics = reports.order_metrics(*fanout)
    assert rows(metrics) == [
        ("a", "c1", "delivered", 60.0, 6.0, 4.0, 3.5),
        ("b", "c1", "delivered", 5.25, 0.5, 1.0, None),
        ("d", "c2", "shipped", 7.0, 0.25, 1.0, None),
    ]


def test_order_metrics_without_fan_out(fanout, rows):
    metrics = reports.order_metrics_no_fanout(*fanout)
    assert rows(metrics, "order_id", "spend_total", "freight_total", "item_count") == [
        ("a", 30.0, 3.0, 2.0),
        ("b", 5.25, 0.5, 1.0),
        ("d", 7.0, 0.25, 1.0),
    ]


def test_consolidated_rows(fanout, rows):
    table = reports.consolidated(*fanout)
    assert rows(table, "order_id", "product_id", "customer_id", "review_id") == [
        ("a", "p1", "c1", "r1"),
        ("a", "p1", "c1", "r2"),
        ("a", "p2", "c1", "r1"),
        ("a", "p2", "c1", "r2"),
        ("b", "p1", "c1", None),
        ("d", "p3", "c2", "r3"),
    ]
    assert table.columns.count("order_id") == 1


def test_sales_by_status(fanout, rows):
    orders, items, _ = fanout
    assert [tuple(row) for row in reports.sales_by_status(orders, items).collect()] == [
        ("delivered", 2, 35.25, 11.75),
        ("shipped", 1, 7.0, 7.0),
    ]


def test_monthly_sales_skip_undated_orders(fanout):
    orders, items, _ = fanout
    undated = items.union(items.limit(1).withColumn("order_id", F.lit("c")))
    assert [tuple(row) for row in reports.monthly_sales(orders, undated).collect()] == [
        ("2018-01", 1, 30.0),
        ("2018-02", 2, 12.25),
    ]


def test_customer_reports(fanout):
    orders, items, _ = fanout
    assert [tuple(row) for row in reports.top_customers(orders, items).collect()] == [
        ("c1", 2, 38.75, 12.92),
        ("c2", 1, 7.25, 7.25),
    ]
    per_order = reports.avg_ticket_per_order(orders, items, k=1).collect()
    assert [tuple(row) for row in per_order] == [("c1", 2, 38.75, 19.38)]


def test_top_products_break_ties_by_id(make):
    items = make.items([("o", 1, p, 1.0, 0.0) for p in ("p4", "p2", "p3", "p1", "p2")])
    top = reports.top_products(items, k=3).collect()
    assert [tuple(row) for row in top] == [
        ("p2", 2, 2.0, 1.0), ("p1", 1, 1.0, 1.0), ("p3", 1, 1.0, 1.0)
    ]


def test_score_shares_count_reviews_without_score(make):
    reviews = make.reviews([("r1", "a", 5), ("r2", "a", None), ("r3", "b", 3), ("r4", "c", None)])
    assert [tuple(row) for row in reports.score_distribution(reviews).collect()] == [
        (3, 1, 25.0), (5, 1, 25.0)
    ]


@pytest.mark.parametrize("seed", range(4))
def test_metrics_equal_the_plain_join_on_messy_tables(make, seed):
    orders, items, reviews = random_tables(make, seed)
    expected = near(plain_metrics(orders, items, reviews).collect())
    assert near(reports.order_metrics(orders, items, reviews).collect()) == expected


@pytest.mark.parametrize("seed", range(4))
def test_sales_equal_the_plain_join_on_messy_tables(make, seed):
    orders, items, reviews = random_tables(make, seed)
    joined = orders.join(items, "order_id")
    plain = joined.groupBy("order_status").agg(
        F.count_distinct("order_id"), F.sum("price"), exact_mean("price")
    )
    assert near(reports.sales_by_status(orders, items).collect()) == near(plain.collect())
    amount = F.col("price") + F.col("freight_value")
    plain = joined.groupBy("customer_id").agg(
        F.count_distinct("order_id"), F.sum(amount), exact_mean("price + freight_value")
    )
    assert near(reports.top_customers(orders, items, k=100).collect()) == near(plain.collect())
    month = F.substring("order_purchase_timestamp", 1, 7)
    plain = joined.where("order_purchase_timestamp is not null").groupBy(month).agg(
        F.count_distinct("order_id"), F.sum("price")
    )
    assert near(reports.monthly_sales(orders, items).collect()) == near(plain.collect())


@pytest.mark.parametrize("seed", range(3))
def test_consolidated_equals_the_plain_join_with_hot_orders(make, seed):
    orders, items, reviews = random_tables(make, seed)
    plain = items.join(orders, "order_id").join(reviews, "order_id", "left")
    table = reports.consolidated(orders, items, reviews, target=Target(8, 20))
    assert table.columns == plain.columns
    assert Counter(table.collect()) == Counter(plain.collect())


def test_totals_agree_across_reports(make):
    orders, items, reviews = random_tables(make, 11)
    orders = orders.dropDuplicates(["order_id"]).where("order_purchase_timestamp is not null")
    by_status = reports.sales_by_status(orders, items).agg(F.sum("sales_total")).first()[0]
    by_month = reports.monthly_sales(orders, items).agg(F.sum("sales_total")).first()[0]
    metrics = reports.order_metrics_no_fanout(orders, items, reviews)
    by_order = metrics.agg(F.sum("spend_total")).first()[0]
    assert by_status == pytest.approx(by_month) == pytest.approx(by_order)


def test_results_do_not_depend_on_partitioning(make):
    tables = random_tables(make, 5)
    results = set()
    for partitions in (1, 3, 8):
        orders, items, reviews = (table.repartition(partitions) for table in tables)
        results.add(
            (
                str(reports.sales_by_status(orders, items).collect()),
                str(reports.top_customers(orders, items).collect()),
                str(sorted(map(str, reports.order_metrics(orders, items, reviews).collect()))),
            )
        )
    assert len(results) == 1


def test_empty_inputs(make):
    orders, items, reviews = make.orders([]), make.items([]), make.reviews([])
    assert reports.sales_by_status(orders, items).count() == 0
    assert reports.monthly_sales(orders, items).count() == 0
    assert reports.top_customers(orders, items).count() == 0
    assert reports.top_products(items).count() == 0
    assert reports.score_distribution(reviews).count() == 0
    assert reports.order_metrics(orders, items, reviews).count() == 0
    assert reports.consolidated(orders, items, reviews).count() == 0


def test_items_are_combined_before_the_shuffle_and_never_meet_reviews(fanout, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = reports.order_metrics(*fanout)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    # One shuffle each for items, reviews and orders.
    assert text.count("Exchange hashpartitioning") == 3


def test_reports_shuffle_each_table_once(fanout, spark):
    orders, items, _ = fanout
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for report in (reports.sales_by_status, reports.monthly_sales, reports.top_customers):
            text = report(orders, items)._jdf.queryExecution().executedPlan().toString()
            # two by order and one by the dimension
            assert text.count("Exchange hashpartitioning(order_id") == 2
            assert text.count("Exchange hashpartitioning") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_orders_are_folded_without_hash_maps_of_joined_rows(fanout, spark):
    """After the shuffles only items and scores fill hash maps; joined rows are folded sorted."""
    orders, items, reviews = fanout
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        metrics = reports.order_metrics(orders, items, reviews)
        for frame, tables in ((metrics, 2), (reports.top_customers(orders, items), 1)):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert plan.count("HashAggregate(keys=[order_id") == 2 * tables  # partial and final
            assert not re.search(r"HashAggregate\(keys=\[order_id[^\]]*,", plan)
        # Items, the widest rows, come after the fold, which leaves rows sorted for that join.
        plan = metrics._jdf.queryExecution().executedPlan().toString()
        assert plan.index("SortAggregate") < plan.index("price_units")
        assert len(re.findall(r"[+:]- Sort \[", plan)) == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
