"""Business reports over orders, items and reviews.

Reports that join start by folding items and reviews to one row per order. Partial
aggregation combines the rows of a hot order before they are shuffled, and no item meets a
review: what the join would have repeated is multiplied instead. Orders meet these rows in
place and are folded after the join, where those that occur more than once leave a
``copies`` count; so each table is shuffled once, and results equal those of the plain join
for any input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import month_of, percent_of
from tillroll.functions.money import ExactSum
from tillroll.operators.joins import TARGET, Target, left_join_with_parent
from tillroll.operators.ranking import top_k

AMOUNT = ExactSum("amount")
PRICE = ExactSum("price")
FREIGHT = ExactSum("freight")


def sales_by_status(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders, sales and mean item price per order status, largest sales first."""
    sales = _sales_per(orders, items, "order_status", "price")
    return sales.select(
        "order_status",
        "n_orders",
        AMOUNT.rounded().alias("sales_total"),
        AMOUNT.mean("n_amounts").alias("avg_price"),
    ).orderBy(F.col("sales_total").desc(), "order_status")


def monthly_sales(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders and sales per month of purchase; orders without a timestamp are left out."""
    dated = orders.where(F.col("order_purchase_timestamp").isNotNull()).select(
        "order_id", month_of(F.col("order_purchase_timestamp")).alias("month")
    )
    sales = _sales_per(dated, items, "month", "price")
    return sales.select("month", "n_orders", AMOUNT.rounded().alias("sales_total")).orderBy("month")


def top_customers(orders: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The customers with the highest spend, price and freight together.

    ``avg_ticket`` is the mean per item; :func:`avg_ticket_per_order` gives the other one.
    """
    return _top_spenders(orders, items, k).select(
        "customer_id",
        "n_orders",
        "spend_total",
        AMOUNT.mean("n_amounts").alias("avg_ticket"),
    )


def avg_ticket_per_order(orders: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The same customers with their spend per order."""
    return _top_spenders(orders, items, k).select(
        "customer_id",
        "n_orders",
        "spend_total",
        AMOUNT.mean("n_orders").alias("avg_ticket_per_order"),
    )


def top_products(items: DataFrame, k: int = 10) -> DataFrame:
    """The products sold most often, with revenue and mean price."""
    sales = (
        items.select("product_id", "price", *PRICE.split("price"))
        .groupBy("product_id")
        .agg(F.count("*").alias("n_sold"), F.count("price").alias("n_prices"), *PRICE.sums())
    )
    return top_k(sales, "n_sold", k, ["product_id"]).select(
        "product_id",
        "n_sold",
        PRICE.rounded().alias("revenue"),
        PRICE.mean("n_prices").alias("avg_price"),
    )


def score_distribution(reviews: DataFrame) -> DataFrame:
    """Reviews per score, and their share of all reviews, scored or not."""
    n_reviews = reviews.agg(F.count("*")).scalar()
    return (
        reviews.where(F.col("review_score").isNotNull())
        .groupBy("review_score")
        .agg(F.count("*").alias("n"))
        .select("review_score", "n", percent_of(F.col("n"), n_reviews).alias("pct"))
        .orderBy("review_score")
    )


def order_metrics(orders: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Spend, freight, item count and mean score per order, as the plain join gives them.

    With two or more reviews the plain join repeats each item, and so the first three
    values; :func:`order_metrics_no_fanout` gives them once.
    """
    return _order_metrics(orders, items, reviews, "copies * coalesce(n_reviews, 1)")


def order_metrics_no_fanout(
    orders: DataFrame, items: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Like :func:`order_metrics`, with each item counted once."""
    return _order_metrics(orders, items, reviews, "1")


def consolidated(
    orders: DataFrame, items: DataFrame, reviews: DataFrame, target: Target = TARGET
) -> DataFrame:
    """Every item with its order and, where there are any, each of the order's reviews."""
    return left_join_with_parent(items, orders, reviews, "order_id", target)


def _folded(joined: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per order and ``columns``, with the number of ``copies`` it had.

    The other columns depend on the order alone. Rows are in place after a join by order,
    so that no further shuffle is needed. The other columns are taken as one struct: Spark
    folds such rows in sorted order, with the memory of one sort instead of two hash maps,
    and a join by order that follows needs no sort of its own.
    """
    rest = [name for name in joined.columns if name not in ("order_id", *columns)]
    folded = joined.groupBy("order_id", *columns).agg(
        F.count("*").alias("copies"), F.first(F.struct(*rest)).alias("rest")
    )
    return folded.select("order_id", *columns, "copies", "rest.*")


def _sales_per(orders: DataFrame, items: DataFrame, dimension: str, amount: str) -> DataFrame:
    """Orders and the exact sum of ``amount`` per value of one order column."""
    per_order = (
        items.select("order_id", F.expr(f"{amount} AS amount"), *AMOUNT.split(amount))
        .groupBy("order_id")
        .agg(F.count("amount").alias("n_amounts"), *AMOUNT.sums())
    )
    # Each order and dimension value is left once, so rows count distinct orders.
    return (
        _folded(orders.select("order_id", dimension).join(per_order, "order_id"), [dimension])
        .groupBy(dimension)
        .agg(
            F.count("*").alias("n_orders"),
            F.expr("sum(n_amounts * copies) AS n_amounts"),
            *AMOUNT.again("copies"),
        )
    )


def _top_spenders(orders: DataFrame, items: DataFrame, k: int) -> DataFrame:
    spend = _sales_per(orders, items, "customer_id", "price + freight_value")
    spend = spend.select("*", AMOUNT.rounded().alias("spend_total"))
    return top_k(spend, "spend_total", k, ["customer_id"])


def _order_metrics(
    orders: DataFrame, items: DataFrame, reviews: DataFrame, times: str
) -> DataFrame:
    per_order = (
        items.select(
            "order_id", "order_item_id", *PRICE.split("price"), *FREIGHT.split("freight_value")
        )
        .groupBy("order_id")
        .agg(F.count("order_item_id").alias("n_items"), *PRICE.sums(), *FREIGHT.sums())
    )
    scores = reviews.groupBy("order_id").agg(
        F.count("*").alias("n_reviews"), F.avg("review_score").alias("avg_score")
    )
    # Orders are folded with their scores only, as items have far wider rows.
    columns = ["customer_id", "order_status"]
    scored = orders.select("order_id", *columns).join(scores, "order_id", "left")
    return _folded(scored, columns).join(per_order, "order_id").select(
        "order_id",
        "customer_id",
        "order_status",
        PRICE.total(times).alias("spend_total"),
        FREIGHT.total(times).alias("freight_total"),
        F.expr(f"cast(n_items * ({times}) AS double) AS item_count"),
        "avg_score",
    )
