import pytest
from pyspark.sql import functions as F

from tillroll.functions.columns import key_bucket, month_of, percent_of
from tillroll.operators import grouping, inspection, ranking, rows as row_ops

ITEMS = [
    ("a", 1, "p1", 10.0, 1.0),
    ("a", 2, "p2", 120.5, 2.0),
    ("b", 1, "p1", None, 0.5),
    ("c", 1, "p3", 100.0, 0.25),
]


def test_projection_and_keyed_sum(make, rows):
    items = make.items(ITEMS)
    assert rows(row_ops.project(items, "price")) == [(10.0,), (100.0,), (120.5,), (None,)]
    pairs = row_ops.keyed_sum(items, "order_id", ["price", "freight_value"], "total")
    assert rows(pairs) == [("a", 11.0), ("a", 122.5), ("b", None), ("c", 100.25)]


def test_filter_is_strict_and_drops_nulls(make, rows):
    assert rows(row_ops.above(make.items(ITEMS), "price", 100), "price") == [(120.5,)]


def test_expansion_gives_one_row_per_column(make, rows):
    expanded = row_ops.expand_columns(make.items(ITEMS), ["order_id", "product_id"], "id")
    assert rows(expanded) == sorted(
        [(row[0],) for row in ITEMS] + [(row[2],) for row in ITEMS]
    )


def test_incomplete_rows_and_labels(make, rows):
    frame = make.frame([(1, 4.0), (2, 3.99), (3, None)], "id int, score double")
    assert rows(row_ops.drop_incomplete(frame, ["score"]), "id") == [(1,), (2,)]
    labelled = row_ops.label_at_least(frame, "score", 4, "good")
    assert rows(labelled, "id", "good") == [(1, 1.0), (2, 0.0), (3, 0.0)]


def test_grouping(make, rows):
    items = make.items(ITEMS)
    assert rows(grouping.count_per_key(items, "product_id")) == [("p1", 2), ("p2", 1), ("p3", 1)]
    sums = grouping.sum_per_key(items, "order_id", "price + freight_value", "total")
    assert rows(sums) == [("a", 133.5), ("b", None), ("c", 100.25)]
    assert rows(grouping.distinct_values(items, "product_id")) == [("p1",), ("p2",), ("p3",)]


def test_numeric_summary_skips_nulls(make):
    row = grouping.numeric_summary(make.items(ITEMS), "price").first()
    assert row.asDict() == {
        "n_values": 3,
        "sum_value": 230.5,
        "avg_value": 76.83,
        "stddev_value": 58.78,
        "min_value": 10.0,
        "max_value": 120.5,
    }


def test_numeric_summary_of_an_empty_table(make):
    row = grouping.numeric_summary(make.items([]), "price").first()
    assert row["n_values"] == 0 and row["sum_value"] is None and row["avg_value"] is None


def test_top_k_breaks_ties_by_key(make):
    ties = make.frame([("p4", 2), ("p1", 2), ("p3", 2), ("p2", 2), ("p0", 1)], "p string, n int")
    for partitions in (1, 3, 8):
        top = ranking.top_k(ties.repartition(partitions), "n", 3, ["p"]).collect()
        assert [row["p"] for row in top] == ["p1", "p2", "p3"]


def test_top_k_keeps_k_rows_per_task_without_a_full_sort(make):
    plan = ranking.top_k(make.items(ITEMS), "price", 2, ["product_id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_head_orders_by_key(make, rows):
    frame = make.items(ITEMS[::-1])
    assert rows(ranking.head(frame, 2, ["order_id", "order_item_id"]), "product_id") == [
        ("p1",), ("p2",)
    ]


def test_counts_and_schemas(make, rows):
    tables = {"items": make.items(ITEMS), "empty": make.reviews([])}
    assert rows(grouping.table_counts(tables)) == [("empty", 0), ("items", 4)]
    schemas = inspection.table_schemas(tables)
    assert schemas.columns == ["table_name", "position", "col_name", "data_type", "n_rows"]
    assert rows(schemas.where("table_name = 'empty'")) == [
        ("empty", 1, "review_id", "string", 0),
        ("empty", 2, "order_id", "string", 0),
        ("empty", 3, "review_score", "int", 0),
    ]


def test_describe_and_explain(make):
    items = make.items(ITEMS)
    described = inspection.describe_view(items).collect()
    assert [(row["col_name"], row["data_type"]) for row in described] == items.dtypes
    sums = grouping.sum_per_key(items, "order_id", "price", "total")
    plan = inspection.explain_view(sums).first()["plan"]
    for title in ("Parsed", "Analyzed", "Optimized", "Physical"):
        assert f"== {title}" in plan
    assert plan.count("HashAggregate") == 2 and "Exchange hashpartitioning(order_id" in plan


def test_column_expressions(make):
    frame = make.frame([("2018-03-09 11:00:00", 1), (None, 2)], "ts string, n int")
    months = frame.select(month_of(F.col("ts")).alias("m")).collect()
    assert [row["m"] for row in months] == ["2018-03", None]
    shares = frame.select(percent_of(F.col("n"), F.lit(16)).alias("pct")).collect()
    assert [row["pct"] for row in shares] == [6.25, 12.5]


@pytest.mark.parametrize("buckets", [2, 10])
def test_key_bucket_is_even_and_independent_of_type(spark, buckets):
    ids = spark.range(20_000)
    bucket = key_bucket(F.col("id"), buckets)
    counts = [row["count"] for row in ids.groupBy(bucket.alias("b")).count().collect()]
    assert len(counts) == buckets and max(counts) < 1.15 * min(counts)
    as_text = key_bucket(F.col("id").cast("string"), buckets)
    assert ids.where(bucket != as_text).count() == 0
