"""The whole batch on CSV files in the fixed schemas, derived from the test tables."""

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from tillroll.plans import batch, reports
from tillroll.sources import sinks
from tillroll.sources.warehouse import retail_tables


@pytest.fixture(scope="module")
def paths(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    tables = retail_tables(spark, f"{TESTDATA}/sf0.001")
    tables["reviews"] = tables["reviews"].withColumn(
        "review_comment_message", F.lit('one "two",\nthree')
    )
    quoted = F.lit('say "so", and\\')
    tables["orders"] = tables["orders"].withColumn("order_estimated_delivery_date", quoted)
    tables["items"] = tables["items"].withColumn("seller_id", quoted)
    paths = {}
    for name, schema in batch.INPUTS.items():
        wanted = [line.split()[0] for line in schema.split(",")]
        columns = [
            F.col(c) if c in tables[name].columns else F.lit(None).cast("string").alias(c)
            for c in wanted
        ]
        paths[name] = sinks.write_csv(tables[name].select(*columns), str(folder / name))
    return paths


@pytest.fixture(scope="module")
def output(spark, paths, tmp_path_factory):
    output = str(tmp_path_factory.mktemp("batch"))
    batch.run(spark, *paths.values(), output)
    return output


def test_landed_tables_hold_every_record(spark, output):
    counts = {
        name: spark.read.parquet(f"{output}/{name}").count()
        for name in ("orders", "items", "reviews")
    }
    assert counts == {"orders": 1500, "items": 6000, "reviews": 1000}
    messages = spark.read.parquet(f"{output}/reviews").select("review_comment_message")
    assert messages.distinct().collect() == [('one "two",\nthree',)]
    for name, column in (("orders", "order_estimated_delivery_date"), ("items", "seller_id")):
        texts = spark.read.parquet(f"{output}/{name}").select(column).distinct().collect()
        assert texts == [('say "so", and\\',)]
    assert spark.read.parquet(f"{output}/items").where("price IS NULL").count() == 0


def test_reports_agree_with_direct_reads(spark, output):
    sales = spark.read.parquet(f"{output}/sales_by_status").agg(F.sum("n_orders")).first()[0]
    assert sales == spark.read.parquet(f"{output}/order_metrics").count()
    top = spark.read.parquet(f"{output}/top_customers")
    assert top.count() == 10 and dict(top.dtypes)["customer_id"] == "string"
    joined = spark.read.parquet(f"{output}/consolidated")
    assert joined.columns[:2] == ["order_id", "order_item_id"] and len(joined.columns) == 20


def test_learning_results_are_complete(spark, output):
    summary = spark.read.parquet(f"{output}/summary").first()
    assert 2 <= summary["best_k"] <= 6 and summary["n_clusters"] == summary["best_k"]
    assert 0 <= summary["auc"] <= 1 and 0 <= summary["accuracy"] <= 1
    clusters = spark.read.parquet(f"{output}/clusters")
    profile = spark.read.parquet(f"{output}/cluster_profile")
    assert profile.agg(F.sum("n_orders")).first()[0] == clusters.count()
    assert spark.read.parquet(f"{output}/silhouettes").count() == 5
    assert spark.read.parquet(f"{output}/coefficients").count() == 5


def test_bucketed_tables_give_the_same_reports_without_shuffling_orders(
    spark, paths, output, tmp_path, rows
):
    tables = batch.land(spark, paths, str(tmp_path), buckets=4, names="first_{}")
    orders, items, reviews = tables["orders"], tables["items"], tables["reviews"]
    metrics = reports.order_metrics(orders, items, reviews)
    assert rows(metrics) == rows(spark.read.parquet(f"{output}/order_metrics"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for frame, shuffles in (
            (reports.order_metrics(orders, items, reviews), 0),
            (reports.consolidated(orders, items, reviews), 0),
            (reports.top_customers(orders, items), 1),
        ):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == shuffles
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_orders_are_refused(spark, paths, tmp_path):
    with pytest.raises(ValueError, match="one order fills"):
        batch.land(spark, paths, str(tmp_path), buckets=4, bucket_rows=5)


def test_foreign_tables_are_not_replaced(spark, paths, tmp_path, make):
    make.frame([(1,)], "x int").write.saveAsTable("other_items")
    with pytest.raises(ValueError, match="exists at another place"):
        batch.land(spark, paths, str(tmp_path / "a"), buckets=2, names="other_{}")
    assert spark.table("other_items").columns == ["x"]
    for _ in range(2):  # its own tables are replaced
        tables = batch.land(spark, paths, str(tmp_path / "b"), buckets=2, names="named_{}")
    assert spark.table("named_items").count() == tables["items"].count() == 6000
