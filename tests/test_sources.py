import os
import subprocess
import sys
import time

import pytest

from tillroll.sources import readers, schemas, sinks
from tillroll.sources.session import persisted, register_views, session_facts, shared_folder

CSV = (
    "review_id,order_id,review_score,review_comment_title,review_comment_message,"
    "review_creation_date,review_answer_timestamp\n"
    'r1,o1,5,good,"said ""fine"", twice",2018-01-01 00:00:00,2018-01-02 00:00:00\n'
    'r2,o2,,,"first line\nsecond line",2018-01-01 00:00:00,\n'
    "r3,o3,bad,x,plain,,\n"
)


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(CSV)
    return str(path)


def test_text_lines_include_header_and_broken_records(spark, csv_file):
    lines = readers.read_text_lines(spark, csv_file)
    assert lines.columns == ["value"] and lines.count() == 5


def test_typed_csv_keeps_quotes_and_line_breaks(spark, csv_file, rows):
    frame = readers.read_csv_typed(spark, csv_file, schemas.REVIEWS)
    assert all(field.nullable for field in frame.schema.fields)
    assert rows(frame, "review_id", "review_score", "review_comment_message") == [
        ("r1", 5, 'said "fine", twice'),
        ("r2", None, "first line\nsecond line"),
        ("r3", None, "plain"),
    ]


@pytest.mark.parametrize("multi_line", [True, False])
def test_quotes_do_not_depend_on_line_breaks(spark, make, tmp_path, rows, multi_line):
    data = [("o1", 1, 'p "x", y', "s\\", "d", 1.0, 2.0), ("o2", 2, '""', ",", "\\\"", 3.0, None)]
    frame = make.frame(data, schemas.ITEMS)
    path = sinks.write_csv(frame, str(tmp_path / "csv"))
    back = readers.read_csv_typed(spark, path, schemas.ITEMS, multi_line=multi_line)
    assert rows(back) == sorted(data, key=repr)


def test_typed_csv_by_line_splits_records(spark, csv_file):
    frame = readers.read_csv_typed(spark, csv_file, schemas.REVIEWS, multi_line=False)
    assert frame.count() == 4


def test_inferred_csv(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text("order_id,price,at,status\n1,2.5,2018-01-01 10:00:00,ok\n2,,,late\n")
    frame = readers.read_csv_inferred(spark, str(path))
    assert [kind for _, kind in frame.dtypes] == ["int", "double", "timestamp", "string"]


@pytest.mark.parametrize("schema, width", [(schemas.ORDERS, 8), (schemas.ITEMS, 7), (schemas.REVIEWS, 7)])
def test_fixed_schemas(spark, tmp_path, schema, width):
    (tmp_path / "x.csv").write_text("")
    assert len(readers.read_csv_typed(spark, str(tmp_path), schema).columns) == width


def test_csv_written_is_read_back_unchanged(spark, make, tmp_path, rows):
    texts = [("a", ' "q", \n x\\" '), ("b", "tab\tend "), ("c", "a,b;c'd"), ("d", None)]
    frame = make.frame(texts, "id string, body string")
    path = sinks.write_csv(frame.repartition(2), str(tmp_path / "out"))
    assert rows(readers.read_csv_typed(spark, path, "id string, body string")) == sorted(
        texts, key=repr
    )


def test_parquet_replaces_the_folder_and_lists_files(spark, make, tmp_path, rows):
    path = str(tmp_path / "table")
    frame = make.frame([(i, i % 2) for i in range(10)], "id int, part int")
    sinks.write_parquet(frame, path)
    sinks.write_parquet(frame.where("id < 6").repartition(3), path)
    assert readers.read_parquet(spark, path).count() == 6
    manifest = sinks.sink_manifest(spark, path).collect()
    assert sum(row["n_rows"] for row in manifest) == 6
    for row in manifest:
        assert (tmp_path / "table" / row["file_name"]).stat().st_size == row["file_bytes"]
    sinks.write_parquet(frame, path, partition_by=["part"])
    assert rows(readers.read_parquet(spark, path), "id", "part") == rows(frame, "id", "part")


def test_session_facts(spark):
    facts = session_facts(spark)
    assert facts["app_name"] == "tillroll-tests" and facts["master"] == "local[4]"
    assert facts["spark_version"] == spark.version and facts["default_parallelism"] == 4


def test_views_answer_sql(spark, fanout):
    register_views(dict(zip(["orders", "items", "reviews"], fanout)), prefix="t_")
    n = spark.sql("SELECT count(*) FROM t_orders JOIN t_items USING (order_id)").first()[0]
    assert n == 4


def test_persisted_frames_are_released(make):
    frame = make.items([("a", 1, "p", 1.0, 0.0)]).selectExpr("order_id")
    before = frame.collect()
    with persisted(frame) as (kept,):
        assert kept.storageLevel.useMemory and kept.storageLevel.useDisk
        assert kept.collect() == before
    assert not frame.storageLevel.useMemory


SCRATCH = """
import sys
from pyspark.sql import SparkSession
from tillroll.plans.catalog import QUERIES
from tillroll.sources.session import release_scratch, shared_folder
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2")
         .config("spark.checkpoint.dir", sys.argv[1]).getOrCreate())
before = spark.sparkContext.getCheckpointDir()
spark.range(3).write.parquet(shared_folder(spark, "x"))
import glob
assert len(glob.glob(sys.argv[1] + "/tillroll-*/x-*")) == 1
release_scratch(spark)
assert glob.glob(sys.argv[1] + "/tillroll-*/*") == []
for name in ("ml_status_index", "eval_majority_share"):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
assert len(glob.glob(sys.argv[1] + "/tillroll-*/order-metrics-*")) == 1
assert spark.sparkContext.getCheckpointDir() == before
"""


def test_scratch_is_written_once_and_gone_afterwards(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run(
        [sys.executable, "-c", SCRATCH, str(tmp_path)], cwd=root, check=True, timeout=300,
        env={k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK", "SPARK"))},
    )
    for _ in range(60):  # the JVM ends a little after Python
        if not list(tmp_path.glob("tillroll-*")):
            break
        time.sleep(0.5)
    assert list(tmp_path.glob("tillroll-*")) == []


def test_shared_folder_follows_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(root) and first != second


def test_stamps_tell_changed_files(spark, tmp_path):
    from tillroll.sources.session import file_stamps

    for part in ("a b", "c"):
        spark.range(3).coalesce(1).write.parquet(str(tmp_path / part))
    frame = spark.read.parquet(str(tmp_path / "a b"), str(tmp_path / "c"))
    first = file_stamps(spark, frame.inputFiles())
    assert len(first) == 2 and all(size > 0 for _, size, _ in first)
    assert file_stamps(spark, frame.inputFiles()) == first
    spark.range(9).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "c"))
    after = file_stamps(spark, spark.read.parquet(str(tmp_path / "a b"), str(tmp_path / "c")).inputFiles())
    assert after != first and len({*after} & {*first}) == 1
    assert file_stamps(spark, []) == ()
