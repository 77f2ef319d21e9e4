import math
import random
import re

import numpy as np
import pytest

from conftest import TESTDATA
from tillroll.operators import checking
from tillroll.plans.catalog import QUERIES


def at_ranks(values, shares):
    """Values at rank ceil(s * n) of the sorted values."""
    ordered = sorted(v for v in values if v is not None and not math.isnan(v))
    return [ordered[max(1, math.ceil(s * len(ordered))) - 1] for s in shares] if ordered else None


@pytest.mark.parametrize("few", [0, 5, 2000])
def test_quantiles_are_those_of_the_sorted_values(spark, monkeypatch, few):
    monkeypatch.setattr(checking, "FEW_ROWS", few)
    monkeypatch.setattr(checking, "RANGES", 8)
    rng = random.Random(few)
    columns = {
        "even": [rng.uniform(-5, 5) for _ in range(700)],
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-30, 30) for _ in range(700)],
        "ties": [float(rng.randrange(3)) for _ in range(700)],
        "one": [7.0] * 700,
        "odd": [rng.choice([None, float("nan"), 1.0, 2.5, -0.5]) for _ in range(700)],
        "none": [None] * 700,
        "huge": [rng.choice([-1.7e308, 1.7e308, 0.0, 1e300]) for _ in range(700)],
        "hot": [3.25] * 500 + [rng.uniform(3, 4) for _ in range(200)],
    }
    frame = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).repartition(5)
    shares = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = checking.exact_quantiles(frame, list(columns), shares)
    assert found == {c: at_ranks(v, shares) for c, v in columns.items()}


def test_quantiles_of_empty_and_integer_columns(spark):
    empty = spark.createDataFrame([], "a double, b int")
    assert checking.exact_quantiles(empty, ["a", "b"]) == {"a": None, "b": None}
    assert checking.exact_quantiles(spark.range(101), ["id"]) == {"id": [25.0, 50.0, 75.0]}
    assert checking.exact_quantiles(empty, []) == {}


def test_report_on_columns(spark):
    data = [(k, float(k), "x" if k % 4 else None) for k in range(100)] + [(5, 1e6, "y"), (None, None, None)]
    frame = spark.createDataFrame(data, "key int, amount double, word string")
    report = {r.col_name: r for r in checking.quality_report({"t": frame}, {"t": ["key"]}, {"t": ["amount"]}).collect()}
    assert [report[c].n_nulls for c in ("key", "amount", "word")] == [1, 1, 26]
    amounts = [x for _, x, _ in data if x is not None]
    assert (report["amount"].q1, report["amount"].median, report["amount"].q3) == tuple(at_ranks(amounts, (0.25, 0.5, 0.75)))
    assert report["amount"].n_outliers == 1 and report["word"].n_outliers is None
    assert {(r.n_rows, r.n_without_key, r.n_keys, r.n_repeated) for r in report.values()} == {(102, 1, 100, 1)}


def test_report_on_an_empty_table(spark):
    frame = spark.createDataFrame([], "key int, amount double")
    rows = checking.quality_report({"t": frame}, {"t": ["key"]}, {"t": ["amount"]}).collect()
    assert [(r.n_rows, r.n_nulls, r.q1, r.n_keys, r.n_repeated) for r in rows] == [(0, 0, None, 0, 0)] * 2


def test_the_report_finds_the_repeated_positions(spark):
    found = QUERIES["quality_report"](spark, f"{TESTDATA}/sf0.01").collect()
    items = next(r for r in found if r.table_name == "items")
    pairs = spark.read.parquet(f"{TESTDATA}/sf0.01/lineitem.parquet").select("l_orderkey", "l_linenumber").distinct().count()
    assert items.n_keys == pairs and items.n_repeated == items.n_rows - pairs > 0


def test_survivors_do_not_depend_on_places(spark):
    rng = np.random.default_rng(1)
    rows = [(int(k) if k else None, int(a), float(b), f"w{c}") for k, a, b, c in rng.integers(0, 6, (400, 4))]
    frame = spark.createDataFrame(rows, "key int, a int, b double, c string")
    wanted = {}
    for r in rows:
        if r[0] is not None and (r[0] not in wanted or (-r[2], r[1], r[2], r[3]) < (-wanted[r[0]][2], *wanted[r[0]][1:])):
            wanted[r[0]] = r
    for parts in (1, 3, 16):
        found = checking.deduplicated(frame.repartition(parts, "c"), ["key"], ["-b"]).collect()
        assert sorted(tuple(r) for r in found if r.key is not None) == sorted(wanted.values())
        assert sorted(tuple(r) for r in found if r.key is None) == sorted(r for r in rows if r[0] is None)


def test_survivors_with_nulls_times_and_bare_keys(spark):
    rows = [(1, None, "a"), (1, "2024-01-02", "b"), (1, "2024-01-05", None), (2, None, None)]
    frame = spark.createDataFrame(rows, "key int, day string, word string").selectExpr("key", "cast(day AS timestamp_ntz) AS at", "word")
    found = {r.key: r for r in checking.deduplicated(frame, ["key"], ["-at"]).collect()}
    assert found[1].at.day == 5 and found[1].word is None and found[2].at is None
    assert checking.deduplicated(frame, ["key"]).where("key = 1").first().word == "a"  # null first
    bare = frame.select("key")
    assert sorted(r.key for r in checking.deduplicated(bare, ["key"]).collect()) == [1, 2]
    assert checking.deduplicated(frame.limit(0), ["key"]).collect() == []


def test_a_hot_key_is_one_row_of_each_task(spark):
    """Rows of a key are combined before the shuffle, without a window."""
    frame = spark.range(0, 40_000, 1, 4).selectExpr("if(id % 3 = 0, 7, id) AS key", "id AS a")
    found = checking.deduplicated(frame, ["key"], ["a"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and re.search(r"partial_min", plan)
    assert found.where("key = 7").collect()[0].a == 0 and found.count() == 40_000 - 13_334
