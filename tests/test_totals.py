import random
from collections import defaultdict
from decimal import Decimal

import pytest

from pyspark.sql import functions as F
from tillroll.operators import totals


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_running_totals_equal_a_walk(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.choice([None, "a", "hot", "hot", "z"]), k, rng.choice([None, 1, 5, -3])) for k in range(500)]
    frame = spark.createDataFrame(rows, "day string, id int, x long").repartition(parts)
    found = totals.running_totals(frame, ["day", "id"], {"total": F.col("x")})
    total, wanted = None, []
    for position, (day, k, x) in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])), 1):
        total = x if total is None else total + (x or 0)
        wanted.append((day, k, x, total, position))
    assert sorted(map(tuple, found.collect()), key=lambda r: r[4]) == wanted


def test_running_totals_take_no_table_into_one_task(spark):
    frame = spark.range(0, 5000, 1, 8).withColumn("x", F.lit(1))
    plan = totals.running_totals(frame, ["id"], {"total": F.col("x")})._jdf.queryExecution().executedPlan().toString()
    single = plan.index("SinglePartition")
    assert "HashAggregate" in plan[single:] and plan.count("SinglePartition") == 1  # over the ranges' sums
    assert totals.running_totals(frame.limit(0), ["id"], {"total": F.col("x")}).collect() == []


def test_cube_repeats_groups_not_rows(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.choice(["x", "y", None]), Decimal(rng.randrange(500)) / 100) for _ in range(400)]
    frame = spark.createDataFrame(rows, "a string, b string, m decimal(14,2)")
    found = totals.cube(frame, ["a", "b"], {"n": F.lit(1), "m": F.col("m")})
    wanted = defaultdict(lambda: [0, Decimal(0)])
    for a, b, m in rows:
        for level, key in ((0, (a, b)), (1, (a, None)), (2, (None, b)), (3, (None, None))):
            wanted[(*key, level)][0] += 1
            wanted[(*key, level)][1] += m
    assert {(r.a, r.b, r.level): [r.n, r.m] for r in found.collect()} == wanted
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan[plan.index("Expand") :]
    assert totals.cube(frame.limit(0), ["a", "b"], {"n": F.lit(1)}).where("level < 3").collect() == []


def test_seasons_of_a_planted_series(spark):
    shares = [0.5, 0.8, 1.0, 1.2, 1.5, 1.0, 0.7, 0.9, 1.1, 1.3, 1.2, 0.8]
    months = [(f"{2010 + k // 12}-{k % 12 + 1:02d}", 100.0 * shares[k % 12]) for k in range(60)]
    found = totals.with_seasons(spark.createDataFrame(months, "month string, amount double"), "month", "amount").orderBy("month").collect()
    assert [r.seasonal for r in found] == pytest.approx([shares[k % 12] for k in range(60)])
    assert [r.trend is None for r in found] == [k < 6 or k >= 54 for k in range(60)]
    assert all(r.residual == pytest.approx(1) for r in found if r.trend is not None)


def test_seasons_fill_gaps_and_bear_few_months(spark):
    frame = spark.createDataFrame([("2020-01", 5.0), ("2020-04", 7.0)], "month string, amount double")
    found = totals.with_seasons(frame, "month", "amount").orderBy("month").collect()
    assert [(r.month, r.amount, r.trend, r.seasonal, r.residual) for r in found] == [
        ("2020-01", 5.0, None, None, None), ("2020-02", 0.0, None, None, None),
        ("2020-03", 0.0, None, None, None), ("2020-04", 7.0, None, None, None),
    ]
    assert totals.with_seasons(frame.limit(0), "month", "amount").collect() == []
