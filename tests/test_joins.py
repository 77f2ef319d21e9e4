import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillroll.operators import joins
from tillroll.operators.joins import Target

FACTS = "key string, fact int"
PARENT = "key string, parent int"
DETAILS = "key string, detail int"


def counted(frame):
    return Counter(tuple(row) for row in frame.collect())


def plain(facts, parent, details):
    return facts.join(parent, "key").join(details, "key", "left")


def skewed(make, fact_hot, detail_hot, seed=3):
    """Keys k0..k9 with a few rows, and hot keys with copies of a single row."""
    rng = random.Random(seed)
    facts = [(f"k{rng.randrange(12)}", i) for i in range(60)] + [(None, -1)] * 3
    details = [(f"k{rng.randrange(2, 14)}", i) for i in range(40)] + [(None, -2)] * 3
    for key, n in fact_hot.items():
        facts += [(key, 1000)] * n
    for key, n in detail_hot.items():
        details += [(key, 2000)] * n
    parent = [(f"k{i}", i) for i in range(11)] + [("k3", 33), ("hot", 77), (None, 0)]
    return make.frame(facts, FACTS), make.frame(parent, PARENT), make.frame(details, DETAILS)


@pytest.mark.parametrize(
    "fact_hot, detail_hot",
    [
        ({}, {}),
        ({"hot": 90}, {}),
        ({"hot": 90}, {"hot": 1}),
        ({"k0": 90}, {"hot": 70}),
        ({"hot": 90}, {"hot": 70}),
        ({"k3": 50, "hot": 40}, {"k3": 45, "k13": 60}),
        ({"hot": 2}, {"hot": 80}),
        ({"hot": 9}, {"hot": 9}),
    ],
)
def test_spread_joins_equal_plain_joins(make, fact_hot, detail_hot):
    facts, parent, details = skewed(make, fact_hot, detail_hot)
    spread = joins.left_join_with_parent(facts, parent, details, "key", Target(10, 40))
    assert counted(spread) == counted(plain(facts, parent, details))
    assert spread.columns == ["key", "fact", "parent", "detail"]
    two = joins.left_join(facts, details, "key", Target(10, 40))
    assert counted(two) == counted(facts.join(details, "key", "left"))


def slots(facts, details, target):
    found = joins.hot_keys(facts, details, "key", target).collect()
    return {r["key"]: (r["fact_slots"], r["detail_slots"]) for r in found}


def largest_cells(facts, details, target):
    """Most facts, most details and most pairs of a cell, keys that match nothing included."""
    hot = joins.hot_keys(facts, details, "key", target)
    cell = ["key", "fact_slot", "detail_slot"]
    n_facts = joins._fact_cells(facts, hot, "key").groupBy(*cell).agg(F.count("*").alias("f"))
    n_details = joins._detail_cells(details, hot, "key").groupBy(*cell).agg(F.count("*").alias("d"))
    both = n_facts.join(n_details, cell, "full").fillna(0, ["f", "d"])
    return tuple(both.agg(F.max("f"), F.max("d"), F.max(F.col("f") * F.col("d"))).first())


def test_hot_keys_are_found_and_sized(make):
    facts, _, details = skewed(make, {"hot": 90}, {})
    assert slots(facts, details, Target(30, 10**6)) == {"hot": (3, 1)}
    assert slots(facts, details, Target(1000, 10**6)) == {}


def test_hot_rows_are_spread_over_cells_even_when_they_are_copies(make):
    facts, parent, details = skewed(make, {"hot": 400}, {"hot": 300})
    hot = joins.hot_keys(facts, details, "key", Target(40, 10**6))
    cells = joins._fact_cells(facts, hot, "key").where("key = 'hot'")
    per_cell = cells.groupBy("fact_slot", "detail_slot").count().collect()
    assert len(per_cell) == 10 * 8
    assert max(row["count"] for row in per_cell) < 100


def test_keys_of_a_small_share_are_spread(spark):
    # 2,000 keys with 0.05 % of the rows each
    facts = spark.range(20_000).selectExpr("cast(id % 2000 AS string) AS key", "id AS fact")
    details = spark.range(2000).selectExpr("cast(id AS string) AS key", "id AS detail")
    target = Target(4, 100)
    assert joins.hot_keys(facts, details, "key", target).count() == 2000
    most = largest_cells(facts, details, target)
    assert most[0] < 10 and most[1] == 1
    joined = joins.left_join(facts, details, "key", target)
    assert counted(joined) == counted(facts.join(details, "key", "left"))


def test_a_key_that_is_hot_only_in_its_pairs_is_spread(make):
    facts, _, details = skewed(make, {"hot": 200}, {"hot": 200})
    target = Target(1000, 2000)
    assert slots(facts, details, target) == {"hot": (20, 1)}
    most = largest_cells(facts, details, target)
    assert most[2] <= 3 * target.pairs
    joined = joins.left_join(facts, details, "key", target)
    assert counted(joined) == counted(facts.join(details, "key", "left"))


def test_rows_without_a_key_are_spread(make):
    facts = make.frame([(None, i) for i in range(900)] + [("a", i) for i in range(100)], FACTS)
    details = make.frame([(None, i) for i in range(900)] + [("a", 1)], DETAILS)
    parent = make.frame([("a", 1), (None, 2)], PARENT)
    target = Target(100, 10**6)
    assert slots(facts, details, target) == {None: (9, 1)}
    most = largest_cells(facts, details, target)
    assert most[0] < 200 and most[1] == 1
    joined = joins.left_join(facts, details, "key", target)
    assert counted(joined) == counted(facts.join(details, "key", "left"))
    with_parent = joins.left_join_with_parent(facts, parent, details, "key", target)
    assert counted(with_parent) == counted(plain(facts, parent, details))


def test_no_extra_work_without_hot_keys(make):
    facts, parent, details = skewed(make, {}, {})
    joined = joins.left_join_with_parent(facts, parent, details, "key")
    text = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in text and "slot" not in text


def test_empty_inputs(make):
    facts = make.frame([], FACTS)
    details = make.frame([], DETAILS)
    parent = make.frame([("a", 1)], PARENT)
    assert joins.left_join_with_parent(facts, parent, details, "key", Target(1, 1)).count() == 0
    assert joins.left_join(parent, details, "key", Target(1, 1)).count() == 1


def test_inner_join_keeps_the_key_once(make, rows):
    left = make.frame([("a", 1), ("b", 2), (None, 3)], PARENT)
    right = make.frame([("a", 5), ("a", 6), (None, 7)], DETAILS)
    joined = joins.inner_join(left, right, "key")
    assert joined.columns == ["key", "parent", "detail"]
    assert rows(joined) == [("a", 1, 5), ("a", 1, 6)]


def test_slots_are_drawn_before_any_shuffle(spark, make):
    """A rerun of a shuffled stage may see rows in another order, but their draws stay theirs."""
    facts = spark.range(400).selectExpr("id", "if(id < 300, 1, id) AS key")
    details = spark.range(40).selectExpr("id AS detail", "if(id < 30, 1, id) AS key")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # every join is shuffled
    try:
        found = joins.left_join(facts, details, "key", joins.Target(rows=20, pairs=100))
        plan = found._jdf.queryExecution().executedPlan().toString().split("\n")
        drawn = [k for k, line in enumerate(plan) if "rand(17)" in line]
        assert len(drawn) == 2
        for k in drawn:
            # only the scan lies below the draw in the tree, whose depth the indent shows
            depth = len(plan[k]) - len(plan[k].lstrip(" :+-*()0123456789"))
            for line in plan[k + 1 :]:
                if len(line) - len(line.lstrip(" :+-*()0123456789")) <= depth:
                    break
                assert "Exchange" not in line
        assert found.count() == 300 * 30 + 100
        assert found.distinct().count() == 300 * 30 + 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
