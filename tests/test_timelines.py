import datetime as dt
import random

import pytest

from pyspark.sql import functions as F
from tillroll.operators import timelines

START = dt.datetime(2024, 1, 1)
SCHEMA = "who string, at timestamp_ntz, x long"


def moment(seconds):
    return START + dt.timedelta(seconds=seconds)


def plain_sessions(rows, gap):
    out, own = [], {}
    for who, at, x in rows:
        if who is not None and at is not None:
            own.setdefault(who, []).append((at, x))
    for who, events in own.items():
        events.sort()
        number, last = 0, None
        for at, x in events:
            if last is None or (at - last).total_seconds() > gap:
                number += 1
                out.append([who, number, at, at, 0, 0])
            out[-1][3], out[-1][4], out[-1][5] = at, out[-1][4] + 1, out[-1][5] + x
            last = at
    return sorted(map(tuple, out))


def events(seed, n=1500):
    rng = random.Random(seed)
    rows = [("hot" if k % 3 == 0 else f"u{rng.randrange(9)}", moment(rng.uniform(-9e4, 9e4)), k) for k in range(n)]
    rows += [("edge", moment(k * 60), 1) for k in range(20)]  # exactly the gap apart
    rows += [("edge", moment(5000 + k * 60.000001), 1) for k in range(5)]
    rows += [(None, moment(1), 1), ("hot", None, 1), ("tie", moment(3), 1), ("tie", moment(3), 1)]
    return rows


@pytest.mark.parametrize("gap", [1, 60, 900])
def test_sessions_equal_a_walk_over_the_events(spark, gap):
    rows = events(gap)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = timelines.sessions(frame, "who", "at", gap, {"x": F.col("x")})
    assert sorted(map(tuple, found.collect())) == plain_sessions(rows, gap)


def test_events_are_summed_before_they_are_ordered(spark):
    """The window runs over ranges of time, not over events."""
    frame = spark.createDataFrame(events(1), SCHEMA)
    plan = timelines.sessions(frame, "who", "at", 60, {})._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("partial_count") > plan.index("Window")  # further down in the plan
    assert timelines.sessions(frame.limit(0), "who", "at", 60, {}).collect() == []


def test_sessions_of_zoned_times(spark):
    rows = [("a", moment(k)) for k in (0, 10, 100)]
    frame = spark.createDataFrame(rows, "who string, at timestamp")
    assert [r.n_events for r in timelines.sessions(frame, "who", "at", 20, {}).orderBy("session").collect()] == [2, 1]


@pytest.mark.parametrize("width", [1, 1000, 10_000_000])
def test_last_events_equal_a_scan(spark, width):
    rng = random.Random(width)
    times = [moment(rng.randrange(-3000, 3000)) for _ in range(60)]
    asked = [(rng.choice(["a", "b", "c", None]), rng.choice(times), k) for k in range(400)]
    asked += [("a", None, 900), ("none", times[0], 901)] + [asked[0]] * 2
    found = [(rng.choice(["a", "b", "b", None]), rng.choice(times[:20] + [None]), k) for k in range(80)]
    wanted = []
    for who, at, x in asked:
        before = [(t, k) for w, t, k in found if None not in (w, t, who, at) and w == who and t <= at]
        wanted.append((who, at, x, max(before)[1] if before else None))
    rows, stream = spark.createDataFrame(asked, SCHEMA), spark.createDataFrame(found, SCHEMA)
    got = timelines.with_last_before(
        rows, "who", "at", stream.withColumnRenamed("x", "y"), "who", "at", ["y"], width
    )
    assert got.columns == ["who", "at", "x", "y"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(wanted, key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_last_events_of_empty_tables(spark):
    rows = spark.createDataFrame([("a", moment(1), 1)], SCHEMA)
    got = timelines.with_last_before(rows, "who", "at", rows.limit(0), "who", "at", ["x"])
    assert [r[3] for r in got.collect()] == [None]
    assert timelines.with_last_before(rows.limit(0), "who", "at", rows, "who", "at", ["x"]).collect() == []
