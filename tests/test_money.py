import math
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.functions.money import ExactSum

X = ExactSum("x")
SCHEMA = "k int, x double"


def summed(frame):
    return (
        frame.select("k", "x", *X.split("x"))
        .groupBy("k")
        .agg(F.count("x").alias("n"), *X.sums())
        .select("k", X.total().alias("total"), X.rounded().alias("rounded"),
                X.mean("n").alias("mean"), "n")
        .orderBy("k")
    )


def test_half_cents_round_away_from_zero(make):
    data = [(1, 0.01), (1, 0.02), (2, -0.01), (2, -0.02), (3, 1.0), (3, 1.01)]
    means = [row["mean"] for row in summed(make.frame(data, SCHEMA)).collect()]
    assert means == [0.02, -0.02, 1.01]


def test_nulls_are_skipped_and_all_null_gives_null(make):
    data = [(1, None), (1, 2.5), (2, None)]
    first, second = summed(make.frame(data, SCHEMA)).collect()
    assert (first["total"], first["mean"], first["n"]) == (2.5, 2.5, 1)
    assert (second["total"], second["rounded"], second["mean"]) == (None, None, None)


def test_amounts_that_are_not_whole_cents_are_kept_as_doubles(make):
    data = [(1, 0.125), (1, 10.0), (2, 1e300), (2, 1.0), (3, 0.3333)]
    first, second, third = summed(make.frame(data, SCHEMA)).collect()
    assert first["total"] == 10.125 and first["rounded"] == 10.13
    assert second["total"] == 1e300
    assert third["total"] == 0.3333 and third["mean"] == 0.33


@pytest.mark.parametrize("size", [1e2, 1e4, 6e7, 1e9, 1e10, 1e12])
@pytest.mark.parametrize("fraction", [0.001, 0.004, 0.0008, 0.00005])
def test_fractions_of_large_amounts_are_not_rounded_away(make, size, fraction):
    amount = size + fraction
    row = summed(make.frame([(1, amount)] * 1000, SCHEMA)).first()
    exact = float(Decimal(amount) * 1000)
    assert abs(row["total"] - exact) <= 8 * math.ulp(exact)
    assert abs(row["mean"] - round(amount, 2)) <= 2 * math.ulp(amount) + 1e-9


def test_tiny_amounts_are_kept(make):
    assert summed(make.frame([(1, 1e-11)] * 3, SCHEMA)).first()["total"] == pytest.approx(3e-11)


def test_nan_and_infinity_propagate(make):
    data = [(1, float("nan")), (1, 1.0), (2, float("inf")), (2, 1.0)]
    first, second = summed(make.frame(data, SCHEMA)).collect()
    assert math.isnan(first["total"]) and second["total"] == math.inf


def test_sums_beyond_the_range_of_exact_doubles(make):
    # Added as doubles, the cents would be lost in either order.
    data = [(1, 9e13 - 0.02)] * 4000 + [(1, 0.01)] * 3
    row = summed(make.frame(data, SCHEMA)).first()
    exact = Decimal(repr(9e13 - 0.02)).quantize(Decimal("0.01")) * 4000 + Decimal("0.03")
    assert row["total"] == float(exact)
    assert row["mean"] == float(
        (exact / 4003).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    )


def test_partial_sums_can_be_added_again_with_a_factor(make):
    data = [(1, 1.1), (1, 2.2), (2, 3.3), (3, None)]
    split = make.frame(data, SCHEMA).select("k", *X.split("x"))
    parts = split.groupBy("k").agg(*X.sums())
    twice = parts.agg(*X.again("2")).select(X.total().alias("t")).first()["t"]
    assert twice == 13.2
    scaled = parts.select("k", X.total("k").alias("t")).orderBy("k").collect()
    assert [row["t"] for row in scaled] == [3.3, 6.6, None]


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(0, 3), st.integers(-10**9, 10**9)), min_size=1, max_size=60
    ),
    st.integers(1, 5),
)
def test_matches_decimal_arithmetic_for_any_cents(make, cents, partitions):
    frame = make.frame([(k, c / 100) for k, c in cents], SCHEMA).repartition(partitions)
    for row in summed(frame).collect():
        values = [c for k, c in cents if k == row["k"]]
        total = Decimal(sum(values)) / 100
        mean = (total / len(values)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert row["total"] == row["rounded"] == float(total)
        assert row["mean"] == float(mean)
