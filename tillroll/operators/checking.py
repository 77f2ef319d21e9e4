"""Checks of tables before they are analysed: nulls, repeated keys, outliers, repeated rows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranges that a round of the selection of quantiles counts values in.
RANGES = 1024
#: Rows in a range whose different values are looked at one by one.
FEW_ROWS = 2_000
QUARTILES = (0.25, 0.5, 0.75)
#: Quartile distances beyond the quartiles from which a value is an outlier.
FENCE = 1.5


class _Range(NamedTuple):
    """Values between two bounds, both included, and how many rows lie below them."""

    low: float
    high: float
    below: int
    rows: int


def exact_quantiles(
    frame: DataFrame, columns: Sequence[str], shares: Sequence[float] = QUARTILES
) -> dict[str, list[float] | None]:
    """Values at the given shares of each column's sorted values, without sorting them.

    A value at share s of n values is the one at rank ceil(s * n), so it is one that occurs.
    Each round counts, for all columns and shares in one pass, the rows in ``RANGES`` ranges
    of equal width and goes on with the range that holds the rank, cut to the values in it,
    until it has one value or ``FEW_ROWS`` rows. Tasks send one row per range. Nulls and NaN are
    left out; a column without other values gives None.
    """
    if not columns:
        return {}
    numbers = frame.select(*(F.nanvl(F.col(name).cast("double"), F.lit(None)).alias(name) for name in columns))
    sides = [f(F.col(name)) for name in columns for f in (F.min, F.max, F.count)]
    found = numbers.agg(*(side.alias(f"s{k}") for k, side in enumerate(sides))).first()
    open_ranges: dict[tuple[int, int], _Range] = {}
    ranks: dict[tuple[int, int], int] = {}
    values: dict[tuple[int, int], float] = {}
    for c in range(len(columns)):
        low, high, rows = found[3 * c : 3 * c + 3]
        for k, share in enumerate(shares):
            if rows:
                ranks[c, k] = max(1, math.ceil(share * rows))
                open_ranges[c, k] = _Range(low, high, 0, rows)
    while open_ranges:
        for at, r in list(open_ranges.items()):
            if r.low == r.high:
                values[at] = open_ranges.pop(at).low
        few = {at: r for at, r in open_ranges.items() if r.rows <= FEW_ROWS}
        for at, value in _among_few(numbers, columns, few, ranks).items():
            values[at] = value
            del open_ranges[at]
        if open_ranges:
            open_ranges = _narrowed(numbers, columns, open_ranges, ranks)
    return {
        name: [values[c, k] for k in range(len(shares))] if (c, 0) in values else None
        for c, name in enumerate(columns)
    }


def _entries(numbers: DataFrame, columns, ranges: Mapping[tuple[int, int], _Range], what) -> DataFrame:
    """(c, lo, hi, value, at) for each value in a range; equal ranges are looked at once."""
    entries = []
    for c, low, high in dict.fromkeys((c, r.low, r.high) for (c, _), r in ranges.items()):
        x = F.col(columns[c])
        here = F.struct(
            F.lit(c).alias("c"), F.lit(low).alias("lo"), F.lit(high).alias("hi"),
            x.alias("value"), what(x, low, high).alias("at"),
        )
        entries.append(F.when(x.between(low, high), here))
    return numbers.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")


def _narrowed(numbers, columns, ranges, ranks) -> dict[tuple[int, int], _Range]:
    """For each rank the range of the next round."""

    def place(x: Column, low: float, high: float) -> Column:
        # halves, so that the width of the widest range is finite
        share = (x / 2 - low / 2) / (high / 2 - low / 2)
        return F.least(F.floor(share * RANGES).cast("int"), F.lit(RANGES - 1))

    counted = _entries(numbers, columns, ranges, place).groupBy("c", "lo", "hi", "at").agg(
        F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most")
    )
    parts: dict[tuple, list] = {}
    for row in counted.collect():  # at most RANGES rows for each column and share
        parts.setdefault((row["c"], row["lo"], row["hi"]), []).append(row)
    after = {}
    for at, r in ranges.items():
        below = r.below
        for row in sorted(parts[at[0], r.low, r.high], key=lambda row: row["at"]):
            if below + row["n"] >= ranks[at]:
                after[at] = _Range(row["least"], row["most"], below, row["n"])
                break
            below += row["n"]
    return after


def _among_few(numbers, columns, ranges, ranks) -> dict[tuple[int, int], float]:
    """The values at ranks in ranges of at most ``FEW_ROWS`` rows."""
    if not ranges:
        return {}
    entries = _entries(numbers, columns, ranges, lambda x, low, high: F.lit(0))
    counted = entries.groupBy("c", "lo", "hi", "value").agg(F.count("*").alias("n"))
    rows = counted.collect()  # at most FEW_ROWS for each column and share
    values = {}
    for at, r in ranges.items():
        below = r.below
        own = [x for x in rows if (x["c"], x["lo"], x["hi"]) == (at[0], r.low, r.high)]
        for row in sorted(own, key=lambda row: row["value"]):
            below += row["n"]
            if below >= ranks[at]:
                values[at] = row["value"]
                break
    return values


def column_report(frame: DataFrame, numeric: Sequence[str] = ()) -> DataFrame:
    """A row for each column: rows, nulls, and for numeric columns quartiles and outliers.

    Outliers lie more than ``FENCE`` quartile distances below the first or above the third
    quartile. One pass counts nulls and outliers of all columns.
    """
    quartiles = exact_quantiles(frame, numeric)
    rows = []
    for position, name in enumerate(frame.columns, start=1):
        q1, median, q3 = quartiles.get(name) or (None, None, None)
        outliers = F.lit(None).cast("long")
        if q1 is not None:
            x, reach = F.col(f"`{name}`"), FENCE * (q3 - q1)
            outliers = F.count_if((x < q1 - reach) | (x > q3 + reach))
        rows.append(
            (position, name, F.count_if(F.col(f"`{name}`").isNull()), (q1, median, q3), outliers)
        )
    counted = frame.agg(
        F.count("*").alias("n_rows"),
        *(nulls.alias(f"nulls{position}") for position, _, nulls, _, _ in rows),
        *(outliers.alias(f"outliers{position}") for position, _, _, q, outliers in rows if q[0] is not None),
    )
    structs = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("col_name"),
            F.col(f"nulls{position}").alias("n_nulls"),
            *(F.lit(x).cast("double").alias(n) for x, n in zip(q, ("q1", "median", "q3"))),
            (F.col(f"outliers{position}") if q[0] is not None else F.lit(None).cast("long")).alias("n_outliers"),
        )
        for position, name, _, q, _ in rows
    ]
    return counted.select("n_rows", F.inline(F.array(*structs)))


def key_report(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows without a whole key, different keys, and rows beyond the first of a key.

    Rows of a key are counted in the map tasks, so a hot key is one row of each.
    """
    whole = F.lit(True)
    for name in keys:
        whole = whole & F.col(name).isNotNull()
    counted = frame.groupBy(*keys).agg(F.count("*").alias("_n"))
    return counted.agg(
        F.coalesce(F.sum(F.when(~whole, F.col("_n"))), F.lit(0)).alias("n_without_key"),
        F.count_if(whole).alias("n_keys"),
        F.coalesce(F.sum(F.when(whole, F.col("_n") - 1)), F.lit(0)).alias("n_repeated"),
    )


def quality_report(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    numeric: Mapping[str, Sequence[str]],
) -> DataFrame:
    """A row for each column of each table, beside what its table's key report says."""
    result = None
    for name, frame in tables.items():
        found = key_report(frame, keys[name]).first().asDict()
        report = column_report(frame, numeric.get(name, ())).select(
            F.lit(name).alias("table_name"), "*", *(F.lit(n).cast("long").alias(x) for x, n in found.items())
        )
        result = report if result is None else result.unionByName(report)
    return result


def deduplicated(frame: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row of each key: the smallest by ``order`` and then by all other columns.

    Smallest means null first, then ascending, column by column; prefix a name of ``order``
    with ``-`` for the largest number or time first, null last. The survivor depends on the
    rows alone, not on their places, so reruns agree. Each map task keeps one row of a key:
    no window, no sort of a key's rows. Rows without a whole key can not be told to be
    repeated and stay.
    """
    named = [name for name in frame.columns if name not in keys]
    places = []
    for position, name in enumerate(order):
        x = F.col(name.lstrip("-"))
        if name.startswith("-"):
            x = F.struct(x.isNull(), -_number(frame, name[1:]))
        places.append(x.alias(f"_order{position}"))
    whole = F.lit(True)
    for name in keys:
        whole = whole & F.col(name).isNotNull()
    if not named:
        kept = frame.where(whole).distinct()
    else:
        row = F.struct(*places, F.struct(*(F.col(f"`{name}`") for name in named)).alias("_row"))
        least = frame.where(whole).groupBy(*keys).agg(F.min(row).alias("_least"))
        kept = least.select(*keys, "_least._row.*").select(*frame.columns)
    return kept.unionByName(frame.where(~whole))


def _number(frame: DataFrame, name: str) -> Column:
    kind = frame.schema[name].dataType.simpleString()
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if kind == "date":
        return F.unix_date(F.col(name))
    return F.col(name)
