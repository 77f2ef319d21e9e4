"""Rows in time: sessions of visitors, and the last event before a row.

Time is cut into ranges, so that a visitor with a large share of all events is never one group:
a visitor's events of a range are summed up in the map tasks, and only ranges, whose number
is bounded by the time that the table spans, are put in order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def micros(frame: DataFrame, column: str) -> Column:
    """A time as microseconds since 1970; times without a zone are taken as they are written."""
    if frame.schema[column].dataType.simpleString() == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(column))
    return F.unix_micros(F.col(column).cast("timestamp"))


def sessions(
    events: DataFrame,
    visitor: str,
    time: str,
    gap_seconds: int,
    sums: Mapping[str, Column],
) -> DataFrame:
    """One row per session: (visitor, session, started, ended, n_events, sums ...).

    A visitor's session goes on as long as the next event is at most ``gap_seconds`` later;
    sessions are numbered from 1. ``sums`` are columns of numbers to add up by session.

    Events of a visitor within a range as wide as the gap are in one session whatever
    happens, so ranges are aggregated first, with partial aggregation. Then sessions are
    stitched from ranges: one begins where a range's first event is too far from the last
    event of the range before. Per visitor that is one row for each gap's time at most,
    however many events there are. Events without a visitor or a time are left out.
    """
    at = micros(events, time)
    width = gap_seconds * 1_000_000
    ranges = (
        events.where(F.col(visitor).isNotNull() & F.col(time).isNotNull())
        .groupBy(visitor, F.floor(at / width).alias("_range"))
        .agg(
            F.min(at).alias("_first"), F.max(at).alias("_last"),
            F.min(time).alias("_started"), F.max(time).alias("_ended"),
            F.count("*").alias("_n"), *(F.sum(x).alias(f"_sum_{name}") for name, x in sums.items()),
        )
    )
    in_order = Window.partitionBy(visitor).orderBy("_range")
    begins = F.col("_first") - F.lag("_last").over(in_order) > width
    numbered = ranges.withColumn("_begins", F.coalesce(begins, F.lit(True)).cast("int"))
    numbered = numbered.withColumn("session", F.sum("_begins").over(in_order))
    return numbered.groupBy(visitor, "session").agg(
        F.min("_started").alias("started"), F.max("_ended").alias("ended"),
        F.sum("_n").alias("n_events"), *(F.sum(f"_sum_{name}").alias(name) for name in sums),
    )


def with_last_before(
    rows: DataFrame,
    row_key: str,
    row_time: str,
    events: DataFrame,
    event_key: str,
    event_time: str,
    event_columns: Sequence[str],
    range_seconds: int = 86_400,
) -> DataFrame:
    """The rows with the columns of their key's last event at or before their time, or nulls.

    Of events of one time the largest by ``event_columns``, in their order, counts. Both
    streams are cut into ranges of time. Within a key's range rows and events are merged in
    order of time; a row that has no event before it in its range takes the last event of
    the nearest range before, which is carried over from range to range. The sorted groups
    are a key's rows and events of one range, and a key's ranges; choose ``range_seconds`` by
    the densest key. Rows without a key or a time have no event; events without are left out.
    """
    width = range_seconds * 1_000_000
    taken = [f"_event_{k}" for k in range(len(event_columns))]
    found = events.where(F.col(event_key).isNotNull() & F.col(event_time).isNotNull()).select(
        F.col(event_key).alias("_key"), micros(events, event_time).alias("_at"),
        F.struct(micros(events, event_time).alias("_t"), *(F.col(c).alias(n) for c, n in zip(event_columns, taken))).alias("_event"),
    )
    asked = rows.select(
        F.col(row_key).alias("_key"), micros(rows, row_time).alias("_at"), F.struct("*").alias("_row")
    )
    both = found.withColumn("_row", F.lit(None).cast(asked.schema["_row"].dataType)).unionByName(
        asked.withColumn("_event", F.lit(None).cast(found.schema["_event"].dataType))
    ).withColumn("_range", F.floor(F.col("_at") / width))
    # events of a time come before rows of that time, and the largest of them last
    in_range = (
        Window.partitionBy("_key", "_range").orderBy("_at", F.col("_row").isNotNull(), "_event")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    within = both.withColumn("_last", F.last("_event", ignorenulls=True).over(in_range)).where("_row IS NOT NULL")
    # what each range hands on: its last event, or what it was handed
    asked_ranges = asked.select("_key", F.floor(F.col("_at") / width).alias("_range"))
    ends = (
        found.select("_key", F.floor(F.col("_at") / width).alias("_range"), "_event")
        .unionByName(asked_ranges.withColumn("_event", F.lit(None).cast(found.schema["_event"].dataType)))
        .where("_key IS NOT NULL AND _range IS NOT NULL")
        .groupBy("_key", "_range").agg(F.max("_event").alias("_event"))
    )
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.withColumn("_before", F.last("_event", ignorenulls=True).over(before)).drop("_event")
    joined = within.join(handed, ["_key", "_range"], "left")
    event = F.when(F.col("_key").isNotNull(), F.coalesce("_last", "_before"))
    return joined.select(
        "_row.*", *(event[name].alias(column) for name, column in zip(taken, event_columns))
    )
