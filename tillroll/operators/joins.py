"""Equality joins that keep working when one key holds a large share of the rows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.sources.session import shared_folder

SALT_SEED = 17
_DRAW = "_draw"


class Target(NamedTuple):
    """What one key may put into one task: rows of a side, and pairs of both sides."""

    rows: int
    pairs: int


TARGET = Target(rows=1_000_000, pairs=20_000_000)


def inner_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join with ``key`` kept once.

    Either side may have hot keys: adaptive execution splits the partitions they fill.
    """
    return left.join(right, key, "inner")


def left_join(
    left: DataFrame, right: DataFrame, key: str, target: Target = TARGET
) -> DataFrame:
    """Left join with ``key`` kept once.

    Adaptive execution cannot split the right side of a left join, so hot keys are spread
    as in :func:`left_join_with_parent`; rows without a key are spread like any other.
    """
    hot = _kept(hot_keys(left, right, key, target))
    if hot.isEmpty():
        return left.join(right, key, "left")
    cell = [key, "fact_slot", "detail_slot"]
    joined = _fact_cells(left, hot, key).join(_detail_cells(right, hot, key), cell, "left")
    return _without_empty_cells(joined).select(key, *_others(left, key), *_others(right, key))


def left_join_with_parent(
    facts: DataFrame,
    parent: DataFrame,
    details: DataFrame,
    key: str,
    target: Target = TARGET,
) -> DataFrame:
    """``facts`` inner join ``parent`` left join ``details``, all on ``key``, kept once.

    Without hot keys this is the plain join, which shuffles each table once. Rows of a key
    that exceeds the target in ``facts``, in ``details`` or in their pairs are dealt out
    over a grid of slots (fact slot x detail slot) and the other tables' rows of that key
    are repeated along the grid, so each pair meets in exactly one cell. Other keys have
    one cell.

    The slot of a row is drawn per row, not from its values, so equal copies spread too.
    Tables with hot keys should come straight from storage, where a rerun task sees the
    same rows in the same order. Looking for hot keys counts both tables' keys once, before the join.
    """
    facts = facts.where(F.col(key).isNotNull())
    hot = _kept(hot_keys(facts, details, key, target))
    if hot.isEmpty():
        return facts.join(parent, key).join(details, key, "left")
    parent_cells = (
        _sized(parent, hot, key)
        .withColumn("fact_slot", _every("fact_slots"))
        .withColumn("detail_slot", _every("detail_slots"))
        .drop("fact_slots", "detail_slots")
    )
    cell = [key, "fact_slot", "detail_slot"]
    joined = (
        _fact_cells(facts, hot, key)
        .join(parent_cells, cell)
        .join(_detail_cells(details, hot, key), cell, "left")
    )
    return _without_empty_cells(joined).select(
        key, *_others(facts, key), *_others(parent, key), *_others(details, key)
    )


def hot_keys(
    facts: DataFrame, details: DataFrame, key: str, target: Target = TARGET
) -> DataFrame:
    """The keys beyond the target, and the slots to spread each over on both sides.

    Exact counts by partial aggregation, so a hot key is one row of a task before the
    shuffle. A cell of the grid holds at most about ``target.rows`` of a side and
    ``target.pairs`` pairs. Null is a key like others here, though it has no pairs. The
    list has no bound but the tables' sizes over the target; joins choose how to meet it.
    """
    counts = (
        _counted(facts, key, "n_facts")
        .join(_counted(details, key, "n_details"), F.col("_key").eqNullSafe(F.col("_other")), "full")
        .select(
            F.coalesce("_key", "_other").alias(key),
            F.coalesce("n_facts", F.lit(0)).alias("n_facts"),
            # a row without a key meets nothing
            F.when(F.coalesce("_key", "_other").isNotNull(), F.coalesce("n_details", F.lit(0)))
            .otherwise(0).alias("n_details"),
        )
    )
    beyond = (
        (F.col("n_facts") > target.rows)
        | (F.col("n_details") > target.rows)
        | (F.col("n_facts").cast("double") * F.col("n_details") > target.pairs)
    )
    detail_slots = F.greatest(F.lit(1), F.ceil(F.col("n_details") / target.rows))
    in_cell = F.ceil(F.col("n_details") / detail_slots)
    by_pairs = F.ceil(F.col("n_facts").cast("double") * in_cell / target.pairs)
    fact_slots = F.greatest(F.lit(1), F.ceil(F.col("n_facts") / target.rows), by_pairs)
    return counts.where(beyond).select(
        key,
        fact_slots.cast("int").alias("fact_slots"),
        detail_slots.cast("int").alias("detail_slots"),
    )


def _counted(frame: DataFrame, key: str, name: str) -> DataFrame:
    other = "_key" if name == "n_facts" else "_other"
    return frame.groupBy(F.col(key).alias(other)).agg(F.count("*").alias(name))


def _kept(hot: DataFrame) -> DataFrame:
    """The list of hot keys, written down, so that both tables' keys are counted once."""
    path = shared_folder(hot.sparkSession, "hot-keys")
    hot.write.parquet(path)
    return hot.sparkSession.read.schema(hot.schema).parquet(path)


def _fact_cells(facts: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    # The slot is drawn before the row is repeated, so that all its copies share it.
    return (
        _sized(_with_draw(facts), hot, key)
        .withColumn("fact_slot", _drawn("fact_slots"))
        .withColumn("detail_slot", _every("detail_slots"))
        .drop(_DRAW)
    )


def _detail_cells(details: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    return (
        _sized(_with_draw(details.where(F.col(key).isNotNull())), hot, key)
        .withColumn("detail_slot", _drawn("detail_slots"))
        .withColumn("fact_slot", _every("fact_slots"))
        .drop("fact_slots", "detail_slots", _DRAW)
        .withColumn("has_detail", F.lit(True))
    )


def _without_empty_cells(joined: DataFrame) -> DataFrame:
    """Drops facts that met no detail only because their cell of the grid is empty.

    A key with several detail slots has details, so its facts meet one in another cell.
    """
    empty_cell = (F.col("detail_slots") > 1) & F.col("has_detail").isNull()
    return joined.where(~empty_cell)


def _sized(frame: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """The frame with its keys' slots; the key's rows are where they were, unsorted by it.

    The list is joined without a hint: adaptive execution broadcasts it when it is small.
    """
    named = hot.withColumnRenamed(key, "_hot")
    return (
        frame.join(named, F.col(key).eqNullSafe(F.col("_hot")), "left")
        .drop("_hot")
        .withColumns(
            {
                "fact_slots": F.coalesce("fact_slots", F.lit(1)),
                "detail_slots": F.coalesce("detail_slots", F.lit(1)),
            }
        )
    )


def _with_draw(frame: DataFrame) -> DataFrame:
    """The frame with a number from 0 to 1 for each row, drawn before any shuffle.

    Drawn later, it would depend on the order in which rows arrive, and a task that is run
    again after a loss could deal its rows out differently.
    """
    return frame.withColumn(_DRAW, F.rand(SALT_SEED))


def _drawn(slots: str) -> Column:
    return F.when(F.col(slots) > 1, F.floor(F.col(_DRAW) * F.col(slots)).cast("int")).otherwise(0)


def _every(slots: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(slots) - 1))


def _others(frame: DataFrame, key: str) -> list[str]:
    return [name for name in frame.columns if name != key]
