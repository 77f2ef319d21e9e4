"""Running totals over a whole table, totals over combinations of columns, and seasons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.sources.session import shared_folder


def running_totals(
    frame: DataFrame, order: Sequence[str], totals: Mapping[str, Column]
) -> DataFrame:
    """The frame with a running total of each column of ``totals`` and its position.

    Rows are put in order by ``order``, null first, over ranges of the table, one task each.
    The ranges' sums, one row a range, are added up first and each range starts from what is
    before it, so no task sees the table. ``order`` should tell all rows apart: rows that are equal in it
    have one range and come in any order. Numbers should be exact (integers, decimals), as
    doubles depend on the ranges. Ranges are stored once, so that both passes see the same.
    """
    spark, names = frame.sparkSession, list(totals)
    path = shared_folder(spark, "ranges")
    (
        frame.select(F.struct("*").alias("_row"), *(F.col(x).alias(f"_by{k}") for k, x in enumerate(order)),
                     *(x.alias(f"_x{k}") for k, x in enumerate(totals.values())))
        .repartitionByRange(*(f"_by{k}" for k in range(len(order))))
        .withColumn("_range", F.spark_partition_id())
        .write.parquet(path)
    )
    ranged = spark.read.parquet(path)
    sums = [F.sum(f"_x{k}").alias(f"_s{k}") for k in range(len(names))]
    # one row for each range
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_range").agg(F.count("*").alias("_n"), *sums).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"),
        *(F.sum(f"_s{k}").over(before).alias(f"_s{k}") for k in range(len(names))),
    )
    inside = Window.partitionBy("_range").orderBy(*(f"_by{k}" for k in range(len(order))))
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranged.withColumns(
        {f"_t{k}": F.sum(f"_x{k}").over(inside) for k in range(len(names))} | {"_p": F.count("*").over(inside)}
    )

    def added(k: int) -> Column:
        own, others = F.col(f"_t{k}"), F.col(f"_s{k}")
        return F.coalesce(own + others, own, others)

    return summed.join(offsets, "_range").select(
        "_row.*", *(added(k).alias(name) for k, name in enumerate(names)), (F.col("_p") + F.col("_n")).alias("position")
    )


def cube(
    frame: DataFrame, by: Sequence[str], sums: Mapping[str, Column]
) -> DataFrame:
    """Sums for every combination of ``by``, and with any of these columns left out.

    ``level`` tells which are left out, as bits from the last column on; they are null.
    Rows are summed by all columns first, so what is repeated for each level is groups, not
    rows. Sums should be exact (integers, decimals).
    """
    whole = frame.groupBy(*by).agg(*(F.sum(x).alias(name) for name, x in sums.items()))
    return whole.cube(*by).agg(F.grouping_id().alias("level"), *(F.sum(name).alias(name) for name in sums))


def with_seasons(monthly: DataFrame, month: str, amount: str) -> DataFrame:
    """(month, amount, trend, seasonal, residual) for every month from the first to the last.

    Months without rows have an amount of zero. The trend is the centred mean of twelve months,
    null where half a year on a side is missing; the seasonal share of a calendar month is the
    mean of amount / trend over the years, scaled so that the twelve have a mean of one; the
    residual is amount / (trend * seasonal). Months are few, whatever the table they come
    from, so they are put in order in one task.
    """
    first = F.to_date(F.concat(F.col(month), F.lit("-01")))
    known = monthly.select(first.alias("_at"), F.col(amount).alias("_amount"))
    bounds = known.agg(F.min("_at").alias("a"), F.max("_at").alias("b")).where("a IS NOT NULL")
    calendar = bounds.select(F.explode(F.expr("sequence(a, b, interval 1 month)")).alias("_at"))
    filled = calendar.join(known, "_at", "left").select("_at", F.coalesce("_amount", F.lit(0.0)).alias("_amount"))
    in_order = Window.orderBy("_at")
    wide, narrow = in_order.rowsBetween(-6, 6), in_order.rowsBetween(-5, 5)
    # half of the months at both ends, so that each calendar month weighs the same
    mean = (F.sum("_amount").over(wide) + F.sum("_amount").over(narrow)) / 24
    trend = filled.withColumn("trend", F.when(F.count("*").over(wide) == 13, mean))
    calendar_month = Window.partitionBy(F.month("_at"))
    share = F.when(F.col("trend") != 0, F.col("_amount") / F.col("trend"))
    seasons = trend.withColumn("_share", F.avg(share).over(calendar_month))
    of_year = seasons.groupBy(F.month("_at").alias("_m")).agg(F.first("_share").alias("_s"))
    scale = of_year.agg(F.avg("_s").alias("_scale"), F.lit(1).alias("_one"))
    scaled = seasons.withColumn("_one", F.lit(1)).join(scale, "_one", "left")
    seasonal = F.when(F.col("_scale") != 0, F.col("_share") / F.col("_scale"))
    result = scaled.select(
        F.date_format("_at", "yyyy-MM").alias(month), F.col("_amount").alias(amount), "trend", seasonal.alias("seasonal")
    )
    base = F.col("trend") * F.col("seasonal")
    return result.withColumn("residual", F.when(base != 0, F.col(amount) / base))
