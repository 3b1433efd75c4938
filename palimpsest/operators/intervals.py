"""Merging overlapping time intervals into periods and listing the gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cumulative_counts(values: DataFrame, group: str, value: str, count: str, bucket: Column) -> DataFrame:
    """Add ``before`` and ``upto``: how many items of the group rank below the value, and up to it.

    ``values`` has one row per distinct ``(group, value)`` with its ``count``.
    ``bucket`` must not decrease with ``value``. Ranks come from two short
    windows: over the buckets of a group (one row per bucket), and over the
    values inside one bucket; the values of a hot group are so spread over
    its buckets.
    """
    rows = values.withColumn("__bucket", bucket)
    sums = rows.groupBy(group, "__bucket").agg(F.sum(count).alias("__sum"))
    below = Window.partitionBy(group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__base", F.coalesce(F.sum("__sum").over(below), F.lit(0))).drop("__sum")
    inside = Window.partitionBy(group, "__bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.join(sums, [group, "__bucket"])
        .withColumn("upto", F.col("__base") + F.sum(count).over(inside))
        .withColumn("before", F.col("upto") - F.col(count))
        .drop("__base", "__bucket")
    )


def merge_intervals(intervals: DataFrame, entity: str, start: str, end: str, bucket_width: int = 30 * 86400) -> DataFrame:
    """Continuous periods of every entity and the gaps between them.

    ``start`` and ``end`` are whole numbers (epoch seconds, days) of half-open
    intervals; a null ``end`` is open. Overlapping, nested and touching
    intervals form one period. Result ``(entity, kind, starts_at, ends_at)``
    with kind ``period`` or ``gap``; ``ends_at`` is null for an open period.
    Rows with a null entity or start, or an end not after the start, have no
    interval; repeated rows change nothing.

    Method: starts and ends are sorted independently per entity. Where the
    start of rank k+1 exceeds the end of rank k all k intervals have ended, so
    a gap begins at that end and a period at that start; the j-th period start
    and the j-th period end pair up. Equal values are counted before the
    shuffle, and a value inside a bucket of ``bucket_width`` has at most that
    many rows, so an entity with any share of the rows is spread over tasks.
    """
    good = intervals.select(F.col(entity).alias("e"), F.col(start).cast("long").alias("s"), F.col(end).cast("long").alias("t")).where(
        "e is not null and s is not null and (t is null or t > s)"
    )
    bucket = F.floor(F.col("v") / bucket_width)
    starts = cumulative_counts(good.groupBy("e", F.col("s").alias("v")).agg(F.count("*").alias("n")), "e", "v", "n", bucket)
    closed = good.where("t is not null").groupBy("e", F.col("t").alias("v")).agg(F.count("*").alias("n"))
    ends = cumulative_counts(closed, "e", "v", "n", bucket)
    # Start of rank before+1 against the end of rank before.
    ranked_ends = ends.select("e", F.col("upto").alias("before"), F.col("v").alias("t"))
    borders = starts.join(ranked_ends, ["e", "before"], "left").where("before = 0 or t < v").select("e", "v", "t", "before")
    # The last border of an entity closes at its latest end, if no interval is open.
    whole = good.groupBy("e").agg(F.max("t").alias("last"), F.max(F.col("t").isNull()).alias("open"))
    tail = whole.select("e", F.when(~F.col("open"), F.col("last")).alias("t"), F.lit(None).cast("long").alias("v"))
    one = F.lit(1).alias("n")
    opened = cumulative_counts(borders.select("e", "v", one), "e", "v", "n", bucket).select("e", "before", F.col("v").alias("s"))
    shut = borders.where("before > 0").select("e", F.col("t").alias("v"), one)
    order = F.coalesce(F.col("t"), F.lit(2**62))
    shut = shut.unionByName(tail.select("e", order.alias("v"), one))
    shut = cumulative_counts(shut, "e", "v", "n", bucket).select("e", "before", F.when(F.col("v") < 2**62, F.col("v")).alias("t"))
    periods = opened.join(shut, ["e", "before"]).select("e", F.lit("period").alias("kind"), F.col("s").alias("starts_at"), F.col("t").alias("ends_at"))
    gaps = borders.where("before > 0").select("e", F.lit("gap").alias("kind"), F.col("t").alias("starts_at"), F.col("v").alias("ends_at"))
    return periods.unionByName(gaps).withColumnRenamed("e", "entity")
