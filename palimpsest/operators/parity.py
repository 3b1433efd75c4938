"""Set and multiset comparison, grouped reconciliation of two sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bag_counts(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key its number of rows on both sides, null-safe, by one shuffle: ``keys, left_count, right_count``."""
    side = lambda df, l, r: df.select(*keys, F.lit(l).alias("__l"), F.lit(r).alias("__r"))  # noqa: E731,E741
    both = side(left, 1, 0).unionByName(side(right, 0, 1))
    return both.groupBy(*keys).agg(F.sum("__l").alias("left_count"), F.sum("__r").alias("right_count"))


def bag_parity(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Multiset intersection and both differences per key: ``common, left_only, right_only``."""
    l, r = F.col("left_count"), F.col("right_count")
    return bag_counts(left, right, keys).select(
        *keys, F.least(l, r).alias("common"), F.greatest(l - r, F.lit(0)).alias("left_only"), F.greatest(r - l, F.lit(0)).alias("right_only")
    )


def relation_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """EXCEPT ALL both ways, labelled; two relations are equal if it is empty."""
    names = left.columns
    extra = left.exceptAll(right.select(*names)).withColumn("side", F.lit("left"))
    return extra.unionByName(right.select(*names).exceptAll(left).withColumn("side", F.lit("right")))


def distinct_with_collisions(df: DataFrame, keys: Sequence[str], content: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Exact duplicates removed, and the keys that have more than one content: ``(rows, collisions)``."""
    rows = df.select(*keys, *content).distinct()
    return rows, rows.groupBy(*keys).agg(F.count("*").alias("contents")).where("contents > 1")


def grouped_reconcile(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str) -> DataFrame:
    """Full outer join of two sources by key, with the rows of each side grouped, never multiplied.

    Result: ``key, left_values, right_values`` (sorted distinct), counts of
    both sides and ``status`` (``both``, ``left_only``, ``right_only``) and
    whether a side ``collides`` (has several rows). Null keys are left out.
    """

    def grouped(df: DataFrame, value: str, name: str) -> DataFrame:
        return (
            df.where(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.array_sort(F.collect_set(value)).alias(f"{name}_values"), F.count("*").alias(f"{name}_count"))
        )

    joined = grouped(left, left_value, "left").join(grouped(right, right_value, "right"), key, "full_outer")
    l, r = F.coalesce("left_count", F.lit(0)), F.coalesce("right_count", F.lit(0))
    status = F.when((l > 0) & (r > 0), "both").when(l > 0, "left_only").otherwise("right_only")
    return joined.select(
        key, "left_values", "right_values", l.alias("left_count"), r.alias("right_count"), status.alias("status"), ((l > 1) | (r > 1)).alias("collides")
    )


def set_difference(df: DataFrame, left: str, right: str) -> DataFrame:
    """Sorted set differences of two array columns as ``left_only`` and ``right_only``."""
    return df.withColumns({"left_only": F.array_sort(F.array_except(left, right)), "right_only": F.array_sort(F.array_except(right, left))})


def unseen_rows(new: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key isn't there yet (insert if absent, work not done), one per key."""
    return new.join(seen.select(*keys).distinct(), list(keys), "left_anti").dropDuplicates(list(keys))
