"""The latest row per key of append-only logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key by ``order`` (the last column must break ties).

    ``max_by`` combines map-side, so a hot key ships one row per task. Null
    orders count as smallest. Without keys the one latest row of all.
    """
    rest = [c for c in df.columns if c not in keys]
    latest = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(latest).select(*keys, "__row.*").select(*df.columns).where(F.lit(True) if keys else F.col(order[-1]).isNotNull())


def latest_then(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Column) -> DataFrame:
    """Keys whose latest row passes ``keep``: first the latest, then the filter, so that a withdrawn key is gone."""
    return latest_rows(df, keys, order).where(keep)


def preferred_rows(df: DataFrame, keys: Sequence[str], preference: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``preference`` (sort columns such as a case and a date descending)."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(*preference)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def exactly_one(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of keys that have exactly one, and ``(keys, candidates)`` of the keys that have more."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("candidates"))
    return df.join(counts.where("candidates = 1").select(*keys), list(keys), "left_semi"), counts.where("candidates > 1")


def status_by_precedence(cases: Sequence[tuple[str, Column]], otherwise: str) -> Column:
    """The first status whose condition holds."""
    status = F.lit(otherwise)
    for name, condition in reversed(cases):
        status = F.when(condition, name).otherwise(status)
    return status


def valid_at(start: Column, end: Column, at: Column) -> Column:
    """Half-open validity; a null end is open, a null start never valid."""
    return F.coalesce((start <= at) & (end.isNull() | (at < end)), F.lit(False))


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, values: Sequence[str]) -> DataFrame:
    """Left rows with the ``values`` of the last right row of their key at or before their time.

    Both tables have ``keys`` and ``time``. One union sorted per key gives the
    last values; there is no join of times with times. Of several right rows
    at one time the one with the greatest values counts. Nulls if there is none.
    """
    from pyspark.sql import Window

    own = [c for c in left.columns]
    tag = "__side"
    right = right.groupBy(*keys, time).agg(F.max(F.struct(*values)).alias("__v"))
    l = left.select(F.struct(*own).alias("__l"), *keys, F.col(time), F.lit(1).alias(tag))
    r = right.select(*keys, time, F.col("__v"), F.lit(0).alias(tag))
    both = l.unionByName(r, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(time, tag).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("__last", F.last("__v", ignorenulls=True).over(w)).where(F.col(tag) == 1)
    return found.select("__l.*", *[F.col("__last")[v].alias(v) for v in values])
