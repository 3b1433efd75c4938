"""Integrity gates: queries whose rows are violations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class GateError(ValueError):
    """A gate that must be empty has rows."""


def require_empty(df: DataFrame, what: str) -> None:
    """Fail with the first violations if there are any."""
    if rows := df.limit(3).collect():
        raise GateError(f"{what}: {[r.asDict() for r in rows]}")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, null keys included."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count <> 1")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    keys = parent.select(F.col(parent_key).alias("__k")).distinct()
    return child.where(F.col(child_key).isNotNull()).join(keys, F.col(child_key) == F.col("__k"), "left_anti")


def broken_sequences(df: DataFrame, keys: Sequence[str], ordinal: str, first: int = 0) -> DataFrame:
    """Keys whose ordinals aren't ``first, first + 1, …`` without gap or repetition."""
    n = F.count("*")
    facts = df.groupBy(*keys).agg(F.min(ordinal).alias("lowest"), F.max(ordinal).alias("highest"), n.alias("row_count"), F.count_distinct(ordinal).alias("distinct_count"))
    good = (F.col("lowest") == first) & (F.col("highest") == F.col("row_count") + first - 1) & (F.col("distinct_count") == F.col("row_count"))
    return facts.where(~F.coalesce(good, F.lit(False)))


def membership_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of only one side: ``keys, side``."""
    l = left.select(*keys).distinct().withColumn("__l", F.lit(True))
    r = right.select(*keys).distinct().withColumn("__r", F.lit(True))
    joined = l.join(r, list(keys), "full_outer").where("__l is null or __r is null")
    return joined.select(*keys, F.when(F.col("__l").isNull(), "right").otherwise("left").alias("side"))


def replay_difference(left: DataFrame, right: DataFrame, keys: Sequence[str], ordinal: str, values: Sequence[str]) -> DataFrame:
    """Steps at which two ordered logs differ, a missing step included: ``keys, ordinal``."""
    on = [*keys, ordinal]
    l = left.select(*on, F.struct(*values).alias("__l"))
    r = right.select(*on, F.struct(*values).alias("__r"))
    return l.join(r, on, "full_outer").where(~F.col("__l").eqNullSafe(F.col("__r"))).select(*on)


def overlapping_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str, order: Sequence[str] = ()) -> DataFrame:
    """Rows that overlap an earlier interval of their key; touching ones don't, a null end is open.

    The furthest end so far against the own start, over a sorted window; no
    join of intervals with intervals.
    """
    w = Window.partitionBy(*keys).orderBy(start, *order).rowsBetween(Window.unboundedPreceding, -1)
    open_before = F.coalesce(F.max(F.col(end).isNull()).over(w), F.lit(False))
    furthest = F.max(end).over(w)
    return df.withColumn("__over", open_before | F.coalesce(furthest > F.col(start), F.lit(False))).where("__over").drop("__over")


def wrong_slices(spans: DataFrame, text: str, start: str, end: str, expected: str, utf8: bool = False) -> DataFrame:
    """Spans whose half-open slice of the text isn't the expected string, by code points or UTF-8 bytes."""
    length = F.col(end) - F.col(start)
    if utf8:
        cut = F.decode(F.substring(F.encode(F.col(text), "UTF-8"), F.col(start) + 1, length), "UTF-8")
    else:
        cut = F.substring(F.col(text), F.col(start) + 1, length)
    return spans.where(~cut.eqNullSafe(F.col(expected)))


def leaf_mismatches(df: DataFrame, keys: Sequence[str], code: str) -> DataFrame:
    """Drop a dotted code if a longer one below it is there too.

    Each code is exploded into its proper prefixes, so the hierarchy is an
    equi-join on the prefix and not a join on ``startswith``.
    """
    parts = F.split(F.col(code), r"\.")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "."))
    parents = (
        df.where(F.size(parts) > 1).select(*keys, F.explode(prefixes).alias(code)).distinct()
    )
    return df.join(parents, [*keys, code], "left_anti")


def assembled_ranges(df: DataFrame, keys: Sequence[str], order: str, text: str, separator: str = "") -> DataFrame:
    """Offsets of every block in the text that the blocks of a key make in order, in code points and UTF-8 bytes."""
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sums = lambda length, extra: F.coalesce(F.sum(length + extra).over(before), F.lit(0))
    chars, size = F.char_length(text), F.octet_length(text)
    s, b = sums(chars, len(separator)), sums(size, len(separator.encode()))
    return df.withColumns({"scalar_start": s, "scalar_end": s + chars, "byte_start": b, "byte_end": b + size})


def wrong_schema(columns: Sequence[str], contract: Sequence[str]) -> dict[str, list[str]]:
    """Missing and unknown columns against a contract."""
    return {"missing": sorted(set(contract) - set(columns)), "unknown": sorted(set(columns) - set(contract))}


def gate_report(violations: dict[str, DataFrame]) -> DataFrame:
    """Violations of every gate, those without any included: ``gate, violations, passed``."""
    made = None
    for name, df in violations.items():
        row = df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("gate"), "violations", (F.col("violations") == 0).alias("passed"))
        made = row if made is None else made.unionByName(row)
    return made


def reasons_of(conditions: Sequence[tuple[str, Column]]) -> Column:
    """Names of the conditions that hold, sorted and distinct; an unknown condition doesn't hold."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in conditions]))))


def invalid_activations(activations: DataFrame, runs: DataFrame, run: str, sha256: str, state: str, sealed: str) -> DataFrame:
    """Activations of a run that isn't there, isn't sealed or has another hash: their columns and ``reasons``.

    ``activations`` names a ``run`` and the hash it expects; ``runs`` has one
    row per run with its hash and state.
    """
    known = runs.select(F.col(run).alias("__run"), F.col(sha256).alias("__sha"), F.col(state).alias("__state"))
    rows = activations.join(known, F.col(run) == F.col("__run"), "left")
    there = F.col("__run").isNotNull()
    reasons = reasons_of([
        ("unknown_run", ~there), ("not_sealed", there & ~F.col("__state").eqNullSafe(F.lit(sealed))), ("other_hash", there & ~F.col(sha256).eqNullSafe(F.col("__sha"))),
    ])
    return rows.withColumn("reasons", reasons).where(F.size("reasons") > 0).drop("__run", "__sha", "__state")


def broken_pages(results: DataFrame, keys: Sequence[str], page: str, rank: str, page_size: int) -> DataFrame:
    """Searches whose result pages don't fit together: the keys and ``reasons``.

    Pages count from 1 without a gap, all but the last are full, and ranks
    count on from page to page: the first of page ``p`` is
    ``(p - 1) * page_size + 1``.
    """
    pages = results.groupBy(*keys, page).agg(F.count("*").alias("n"), F.count_distinct(rank).alias("ranks"), F.min(rank).alias("lo"), F.max(rank).alias("hi"))
    before = (F.col(page) - 1) * page_size
    pages = pages.withColumn("shifted", (F.col("lo") != before + 1) | (F.col("hi") != before + F.col("n")) | (F.col("ranks") != F.col("n")) | F.col("lo").isNull())
    each = pages.groupBy(*keys).agg(
        F.min(page).alias("first"), F.max(page).alias("last"), F.count("*").alias("pages"), F.bool_or("shifted").alias("shifted"), F.count_if(F.col("n") > page_size).alias("over"),
        F.count_if(F.col("n") < page_size).alias("short"), F.max_by("n", page).alias("tail"),
    )
    reasons = reasons_of([
        ("pages_missing", (F.col("first") != 1) | (F.col("last") != F.col("pages"))), ("ranks_broken", F.col("shifted")), ("page_overfull", F.col("over") > 0),
        ("page_short", F.col("short") > F.when(F.col("tail") < page_size, 1).otherwise(0)),
    ])
    return each.select(*keys, reasons.alias("reasons")).where(F.size("reasons") > 0)
