"""Version chains of ordered observations: states, edges, presence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from palimpsest.functions.text import soft_wrapped
from palimpsest.runtime import materialize


def change_relation(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str = "relation") -> DataFrame:
    """Relation of each observation to the one before: ``first``, ``same`` or ``changed``; nulls compare as values."""
    w = Window.partitionBy(*keys).orderBy(*order)
    first = F.row_number().over(w) == 1
    same = F.col(value).eqNullSafe(F.lag(value).over(w))
    return df.withColumn(out, F.when(first, "first").when(same, "same").otherwise("changed"))


def text_states(df: DataFrame, keys: Sequence[str], order: str, value: Column, label: str | None = None) -> DataFrame:
    """Runs of consecutive observations of equal value (gaps and islands).

    Runs are of observations, not of order numbers: a missing number splits
    none. ``A, A, B, A`` gives three states. Result: keys, ``state_order``
    from 0, ``state_value``, ``first_order``, ``last_order``,
    ``observation_count`` and, with ``label``, the labels in order.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    rows = df.select(*keys, F.col(order).alias("__o"), value.alias("__v"), *([F.col(label).alias("__l")] if label else []))
    w = Window.partitionBy(*keys).orderBy("__o")
    starts = F.when(F.row_number().over(w) == 1, 1).when(F.col("__v").eqNullSafe(F.lag("__v").over(w)), 0).otherwise(1)
    rows = rows.withColumn("__start", starts)
    rows = rows.withColumn("state_order", (F.sum("__start").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).cast("int"))
    facts = [
        F.first("__v").alias("state_value"), F.min("__o").alias("first_order"), F.max("__o").alias("last_order"), F.count("*").alias("observation_count"),
    ]
    if label:
        facts.append(F.transform(F.array_sort(F.collect_list(F.struct("__o", "__l"))), lambda x: x["__l"]).alias("labels"))
    return rows.groupBy(*keys, "state_order").agg(*facts)


def state_edges(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adjacent states as edges: keys, older and newer state, and the orders on both sides of the step."""
    w = Window.partitionBy(*keys).orderBy("state_order")
    return (
        states.select(
            *keys,
            F.col("state_order").alias("older_state"),
            F.lead("state_order").over(w).alias("newer_state"),
            F.col("last_order").alias("older_last_order"),
            F.lead("first_order").over(w).alias("newer_first_order"),
        )
        .where("newer_state is not null")
        .withColumn("crosses_gap", F.col("newer_first_order") > F.col("older_last_order") + 1)
    )


def presence(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Coverage of each key's observations: first and last order, counts, and whether no order is missing between."""
    return df.groupBy(*keys).agg(
        F.min(order).alias("first_order"),
        F.max(order).alias("last_order"),
        F.count_distinct(order).alias("observed"),
        F.count_distinct(value).alias("unique_values"),
        (F.max(order) - F.min(order) + 1 == F.count_distinct(order)).alias("contiguous"),
    )


def carry_heading(df: DataFrame, keys: Sequence[str], order: str, heading: Column, out: str = "segment") -> DataFrame:
    """Give every ordered block the last heading at or before it; blocks before the first one get null."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(heading, ignorenulls=True).over(w))


def new_values(df: DataFrame, keys: Sequence[str], order: str, values: str, out: str = "new_values") -> DataFrame:
    """Array elements that the row before doesn't have; all of the first row's."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn(out, F.array_sort(F.array_except(values, F.coalesce(F.lag(values).over(w), F.array().cast(df.schema[values].dataType)))))


def _by_depth(df: DataFrame, depth: str) -> tuple[DataFrame, list, Column]:
    """The rows written once, the depths that occur in ascending order, and the place of a row's depth among them from 1."""
    rows = materialize(df, "depths")
    depths = sorted(r[0] for r in rows.select(depth).where(F.col(depth).isNotNull()).distinct().collect())
    return rows, depths, F.array_position(F.array(*[F.lit(d) for d in depths]).cast(ArrayType(df.schema[depth].dataType)), F.col(depth)).cast("int")


def nested_ranges(df: DataFrame, keys: Sequence[str], order: str, depth: str) -> DataFrame:
    """End of every heading's range: the next heading of the same or a smaller depth (exclusive), null for the last.

    Headings nest, so a parent's range holds its children's. For each depth
    the next smaller-or-equal heading is the nearest of the next ones at each
    depth up to it, which windows give without a join of headings with
    headings; the number of windows is the number of depths that occur.
    """
    rows, depths, place = _by_depth(df, depth)
    after = Window.partitionBy(*keys).orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    nexts = [F.first(F.when(F.col(depth) == d, F.col(order)), ignorenulls=True).over(after) for d in depths]
    rows = rows.withColumn("__n", F.array(*nexts).cast(ArrayType(df.schema[order].dataType)))
    return rows.withColumn("range_end", F.array_min(F.slice("__n", 1, place))).drop("__n")


def outline_parents(df: DataFrame, keys: Sequence[str], order: str, depth: str) -> DataFrame:
    """Parent of every ordered node of an outline: the nearest one before it with a smaller depth, null at the top.

    One window gives the last node of each depth that occurs before the node;
    the latest of those with a smaller depth is the parent.
    """
    rows, depths, place = _by_depth(df, depth)
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    lasts = [F.last(F.when(F.col(depth) == d, F.col(order)), ignorenulls=True).over(before) for d in depths]
    rows = rows.withColumn("__l", F.array(*lasts).cast(ArrayType(df.schema[order].dataType)))
    return rows.withColumn("parent_order", F.array_max(F.slice("__l", 1, place - 1))).drop("__l")


def logical_blocks(df: DataFrame, keys: Sequence[str], order: str, text: str) -> DataFrame:
    """Physical lines folded into logical blocks: a line that continues the one before joins its block.

    Result: keys, ``block_order`` from 0, ``first_line``, ``last_line`` and
    ``block_text`` (lines joined without a separator). A line continues if
    the one before isn't empty and has no closing punctuation, and it leads
    with no outline marker; see :func:`palimpsest.functions.text.soft_wrapped`.
    """
    w = Window.partitionBy(*keys).orderBy("__o")
    rows = df.select(*keys, F.col(order).alias("__o"), F.coalesce(F.col(text), F.lit("")).alias("__t"))
    starts = ~F.coalesce(soft_wrapped(F.lag("__t").over(w), F.col("__t")), F.lit(False))
    rows = rows.withColumn("__start", starts.cast("int"))
    rows = rows.withColumn("block_order", (F.sum("__start").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).cast("int"))
    lines = F.array_sort(F.collect_list(F.struct("__o", "__t")))
    return rows.groupBy(*keys, "block_order").agg(
        F.min("__o").alias("first_line"), F.max("__o").alias("last_line"), F.array_join(F.transform(lines, lambda x: x["__t"]), "").alias("block_text")
    )


def transition_label(before: Column, after: Column) -> Column:
    """What names the step from one version to the next, by the ISO dates that their texts hold.

    struct(new_dates, distance, compared_with, label): the number of dates
    that only the newer version has, how many versions apart the two are at
    least, ``older_version`` or ``previous_version`` by that, and the year of
    the Republic and month of the latest new date, null without any. Null
    dates don't count; null arrays count as empty.
    """
    none = F.array().cast("array<string>")
    new = F.array_except(F.array_distinct(F.array_compact(F.coalesce(after, none))), F.coalesce(before, none))
    n, latest = F.size(new).cast("bigint"), F.array_max(new)
    month = F.concat((F.substring(latest, 1, 4).cast("int") - 1911).cast("string"), F.lit("年"), F.substring(latest, 6, 2).cast("int").cast("string"), F.lit("月"))
    return F.struct(
        n.alias("new_dates"), F.greatest(F.lit(1).cast("bigint"), n).alias("distance"), F.when(n > 1, "older_version").otherwise("previous_version").alias("compared_with"), month.alias("label")
    )
