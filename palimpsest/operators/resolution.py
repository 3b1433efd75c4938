"""Coverage audits, resolution of markers to events, work queues and three-valued decisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions import ids
from palimpsest.operators.latest import as_of


def coverage_audit(expected: DataFrame, found: DataFrame, key: str, value: str, cut: Column | None = None) -> DataFrame:
    """Compare two sets of values per key, and say why a key isn't complete.

    Result: ``key, expected_values, found_values, missing, unexpected,
    post_cut, reasons, complete``. Values after ``cut`` are reported apart
    and not compared. A key without any evidence is incomplete, and keys that
    only the found side has are orphans.
    """
    inside = lambda df: df.where(F.col(value) <= cut) if cut is not None else df
    sets = lambda df, name: df.where(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(value)).alias(name))
    joined = sets(inside(expected), "expected_values").join(sets(inside(found), "found_values"), key, "full_outer")
    after = expected.where(F.col(value) > cut) if cut is not None else expected.where(F.lit(False))
    joined = joined.join(sets(after, "post_cut"), key, "full_outer")
    none = F.array().cast(f"array<{dict(expected.dtypes)[value]}>")
    e, f, p = (F.coalesce(F.col(c), none) for c in ("expected_values", "found_values", "post_cut"))
    missing, unexpected = F.array_sort(F.array_except(e, f)), F.array_sort(F.array_except(f, e))
    reason = lambda name, condition: F.when(condition, F.lit(name))
    reasons = F.array_compact(
        F.array(
            reason("no_evidence", F.size(f) == 0), reason("not_expected", F.size(e) == 0), reason("values_missing", F.size(missing) > 0),
            reason("values_unexpected", F.size(unexpected) > 0), reason("values_after_cut", F.size(p) > 0),
        )
    )
    return joined.select(
        key, e.alias("expected_values"), f.alias("found_values"), missing.alias("missing"), unexpected.alias("unexpected"), p.alias("post_cut"),
        reasons.alias("reasons"), (F.size(reasons) == 0).alias("complete"),
    )


def resolve_markers(markers: DataFrame, events: DataFrame, *, marker: str, event: str, date: str, designation: str) -> DataFrame:
    """Link dated markers to the events of the same date and say how far each is resolved.

    All pairs of a date are kept as evidence. A pair is ``incompatible`` if
    both designations are known and differ, ``indeterminate`` if one is null.
    Status in this order: ``invalid_date`` (null date), ``no_match``,
    ``no_compatible``, ``ambiguous`` (several that fit), ``indeterminate``,
    ``resolved``. Result: ``marker, status, candidates, compatible,
    event_ids``.
    """
    m = markers.select(F.col(marker).alias("marker"), F.col(date).alias("d"), F.col(designation).alias("md"))
    e = events.select(F.col(event).alias("event"), F.col(date).alias("d"), F.col(designation).alias("ed"))
    pairs = m.join(e, "d", "left")
    fits = F.when(F.col("event").isNull(), None).when(F.col("md").isNull() | F.col("ed").isNull(), "indeterminate").when(F.col("md") == F.col("ed"), "compatible").otherwise("incompatible")
    facts = pairs.withColumn("fit", fits).groupBy("marker").agg(
        F.max(F.col("d").isNull()).alias("no_date"),
        F.count("event").alias("candidates"),
        F.count_if(F.col("fit") == "compatible").alias("compatible"),
        F.count_if(F.col("fit") == "indeterminate").alias("unclear"),
        F.array_sort(F.collect_set(F.when(F.col("fit") != "incompatible", F.col("event")))).alias("event_ids"),
    )
    status = (
        F.when(F.col("no_date"), "invalid_date")
        .when(F.col("candidates") == 0, "no_match")
        .when(F.col("compatible") + F.col("unclear") == 0, "no_compatible")
        .when(F.col("compatible") + F.col("unclear") > 1, "ambiguous")
        .when(F.col("unclear") == 1, "indeterminate")
        .otherwise("resolved")
    )
    return facts.select("marker", status.alias("status"), "candidates", "compatible", "event_ids")


def candidate_blockers(
    markers: DataFrame, events: DataFrame, *, marker: str, event: str, date: str, designation: str, marker_flags: Sequence[str] = (), event_flags: Sequence[str] = ()
) -> DataFrame:
    """All pairs of markers and events of one date with what keeps each from being accepted.

    ``marker_flags`` and ``event_flags`` are boolean columns of the two
    tables; a true one blocks under its own name, a null one doesn't. A
    missing designation of either side and designations that differ or can't
    be compared block too. Result: ``marker, event, fit, blockers, eligible``,
    the blockers sorted and distinct. Markers and events without a date are
    in no pair.
    """
    m = markers.select(F.col(marker).alias("marker"), F.col(date).alias("d"), F.col(designation).alias("md"), *[F.col(f).alias(f"m_{f}") for f in marker_flags])
    e = events.select(F.col(event).alias("event"), F.col(date).alias("d"), F.col(designation).alias("ed"), *[F.col(f).alias(f"e_{f}") for f in event_flags])
    fit = F.when(F.col("md").isNull() | F.col("ed").isNull(), "indeterminate").when(F.col("md") == F.col("ed"), "compatible").otherwise("incompatible")
    pairs = m.join(e, "d").withColumn("fit", fit)
    reasons = [
        F.when(F.col("md").isNull(), F.lit("marker_designation_omitted")), F.when(F.col("ed").isNull(), F.lit("event_designation_omitted")),
        F.when(F.col("fit") == "incompatible", F.lit("designation_incompatible")), F.when(F.col("fit") == "indeterminate", F.lit("designation_indeterminate")),
        *[F.when(F.col(f"m_{f}"), F.lit(f"marker_{f}")) for f in marker_flags], *[F.when(F.col(f"e_{f}"), F.lit(f"event_{f}")) for f in event_flags],
    ]
    blockers = F.array_sort(F.array_distinct(F.array_compact(F.array(*reasons))))
    return pairs.select("marker", "event", "fit", blockers.alias("blockers"), (F.size(blockers) == 0).alias("eligible"))


def gap_work_units(pairs: DataFrame, candidates: DataFrame, key: str, lanes: Sequence[tuple[str, int, Column]], otherwise: tuple[str, int], cut: str, columns: Sequence[str]) -> DataFrame:
    """One unit of work per pair of evidence that is still open.

    ``candidates`` are joined to the pairs on ``key``; a lane is the first of
    ``(name, priority, condition)`` that holds. Result: ``key``, a stable
    ``work_unit_id`` of the key, ``lane, priority``, the ``columns`` and the
    hash of these, ``cut``. Candidates without a pair become units of the lane
    ``unknown_pair``, so that none is lost.
    """
    known = pairs.withColumn("__pair", F.lit(True)).join(candidates.withColumn("__candidate", F.lit(True)), key, "full_outer")
    lane, priority = F.lit(otherwise[0]), F.lit(otherwise[1])
    for name, rank, condition in reversed(lanes):
        lane, priority = F.when(condition, F.lit(name)).otherwise(lane), F.when(condition, F.lit(rank)).otherwise(priority)
    orphan = F.col("__pair").isNull()
    made = known.select(
        key, ids.stable_id("gap-work-unit", F.col(key)).alias("work_unit_id"), F.when(orphan, "unknown_pair").otherwise(lane).alias("lane"),
        F.when(orphan, 0).otherwise(priority).alias("priority"), *columns,
    )
    return made.withColumn("row_sha256", F.sha2(ids.canonical_row(made, [key, *columns]), 256)).withColumn("declared_cut", F.lit(cut))


def dataset_audit(expected: DataFrame, found: DataFrame, known: DataFrame, key: str, value: str, cut: Column | None = None) -> DataFrame:
    """:func:`coverage_audit` summed over all keys, one row, with what refers to no known key.

    ``known`` has the keys that exist. Counts: ``known_keys, audited_keys,
    complete_keys, missing_values, unexpected_values, post_cut_values``, the
    known keys ``without_rows`` and the ``orphan_keys`` of both sides.
    """
    audit = coverage_audit(expected, found, key, value, cut)
    listed = known.select(key).where(F.col(key).isNotNull()).distinct().withColumn("known", F.lit(True))
    rows = audit.withColumn("audited", F.lit(True)).join(listed, key, "full_outer")
    audited = F.col("audited").isNotNull()
    total = lambda c: F.coalesce(F.sum(F.size(c)), F.lit(0))
    return rows.agg(
        F.count("known").alias("known_keys"), F.count_if(audited).alias("audited_keys"), F.count_if(F.col("complete")).alias("complete_keys"),
        total(F.when(audited, F.col("missing"))).alias("missing_values"), total(F.when(audited, F.col("unexpected"))).alias("unexpected_values"),
        total(F.when(audited, F.col("post_cut"))).alias("post_cut_values"), F.count_if(~audited).alias("without_rows"), F.count_if(audited & F.col("known").isNull()).alias("orphan_keys"),
    )


def joint_artifacts(left: DataFrame, right: DataFrame, key: str, artifact: str) -> DataFrame:
    """Per key the artifacts that hold both the one and the other piece of evidence, with their number and class."""
    a, b = (df.select(key, artifact).distinct() for df in (left, right))
    both = a.join(b, [key, artifact]).groupBy(key).agg(F.array_sort(F.collect_set(artifact)).alias("artifacts"))
    rows = a.select(key).union(b.select(key)).distinct().join(both, key, "left")
    n = F.coalesce(F.size("artifacts"), F.lit(0))
    n = F.when(n < 0, 0).otherwise(n)
    return rows.select(key, "artifacts", n.alias("joint_count"), F.when(n == 0, "none").when(n == 1, "unique").otherwise("ambiguous").alias("joint_class"))


# Three-valued truth as 1, 0 (false) and -1 (unknown).


def truth(condition: Column) -> Column:
    """1 or 0 of a boolean, -1 where it is null."""
    return F.when(condition.isNull(), -1).when(condition, 1).otherwise(0).cast("short")


def fact_truth(facts: Column, name: str) -> Column:
    """Truth of a fact in a JSON text: -1 unless the value is a JSON boolean."""
    value = F.get_json_object(facts, f"$.{name}")
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(facts), f"$.{name}", "variant"))
    return F.when(kind != "BOOLEAN", -1).when(value == "true", 1).when(value == "false", 0).otherwise(-1).cast("short")


def compare_truth(value: Column, operator: str, limit: Column) -> Column:
    """Truth of a comparison (``>=``, ``<`` or ``=``), -1 if either side is null."""
    tests = {">=": value >= limit, "<": value < limit, "=": value == limit}
    return truth(tests[operator])


def all_of(truths: Sequence[Column]) -> Column:
    """Conjunction: false wins, then unknown."""
    low = F.array_contains(F.array(*truths), F.lit(0).cast("short"))
    unknown = F.array_contains(F.array(*truths), F.lit(-1).cast("short"))
    return F.when(low, 0).when(unknown, -1).otherwise(1).cast("short")


def any_of(truths: Sequence[Column]) -> Column:
    """Disjunction: true wins, then unknown."""
    high = F.array_contains(F.array(*truths), F.lit(1).cast("short"))
    unknown = F.array_contains(F.array(*truths), F.lit(-1).cast("short"))
    return F.when(high, 1).when(unknown, -1).otherwise(0).cast("short")


def at_least(truths: Sequence[Column], n: int) -> Column:
    """Whether at least ``n`` are true: unknown while the unknown ones could decide."""
    yes = F.aggregate(F.array(*truths), F.lit(0), lambda acc, t: acc + F.when(t == 1, 1).otherwise(0))
    maybe = F.aggregate(F.array(*truths), F.lit(0), lambda acc, t: acc + F.when(t != 0, 1).otherwise(0))
    return F.when(yes >= n, 1).when(maybe < n, 0).otherwise(-1).cast("short")


def exactly(truths: Sequence[Column], n: int) -> Column:
    """Whether just ``n`` are true: unknown while the unknown ones could decide."""
    yes = F.aggregate(F.array(*truths), F.lit(0), lambda acc, t: acc + F.when(t == 1, 1).otherwise(0))
    maybe = F.aggregate(F.array(*truths), F.lit(0), lambda acc, t: acc + F.when(t != 0, 1).otherwise(0))
    return F.when((yes > n) | (maybe < n), 0).when(yes == maybe, 1).otherwise(-1).cast("short")


def disallowed_attempts(attempts: DataFrame, states: DataFrame, keys: Sequence[str], time: str, kind: str, state: str, allowed: DataFrame) -> DataFrame:
    """Attempts that the state at their time doesn't allow, with that state (null if there was none yet).

    ``allowed`` has the pairs ``(kind, state)``.
    """
    seen = as_of(attempts, states, keys, time, [state])
    pairs = allowed.select(F.col("kind").alias("__k"), F.col("state").alias("__s")).distinct()
    return seen.join(pairs, (F.col(kind) == F.col("__k")) & (F.col(state) == F.col("__s")), "left_anti")


def first_category(categories: Sequence[tuple[str, Column]]) -> Column:
    """The first category that is true; an unknown one of higher priority stops the search: struct(category, reason)."""
    out = F.struct(F.lit(None).cast("string").alias("category"), F.lit("none_true").alias("reason"))
    for name, value in reversed(categories):
        hit = F.struct(F.lit(name).alias("category"), F.lit("true").alias("reason"))
        stop = F.struct(F.lit(None).cast("string").alias("category"), F.lit("higher_priority_unknown").alias("reason"))
        out = F.when(value == 1, hit).when(value == -1, stop).otherwise(out)
    return out


def illegal_transitions(df: DataFrame, keys: Sequence[str], order: Sequence[str], state: str, edges: DataFrame) -> DataFrame:
    """Steps of a log that the table of allowed ``(from_state, to_state)`` doesn't have; the first step comes from null."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(*order)
    steps = df.withColumn("from_state", F.lag(state).over(w)).withColumn("to_state", F.col(state))
    allowed = edges.select(F.col("from_state").alias("__f"), F.col("to_state").alias("__t")).distinct()
    return steps.join(allowed, F.col("from_state").eqNullSafe(F.col("__f")) & F.col("to_state").eqNullSafe(F.col("__t")), "left_anti")
