"""History of changing entity attributes, kept as checkpoints and deltas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.operators.links import follow_links_counted
from palimpsest.runtime import materialize, materialize_counted

#: Versions from one full checkpoint to the next; also the longest run of
#: patches that a reconstruction folds.
CHECKPOINT_EVERY = 16
#: Versions of one chain that a window task holds at most.
BLOCK = 1024


def version_paths(versions: DataFrame, edges: DataFrame, version: str, older: str, newer: str) -> DataFrame:
    """Place every version on a path of successive versions.

    Result ``(version, path, position)``: ``path`` is the first version of the
    path, ``position`` counts from 0. Versions that only the edges name are
    placed too. A version has one successor and one predecessor on its path;
    of several, the smallest id holds, and where two versions name the same
    successor the path of the other one ends there (see
    :func:`follow_branches`). A cycle of edges is cut
    before its smallest version.
    """
    link = edges.select(F.col(older).alias("o"), F.col(newer).alias("n")).where("o is not null and n is not null and o <> n")
    link = link.groupBy("o").agg(F.min("n").alias("n")).groupBy("n").agg(F.min("o").alias("o"))
    ids = (
        versions.select(F.col(version).alias("v"))
        .union(edges.select(F.col(older)))
        .union(edges.select(F.col(newer)))
        .where("v is not null")
        .distinct()
    )
    nodes = ids.join(link, ids.v == link.n, "left").select("v", F.col("o").alias("up"))
    whole, on_cycles = follow_links_counted(nodes, "v", "up", parents_exist=True)
    if on_cycles:
        starts = whole.where("depth is null").select("root").distinct().withColumnRenamed("root", "v").withColumn("cut", F.lit(True))
        nodes = nodes.join(starts, "v", "left").select("v", F.when(F.col("cut").isNull(), F.col("up")).alias("up"))
        whole, _ = follow_links_counted(nodes, "v", "up", parents_exist=True)
    return whole.select(F.col("node").alias("version"), F.col("root").alias("path"), F.col("depth").alias("position"))


def store_history(versions: DataFrame, placed: DataFrame, version: str, attributes: Sequence[str]) -> DataFrame:
    """Checkpoint-delta storage of the versions' attributes.

    Result ``(path, checkpoint, position, version, full, attrs)``: every
    ``CHECKPOINT_EVERY``-th version of a path is a checkpoint with all
    attributes (``full``), the others are patches that hold only the
    attributes whose value differs from the version before, a null value
    included. ``checkpoint`` is the number of the checkpoint that a row
    belongs to. ``versions`` has one row per version; attributes are kept as
    strings; a version without a row has all of them null.
    """
    rows = placed.join(
        versions.select(F.col(version).alias("version"), *[F.col(a).cast("string").alias(a) for a in attributes]),
        "version",
        "left",
    ).withColumn("checkpoint", F.floor(F.col("position") / CHECKPOINT_EVERY))
    before = Window.partitionBy("path", "checkpoint").orderBy("position")
    full = F.col("position") % CHECKPOINT_EVERY == 0
    kept = F.array(
        *[
            F.when(full | ~F.col(a).eqNullSafe(F.lag(a).over(before)), F.struct(F.lit(a).alias("name"), F.col(a).alias("value")))
            for a in attributes
        ]
    )
    return rows.select("path", "checkpoint", "position", "version", full.alias("full"), F.array_compact(kept).alias("attrs"))


def reconstruct(store: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """All versions with all attributes, from their checkpoint and patches.

    The patches of a checkpoint are folded forward in order. A group is one
    checkpoint with its patches, ``CHECKPOINT_EVERY`` rows at most, so a path
    of any length is spread over as many groups as it has checkpoints.
    """
    groups = store.groupBy("path", "checkpoint").agg(
        F.array_sort(F.collect_list(F.struct("position", "version", "attrs"))).alias("steps")
    )
    named = lambda attrs, a: F.filter(attrs, lambda x: x["name"] == a)
    empty = F.struct(*[F.lit(None).cast("string").alias(a) for a in attributes])

    def patched(state, step):
        return F.struct(
            *[
                F.when(F.size(named(step["attrs"], a)) > 0, F.get(named(step["attrs"], a), F.lit(0))["value"])
                .otherwise(state[a])
                .alias(a)
                for a in attributes
            ]
        )

    def forward(states, step):
        last = F.when(F.size(states) > 0, F.element_at(states, -1)["state"]).otherwise(empty)
        entry = F.struct(step["position"].alias("position"), step["version"].alias("version"), patched(last, step).alias("state"))
        return F.concat(states, F.array(entry))

    start = F.array().cast(
        "array<struct<position:bigint,version:string,state:struct<" + ",".join(f"`{a}`:string" for a in attributes) + ">>>"
    )
    folded = groups.select("path", F.explode(F.aggregate("steps", start, forward)).alias("x"))
    return folded.select("path", "x.position", "x.version", "x.state.*")


def validity(states: DataFrame, valid_from: str) -> DataFrame:
    """Add ``valid_to``: the ``valid_from`` of the next version on the path that has one.

    Versions without ``valid_from`` are passed over and get no row. ``valid_to``
    is null for the last one. The search runs over blocks of ``BLOCK``
    positions; a second window over one row per block finds the first date
    after the block.
    """
    rows = states.withColumn("__block", F.floor(F.col("position") / BLOCK))
    inside = Window.partitionBy("path", "__block").orderBy("position").rowsBetween(1, Window.unboundedFollowing)
    rows = rows.where(F.col(valid_from).isNotNull()).withColumn("__next", F.first(valid_from, ignorenulls=True).over(inside))
    heads = rows.groupBy("path", "__block").agg(F.min_by(valid_from, "position").alias("__head"))
    after = Window.partitionBy("path").orderBy("__block").rowsBetween(1, Window.unboundedFollowing)
    heads = heads.withColumn("__later", F.first("__head").over(after)).drop("__head")
    return (
        rows.join(heads, ["path", "__block"])
        .withColumn("valid_to", F.coalesce("__next", "__later"))
        .drop("__next", "__later", "__block")
    )


def _nearest(dated: DataFrame, points: DataFrame, behind: bool) -> DataFrame:
    """The dated version nearest to every point of a path: at or behind it, or at or before it.

    ``dated`` has ``(path, position, date)`` and ``points`` ``(id, path,
    position)``; the result adds ``near`` and ``date``, null if there is none.
    The search runs over blocks of ``BLOCK`` positions, as in
    :func:`validity`, so a long path with many points is not one task.
    """
    block = F.floor(F.col("position") / BLOCK).alias("block")
    version = F.struct(F.col("position").alias("near"), "date")
    both = dated.select(F.lit(None).cast("bigint").alias("id"), "path", "position", block, version.alias("v")).unionByName(
        points.select("id", "path", "position", block, F.lit(None).cast("struct<near:bigint,date:string>").alias("v"))
    )
    # At its own position a version counts for a point in both directions.
    last = F.desc if behind else F.asc
    seen = Window.partitionBy("path", "block").orderBy(last("position"), F.col("id").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("here", F.last("v", ignorenulls=True).over(seen))
    heads = dated.groupBy("path", block).agg((F.min if behind else F.max)(version).alias("edge"))
    # Blocks that only have points need the edge of another block as well.
    heads = both.select("path", "block").distinct().join(heads, ["path", "block"], "left")
    other = Window.partitionBy("path").orderBy(last("block")).rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumn("there", F.last("edge", ignorenulls=True).over(other)).select("path", "block", "there")
    found = both.where("id is not null").join(heads, ["path", "block"]).withColumn("v", F.coalesce("here", "there"))
    return found.select("id", "path", "position", "v.near", "v.date")


def follow_branches(rows: DataFrame, placed: DataFrame, edges: DataFrame, older: str, newer: str, valid_from: str) -> DataFrame:
    """Close periods by the edges that leave their path, too.

    Such edges are there where several versions name one newer version, or
    one version several newer ones. The period of the last dated version at
    or before such an edge ends with the earliest date that any of its
    successors leads to, versions without a date being passed over. ``rows``
    are of :func:`validity`; without such edges they are returned as they
    are. An edge back to an earlier version of its own path closes a cycle
    and leads nowhere.
    """
    link = edges.select(F.col(older).alias("o"), F.col(newer).alias("n")).where("o is not null and n is not null and o <> n").distinct()
    a = placed.select(F.col("version").alias("o"), "path", "position")
    b = placed.select(F.col("version").alias("n"), F.col("path").alias("to_path"), F.col("position").alias("to_position"))
    off_path = "path <> to_path or to_position > position + 1"
    branches, (some,) = materialize_counted(
        link.join(a, "o").join(b, "n").where(off_path).select(F.xxhash64("o", "n").alias("id"), "path", "position", "to_path", "to_position"), "branches", F.count("*")
    )
    if not some:
        return rows
    dated = materialize(rows.select("path", "position", F.col(valid_from).alias("date")), "dated")
    ends = _nearest(dated, branches.select("id", F.col("to_path").alias("path"), F.col("to_position").alias("position")), behind=True)
    owners = _nearest(dated, branches.select("id", "path", "position"), behind=False).select("id", F.col("near").alias("owner"))
    state = branches.join(ends.select("id", F.col("near").alias("upto"), F.col("date").alias("later")), "id").join(owners, "id")
    state = materialize(state, "branches")
    # A branch also leads where the branches lead that leave its target before the first date there.
    onward = state.select(F.col("id").alias("next"), F.col("path").alias("to_path"), F.col("position").alias("leaves"), F.col("owner").alias("after"))
    reach = F.col("leaves") >= F.col("to_position")
    steps = state.join(onward, "to_path").where(reach & (F.col("upto").isNull() | (F.col("leaves") < F.col("upto"))) & (F.col("after").isNull() | (F.col("after") < F.col("to_position"))))
    steps, (moving,) = materialize_counted(steps.select("id", "next").where("id <> next").distinct(), "steps", F.count("*"))
    best = state.select("id", "later")
    for _ in range(some if moving else 0):
        better = steps.join(best.select(F.col("id").alias("next"), "later"), "next").groupBy("id").agg(F.min("later").alias("found"))
        moved = best.join(better, "id", "left")
        changed = F.coalesce(F.col("found") < F.col("later"), F.col("found").isNotNull() & F.col("later").isNull())
        best, (n,) = materialize_counted(moved.select("id", F.least("later", "found").alias("later"), changed.alias("changed")), "best", F.count_if("changed"))
        if not n:
            break
    closed = state.drop("later").join(best.select("id", "later"), "id").where("owner is not null")
    closed = closed.groupBy("path", F.col("owner").alias("position")).agg(F.min("later").alias("later"))
    return rows.join(closed, ["path", "position"], "left").withColumn("valid_to", F.least("valid_to", "later")).drop("later")


def version_history(
    versions: DataFrame,
    edges: DataFrame,
    *,
    version: str,
    valid_from: str,
    older: str,
    newer: str,
    attributes: Sequence[str] = (),
    observed: Sequence[str] = (),
) -> DataFrame:
    """Full history of versions with the period for which each was valid.

    ``versions`` may show a version many times (in every snapshot); the
    earliest ``valid_from`` holds, and the attributes of the first row by
    ``observed`` (of several the smallest values, taken together). Result: ``version, path, position, valid_from, valid_to`` and the
    attributes, one row per version with any ``valid_from``; ``valid_to`` is
    null for the last; of several successors the earliest date holds. Null versions and empty tables give no rows, unknown
    edge ends are versions without attributes, and columns that aren't named
    don't matter.
    """
    names = ["valid_from", *[f"a{i}" for i in range(len(attributes))]]
    rows = versions.where(F.col(version).isNotNull()).groupBy(F.col(version).cast("string").alias("v"))
    first = F.min(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(observed)], *[F.col(a).cast("string").alias(n) for a, n in zip(attributes, names[1:])], F.lit(0).alias("end")))
    seen = rows.agg(F.min(valid_from).cast("string").alias("valid_from"), first.alias("first"))
    seen = seen.select("v", "valid_from", *[F.col(f"first.{n}").alias(n) for n in names[1:]])
    seen = materialize(seen, "seen")
    ends = edges.select(F.col(older).cast("string").alias("o"), F.col(newer).cast("string").alias("n"))
    placed = version_paths(seen, ends, "v", "o", "n")
    store = materialize(store_history(seen, placed, "v", names), "history")
    rows = follow_branches(validity(reconstruct(store, names), "valid_from"), placed, ends, "o", "n", "valid_from")
    return rows.select(
        "version", "path", "position", "valid_from", "valid_to", *[F.col(n).alias(a) for a, n in zip(attributes, names[1:])]
    )
