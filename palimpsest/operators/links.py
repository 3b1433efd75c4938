"""Following single-successor links (version chains, supersession) to their ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.runtime import discard, materialize, materialize_counted


def follow_links(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """Root and depth of every node of a forest given by parent links.

    Result ``(node, root, depth)``. A parent that isn't itself a node counts
    as none, so its children are roots. Nodes on a cycle, or that lead into
    one, have the smallest node of that cycle as root and depth null. Rows
    with a null node are left out; of several parents of one node the smallest
    holds.

    Method: pointer jumping. Each round joins the nodes whose pointer still
    moves with the table of pointers, twice, so a chain of n links takes
    log3(n) rounds of equi-joins on unique keys, whatever the shape of the
    forest; no chain is ever gathered in one task. Each round is written to
    the shared folder.
    """
    return follow_links_counted(nodes, node, parent)[0]


def follow_links_counted(nodes: DataFrame, node: str, parent: str, parents_exist: bool = False) -> tuple[DataFrame, int]:
    """:func:`follow_links`, and how many nodes are on a cycle or lead into one.

    With ``parents_exist`` every parent is known to be a node.
    """
    links = (
        nodes.select(F.col(node).alias("id"), F.col(parent).alias("up"))
        .where("id is not null")
        .groupBy("id")
        .agg(F.min("up").alias("up"))
    )
    if parents_exist:
        links = links.withColumn("real", F.col("up").isNotNull())
    else:
        known = links.select(F.col("id").alias("up"), F.lit(True).alias("real"))
        links = links.join(known, "up", "left").withColumn("real", F.coalesce("real", F.lit(False)))
    up = F.when(F.col("real"), F.col("up"))
    counts = F.count("*"), F.coalesce(F.sum(F.when(F.col("done"), 0).otherwise(1)), F.lit(0))
    state, (total, left) = materialize_counted(
        links.select(
            "id",
            F.coalesce(up, "id").alias("ptr"),
            F.when(F.col("real"), 1).otherwise(0).cast("long").alias("steps"),
            F.least("id", up).alias("low"),
            (~F.col("real")).alias("done"),
        ),
        "links",
        *counts,
    )
    jump = 1
    while left and jump <= total:
        # Two joins with the same table triple the reach of a pointer.
        ahead = state.select(*[F.col(c).alias(c + "_2") for c in state.columns])
        moved = state.where("not done")
        for _ in range(2):
            moved = moved.join(ahead, F.col("ptr") == F.col("id_2")).select(
                "id",
                F.col("ptr_2").alias("ptr"),
                F.when(F.col("done"), F.col("steps")).otherwise(F.col("steps") + F.col("steps_2")).alias("steps"),
                F.least("low", "low_2").alias("low"),
                F.col("done_2").alias("done"),
            )
        before = state
        state, (_, left) = materialize_counted(before.where("done").unionByName(moved), "links", *counts)
        discard(before)
        jump *= 3
    found = state.where("done").select("id", F.col("ptr").alias("root"), F.col("steps").alias("depth"))
    if left:
        # What still moves runs in a cycle: the pointer stands on it, and the lowest node seen from there is the cycle's.
        moving = state.where("not done")
        on_cycle = moving.select(F.col("id").alias("ptr"), F.col("low").alias("root"))
        found = found.unionByName(moving.select("id", "ptr").join(on_cycle, "ptr").select("id", "root", F.lit(None).cast("long").alias("depth")))
    return found.withColumnRenamed("id", "node"), left


def closure(edges: DataFrame, source: str, target: str) -> DataFrame:
    """Everything that each node reaches along many-to-many edges.

    Result ``(node, reached, distance, path, on_cycle)``, one row per pair: the
    number of edges of the shortest way, the nodes of that way (of several
    the smallest path) and whether ``reached`` is the node itself, which then
    is on a cycle. Nulls and repeated edges don't count.

    Each round extends the pairs of the round before by one edge and keeps
    the new ones, so there are as many rounds as the longest shortest way has
    edges, and cycles end by themselves. The pairs are the result; nothing
    else is kept.
    """
    links = edges.select(F.col(source).alias("a"), F.col(target).alias("b")).where("a is not null and b is not null").distinct()
    links = materialize(links, "links")
    found = links.select(F.col("a").alias("node"), F.col("b").alias("reached"), F.lit(1).alias("distance"), F.array("a", "b").alias("path"))
    last = found
    while True:
        step = last.join(links, F.col("reached") == F.col("a")).select("node", F.col("b").alias("reached"), (F.col("distance") + 1).alias("distance"), F.concat("path", F.array("b")).alias("path"))
        step = step.groupBy("node", "reached").agg(F.min("distance").alias("distance"), F.min("path").alias("path"))
        last, (n,) = materialize_counted(step.join(found.select("node", "reached"), ["node", "reached"], "left_anti"), "closure", F.count("*"))
        if not n:
            break
        found = found.unionByName(last)
    return found.withColumn("on_cycle", F.col("node") == F.col("reached"))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of undirected edges: ``(node, component)``, named by their smallest node.

    Nodes without an edge to another one have no row; nulls, loops and
    repeated edges don't count.

    Method: alternating stars. Each round hangs the larger neighbours of every
    node on its smallest neighbour, then the smaller ones, until only stars
    are left. The rounds grow with the logarithm of the nodes, no component
    is ever gathered in one task, and each round is written.
    """
    rows = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    mark = F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    state, seen = materialize_counted(rows, "stars", *mark)
    while True:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        before = state
        state, now = materialize_counted(small, "stars", *mark)
        discard(before)
        if now == seen:
            break
        seen = now
    hung = state.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return hung.unionByName(hung.select(F.col("component").alias("node"), "component").distinct())
