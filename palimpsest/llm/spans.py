"""Long exact spans that records share, from a compacted de Bruijn graph.

The edges are the k-mers of ``span`` code points of every text. Each belongs
to the anchor that it holds: the token of ``ANCHOR`` code points with the
smallest hash in it; anchors that one owner alone has are dropped with their
edges. What is left is the graph: an edge follows another one if it does so in
some text. Runs in which each edge has one successor and that one predecessor,
wherever they stand, are compacted into one node by joins on the edges; where
all occurrences of an anchor have the same edges, these are one from the
start. The source coordinates of every compacted node then lead back to the
texts, and only spans whose texts are equal count as shared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.arrays import mix, rolling_hash, steps
from palimpsest.llm.members import distinct_texts, meeting, same
from palimpsest.runtime import discard, materialize

#: Code points of an anchor token. Shorter ones make fewer paths, longer ones repeat less often by chance.
ANCHOR = 24


def _smallest(values: np.ndarray, window: int) -> np.ndarray:
    """Position of the leftmost smallest value in every window, by doubling."""
    low, at, size = values, np.arange(len(values)), 1

    def join(a, ia, b, ib):
        left = a <= b
        return np.where(left, a, b), np.where(left, ia, ib)

    while size * 2 <= window:
        n = len(low) - size
        low, at = join(low[:n], at[:n], low[size:], at[size:])
        size *= 2
    if size < window:
        step = window - size
        n = len(low) - step
        low, at = join(low[:n], at[:n], low[step:], at[step:])
    return at


def paths(points: np.ndarray, bounds: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """Paths of the texts: (text, anchor hash, path hash, first edge, last edge), offsets within the text."""
    window = span - ANCHOR + 1
    if len(points) < span:
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64))
    tokens, edges = rolling_hash(points, ANCHOR), rolling_hash(points, span)
    at = _smallest(mix(tokens), window)
    sizes = np.diff(bounds)
    each = np.maximum(sizes - span + 1, 0)
    text = np.repeat(np.arange(len(sizes)), each)
    edge = np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each) + np.repeat(bounds[:-1], each)
    anchor = at[edge]
    start = np.ones(len(edge), dtype=bool)
    start[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(start)
    last = np.append(first[1:], len(edge)) - 1
    a, b = edge[first], edge[last]
    of = text[first]
    return of, tokens[anchor[first]], path_hash(edges[a], edges[b], b - a), a - bounds[of], b - bounds[of]


def path_hash(first: np.ndarray, last: np.ndarray, steps_between: np.ndarray) -> np.ndarray:
    """Hash of a path: its first and last edge overlap and so cover all of it."""
    return mix(mix(first + np.uint64(1)) ^ last + steps_between.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _occurrences(texts: DataFrame, span: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds = np.asarray(batch.column(2)).view(np.uint64)
            for start, points, bounds in steps(batch.column(3)):
                of, anchor, path, first, last = paths(points, bounds, span)
                at = of + start
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), _long(mix(anchor ^ seeds[at])), _long(path),
                        pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
                    ],
                    names=["short", "owner", "anchor", "path", "first", "last"],
                )

    rows = texts.select("short", "owner", F.xxhash64("scope"), "text")
    return rows.mapInArrow(run, "short bigint, owner bigint, anchor bigint, path bigint, first int, last int")


def _edges(texts: DataFrame, found: DataFrame, span: int) -> DataFrame:
    """``(short, owner, n, before, behind, first, last)`` of every text with shared anchors.

    Arrays hold its edges, or paths of such, in order, and their neighbours.
    """
    anchors = (
        found.groupBy("anchor")
        .agg(F.min("owner").alias("lo"), F.max("owner").alias("hi"), F.min("path").alias("p"), F.max("path").alias("q"))
        .where("lo <> hi")
        .select("anchor", (F.col("p") != F.col("q")).alias("branches"))
    )
    places = found.select("short", "anchor", "first", "last").join(materialize(anchors, "anchors"), "anchor")
    # A text has no more paths than code points.
    wanted = places.groupBy("short").agg(F.array_sort(F.collect_list(F.struct("first", "last", "branches"))).alias("places"))
    rows = texts.select("short", "owner", F.xxhash64("scope").alias("seed"), "text").join(wanted, "short").select("short", "owner", "seed", "text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(4)
            values, offsets = lists.flatten(), np.asarray(lists.offsets) - lists.offsets[0].as_py()
            lo, hi, branches = (np.asarray(values.field(i)) for i in range(3))
            seeds = np.asarray(batch.column(2)).view(np.uint64)
            for start, points, bounds in steps(batch.column(3)):
                count = len(bounds) - 1
                inside = slice(offsets[start], offsets[start + count])
                of = np.repeat(np.arange(count), np.diff(offsets[start : start + count + 1]))
                a, b, split = lo[inside].astype(np.int64), hi[inside].astype(np.int64), branches[inside].astype(bool)
                # A branching place gives each of its edges, another one its whole path.
                times = np.where(split, b - a + 1, 1)
                which = np.repeat(np.arange(len(a)), times)
                step = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
                first, last = a[which] + step, np.where(split[which], a[which] + step, b[which])
                row = of[which]
                edges = rolling_hash(points, span)
                nodes = mix(path_hash(edges[first + bounds[row]], edges[last + bounds[row]], last - first) ^ seeds[start + row])
                # The edge before and behind each one in its text, 0 where there is none.
                linked = (row[1:] == row[:-1]) & (first[1:] == last[:-1] + 1)
                before, behind = np.zeros_like(nodes), np.zeros_like(nodes)
                before[1:][linked], behind[:-1][linked] = nodes[:-1][linked], nodes[1:][linked]
                ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=count))]).astype(np.int32))
                lists = [_long(nodes), _long(before), _long(behind), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, count), batch.column(1).slice(start, count), *[pa.ListArray.from_arrays(ends, x) for x in lists]],
                    names=["short", "owner", "n", "before", "behind", "first", "last"],
                )

    return rows.mapInArrow(run, "short bigint, owner bigint, n array<bigint>, before array<bigint>, behind array<bigint>, first array<int>, last array<int>")


def compacted(edges: DataFrame) -> DataFrame:
    """Nodes of the compacted graph that several owners have: ``(short, node, first, last)``, one row per occurrence.

    ``edges`` is of :func:`_edges`. An edge is joined to the one before it if
    it follows that one, and nothing else, wherever either stands. Both ends
    of the graph at a text's ends or at dropped anchors count as edges of
    their own, so a run of edges is either there as a whole or not at all,
    and its first edge names it.
    """
    only = lambda side: (F.min(side) == F.max(side)) & (F.min(side) != 0)
    of = edges.select("owner", F.inline(F.arrays_zip("n", "before", "behind"))).groupBy("n")
    known = of.agg(F.min("owner").alias("lo"), F.max("owner").alias("hi"), only("before").alias("one_before"), only("behind").alias("one_behind"))
    known = known.where("lo <> hi").select("n", "one_before", "one_behind")
    rows = edges.select("short", F.inline(F.arrays_zip("n", "first", "last"))).join(known, "n")
    order = Window.partitionBy("short").orderBy("first")
    follows = F.col("one_before") & F.lag("one_behind").over(order) & (F.lag("last").over(order) + 1 == F.col("first"))
    runs = rows.withColumn("starts", F.when(follows, 0).otherwise(1)).withColumn("run", F.sum("starts").over(order))
    return runs.groupBy("short", "run").agg(F.min_by("n", "first").alias("node"), F.min("first").alias("first"), F.max("last").alias("last")).drop("run")


def shared_nodes(texts: DataFrame, span: int) -> DataFrame:
    """Spans of the texts that others have: ``(id, owner, node, passage, first, end)``, half-open code-point offsets.

    ``texts`` is ``(id, scope, text, owner)``, one row per scope and distinct
    text; ``owner`` is a number, of its own for a text that several owners
    have. ``passage`` is read from the text at the coordinates of the node's
    occurrence, so two rows are of one span only if node and passage agree.
    """
    texts = texts.withColumn("short", F.xxhash64("id"))
    found = materialize(_occurrences(texts, span), "occurrences")
    edges = materialize(_edges(texts, found, span), "edges")
    discard(found)
    places = compacted(edges).groupBy("short").agg(F.collect_list(F.struct("node", "first", (F.col("last") + span).alias("end"))).alias("places"))
    rows = texts.select("short", "id", "owner", "text").join(places, "short").select("id", "owner", "text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            values = lists.flatten()
            nodes, first, end = (values.field(i) for i in range(3))
            row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
            own = batch.column(2).to_pylist()
            passages = [own[i][a:b] for i, a, b in zip(row.tolist(), first.to_pylist(), end.to_pylist())]
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), nodes, pa.array(passages, pa.string()), first, end], names=["id", "owner", "node", "passage", "first", "end"]
            )

    nodes = materialize(rows.mapInArrow(run, "id binary, owner bigint, node bigint, passage string, first int, end int"), "nodes")
    discard(edges)
    return nodes


def _graph(records: DataFrame, record: str, owner: str, text: str, scope: str | None, span: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    members, texts = distinct_texts(records, record=record, owner=owner, text=text, scope=scope, shortest=span)
    texts = texts.withColumn("owner", F.coalesce("owner", F.xxhash64("id")))
    return members, texts, shared_nodes(texts, span)


def shared_spans(records: DataFrame, *, record: str, owner: str, text: str, scope: str | None = None, span: int = 60) -> DataFrame:
    """Pairs of records of different owners that share ``span`` or more consecutive code points.

    Result ``(record_a, record_b)`` with ``record_a < record_b``, distinct,
    behind ``scope`` if one is named: then only records of one scope are
    compared. Some text of the one and some text of the other must share
    them. Null scopes, records, owners and texts, and texts shorter than
    ``span``, are in no pair.

    Spans in the same set of texts are one class, found by counts and sums
    that don't depend on order; one span of each class is enough to name its
    pairs, so texts that share many spans make their pairs once. The pairs
    themselves are the result and are only made at the end.
    """
    members, _, nodes = _graph(records, record, owner, text, scope, span)
    # A text may have a span twice.
    held = nodes.select("node", "passage", "id").distinct()
    mark = F.xxhash64("id")
    sets = held.groupBy("node", "passage").agg(
        F.count("*").alias("n"), F.sum(mark.cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("x")
    )
    classes = sets.where("n > 1").groupBy("n", "s", "x").agg(F.min(F.struct("node", "passage")).alias("k")).select("k.*")
    texts_of = held.join(classes, ["node", "passage"], "left_semi").select(F.xxhash64("node", "passage").alias("span"), "node", "id")
    whole = members.groupBy("id").agg(F.min("owner").alias("lo"), F.max("owner").alias("hi")).where("lo <> hi")
    # A text of several owners is a span by itself.
    alone = whole.select(F.xxhash64("id").alias("span"), F.xxhash64(F.lit(2), "id").alias("node"), "id")
    of = materialize(texts_of.unionByName(alone).join(members, "id").select("span", "node", "scope", "record", "owner").distinct(), "spans")
    a, b = meeting(of, ["span", "node"], "record")
    pairs = a.join(b, same("span", "node") & (F.col("a.record") < F.col("b.record")) & (F.col("a.owner") != F.col("b.owner")))
    made = pairs.select(F.col("a.scope").alias("scope"), F.col("a.record").alias("record_a"), F.col("b.record").alias("record_b")).distinct()
    return made.drop("scope") if scope is None else made.withColumnRenamed("scope", scope)


def shared_share(records: DataFrame, *, record: str, owner: str, text: str, scope: str | None = None, span: int = 60) -> DataFrame:
    """How much of every record's texts stands in a record of another owner.

    Result ``(record, texts, characters, shared)``, behind ``scope`` if one is
    named, over the record's distinct texts of at least ``span`` code points;
    ``shared`` counts the code points that lie in a span of at least ``span``
    that some text of another owner (and the same scope) has.
    """
    members, texts, nodes = _graph(records, record, owner, text, scope, span)
    several = members.groupBy("id").agg(F.min("owner").alias("lo"), F.max("owner").alias("hi")).where("lo <> hi").select("id")
    shared = nodes.groupBy("node", "passage").agg(F.min("owner").alias("lo"), F.max("owner").alias("hi")).where("lo <> hi").select("node", "passage")
    spans = nodes.join(shared, ["node", "passage"], "left_semi").select("id", "first", "end")
    lengths = texts.select("id", F.char_length("text").alias("characters"))
    spans = spans.unionByName(lengths.join(several, "id", "left_semi").select("id", F.lit(0).alias("first"), F.col("characters").alias("end")))
    # Spans of one text, in order: what each adds beyond the furthest end so far.
    merged = spans.groupBy("id").agg(F.array_sort(F.collect_set(F.struct("first", "end"))).alias("spans"))
    none = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("upto"))
    add = lambda acc, x: F.struct(
        (acc["sum"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["first"], acc["upto"]))).alias("sum"), F.greatest(acc["upto"], x["end"]).alias("upto")
    )
    covered = merged.select("id", F.aggregate("spans", none, add, lambda acc: acc["sum"]).alias("shared"))
    of = members.select("id", "scope", "record").distinct().join(lengths, "id").join(covered, "id", "left")
    made = of.groupBy("scope", "record").agg(
        F.count("*").alias("texts"), F.sum("characters").alias("characters"), F.coalesce(F.sum("shared"), F.lit(0)).alias("shared")
    )
    return made.drop("scope") if scope is None else made.withColumnRenamed("scope", scope)
