"""Near-duplicate records by HyperMinHash sketches.

Each text has several sketches; a register of a sketch holds the leading-zero
count of the smallest hash in its bucket and the mantissa bits that follow.
The registers of a text are made and stored once. Bands of them find
candidates, a collision-corrected estimate from the stored registers discards
the clearly dissimilar ones, and the exact similarity of the strings, which
are only read now, decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.arrays import mix, rolling_hash, steps
from palimpsest.llm.members import distinct_texts, meeting, same
from palimpsest.operators.links import components
from palimpsest.runtime import discard, materialize, materialize_counted

#: Independent sketches and the registers of each; several small sketches leave fewer buckets empty than a large one.
SKETCHES, REGISTERS = 15, 10
#: Registers in a band. A pair of similarity 0.75 shares no band of 30 once in 3000 times, one of 0.8 once in 150,000.
BAND = 5
#: Mantissa bits that a register keeps.
MANTISSA = 10
#: One text of so many is looked at to find the hot bands, and the texts of a hot band that a task holds of it.
LOOK, TOGETHER = 64, 4096
#: How far an estimate may lie under the threshold: over five standard deviations of it.
MARGIN = 0.2


def _register(smallest: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of 32-bit minima, in one 16-bit register."""
    length = np.frexp(smallest.astype(np.float64))[1].astype(np.uint64)
    zeros = np.uint64(32) - length
    mantissa = (smallest.astype(np.uint64) << (zeros + np.uint64(1)) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - MANTISSA)
    return (zeros << np.uint64(MANTISSA) | mantissa).astype(np.uint16)


def registers(points: np.ndarray, bounds: np.ndarray, width: int) -> np.ndarray:
    """HyperMinHash registers of texts, (texts, SKETCHES * REGISTERS).

    The elements are the windows of ``width`` code points; a shorter text is
    its own only element. An empty register takes the value of the next
    filled one in a fixed order, so that it agrees as likely as any other.
    """
    sizes = np.diff(bounds)
    count = len(sizes)
    windows = np.maximum(sizes - width + 1, 0)
    owners = np.repeat(np.arange(count), windows)
    at = np.arange(len(owners)) - np.repeat(np.cumsum(windows) - windows, windows) + np.repeat(bounds[:-1], windows)
    hashes = rolling_hash(points, width)[at] if len(at) else np.zeros(0, dtype=np.uint64)
    short = np.flatnonzero(windows == 0)
    if len(short):
        own = np.zeros(len(short), dtype=np.uint64)
        for k in range(width - 1):
            has = sizes[short] > k
            own[has] = mix(own[has] + points[bounds[:-1][short[has]] + k].astype(np.uint64) + np.uint64(k + 1))
        hashes, owners = np.concatenate([hashes, own]), np.concatenate([owners, short])
    made = np.empty((REGISTERS, SKETCHES, count), dtype=np.uint16)
    first = owners * REGISTERS
    for s in range(SKETCHES):
        z = mix(hashes + np.uint64((s + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        slot = ((z >> np.uint64(32)) * np.uint64(REGISTERS) >> np.uint64(32)).astype(np.int64)
        slot += first
        smallest = np.full(count * REGISTERS, 0xFFFFFFFF, dtype=np.uint32)
        np.minimum.at(smallest, slot, z.astype(np.uint32))
        smallest = smallest.reshape(count, REGISTERS)
        filled = smallest < 0xFFFFFFFF
        out = smallest.copy()
        missing = ~filled
        for t in range(1, REGISTERS):
            if not missing.any():
                break
            # Bucket i looks at i + t, with a stride of its own so that neighbours don't all borrow from one.
            other = (np.arange(REGISTERS) * (1 + t % 3) + t * 7 + np.arange(REGISTERS)) % REGISTERS
            use = missing & filled[:, other]
            out[use] = smallest[:, other][use]
            missing &= ~use
        if missing.any():
            anything = smallest.min(axis=1, keepdims=True)
            out = np.where(missing, anything, out)
        made[:, s, :] = _register(out).T
    # A band takes its registers from different sketches.
    return np.ascontiguousarray(made.reshape(REGISTERS * SKETCHES, count).T)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimates from registers, corrected for registers that agree by chance.

    Two different minima have the same leading zeros with probability 1/3 and
    then the same mantissa with 2**-MANTISSA.
    """
    chance = 2.0**-MANTISSA / 3
    return ((a == b).mean(axis=1) - chance) / (1 - chance)


def windows_of(text: str, width: int) -> set[str]:
    """The different substrings of ``width`` characters; a shorter text is its own only one."""
    return {text[i : i + width] for i in range(len(text) - width + 1)} if len(text) >= width else {text}


def similarity(a: str, b: str, width: int) -> float:
    """Exact Jaccard similarity of two strings."""
    x, y = windows_of(a, width), windows_of(b, width)
    common = len(x & y)
    return common / (len(x) + len(y) - common)


def _all_registers(texts: pa.Array, width: int) -> np.ndarray:
    parts = [registers(points, bounds, width) for _, points, bounds in steps(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, SKETCHES * REGISTERS), dtype=np.uint16)


def _sketched(texts: DataFrame, width: int) -> DataFrame:
    """``(id, scope, owner, sketch)``: the registers of every text, as bytes."""
    kind = dict(texts.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = _all_registers(batch.column(3), width)
            size = made.shape[1] * made.itemsize
            offsets = pa.py_buffer(np.arange(len(made) + 1, dtype=np.int32) * np.int32(size))
            sketch = pa.Array.from_buffers(pa.binary(), len(made), [None, offsets, pa.py_buffer(made.tobytes())])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], sketch], names=["id", "scope", "owner", "sketch"])

    return texts.select("id", "scope", "owner", "text").mapInArrow(run, f"id {kind['id']}, scope string, owner {kind['owner']}, sketch binary")


def _matrix(sketches: pa.Array) -> np.ndarray:
    """Sketches that were stored as bytes, (texts, registers)."""
    body = sketches.buffers()[2]
    start, width = sketches.offset, SKETCHES * REGISTERS
    offsets = np.frombuffer(sketches.buffers()[1], dtype=np.int32)[start : start + len(sketches) + 1]
    return np.frombuffer(body, dtype=np.uint16)[offsets[0] // 2 : offsets[-1] // 2].reshape(len(sketches), width)


def _candidates(sketches: DataFrame) -> DataFrame:
    """``(short_a, short_b)``: texts of one scope and different owners that share a band, each pair once.

    Of a hot band one side is split over several tasks and the other one
    copied to them. Which bands are hot is seen in one of ``LOOK`` texts by
    their ids; that decides where pairs are made, not which.
    """
    size = BAND * 2
    bands = [F.xxhash64("scope", F.lit(k), F.substring("sketch", k * size + 1, size)) for k in range(SKETCHES * REGISTERS // BAND)]
    banded = lambda of: of.select(F.explode(F.array(*bands)).alias("band"), "short", "owner")
    seen = banded(sketches.where(F.pmod("short", F.lit(LOOK)) == 0)).groupBy("band").agg((F.count("*") * LOOK / TOGETHER).cast("int").alias("more"))
    hot, (some,) = materialize_counted(seen.where("more > 0"), "hot", F.count("*"))
    a = b = banded(sketches)
    if some:
        met = a.join(hot, "band", "left").withColumn("more", F.coalesce("more", F.lit(0)))
        part = lambda of: F.when(F.col("more") == 0, F.col("band")).otherwise(F.xxhash64("band", of))
        a = met.withColumn("band", part(F.pmod("short", F.col("more") + 1).cast("int")))
        b = met.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("more")))).withColumn("band", part(F.col("part")))
    a, b = a.alias("a"), b.alias("b")
    apart = F.col("a.owner").isNull() | F.col("b.owner").isNull() | (F.col("a.owner") != F.col("b.owner"))
    met = a.join(b, (F.col("a.band") == F.col("b.band")) & (F.col("a.short") < F.col("b.short")) & apart)
    return met.select(F.col("a.short").alias("short_a"), F.col("b.short").alias("short_b")).distinct()


def near_duplicate_texts(texts: DataFrame, *, threshold: float, width: int) -> DataFrame:
    """Pairs of different texts of at least ``threshold`` similarity.

    ``texts`` is ``(id, scope, text, owner)``, one row per scope and distinct
    text, ``owner`` a number if all its records have the same owner, else
    null; pairs of one owner or of two scopes aren't looked for. Result ``(id_a, id_b, similarity)``, each pair
    once.
    """
    kind = dict(texts.dtypes)["id"]
    written = materialize(_sketched(texts, width), "sketches")
    # A short id stands for a text while bands meet; the texts behind equal short ids come apart in the comparison.
    sketches = written.withColumn("short", F.xxhash64("id"))
    sketch = sketches.select("short", "id", "sketch")
    both = _candidates(sketches).join(sketch.withColumnsRenamed({"short": "short_a", "id": "id_a", "sketch": "a"}), "short_a")
    both = both.join(sketch.withColumnsRenamed({"short": "short_b", "id": "id_b", "sketch": "b"}), "short_b").select("id_a", "id_b", "a", "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                likely = estimate(_matrix(batch.column(2)), _matrix(batch.column(3))) >= threshold - MARGIN
                yield batch.select(["id_a", "id_b"]).filter(pa.array(likely))

    likely = materialize(both.mapInArrow(compare, f"id_a {kind}, id_b {kind}"), "likely")
    discard(written)
    needed = likely.select(F.explode(F.array("id_a", "id_b")).alias("id")).distinct()
    text = texts.select("id", "text").join(needed, "id", "left_semi")
    read = likely.join(text.withColumnsRenamed({"id": "id_a", "text": "text_a"}), "id_a")
    read = read.join(text.withColumnsRenamed({"id": "id_b", "text": "text_b"}), "id_b").select("id_a", "id_b", "text_a", "text_b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            exact = np.array([similarity(x, y, width) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())], dtype=np.float64)
            made = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(exact)], names=["id_a", "id_b", "similarity"])
            yield made.filter(pa.array(exact >= threshold))

    return read.mapInArrow(verify, f"id_a {kind}, id_b {kind}, similarity double")


def near_duplicates(records: DataFrame, *, record: str, owner: str, text: str, scope: str | None = None, threshold: float = 0.75, width: int = 5) -> DataFrame:
    """Pairs of records of different owners of which some texts are near-duplicates.

    Result ``(record_a, record_b)`` with ``record_a < record_b``, distinct,
    behind ``scope`` if one is named: then only records of one scope are
    compared. Two texts are near-duplicates if the Jaccard similarity of
    their different substrings of ``width`` code points is at least
    ``threshold``; equal texts are. A record may have many texts and a text
    many records. Null scopes, records, owners and texts are in no pair; two
    empty texts are equal.

    Texts are made distinct first, so copies cost one row however many there
    are; only pairs of different texts are searched, and the pairs of records
    are made at the end from the texts' memberships.
    """
    members, texts = distinct_texts(records, record=record, owner=owner, text=text, scope=scope)
    similar = near_duplicate_texts(texts, threshold=threshold, width=width).select("id_a", "id_b")
    a = members.select(F.col("id").alias("id_a"), "scope", F.col("record").alias("ra"), F.col("owner").alias("oa"))
    b = members.select(F.col("id").alias("id_b"), F.col("record").alias("rb"), F.col("owner").alias("ob"))
    found = similar.join(a, "id_a").join(b, "id_b").where("oa <> ob and ra <> rb")
    made = found.select("scope", F.least("ra", "rb").alias("record_a"), F.greatest("ra", "rb").alias("record_b"))
    # Records of one text.
    shared = members.groupBy("id").agg(F.min("owner").alias("lo"), F.max("owner").alias("hi")).where("lo <> hi")
    x, y = meeting(materialize(members.join(shared, "id", "left_semi"), "shared"), ["id"], "record")
    equal = x.join(y, same("id") & (F.col("a.record") < F.col("b.record")) & (F.col("a.owner") != F.col("b.owner")))
    made = made.unionByName(equal.select("a.scope", F.col("a.record").alias("record_a"), F.col("b.record").alias("record_b"))).distinct()
    return made.drop("scope") if scope is None else made.withColumnRenamed("scope", scope)


def near_duplicate_groups(records: DataFrame, *, record: str, owner: str, text: str, scope: str | None = None, threshold: float = 0.75, width: int = 5) -> DataFrame:
    """Groups of records that chains of near-duplicate texts connect.

    Result ``(record, group_id, records)``, one row per record in a group of
    several owners, behind ``scope`` if one is named: ``group_id`` is the
    smallest record of the group and ``records`` their number. The links are
    made between distinct texts, and between each text and its records, so
    copies cost one link each and are never paired with one another. What
    counts as near is as in :func:`near_duplicates`.
    """
    members, texts = distinct_texts(records, record=record, owner=owner, text=text, scope=scope)
    node = F.unhex(F.md5(F.concat_ws("\n", F.lit("record"), "scope", "record")))
    links = near_duplicate_texts(texts, threshold=threshold, width=width).select("id_a", "id_b")
    links = links.unionByName(members.select(F.col("id").alias("id_a"), node.alias("id_b")))
    held = members.join(components(links, "id_a", "id_b").withColumnRenamed("node", "id"), "id").select("scope", "record", "owner", "component").distinct()
    groups = held.groupBy("component").agg(F.min("record").alias("group_id"), F.count_distinct("record").alias("records"), F.min("owner").alias("lo"), F.max("owner").alias("hi"))
    made = held.select("scope", "record", "component").distinct().join(groups.where("lo <> hi"), "component").select("scope", "record", "group_id", "records")
    return made.drop("scope") if scope is None else made.withColumnRenamed("scope", scope)
