"""Canonical JSON, content-derived ids and order-independent fingerprints."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def canonical_json_text(value: object) -> str:
    """Sorted keys, compact separators, no escapes of non-ASCII characters."""
    return json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"), allow_nan=False)


def canonical_json(column: Column) -> Column:
    """Canonical text of a JSON text column; null for null, an error for text that isn't JSON."""

    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if t is None else canonical_json_text(json.loads(t)) for t in values.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")(column)


def canonical_row(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Canonical JSON of a row of flat columns, nulls kept; stays in the JVM.

    Spark writes struct fields in their order, so the columns are sorted by
    name, as canonical JSON sorts its keys.
    """
    names = sorted(columns or df.columns)
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


def stable_id(namespace: str, *parts: Column) -> Column:
    """SHA-256 over a namespace and its parts, joined by the unit separator."""
    return F.sha2(F.concat_ws("\u001f", F.lit(namespace), *[p.cast("string") for p in parts]), 256)


def uuid_v5(namespace: str, column: Column) -> Column:
    """Name-based UUIDs of a text column."""
    space = uuid.UUID(namespace)

    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if t is None else str(uuid.uuid5(space, t)) for t in values.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")(column)


def uuid_v8(namespace: str, column: Column) -> Column:
    """UUIDs of version 8 from the SHA-256 of namespace and value; built-in functions only."""
    h = F.sha2(F.concat(F.lit(namespace + "\n"), column), 256)
    nibble = F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-8"), F.substring(h, 14, 3), F.lit("-"),
        F.lower(F.hex(nibble)), F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12),
    )


def row_hash(df: DataFrame, columns: list[str] | None = None, newline: bool = True) -> Column:
    """SHA-256 of the canonical row, with the closing newline of a JSON line or without."""
    text = canonical_row(df, columns)
    return F.sha2(F.concat(text, F.lit("\n")) if newline else text, 256)


def _sorted_fingerprint(df: DataFrame, columns: list[str] | None, by: tuple[str, ...], newline: bool) -> DataFrame:
    """SHA-256 over the sorted row hashes of each group, each closed by a newline or with newlines only between them.

    A window sorts by group and hash, on disk where need be, and one pass
    over its rows digests them: a group is one task's work, as SHA-256 reads
    its bytes in order, but it is never held in memory.
    """
    keys = [f"__k{i}" for i in range(len(by))]
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], row_hash(df, columns, newline).alias("__h"))
    rows = rows.withColumn("__first", F.row_number().over(Window.partitionBy(*keys).orderBy("__h")) == 1)
    made = rows.select(*keys, F.col("__h").alias("fingerprint"), F.lit(0).cast("bigint").alias("row_count"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, count = None, None, 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*key, pa.array([digest.hexdigest()]), pa.array([count], pa.int64())], names=[*keys, "fingerprint", "row_count"])

        for batch in batches:
            hashes = batch.column("__h").to_pylist()
            starts = [i for i, first in enumerate(batch.column("__first").to_pylist()) if first]
            # The rows before the first start go on with the group of the batch before.
            for at, end in zip([0, *starts], [*starts, len(hashes)]):
                if at == end:
                    continue
                if batch.column("__first")[at].as_py():
                    if key is not None:
                        yield row()
                    key, digest, count = [batch.column(k).slice(at, 1) for k in keys], hashlib.sha256(), 0
                text = "\n".join(hashes[at:end])
                digest.update((text + "\n" if newline else "\n" + text if count else text).encode())
                count += end - at
        if key is not None:
            yield row()

    found = rows.mapInArrow(run, made.schema)
    if not by:
        # A table without rows has a fingerprint, too.
        nothing = F.lit(hashlib.sha256().hexdigest())
        return found.agg(F.coalesce(F.first("fingerprint"), nothing).alias("fingerprint"), F.coalesce(F.first("row_count"), F.lit(0)).cast("bigint").alias("row_count"))
    return found.select(*[F.col(k).alias(c) for c, k in zip(by, keys)], "fingerprint", "row_count")


def row_set_fingerprint(df: DataFrame, columns: list[str] | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Fingerprint of a set of rows that their order doesn't change, per ``by`` group.

    SHA-256 over the sorted row hashes, each closed by a newline. Its bytes
    are digested in order, so a group takes one task, in constant memory; the
    sum of :func:`row_sum_fingerprint` is for tables whose hashes should
    combine map-side.
    """
    return _sorted_fingerprint(df, columns, by, True)


def portable_fingerprint(df: DataFrame, columns: list[str] | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """As :func:`row_set_fingerprint`, with newlines only between the hashes and none in the rows."""
    return _sorted_fingerprint(df, columns, by, False)


def row_sum_fingerprint(df: DataFrame, columns: list[str] | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """A fingerprint that combines map-side: sum of 64-bit row hashes and their number."""
    rows = df.select(*by, F.xxhash64(canonical_row(df, columns)).cast("decimal(38,0)").alias("__h"))
    return rows.groupBy(*by).agg(F.sum("__h").alias("fingerprint"), F.count("*").alias("row_count"))


def object_fingerprint(fingerprints: DataFrame, name: str, fingerprint: str) -> DataFrame:
    """One fingerprint of named parts (a handful of tables), whatever their order: ``fingerprint, parts``."""
    pairs = F.array_sort(F.collect_list(F.concat_ws("=", name, fingerprint)))
    return fingerprints.agg(F.sha2(F.array_join(pairs, "\n"), 256).alias("fingerprint"), F.count("*").alias("parts"))
