"""Distinct texts of records, and which records have them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.runtime import materialize

#: Rows of one key that meet all others of it in one task.
TOGETHER = 1024


def distinct_texts(records: DataFrame, *, record: str, owner: str, text: str, scope: str | None = None, shortest: int = 0) -> tuple[DataFrame, DataFrame]:
    """Memberships ``(id, scope, record, owner)`` and distinct texts ``(id, scope, text, owner)``, both written.

    A text is one row per scope however many records have it; its ``owner``
    is a number, or null if several owners have it. Rows with a null scope,
    record, owner or text, and texts of fewer than ``shortest`` characters,
    are left out.
    """
    kind = F.lit("") if scope is None else F.col(scope)
    rows = records.select(kind.alias("scope"), F.col(record).alias("record"), F.col(owner).alias("owner"), F.col(text).alias("text"))
    rows = rows.where("scope is not null and record is not null and owner is not null and text is not null")
    if shortest:
        rows = rows.where(F.char_length("text") >= shortest)
    keyed = rows.withColumn("id", F.unhex(F.md5(F.concat_ws("\n", "scope", "text"))))
    mark = F.xxhash64("owner")
    texts = (
        keyed.groupBy("id")
        .agg(F.first("scope").alias("scope"), F.first("text").alias("text"), F.min(mark).alias("lo"), F.max(mark).alias("hi"))
        .select("id", "scope", "text", F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("owner"))
    )
    return materialize(keyed.select("id", "scope", "record", "owner").distinct(), "members"), materialize(texts, "texts")


def meeting(rows: DataFrame, keys: Sequence[str], by: str) -> tuple[DataFrame, DataFrame]:
    """Both sides ``a`` and ``b`` of a join of rows with the others of their keys, to be joined on the keys and ``part``.

    Keys with one row are left out. Of a key with many, side ``a`` is split
    into parts by the hash of ``by`` and side ``b`` copied to them, so the
    pairs of a hot key, which are the result, are made in many tasks.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys, F.ceil(F.col("n") / TOGETHER).cast("int").alias("parts"))
    met = rows.join(counts, list(keys))
    a = met.withColumn("part", F.pmod(F.xxhash64(by), "parts").cast("int")).drop("parts")
    return a.alias("a"), met.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts").alias("b")


def same(*keys: str):
    """Condition of the join of :func:`meeting`."""
    met = F.col("a.part") == F.col("b.part")
    for key in keys:
        met = met & (F.col(f"a.{key}") == F.col(f"b.{key}"))
    return met
