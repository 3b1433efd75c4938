"""What changed between consecutive full snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def consecutive_editions(editions: DataFrame, series: str, edition: str, order: str) -> DataFrame:
    """Neighbouring editions of each series by ``order``.

    Result ``(series, older, newer)``. Repeated rows count once; an edition
    with several orders takes its smallest; ties in order are broken by the
    edition key, so the neighbourhood is total. Rows with a null series,
    edition or order name no place in a series and are left out.

    The window runs over the edition list of one series (its key, not its
    records), which holds one short row per delivery.
    """
    rows = (
        editions.select(F.col(series).alias("__s"), F.col(edition).alias("__e"), F.col(order).alias("__o"))
        .where(F.col("__s").isNotNull() & F.col("__e").isNotNull() & F.col("__o").isNotNull())
        .groupBy("__s", "__e")
        .agg(F.min("__o").alias("__o"))
    )
    by_order = Window.partitionBy("__s").orderBy("__o", "__e")
    return (
        rows.withColumn("__older", F.lag("__e").over(by_order))
        .where(F.col("__older").isNotNull())
        .select(F.col("__s").alias("series"), F.col("__older").alias("older"), F.col("__e").alias("newer"))
    )


def snapshot_changes(
    records: DataFrame,
    pairs: DataFrame,
    edition: str,
    key: str,
    values: Sequence[str],
) -> DataFrame:
    """Records added, removed or changed from each edition to the next.

    ``pairs`` is ``(series, older, newer)``, as of
    :func:`consecutive_editions`; ``records`` are the full snapshots, one row
    per ``edition`` and ``key`` with the compared ``values``. The result is
    ``(series, newer, key, change_kind)``.

    Method: the older side and the newer side of every pair are bags of
    ``(pair, key, values)``. ``newer EXCEPT ALL older`` and ``older EXCEPT ALL
    newer`` remove the identical rows; both differences are read off one
    signed count per distinct row, so they cost one shuffle instead of four.
    The residues are then joined in full by key: only a newer residue is
    ``added``, only an older one ``removed``, both ``changed``.

    Values are compared by two 64-bit hashes of their content, computed here
    and never taken from the table, so that long texts aren't shuffled. Nulls
    are a value of their own (``null`` and ``''`` differ). Repeated rows count
    once. When an edition has several different values for one key, they count
    as one set, and any difference of the sets is ``changed``. Rows without an
    edition or key are left out; an edition of ``pairs`` without any record is
    an empty snapshot.
    """
    content = [x for v in values for x in (F.col(v).isNull(), F.col(v))]
    rows = (
        records.where(F.col(edition).isNotNull() & F.col(key).isNotNull())
        .select(
            F.col(edition).alias("__e"),
            F.col(key).alias("__k"),
            F.xxhash64(*content).alias("__h1"),
            F.xxhash64(F.lit(1), *content).alias("__h2"),
        )
        .distinct()
        .groupBy("__e", "__k")
        .agg(F.count("*").alias("__n"), F.bit_xor("__h1").alias("__h1"), F.bit_xor("__h2").alias("__h2"))
    )
    side = lambda of, sign: F.struct(F.col(of).alias("__e"), F.lit(sign).alias("__sign"))
    sides = pairs.select("series", "newer", F.explode(F.array(side("older", -1), side("newer", 1))).alias("__side"))
    residue = (
        rows.join(sides.select("series", "newer", "__side.*"), "__e")
        .groupBy("series", "newer", "__k", "__n", "__h1", "__h2")
        .agg(F.sum("__sign").alias("__left"))
        .where("__left <> 0")
    )
    by = ["series", "newer", "__k"]
    gone = residue.where("__left < 0").select(*by, F.lit(True).alias("__old"))
    came = residue.where("__left > 0").select(*by, F.lit(True).alias("__new"))
    kind = F.when(F.col("__old") & F.col("__new"), "changed").when(F.col("__new"), "added").otherwise("removed")
    return gone.join(came, by, "full_outer").select("series", "newer", F.col("__k").alias("key"), kind.alias("change_kind"))
