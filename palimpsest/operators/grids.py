"""Tables with spans as full grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalized_grid(cells: DataFrame, keys: Sequence[str], row: str, column: str, row_span: str, column_span: str, value: str) -> DataFrame:
    """Every place of the tables with the cell that covers it.

    Result: keys, ``row_index``, ``column_index``, ``origin_row``,
    ``origin_column``, ``value``, ``inherited`` (covered by another cell's
    span). Where two cells claim a place the own cell holds, else the one of
    the smallest origin. Spans below one count as one.
    """
    span = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(1)), F.lit(1))
    rows = F.explode(F.sequence(F.col(row), F.col(row) + span(row_span) - 1)).alias("row_index")
    wide = cells.select(*keys, F.col(row).alias("origin_row"), F.col(column).alias("origin_column"), span(column_span).alias("__w"), F.col(value).alias("value"), rows)
    columns = F.explode(F.sequence(F.col("origin_column"), F.col("origin_column") + F.col("__w") - 1)).alias("column_index")
    places = wide.select(*keys, "row_index", columns, "origin_row", "origin_column", "value")
    inherited = (F.col("row_index") != F.col("origin_row")) | (F.col("column_index") != F.col("origin_column"))
    places = places.withColumn("inherited", inherited)
    first = F.min_by(F.struct("origin_row", "origin_column", "value", "inherited"), F.struct("inherited", "origin_row", "origin_column"))
    return places.groupBy(*keys, "row_index", "column_index").agg(first.alias("__c")).select(*keys, "row_index", "column_index", "__c.*")
