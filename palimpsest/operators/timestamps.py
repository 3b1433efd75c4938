"""Normalise columns of mixed timestamps to UTC."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.functions import timestamps as T
from palimpsest.functions.dates import iso_seconds
from palimpsest.functions.zones import tzdata_version


def utc_epoch(value: Column, clock_zone: Column | None = None, precision: Column | None = None) -> Column:
    """The first moment that a timestamp text means, as UTC epoch seconds.

    A zone in the text wins, else ``clock_zone``, else Asia/Taipei. A clock
    reading that occurs twice is the first, one that is skipped moves on by
    the skip; fractions are dropped. Null for null and empty values and for
    those without a real calendar date, a valid clock reading or a
    known zone in the text. An unknown ``clock_zone`` counts as none.

    Method: shape masks, each mapped to a parser once, and zone transition
    tables; see :mod:`palimpsest.functions.timestamps`. The driver's release
    of the zone rules goes with the task, and a worker that reads another one
    fails instead of mixing two.
    """
    version = tzdata_version()

    def convert(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        """Seconds of each batch."""
        if (here := tzdata_version()) != version:
            raise RuntimeError(f"zone rules {here} on this worker, {version} on the driver")
        for values, zones, precisions in batches:
            seconds = pd.Series(T.utc_seconds(values, zones, precisions))
            yield seconds.astype("Int64").mask(seconds == T.NONE)

    nothing = F.lit(None).cast("string")
    run = F.pandas_udf(convert, "bigint")
    return run(
        value.cast("string"),
        nothing if clock_zone is None else clock_zone.cast("string"),
        nothing if precision is None else precision.cast("string"),
    )


def utc_start(value: Column, clock_zone: Column | None = None, precision: Column | None = None) -> Column:
    """:func:`utc_epoch` as ``YYYY-MM-DDTHH:MM:SSZ``."""
    return iso_seconds(utc_epoch(value, clock_zone, precision))
