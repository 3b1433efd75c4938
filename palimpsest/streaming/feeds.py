"""Feeds and state machines as streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def new_items(items: DataFrame, guid: str, seen_at: str, late: str = "30 days") -> DataFrame:
    """The first sight of each item of a feed; repeats within the watermark are dropped."""
    return items.withWatermark(seen_at, late).dropDuplicatesWithinWatermark([guid])


def windowed_counts(events: DataFrame, ts: str, keys: list[str], width: str, late: str) -> DataFrame:
    """Counts per key and tumbling window, with late events up to the watermark."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width), *keys).agg(F.count("*").alias("n"))


def collapsed_feed(count: Column, previous: Column, ratio: float, least: int = 4) -> Column:
    """Whether a poll has suspiciously fewer items than the one before (which had at least ``least``)."""
    return F.coalesce((previous >= least) & (count < F.ceil(previous * ratio)), F.lit(False))


def checked_transitions(events: DataFrame, key: str, sequence: str, state: str, allowed: set[tuple[str | None, str]]) -> DataFrame:
    """Each event of a state machine with the state before it and whether the step is allowed.

    The state per key is its last state and sequence; an event that isn't
    after it is a replay and is dropped. Works on streams (state across
    batches) and on batches alike.
    """
    kinds = dict(events.dtypes)
    schema = f"{key} {kinds[key]}, {sequence} {kinds[sequence]}, from_state string, to_state string, legal boolean"

    def step(keys: tuple, batches: Iterator[pd.DataFrame], store: GroupState) -> Iterator[pd.DataFrame]:
        last, state_now = store.get if store.exists else (None, None)
        out = []
        for number, to in sorted((n, s) for batch in batches for n, s in zip(batch[sequence].tolist(), batch[state].tolist())):
            if last is not None and number <= last:
                continue
            out.append((keys[0], number, state_now, to, (state_now, to) in allowed))
            last, state_now = number, to
        store.update((last, state_now))
        yield pd.DataFrame(out, columns=[key, sequence, "from_state", "to_state", "legal"])

    return events.select(key, sequence, state).groupBy(key).applyInPandasWithState(
        step, schema, f"last {kinds[sequence]}, state string", "append", GroupStateTimeout.NoTimeout
    )
