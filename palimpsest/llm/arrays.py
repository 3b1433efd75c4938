"""Columns of texts as code-point arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are handled in one step (a longer text is a step of its own); arrays of this size stay in the processor's caches.
STEP = 1 << 18


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All code points of a column of texts and the bounds of each text in them; null counts as empty."""
    filled = texts.cast(pa.large_string()).fill_null("")
    count = len(filled)
    offsets = np.frombuffer(filled.buffers()[1], dtype=np.int64)[filled.offset : filled.offset + count + 1]
    body = filled.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8)[offsets[0] : offsets[-1]] if body is not None and body.size else np.zeros(0, dtype=np.uint8)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    bounds = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets - offsets[0]]
    return points, bounds.astype(np.int64)


def steps(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The column in slices of at most STEP bytes: (first row, code points, bounds)."""
    filled = texts.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(filled.buffers()[1], dtype=np.int64)[filled.offset : filled.offset + len(filled) + 1]
    start = 0
    while start < len(filled):
        end = max(start + 1, int(np.searchsorted(ends, ends[start] + STEP, side="right")) - 1)
        yield start, *code_points(filled.slice(start, end - start))
        start = end


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finaliser of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def rolling_hash(points: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` code points, by doubling; windows over the end are left out."""
    base = 0x9E3779B97F4A7C15
    power = lambda n: np.uint64(pow(base, n, 1 << 64))
    part, size = mix(points.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)), 1
    total, done = None, 0
    left = width
    while left:
        if left & 1:
            total = part[: len(part)] if total is None else total[: max(0, len(points) - done - size + 1)] * power(size) + part[done:][: max(0, len(points) - done - size + 1)]
            done += size
        left >>= 1
        if left:
            part = part[: max(0, len(part) - size)] * power(size) + part[size:]
            size *= 2
    return total[: max(0, len(points) - width + 1)]
