"""Passages of held-out evaluation items inside a corpus.

One Aho-Corasick automaton over the normalised items scans every text once.
It holds windows of the items at such distances that each passage that
counts has one of them in it; a hit is extended on both sides to the
whole passage, and its offsets are mapped back to the original text.
"""

from __future__ import annotations

import functools
import unicodedata
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Consecutive letters and digits that make a leak.
LENGTH = 30
#: Characters of items in one automaton, which takes about 100 bytes for each; more items are scanned in as many passes.
BLOCK_CHARACTERS = 4_000_000


@functools.lru_cache(maxsize=1)
def fold_table() -> np.ndarray:
    """For every code point the letter or digit it counts as, 0 if it counts for nothing.

    Width and case are folded; letters are the categories L*, digits Nd.
    """
    table = np.zeros(0x110000, dtype=np.uint32)
    for point in [*range(0xD800), *range(0xE000, 0x110000)]:
        char = chr(point)
        if unicodedata.decomposition(char).startswith(("<wide>", "<narrow>")):
            char = wide if len(wide := unicodedata.normalize("NFKC", char)) == 1 else char
        kind = unicodedata.category(char)
        if kind[0] == "L" or kind == "Nd":
            folded = char.casefold()
            table[point] = ord(folded if len(folded) == 1 else char)
    return table


def normalise(text: str) -> tuple[str, np.ndarray]:
    """Letters and digits of a text, folded, and the offset of each in the text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    folded = fold_table()[points]
    at = np.flatnonzero(folded)
    return folded[at].tobytes().decode("utf-32-le", "surrogatepass"), at


class Items:
    """The automaton of a block of items.

    A passage of ``length`` characters holds ``length // 2 + 1`` windows of
    ``length - length // 2`` characters, so one of them starts at a multiple
    of ``length // 2`` in the item: only these are words of the automaton. Items shorter than ``length`` are whole words if ``short``.
    """

    def __init__(self, items: list[tuple], length: int, short: bool) -> None:
        self.keys = [key for key, _ in items]
        self.texts = [normalise(text)[0] for _, text in items]
        self.length = length
        self.width = max(length - length // 2, 1)
        stride = max(length // 2, 1)
        places: dict[str, list[int]] = {}
        for number, text in enumerate(self.texts):
            if len(text) >= length:
                for at in range(0, len(text) - self.width + 1, stride):
                    places.setdefault(text[at : at + self.width], []).extend((number, at))
            elif short and text:
                places.setdefault(text, []).extend((number, 0))
        self.automaton = ahocorasick.Automaton()
        for window, at in places.items():
            # Bytes take a fraction of the memory of tuples of numbers.
            self.automaton.add_word(window, (len(window), np.array(at, dtype=np.int32).tobytes()))
        if places:
            self.automaton.make_automaton()

    def scan(self, text: str) -> dict[int, list[tuple[int, int]]]:
        """Item numbers that leak into a text, with the merged spans of original offsets."""
        if not len(self.automaton):
            return {}
        folded, at = normalise(text)
        spans: dict[int, list[tuple[int, int]]] = {}
        seen: dict[tuple[int, int], int] = {}
        for end, (size, packed) in self.automaton.iter(folded):
            first = end - size + 1
            places = np.frombuffer(packed, dtype=np.int32).tolist()
            for number, place in zip(places[::2], places[1::2]):
                shift = first - place
                # A passage that has been extended over this window already.
                if seen.get((number, shift), -1) > end:
                    continue
                item = self.texts[number]
                a, b = _extended(folded, item, first, place, size)
                seen[number, shift] = b
                if b - a >= min(self.length, len(item)):
                    spans.setdefault(number, []).append((a, b))
        return {n: [(int(at[a]), int(at[b - 1]) + 1) for a, b in _merged(own)] for n, own in spans.items()}


def _common(a: str, b: str) -> int:
    """Length of the common start of two strings, by halving."""
    top = min(len(a), len(b))
    if a[:top] == b[:top]:
        return top
    low, high = 0, top
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle)
    return low


def _extended(text: str, item: str, first: int, place: int, size: int) -> tuple[int, int]:
    """Bounds in ``text`` of the longest common passage around a window at ``first`` and, in the item, at ``place``."""
    room = min(first, place)
    before = _common(text[first - room : first][::-1], item[place - room : place][::-1])
    behind = _common(text[first + size : first + size + len(item)], item[place + size :])
    return first - before, first + size + behind


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    made: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if made and a <= made[-1][1]:
            made[-1] = (made[-1][0], max(b, made[-1][1]))
        else:
            made.append((a, b))
    return made


@functools.lru_cache(maxsize=1)
def _loaded(token: str, length: int, short: bool) -> Items:
    """The automaton of a block, made once per Python worker; ``_BLOCKS`` has the block while it is made."""
    return Items(_BLOCKS[token], length, short)


_BLOCKS: dict[str, list[tuple]] = {}


def items_of(token: str, block: list[tuple], length: int, short: bool) -> Items:
    """:class:`Items` of a block named ``token``, from this worker's cache if it is there."""
    _BLOCKS[token] = block
    try:
        return _loaded(token, length, short)
    finally:
        del _BLOCKS[token]


def find_leaks(
    documents: DataFrame, items: DataFrame, *, doc_key: str, doc_text: str, item_key: str, item_text: str, length: int = LENGTH, short: bool = False
) -> DataFrame:
    """Documents in which ``length`` or more consecutive letters and digits of an item stand.

    Result ``(doc_key, item_key, spans, covered)``, one row per distinct pair
    and row of ``documents``: the half-open offsets in the document's text and
    their total length. Everything but letters and digits is dropped from both
    texts, width and case are ignored. Items with fewer letters and digits
    leak nowhere, or with ``short`` wherever they stand as a whole; null and
    empty texts match nothing; extra columns don't matter; empty tables give
    no rows.

    The items are the evaluation material, not the corpus. They go to the
    workers in blocks of ``BLOCK_CHARACTERS``, each one automaton that a
    worker makes once, and one scan of all texts, so what a worker holds is
    bounded. The texts aren't shuffled.
    """
    rows = documents.select(F.col(doc_key).alias("__doc"), F.col(doc_text).cast("string").alias("__text")).where("__text is not null")
    kinds = dict(rows.dtypes) | {"__item": items.select(F.col(item_key)).dtypes[0][1]}
    schema = f"`__doc` {kinds['__doc']}, `__item` {kinds['__item']}, spans array<struct<start:int,end:int>>, covered int"
    item_rows = items.select(F.col(item_key), F.col(item_text).cast("string")).where(F.col(item_text).isNotNull()).distinct()
    context = documents.sparkSession.sparkContext
    shared = []
    block: list[tuple] = []
    size = 0
    # The driver holds one block at a time.
    for key, text in item_rows.toLocalIterator():
        if size + len(text) > BLOCK_CHARACTERS and block:
            shared.append(context.broadcast(block))
            block, size = [], 0
        block.append((key, text))
        size += len(text)
    if block:
        shared.append(context.broadcast(block))
    item_type = pa.int64() if kinds["__item"] in ("bigint", "int") else pa.string()
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    out = documents.sparkSession.createDataFrame([], schema)
    for number, one in enumerate(shared):
        token = f"{uuid.uuid4().hex}-{number}"

        def run(batches: Iterator[pa.RecordBatch], one=one, token=token) -> Iterator[pa.RecordBatch]:
            own = items_of(token, one.value, length, short)
            for batch in batches:
                docs, keys, spans, covered = [], [], [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    for number, found in own.scan(text).items():
                        docs.append(i)
                        keys.append(own.keys[number])
                        spans.append([{"start": a, "end": b} for a, b in found])
                        covered.append(sum(b - a for a, b in found))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(docs, pa.int32())),
                        pa.array(keys, item_type).cast(pa.int32() if kinds["__item"] == "int" else item_type),
                        pa.array(spans, spans_type),
                        pa.array(covered, pa.int32()),
                    ],
                    names=["__doc", "__item", "spans", "covered"],
                )

        found = rows.mapInArrow(run, schema)
        out = found if len(shared) == 1 else out.unionByName(found)
    return out.withColumnsRenamed({"__doc": doc_key, "__item": item_key})
