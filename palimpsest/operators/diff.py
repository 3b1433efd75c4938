"""Lossless text diffs: blocks, characters with offsets, and what only the form changed."""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.text import SINGLE_QUOTES
from palimpsest.operators.parity import distinct_with_collisions

KINDS = {"delete": "removed", "insert": "added", "replace": "replaced"}
SEGMENT = "struct<kind:string,old_text:string,new_text:string,old_start:int,old_end:int,new_start:int,new_end:int,old_byte_start:int,old_byte_end:int,new_byte_start:int,new_byte_end:int>"
TOKEN = re.compile(r"[A-Za-z]+|\d+(?:\.\d+)?|[㐀-鿿]|\s+|[^A-Za-z\d\s㐀-鿿]")


#: Pairs of elements up to which a part of two sequences is compared element by element.
SMALL = 1 << 14
_BASE = 0x9E3779B97F4A7C15


class _Hashes:
    """Hashes of all windows of a sequence of numbers, for any width."""

    def __init__(self, values: np.ndarray, powers: np.ndarray, inverse: np.ndarray) -> None:
        self.inverse = inverse
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[: len(values)], dtype=np.uint64)])

    def windows(self, low: int, high: int, width: int) -> np.ndarray:
        """Of the windows that lie between ``low`` and ``high``."""
        starts = slice(low, high - width + 1)
        return (self.sums[low + width : high + 1] - self.sums[starts]) * self.inverse[starts]


def _longest(a: _Hashes, b: _Hashes, part: tuple[int, int, int, int]) -> tuple[int, int, int]:
    """The longest common run of two parts: the first in ``a``, then the first in ``b``; its length by halving."""
    alo, ahi, blo, bhi = part

    def common(width: int) -> np.ndarray:
        other = np.sort(b.windows(blo, bhi, width))
        own = a.windows(alo, ahi, width)
        at = np.minimum(np.searchsorted(other, own), len(other) - 1)
        return np.flatnonzero(other[at] == own)

    low, high = 0, min(ahi - alo, bhi - blo)
    first = None
    width = 1
    # Widths are doubled until no run is so long, then halved in between.
    while low < high:
        width = min(width, high)
        found = common(width)
        if len(found):
            low, first = width, int(found[0])
            width = low * 2 if high == min(ahi - alo, bhi - blo) else (low + high + 1) // 2
        else:
            high = width - 1
            width = (low + high + 1) // 2
    if first is None:
        return alo, blo, 0
    wanted = a.windows(alo + first, alo + first + low, low)[0]
    return alo + first, blo + int(np.flatnonzero(b.windows(blo, bhi, low) == wanted)[0]), low


def steps(old: Sequence, new: Sequence) -> list[tuple[str, int, int, int, int]]:
    """Edit steps between two sequences, equal ones included.

    The longest common run comes first (the leftmost in the old, then in the
    new sequence), then those of the parts on its left and right: the steps
    of ``difflib`` without its heuristics. Long parts find their run by
    hashes of windows, in about n log n steps a level instead of n squared.
    """
    if len(old) * len(new) <= SMALL:
        return SequenceMatcher(None, old, new, autojunk=False).get_opcodes()
    numbers: dict = {}
    code = lambda items: np.array([numbers.setdefault(x, len(numbers) + 1) for x in items], dtype=np.uint64)
    x, y = code(old), code(new)
    longest = max(len(x), len(y)) + 1
    power = lambda base: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(longest, base, np.uint64)]), dtype=np.uint64)
    powers, inverse = power(_BASE), power(pow(_BASE, -1, 1 << 64))
    # Scrambled, so that sums of neighbours don't stand for each other.
    scrambled = lambda v: (v ^ (v >> np.uint64(3))) * np.uint64(0xBF58476D1CE4E5B9) ^ np.uint64(0x94D049BB133111EB)
    a, b = _Hashes(scrambled(x), powers, inverse), _Hashes(scrambled(y), powers, inverse)
    todo, runs = [(0, len(x), 0, len(y))], []
    while todo:
        alo, ahi, blo, bhi = part = todo.pop()
        if (ahi - alo) * (bhi - blo) <= SMALL:
            small = SequenceMatcher(None, old[alo:ahi], new[blo:bhi], autojunk=False).get_matching_blocks()
            runs.extend((alo + i, blo + j, k) for i, j, k in small if k)
            continue
        i, j, k = _longest(a, b, part)
        if k and not np.array_equal(x[i : i + k], y[j : j + k]):
            # Two windows of one hash: this part is compared element by element.
            i, j, k = SequenceMatcher(None, old, new, autojunk=False).find_longest_match(alo, ahi, blo, bhi)
        if k:
            runs.append((i, j, k))
            if alo < i and blo < j:
                todo.append((alo, i, blo, j))
            if i + k < ahi and j + k < bhi:
                todo.append((i + k, ahi, j + k, bhi))
    return _opcodes(sorted(runs), len(x), len(y))


def _opcodes(runs: list[tuple[int, int, int]], n: int, m: int) -> list[tuple[str, int, int, int, int]]:
    """The steps that common runs leave, neighbouring runs made one."""
    joined: list[list[int]] = []
    for i, j, k in runs:
        if joined and joined[-1][0] + joined[-1][2] == i and joined[-1][1] + joined[-1][2] == j:
            joined[-1][2] += k
        else:
            joined.append([i, j, k])
    made, i, j = [], 0, 0
    for a, b, k in [*joined, [n, m, 0]]:
        if i < a or j < b:
            made.append(("replace" if i < a and j < b else "delete" if i < a else "insert", i, a, j, b))
        if k:
            made.append(("equal", a, a + k, b, b + k))
        i, j = a + k, b + k
    return made


def exact_segments(old: str | None, new: str | None) -> list[dict]:
    """Character diff whose pieces, joined, give back both texts; offsets in code points and UTF-8 bytes."""
    a, b = old or "", new or ""
    bytes_of = lambda t: list(itertools.accumulate((len(c.encode()) for c in t), initial=0))
    at_a, at_b = bytes_of(a), bytes_of(b)
    made = []
    for tag, i, j, k, m in steps(list(a), list(b)):
        has_old, has_new = tag != "insert", tag != "delete"
        made.append(
            {
                "kind": "unchanged" if tag == "equal" else KINDS[tag],
                "old_text": a[i:j] if has_old else None, "new_text": b[k:m] if has_new else None,
                "old_start": i if has_old else None, "old_end": j if has_old else None,
                "new_start": k if has_new else None, "new_end": m if has_new else None,
                "old_byte_start": at_a[i] if has_old else None, "old_byte_end": at_a[j] if has_old else None,
                "new_byte_start": at_b[k] if has_new else None, "new_byte_end": at_b[m] if has_new else None,
            }
        )
    return made


def token_segments(old: str | None, new: str | None) -> list[dict]:
    """Diff of words, numbers and single ideographs."""
    a, b = TOKEN.findall(old or ""), TOKEN.findall(new or "")
    return [
        {"kind": "unchanged" if tag == "equal" else KINDS[tag], "old_text": "".join(a[i:j]) or None, "new_text": "".join(b[k:m]) or None}
        for tag, i, j, k, m in steps(a, b)
    ]


def form_diff(old: str | None, new: str | None) -> dict:
    """Which characters changed in substance and which only in form.

    White space, single quotes and width variants are ``ignored``; the rest
    is ``unchanged``, ``removed`` or ``added``. Result: ``change_kind``, the
    segments of both sides, and the classes of ignored changes.
    """
    sides = [old or "", new or ""]
    labels: list[list[str]] = []
    shown: list[list[int]] = []
    for text in sides:
        skip = [c.isspace() or c in SINGLE_QUOTES for c in text]
        labels.append(["ignored" if s else "" for s in skip])
        shown.append([i for i, s in enumerate(skip) if not s])
    ignored = {
        name
        for name, test in (("whitespace", str.isspace), ("single_quote", SINGLE_QUOTES.__contains__))
        if list(filter(test, sides[0])) != list(filter(test, sides[1]))
    }
    folded = [[unicodedata.normalize("NFKC", text[i]) for i in at] for text, at in zip(sides, shown)]
    for tag, i, j, k, m in steps(*folded):
        if tag == "equal":
            for x, y in zip(shown[0][i:j], shown[1][k:m]):
                variant = sides[0][x] != sides[1][y]
                ignored |= {"width_variant"} if variant else set()
                labels[0][x] = labels[1][y] = "ignored" if variant else "unchanged"
        else:
            for x in shown[0][i:j]:
                labels[0][x] = "removed"
            for y in shown[1][k:m]:
                labels[1][y] = "added"
    removed, added = "removed" in labels[0], "added" in labels[1]
    segments = []
    for side, text, own in zip(("old", "new"), sides, labels):
        at = 0
        for kind, run in itertools.groupby(own):
            length = sum(1 for _ in run)
            segments.append({"side": side, "kind": kind, "text": text[at : at + length]})
            at += length
    kind = "replaced" if removed and added else "removed" if removed else "added" if added else "format_only"
    return {"change_kind": kind, "segments": segments, "ignored_classes": sorted(ignored)}


def _pairwise(function: Callable, kind: str, arrow: pa.DataType) -> Callable[[Column, Column], Column]:
    def run(old: pa.Array, new: pa.Array) -> pa.Array:
        return pa.array([function(a, b) for a, b in zip(old.to_pylist(), new.to_pylist())], arrow)

    return lambda old, new: F.arrow_udf(run, kind)(old, new)


_text, _int = pa.string(), pa.int32()
_segment = pa.struct([("kind", _text), ("old_text", _text), ("new_text", _text), *[(n, _int) for n in ("old_start", "old_end", "new_start", "new_end", "old_byte_start", "old_byte_end", "new_byte_start", "new_byte_end")]])
exact_diff = _pairwise(exact_segments, f"array<{SEGMENT}>", pa.list_(_segment))
token_diff = _pairwise(token_segments, "array<struct<kind:string,old_text:string,new_text:string>>", pa.list_(pa.struct([("kind", _text), ("old_text", _text), ("new_text", _text)])))
semantic_diff = _pairwise(
    form_diff,
    "struct<change_kind:string,segments:array<struct<side:string,kind:string,text:string>>,ignored_classes:array<string>>",
    pa.struct([("change_kind", _text), ("segments", pa.list_(pa.struct([("side", _text), ("kind", _text), ("text", _text)]))), ("ignored_classes", pa.list_(_text))]),
)


def block_hunks(pairs: DataFrame, edge: str, old_blocks: str, new_blocks: str, key: Callable[[str], str], joiner: str = "\n") -> DataFrame:
    """Changed runs of blocks between two ordered block lists.

    ``pairs`` holds per ``edge`` two arrays of block texts; blocks are equal
    if their ``key`` is. Result ``(edge, hunk_order, change_kind, old_text,
    new_text)``, hunks numbered from 0; an edge without a changed block has
    none. Null arrays count as empty.
    """
    kind = dict(pairs.dtypes)[edge]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("row", "hunk_order", "change_kind", "old_text", "new_text")}
            for row, (old, new) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                old, new = old or [], new or []
                changed = [s for s in steps([key(x) for x in old], [key(x) for x in new]) if s[0] != "equal"]
                for number, (tag, i, j, k, m) in enumerate(changed):
                    values = (row, number, KINDS[tag], joiner.join(old[i:j]) or None, joiner.join(new[k:m]) or None)
                    for name, value in zip(out, values):
                        out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(out["row"], pa.int32())), pa.array(out["hunk_order"], _int), *[pa.array(out[n], _text) for n in ("change_kind", "old_text", "new_text")]],
                names=["edge", "hunk_order", "change_kind", "old_text", "new_text"],
            )

    made = pairs.select(edge, old_blocks, new_blocks).mapInArrow(run, f"edge {kind}, hunk_order int, change_kind string, old_text string, new_text string")
    return made.withColumnRenamed("edge", edge)


def replayed(segments: DataFrame, keys: list[str], order: str, old: str, new: str) -> DataFrame:
    """Both texts of a diff, joined from its pieces in order: ``keys, old_text, new_text``."""
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order), F.coalesce(F.col(c), F.lit("")).alias("t")))), lambda x: x["t"]), "")
    rows, _ = distinct_with_collisions(segments, [*keys, order], [old, new])
    return rows.groupBy(*keys).agg(joined(old).alias("old_text"), joined(new).alias("new_text"))


def replay_problems(wholes: DataFrame, segments: DataFrame, key: str, order: str, texts: tuple[str, str], pieces: tuple[str, str]) -> DataFrame:
    """``(key, problem)`` of every diff whose pieces don't give back its texts.

    ``no_segments``, ``old_text``, ``new_text`` or ``both_texts``; a null text
    is an empty one.
    """
    made = replayed(segments, [key], order, *pieces).select(key, F.col("old_text").alias("__o"), F.col("new_text").alias("__n"))
    rows = wholes.join(made, key, "left")
    old, new = (F.coalesce(F.col(whole), F.lit("")) != F.col(back) for whole, back in zip(texts, ("__o", "__n")))
    problem = F.when(F.col("__o").isNull(), "no_segments").when(old & new, "both_texts").when(old, "old_text").when(new, "new_text")
    return rows.select(key, problem.alias("problem")).where("problem is not null")


def unique_matches(old: DataFrame, new: DataFrame, scope: list[str], old_id: str, new_id: str, signatures: list[str]) -> DataFrame:
    """Match rows of two tables in stages, each only where a signature is unique on both sides.

    ``signatures`` are columns of both tables, the strongest first; what one
    stage matches is out of the next. Result: scope, ``old_id``, ``new_id``,
    ``stage`` (null for the unmatched of either side, which stay unresolved:
    nothing is guessed).
    """
    a = old.select(*scope, F.col(old_id).alias("old_id"), *signatures)
    b = new.select(*scope, F.col(new_id).alias("new_id"), *signatures)
    matched = None
    left, right = a, b
    for number, signature in enumerate(signatures):
        on = [*scope, signature]
        single = lambda df, name: df.where(F.col(signature).isNotNull()).groupBy(*on).agg(F.count("*").alias("__n"), F.first(name).alias(name)).where("__n = 1").drop("__n")  # noqa: E731,B023
        stage = single(left, "old_id").join(single(right, "new_id"), on).select(*scope, "old_id", "new_id", F.lit(number).alias("stage"))
        matched = stage if matched is None else matched.unionByName(stage)
        left = left.join(stage.select(*scope, "old_id"), [*scope, "old_id"], "left_anti")
        right = right.join(stage.select(*scope, "new_id"), [*scope, "new_id"], "left_anti")
    none = lambda c, df: F.lit(None).cast(dict(df.dtypes)[c]).alias(c)
    rest = left.select(*scope, "old_id", none("new_id", b), F.lit(None).cast("int").alias("stage"))
    rest = rest.unionByName(right.select(*scope, none("old_id", a), "new_id", F.lit(None).cast("int").alias("stage")))
    return matched.unionByName(rest)
