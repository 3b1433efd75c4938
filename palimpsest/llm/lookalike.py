"""One consistent form of texts that look the same but differ in their characters.

A column of texts becomes one array of code points. A lookup table gives each
code point its expansion, gathers place the expansions at their offsets, and
marks are ordered and composed on whole arrays; no string is handled by itself.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.members import meeting, same
from palimpsest.runtime import materialize

# Letters of other scripts with the shape of a Latin letter.
HOMOGLYPHS = {
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X", "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J",
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C",
    "Т": "T", "У": "Y", "Х": "X", "Ь": "b", "Ѵ": "V", "Ү": "Y", "Ԛ": "Q", "Ԝ": "W", "Ԍ": "G", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c",
    "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ѡ": "w", "ѵ": "v", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "Ӏ": "I", "ү": "y",
    # Armenian
    "Լ": "L", "Ո": "U", "Ս": "U", "Տ": "S", "Օ": "O", "զ": "q", "հ": "h", "ո": "n", "ս": "u", "ց": "g", "օ": "o",
    # Cherokee
    "Ꭰ": "D", "Ꭱ": "R", "Ꭲ": "T", "Ꭵ": "i", "Ꭺ": "A", "Ꭻ": "J", "Ꭼ": "E", "Ꮃ": "W", "Ꮇ": "M", "Ꮋ": "H", "Ꮍ": "Y", "Ꮐ": "G", "Ꮒ": "h",
    "Ꮓ": "Z", "Ꮟ": "b", "Ꮢ": "R", "Ꮥ": "S", "Ꮩ": "V", "Ꮪ": "S", "Ꮮ": "L", "Ꮯ": "C", "Ꮲ": "P", "Ꮶ": "K", "Ꮷ": "d", "Ᏻ": "G", "Ᏼ": "B",
    # Coptic
    "Ⲃ": "B", "Ⲏ": "H", "Ⲓ": "I", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲟ": "O", "ⲟ": "o", "Ⲣ": "P", "ⲣ": "p", "Ⲥ": "C", "ⲥ": "c", "Ⲧ": "T", "Ⲩ": "Y", "Ⲭ": "X",
    # Lisu
    "ꓐ": "B", "ꓑ": "P", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N", "ꓡ": "L",
    "ꓢ": "S", "ꓣ": "R", "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O", "ꓴ": "U",
    # Latin letters of other use
    "ı": "i", "ɡ": "g", "ɑ": "a",
}
# Kinds of compatibility forms that look like what they stand for.
SAME_LOOK = {"<wide>", "<narrow>", "<compat>", "<square>", "<font>", "<noBreak>", "<small>", "<vertical>", "<initial>", "<medial>", "<final>", "<isolated>"}
# Ranges of code points without any mark on the page, beside the category Cf.
UNSEEN = [(0x034F, 0x034F), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFFA0, 0xFFA0), (0xE0000, 0xE0FFF)]
PLANES = 0x110000


def _unseen(char: str) -> bool:
    return unicodedata.category(char) == "Cf" or any(a <= ord(char) <= b for a, b in UNSEEN)


def _expansion(char: str) -> str:
    if _unseen(char):
        return ""
    if "가" <= char <= "힣":
        return unicodedata.normalize("NFD", char)
    # Letters of syllables that stand by themselves don't join on the page.
    if "\u3131" <= char <= "\u318e":
        return char
    kind, *points = unicodedata.decomposition(char).split() or [""]
    if not points and not kind:
        return " " if unicodedata.category(char) == "Zs" else HOMOGLYPHS.get(char, char)
    if kind.startswith("<") and kind not in SAME_LOOK:
        return HOMOGLYPHS.get(char, char)
    if not kind.startswith("<"):
        points = [kind, *points]
    return "".join(_expansion(chr(int(p, 16))) for p in points)


@functools.lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, ...]:
    """Expansion lengths, starts and characters; combining classes; composition keys and results."""
    lengths = np.ones(PLANES, dtype=np.uint8)
    single = np.arange(PLANES, dtype=np.uint32)
    starts = np.zeros(PLANES, dtype=np.int32)
    classes = np.zeros(PLANES, dtype=np.uint8)
    flat: list[int] = []
    pairs: dict[int, int] = {}
    for point in [*range(0xD800), *range(0xE000, PLANES)]:
        char = chr(point)
        category = unicodedata.category(char)
        if category in ("Cn", "Co"):
            if any(a <= point <= b for a, b in UNSEEN):
                lengths[point] = 0
            continue
        classes[point] = unicodedata.combining(char)
        text = _expansion(char)
        lengths[point] = len(text)
        if len(text) == 1:
            single[point] = ord(text)
        elif text:
            starts[point] = len(flat)
            flat.extend(map(ord, text))
        parts = unicodedata.decomposition(char).split()
        if len(parts) == 2 and not parts[0].startswith("<") and unicodedata.normalize("NFC", char) == char:
            pairs[int(parts[0], 16) << 21 | int(parts[1], 16)] = point
    keys = np.array(sorted(pairs), dtype=np.int64)
    return lengths, single, starts, np.array(flat, dtype=np.uint32), classes, keys, np.array([pairs[k] for k in keys.tolist()], dtype=np.uint32)


def _expand(points: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths, single, starts, flat, *_ = tables()
    n = lengths[points]
    if (n == 1).all():
        return single[points], rows
    each = n.astype(np.int64)
    out = np.repeat(single[points], each)
    wide = np.flatnonzero(each > 1)
    if len(wide):
        ends = np.cumsum(each)
        count = each[wide]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        out[np.repeat(ends[wide] - count, count) + within] = flat[np.repeat(starts[points[wide]], count) + within]
    return out, np.repeat(rows, each)


def _order_marks(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sort every run of marks by combining class, all runs in one stable sort."""
    of = tables()[4][points]
    marks = np.flatnonzero(of)
    if len(marks) < 2 or not ((of[1:] > 0) & (of[:-1] > of[1:]) & (rows[1:] == rows[:-1])).any():
        return points
    run = np.cumsum(np.concatenate([[1], (np.diff(marks) > 1) | (rows[marks[1:]] != rows[marks[:-1]])]))
    points[marks] = points[marks][np.lexsort((of[marks], run))]
    return points


def _compose(points: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Join each base with the mark behind it where one character has both, until none is left."""
    *_, classes, keys, results = tables()
    while True:
        marks = np.flatnonzero((classes[points[1:]] > 0) & (rows[1:] == rows[:-1])) + 1
        pair = points[marks - 1].astype(np.int64) << 21 | points[marks].astype(np.int64)
        found = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        hit = keys[found] == pair
        if not hit.any():
            return points, rows
        at = marks[hit]
        points[at - 1] = results[found[hit]]
        keep = np.ones(len(points), dtype=bool)
        keep[at] = False
        points, rows = points[keep], rows[keep]


# First code points of the parts of Hangul syllables and of the syllables, and how many of each part there are.
LEAD, VOWEL, TAIL, SYLLABLE = 0x1100, 0x1161, 0x11A7, 0xAC00
LEADS, VOWELS, TAILS = 19, 21, 28


def _join_syllables(points: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Join the parts of Hangul syllables by their arithmetic: first lead and vowel, then the tail."""
    if not ((points >= LEAD) & (points < TAIL + TAILS)).any():
        return points, rows
    for tail in (False, True):
        a, b = points[:-1].astype(np.int64), points[1:].astype(np.int64)
        together = rows[1:] == rows[:-1]
        if tail:
            open_syllable = (a >= SYLLABLE) & (a < SYLLABLE + LEADS * VOWELS * TAILS) & ((a - SYLLABLE) % TAILS == 0)
            hit = together & open_syllable & (b > TAIL) & (b < TAIL + TAILS)
            made = a + b - TAIL
        else:
            hit = together & (a >= LEAD) & (a < LEAD + LEADS) & (b >= VOWEL) & (b < VOWEL + VOWELS)
            made = SYLLABLE + ((a - LEAD) * VOWELS + b - VOWEL) * TAILS
        at = np.flatnonzero(hit)
        points[at] = made[at]
        keep = np.ones(len(points), dtype=bool)
        keep[at + 1] = False
        points, rows = points[keep], rows[keep]
    return points, rows


def consistent(texts: pa.Array) -> pa.Array:
    """The consistent form of every text of a column; null for null."""
    texts = texts.cast(pa.large_string())
    count = len(texts)
    if not count:
        return pa.array([], pa.string())
    filled = texts.fill_null("")
    offsets = np.frombuffer(filled.buffers()[1], dtype=np.int64)[filled.offset : filled.offset + count + 1]
    raw = (filled.buffers()[2] or pa.py_buffer(b""))[offsets[0] : offsets[-1]]
    data = np.frombuffer(raw, dtype=np.uint8) if len(raw) else np.zeros(0, dtype=np.uint8)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets - offsets[0]]
    rows = np.repeat(np.arange(count, dtype=np.int32), np.diff(first))
    points, rows = _expand(points, rows)
    points, rows = _join_syllables(*_compose(_order_marks(points, rows), rows))
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    ends = np.concatenate([[0], np.cumsum(np.bincount(rows, weights=width, minlength=count))]).astype(np.int64)
    body = points.tobytes().decode("utf-32-le").encode("utf-8")
    valid = pa.array(np.asarray(texts.is_valid())).buffers()[1] if texts.null_count else None
    made = pa.LargeStringArray.from_buffers(count, pa.py_buffer(ends), pa.py_buffer(body), valid)
    return made.cast(pa.string())


def consistent_form(text: Column) -> Column:
    """:func:`consistent` of a string column.

    Width, coding of accents, unseen characters, kinds of spaces, compatibility
    forms of signs, units, ligatures and ideographs and look-alike letters are
    made one; case, superscripts, digits and the number of spaces stay. Null
    for null, the empty text for one of unseen characters only.
    """
    return F.arrow_udf(lambda texts: consistent(texts), "string")(text.cast("string"))


def _hashes(column: Column, name: str) -> list[Column]:
    """Two 64-bit hashes of a text, which stand for it in joins."""
    return [F.xxhash64(column).alias(name + "1"), F.xxhash64(F.lit(1), column).alias(name + "2")]


def _formed(rows: DataFrame) -> DataFrame:
    """``rows`` with a text ``t``, which hashes of its form and of itself replace; the forms are made once."""
    keys = [c for c in rows.columns if c != "t"]
    formed = rows.withColumn("f", consistent_form(F.col("t"))).select(*keys, *_hashes(F.col("f"), "f"), *_hashes(F.col("t"), "t"))
    return materialize(formed.distinct(), "forms")


def same_look_pairs(records: DataFrame, record: str, text: str) -> DataFrame:
    """Pairs of records with different strings of one consistent form.

    Result ``(record_a, record_b)`` with ``record_a < record_b``, distinct.
    Null records and texts are in no pair; equal strings make none. Only the
    forms that several different strings share are joined, so groups of equal
    copies, of whatever size, are dropped before; what is left has the size of
    the result.
    """
    rows = _formed(records.select(F.col(record).alias("id"), F.col(text).alias("t")).where("id is not null and t is not null"))
    mixed = rows.groupBy("f1", "f2").agg(F.min("t1").alias("lo"), F.max("t1").alias("hi")).where("lo <> hi").select("f1", "f2")
    a, b = meeting(rows.join(mixed, ["f1", "f2"], "left_semi"), ["f1", "f2"], "id")
    other = (F.col("a.t1") != F.col("b.t1")) | (F.col("a.t2") != F.col("b.t2"))
    return (
        a.join(b, same("f1", "f2") & (F.col("a.id") < F.col("b.id")) & other)
        .select(F.col("a.id").alias("record_a"), F.col("b.id").alias("record_b"))
        .distinct()
    )


def same_look_successors(records: DataFrame, pairs: DataFrame, *, record: str, entity: str, edition: str, text: str) -> DataFrame:
    """Pairs of an entity's records in neighbouring editions with different strings of one form.

    ``pairs`` has the neighbouring editions as ``(older, newer)``. Result as
    of :func:`same_look_pairs`.
    """
    rows = records.select(F.col(record).alias("id"), F.col(entity).alias("w"), F.col(edition).alias("e"), F.col(text).alias("t"))
    rows = _formed(rows.where("id is not null and w is not null and e is not null and t is not null"))
    mixed = rows.groupBy("w", "f1", "f2").agg(F.min("t1").alias("lo"), F.max("t1").alias("hi")).where("lo <> hi").select("w", "f1", "f2")
    some = rows.join(mixed, ["w", "f1", "f2"], "left_semi")
    older = some.join(pairs.select(F.col("older").alias("e"), F.col("newer").alias("next")), "e").drop("e")
    older = older.select("w", "f1", "f2", F.col("next").alias("e"), F.col("id").alias("old_id"), F.col("t1").alias("o1"), F.col("t2").alias("o2"))
    found = some.join(older, ["w", "f1", "f2", "e"]).where("(t1 <> o1 or t2 <> o2) and id <> old_id")
    return found.select(F.least("id", "old_id").alias("record_a"), F.greatest("id", "old_id").alias("record_b")).distinct()


def same_look_parts(parts: DataFrame, wholes: DataFrame, *, part: str, part_text: str, of: str, whole: str, whole_text: str) -> DataFrame:
    """Parts that aren't verbatim in their whole but look the same as a part of it.

    ``of`` names a part's whole. Result as of :func:`same_look_pairs`. Parts
    without a text, whole or any visible character are in no pair. Forms are
    only made of the parts that aren't verbatim, and of their wholes.
    """
    a = parts.select(F.col(part).alias("id"), F.col(of).alias("whole_id"), F.col(part_text).alias("p")).where("id is not null and p is not null").distinct()
    b = wholes.select(F.col(whole).alias("whole_id"), F.col(whole_text).alias("t")).where("t is not null")
    # Written before the forms are made: the planner would else form every whole ahead of the join.
    candidates = materialize(a.join(b, "whole_id").where("not contains(t, p)"), "parts")
    formed = candidates.select("id", "whole_id", consistent_form(F.col("p")).alias("pf"), consistent_form(F.col("t")).alias("tf"))
    found = formed.where("pf <> '' and contains(tf, pf)")
    return found.select(F.least("id", "whole_id").alias("record_a"), F.greatest("id", "whole_id").alias("record_b")).distinct()
