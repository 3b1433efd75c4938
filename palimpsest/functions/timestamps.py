"""Mixed timestamp notations read into UTC seconds, a whole column at a time."""

from __future__ import annotations

import functools
import re

import numpy as np
import pandas as pd

from palimpsest.functions.numerals import NUMERAL_CHARS, chinese_number
from palimpsest.functions.zones import zone

DEFAULT_ZONE = "Asia/Taipei"
#: Characters of the first length class; each further one is twice as long.
SHORT = 64
#: Code points that are read at once; longer values are read alone.
POINTS = 1 << 22
#: Digits that a 64-bit number surely holds.
DIGITS = 18
NONE = np.iinfo(np.int64).min

# Months by the first three letters of their English names.
MONTHS = {m: i + 1 for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())}
WEEKDAYS = "mon tue wed thu fri sat sun".split()

_D, _A, _C, _B = "9", "A", "C", " "


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lookup tables over the basic plane: folded character, and its class in the mask."""
    fold = np.arange(0x10000, dtype=np.uint32)
    fold[0xFF01:0xFF5F] = np.arange(0x21, 0x7F)
    for c in (0x3000, 0xA0, 0x202F, 0x2009, 0x2003, 0x2005, 0x09, 0x0A, 0x0D):
        fold[c] = 0x20
    for c, to in ((0x2212, "-"), (0x2010, "-"), (0x2011, "-"), (0x2013, "-"), (0x2215, "/"), (0x2044, "/"), (0xFE55, ":")):
        fold[c] = ord(to)
    kind = fold.copy()
    kind[ord("0") : ord("9") + 1] = ord(_D)
    kind[ord("A") : ord("Z") + 1] = kind[ord("a") : ord("z") + 1] = ord(_A)
    for c in NUMERAL_CHARS:
        kind[ord(c)] = ord(_C)
    return fold, kind[fold]


def shape_masks(values: np.ndarray, width: int = SHORT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded code points (n x width), lengths and mask strings of values of at most ``width`` characters.

    The values are copied into one code-point array, of which the tables give
    the folded character and its class.
    """
    fixed = np.asarray(values, dtype=f"<U{width}")
    points = np.ascontiguousarray(fixed).view(np.uint32).reshape(len(fixed), width)
    fold, kind = _tables()
    points = np.where(points < 0x10000, points, 0xFFFD)
    folded, masks = fold[points], kind[points].astype(np.uint32)
    masks = np.ascontiguousarray(masks).view(f"<U{width}").ravel()
    return folded, np.char.str_len(masks), masks


def _runs(mask: str) -> list[tuple[str, int, int]]:
    """Runs of a class as (class, start, end); every other character is a run of its own."""
    return [(m[0][0], m.start(), m.end()) for m in re.finditer(rf"{_D}+|{_A}+|{_C}+|.", mask, re.DOTALL)]


_DATE = r"(?P<date>" + "|".join(
    [
        r"(?P<num1>[9C]) ?(?P<sep>[/.年-]) ?(?P<num2>[9C]) ?(?:[/.月-]) ?(?P<num3>[9C])日?",
        r"(?P<dmy_d>9)[ -](?P<dmy_m>A)\.?[ -](?P<dmy_y>9)",
        r"(?P<mdy_m>A)\.? (?P<mdy_d>9),? (?P<mdy_y>9)",
        r"(?P<my_m>A)\.? (?P<my_y>9)",
        r"(?P<ym_y>[9C]) ?(?:[/.年-]) ?(?P<ym_m>[9C])月?",
        r"(?P<y>[9C])年",
        r"(?P<digits>9)",
    ]
) + ")"
_TIME = r"(?:[ ,AT]? ?(?P<half1>上午|下午|中午|凌晨|早上|晚上)? ?(?P<h>9)(?:[:時点點] ?(?P<mi>9)(?:[:分] ?(?P<s>9)(?:[.,](?P<f>9))?秒?|分)?|時)(?: ?(?P<half2>a)(?![Aa+/:-]))?)?"
_ZONE = r"(?: ?(?P<zone>\[?[Aa](?:[/_-][Aa])*\]?(?:[+-]9(?::9)?)?|[+-]9(?::9)?))?"
_GRAMMAR = re.compile(rf"(?P<day>A, )?{_DATE}{_TIME}{_ZONE}")


class Reader:
    """The parser of one mask: which characters hold which field."""

    def __init__(self, mask: str):
        self.fields: dict[str, tuple[int, int]] = {}
        runs = _runs(mask)
        # Each run is one character of the collapsed mask, two letters (AM, PM) being their own; what stands
        # around the date (titles, brackets, editions) holds neither digits nor letters.
        collapsed = "".join("a" if kind == _A and end - at == 2 else kind for kind, at, end in runs)
        first = re.search("[9AaC]", collapsed)
        start = first.start() if first else len(collapsed)
        bare = collapsed[start : max(collapsed.rfind(c) for c in "9AaC年月日時分秒]") + 1]
        found = _GRAMMAR.fullmatch(bare) or _GRAMMAR.fullmatch(bare.rstrip("]"))
        if found:
            for name, text in found.groupdict().items():
                if text is not None:
                    a, b = found.span(name)
                    self.fields[name] = (runs[start + a][1], runs[start + b - 1][2])
        self.sep = found["sep"] if found else None


@functools.lru_cache(maxsize=65536)
def reader(mask: str) -> Reader:
    """The reader of a mask, made once per process."""
    return Reader(mask)


def _text(points: np.ndarray, span: tuple[int, int]) -> np.ndarray:
    width = span[1] - span[0]
    return np.ascontiguousarray(points[:, span[0] : span[1]]).view(f"<U{width}").ravel()


def _each(texts: np.ndarray, read) -> np.ndarray:
    """read of every text, called once per distinct text; NONE for None."""
    codes, distinct = pd.factorize(texts)
    return np.array([NONE if (x := read(t)) is None else x for t in distinct], dtype=np.int64)[codes]


def _number(points: np.ndarray, span: tuple[int, int], numerals: bool = True) -> np.ndarray:
    digits = points[:, span[0] : span[1]].astype(np.int64) - 48
    if ((digits >= 0) & (digits <= 9)).all():
        if digits.shape[1] > DIGITS:
            lead = (digits[:, :-DIGITS] > 0).any(axis=1)
            return np.where(lead, 10**DIGITS, _number(points, (span[1] - DIGITS, span[1])))
        return digits @ (10 ** np.arange(span[1] - span[0] - 1, -1, -1, dtype=np.int64))
    return _each(_text(points, span), chinese_number)


def _month(points: np.ndarray, span: tuple[int, int]) -> np.ndarray:
    def read(text: str) -> int | None:
        whole = "january february march april may june july august september october november december sept".split()
        low = text.lower()
        return MONTHS.get(low[:3]) if len(low) == 3 or low in whole else None

    return _each(_text(points, span), read)


def _days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Days since 1970 of calendar dates, and whether they exist."""
    ok = (y >= 1) & (y <= 9999) & (m >= 1) & (m <= 12) & (d >= 1) & (d <= 31)
    months = (np.where(ok, y, 1970) - 1970) * 12 + np.where(ok, m, 1) - 1
    first = months.astype("M8[M]")
    days = first.astype("M8[D]").astype(np.int64) + np.where(ok, d, 1) - 1
    ok &= days < (first + 1).astype("M8[D]").astype(np.int64)
    return days, ok


def _year(y: np.ndarray) -> np.ndarray:
    return np.where((y >= 1) & (y < 1000), y + 1911, y)


def _digits(points: np.ndarray, span: tuple[int, int], precision: np.ndarray):
    """Digits alone: (year, month, day, h, min, s), or epoch seconds, by their number and the precision."""
    n, (a, b) = span[1] - span[0], span
    one, zero = np.ones(len(points), dtype=np.int64), np.zeros(len(points), dtype=np.int64)
    cut = lambda i, j: _number(points, (a + i, a + j))
    month, day = precision == "month", precision == "day"
    if n <= 3:
        return _year(cut(0, n)), one, one, zero, zero, zero
    if n == 4:
        y, m = np.where(month, _year(cut(0, 2)), _year(cut(0, 4))), np.where(month & (cut(0, 4) // 100 < 1000), cut(2, 4), 1)
        return y, m, one, zero, zero, zero
    if n == 5:
        return _year(cut(0, 3)), cut(3, 5), one, zero, zero, zero
    if n == 6:
        western = month | (~day & (cut(0, 4) >= 1900) & (cut(0, 4) < 2100) & (cut(4, 6) >= 1) & (cut(4, 6) <= 12))
        return (
            np.where(western, cut(0, 4), _year(cut(0, 2))), np.where(western, cut(4, 6), cut(2, 4)),
            np.where(western, 1, cut(4, 6)), zero, zero, zero,
        )
    if n == 7:
        return _year(cut(0, 3)), cut(3, 5), cut(5, 7), zero, zero, zero
    if n in (8, 12, 14):
        clock = [cut(i, i + 2) if i < n else zero for i in (8, 10, 12)]
        return cut(0, 4), cut(4, 6), cut(6, 8), *clock
    return None


def _read_group(points: np.ndarray, r: Reader, clock_zone: np.ndarray, precision: np.ndarray) -> np.ndarray:
    """UTC seconds of values that share one mask; NONE where they mean no moment."""
    count, f = len(points), r.fields
    nothing = np.full(count, NONE)
    if "date" not in f:
        return nothing
    one, zero = np.ones(count, dtype=np.int64), np.zeros(count, dtype=np.int64)
    h = mi = s = zero
    if "num1" in f:
        a, m, c = (_number(points, f[x]) for x in ("num1", "num2", "num3"))
        long_last = f["num3"][1] - f["num3"][0] == 4 and f["num1"][1] - f["num1"][0] <= 2
        if long_last and r.sep == "/":
            return nothing  # day and month can't be told apart
        y, d = (c, a) if long_last else (_year(a), c)
    elif "dmy_d" in f or "mdy_d" in f:
        k = "dmy" if "dmy_d" in f else "mdy"
        y, m, d = _number(points, f[k + "_y"]), _month(points, f[k + "_m"]), _number(points, f[k + "_d"])
    elif "my_m" in f:
        y, m, d = _number(points, f["my_y"]), _month(points, f["my_m"]), one
    elif "ym_y" in f:
        y, m, d = _year(_number(points, f["ym_y"])), _number(points, f["ym_m"]), one
    elif "y" in f:
        y, m, d = _year(_number(points, f["y"])), one, one
    else:
        width = f["digits"][1] - f["digits"][0]
        if width in (10, 13) and "h" not in f:
            return _number(points, f["digits"]) // (1000 if width == 13 else 1)
        parts = _digits(points, f["digits"], precision)
        if parts is None or ("h" in f and width != 8 and width != 7):
            return nothing
        y, m, d, h, mi, s = parts
    if "day" in f:
        span = f["day"][0], f["day"][1] - 2
        if (_each(_text(points, span), lambda t: 0 if t.lower()[:3] in WEEKDAYS else None) == NONE).all():
            return nothing
    days, ok = _days(y, m, d)
    if "h" in f:
        h = _number(points, f["h"])
        mi, s = (_number(points, f[x]) if x in f else zero for x in ("mi", "s"))
        for k in ("half1", "half2"):
            if k in f:
                half = _each(_text(points, f[k]), lambda t: {"AM": 0, "PM": 1, "上午": 0, "凌晨": 0, "早上": 0, "下午": 1, "晚上": 1, "中午": 2}.get(t.upper()))
                ok &= (half != NONE) & (h >= 0) & (h <= 12)
                h = np.where(half == 0, np.where(h == 12, 0, h), np.where((half == 1) & (h < 12), h + 12, np.where((half == 2) & (h < 11), h + 12, h)))
    ok &= (h >= 0) & (h <= 24) & (mi >= 0) & (mi < 60) & (s >= 0) & (s <= 60) & ((h < 24) | ((mi == 0) & (s == 0)))
    local = np.where(ok, days, 0) * 86400 + h * 3600 + mi * 60 + s
    names = _text(points, f["zone"]) if "zone" in f else clock_zone
    result = nothing.copy()
    codes, distinct = pd.factorize(names, use_na_sentinel=False)
    for i, name in enumerate(distinct):
        at = ok & (codes == i)
        table = zone(name) if isinstance(name, str) and name.strip() else None
        if table is None and "zone" not in f:
            table = zone(DEFAULT_ZONE)
        if table is not None:
            result[at] = table.to_utc(local[at])
    return result


def utc_seconds(values: pd.Series, zones: pd.Series | None = None, precisions: pd.Series | None = None) -> np.ndarray:
    """UTC seconds of every value, NONE where it means no moment.

    The values, without the blanks around them, are split by length class
    and shape mask; each distinct mask is mapped to its reader once, which
    then converts all its values at once.
    """
    size = len(values)
    result = np.full(size, NONE)
    texts = np.array([t.strip() for t in values.where(values.notna(), "")], dtype=object)
    lengths = np.array([0 if "\0" in t else len(t) for t in texts], dtype=np.int64)
    zones = (zones if zones is not None else pd.Series([None] * size)).to_numpy(dtype=object)
    precisions = (precisions if precisions is not None else pd.Series([None] * size)).to_numpy(dtype=object)
    low, width = 0, SHORT
    while low < lengths.max(initial=0):
        usable = np.flatnonzero((lengths > low) & (lengths <= width))
        step = max(1, POINTS // width)
        for at in (usable[i : i + step] for i in range(0, len(usable), step)):
            result[at] = _read_class(texts[at], zones[at], precisions[at], int(lengths[at].max()) if width > SHORT else SHORT)
        low, width = width, width * 2
    return result


def _read_class(texts: np.ndarray, zones: np.ndarray, precisions: np.ndarray, width: int) -> np.ndarray:
    """UTC seconds of values of one length class."""
    result = np.full(len(texts), NONE)
    points, _, masks = shape_masks(texts, width)
    codes, distinct = pd.factorize(masks)
    order = np.argsort(codes, kind="stable")
    bounds = np.searchsorted(codes[order], np.arange(len(distinct) + 1))
    # Long masks aren't kept for later batches.
    read = reader if width <= SHORT else Reader
    for i, mask in enumerate(distinct):
        at = order[bounds[i] : bounds[i + 1]]
        result[at] = _read_group(points[at], read(mask), zones[at], precisions[at])
    return result


def iso_utc(seconds: np.ndarray) -> np.ndarray:
    """``YYYY-MM-DDTHH:MM:SSZ`` of UTC seconds, None for NONE."""
    text = np.datetime_as_string(np.where(seconds == NONE, 0, seconds).astype("M8[s]"), unit="s")
    return np.where(seconds == NONE, None, np.char.add(text, "Z").astype(object))
