"""Versioned zone transition tables for vectorised local-to-UTC conversion."""

from __future__ import annotations

import functools
import re
import zoneinfo
from datetime import datetime, timezone
from importlib import resources
from pathlib import Path

import numpy as np

FIRST_YEAR, LAST_YEAR = 1880, 2100

# Offsets in minutes of zone abbreviations. CST is China Standard Time here.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "EET": 120,
    "EEST": 180, "MSK": 180, "CST": 480, "HKT": 480, "SGT": 480, "AWST": 480, "JST": 540, "KST": 540, "AEST": 600,
    "AEDT": 660, "EST": -300, "EDT": -240, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}


@functools.lru_cache(maxsize=1)
def tzdata_version() -> str:
    """Release of the zone rules that this process reads."""
    for folder in zoneinfo.TZPATH:
        for name in ("tzdata.zi", "+VERSION"):
            path = Path(folder, name)
            if path.is_file():
                head = path.open().readline()
                return (re.search(r"\d{4}[a-z]+", head) or [head.strip()])[0]
    try:
        return resources.files("tzdata").joinpath("zones").parent.joinpath("__init__.py").read_text().split('"')[-2]
    except (ModuleNotFoundError, FileNotFoundError, IndexError):
        return "unknown"


class ZoneTable:
    """Local thresholds and offsets of one zone.

    ``thresholds[i]`` is the first local second that reads with
    ``offsets[i + 1]``. A reading that occurs twice is the first one, so the
    old offset holds until the old clock has reached the change; a reading
    that is skipped moves on by the length of the skip, which is what the old
    offset gives.
    """

    def __init__(self, name: str):
        zone = zoneinfo.ZoneInfo(name)
        at = lambda s: int(datetime.fromtimestamp(s, zone).utcoffset().total_seconds())
        day, low = 86400, int(datetime(FIRST_YEAR, 1, 1, tzinfo=timezone.utc).timestamp())
        high = int(datetime(LAST_YEAR, 1, 1, tzinfo=timezone.utc).timestamp())
        offsets, thresholds = [at(low)], []
        for start in range(low, high, day):
            if (new := at(start + day)) == offsets[-1]:
                continue
            a, b = start, start + day
            while b - a > 1:
                middle = (a + b) // 2
                a, b = (middle, b) if at(middle) == offsets[-1] else (a, middle)
            thresholds.append(b + max(offsets[-1], new))
            offsets.append(new)
        self.thresholds, self.offsets = np.array(thresholds, dtype=np.int64), np.array(offsets, dtype=np.int64)

    def to_utc(self, local: np.ndarray) -> np.ndarray:
        return local - self.offsets[np.searchsorted(self.thresholds, local, side="right")]


class FixedOffset:
    """An offset that never changes."""

    def __init__(self, minutes: int):
        self.seconds = minutes * 60

    def to_utc(self, local: np.ndarray) -> np.ndarray:
        return local - self.seconds


@functools.lru_cache(maxsize=4096)
def zone(text: str) -> ZoneTable | FixedOffset | None:
    """The zone that a text names: a region, an abbreviation or an offset; None if it names none."""
    text = text.strip().strip("[]()")
    found = re.fullmatch(r"(?:UTC|GMT|UT)?\s*([+-])(\d{1,2})(?::?(\d{2}))?(?::?\d{2})?", text.replace("−", "-"), re.IGNORECASE)
    if found:
        minutes = int(found[2]) * 60 + int(found[3] or 0)
        return FixedOffset(-minutes if found[1] == "-" else minutes) if minutes <= 18 * 60 else None
    if text.upper() in ABBREVIATIONS:
        return FixedOffset(ABBREVIATIONS[text.upper()])
    try:
        return ZoneTable(text)
    except (zoneinfo.ZoneInfoNotFoundError, ValueError, OSError):
        return None
