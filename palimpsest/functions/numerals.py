"""Chinese numerals."""

from __future__ import annotations

import re

# Digits and units of Chinese numerals.
DIGITS = {"〇": 0, "零": 0, "○": 0, "一": 1, "二": 2, "兩": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9, "元": 1}
UNITS = {"十": 10, "百": 100, "千": 1000}
TENS = {"廿": 20, "卅": 30}
NUMERAL_CHARS = "".join([*DIGITS, *UNITS, *TENS])


def chinese_number(text: str) -> int | None:
    """The integer that Chinese (or mixed) numerals spell, None if they don't.

    Both place notation (``二〇一五``) and units (``一百零七``, ``二十三``, ``3百``)
    are read.
    """
    text = text.strip()
    if not text:
        return None
    if re.fullmatch(r"\d+", text):
        return int(text)
    if all(c in DIGITS for c in text):
        return int("".join(str(DIGITS[c]) for c in text))
    total, digit = 0, None
    for part in re.findall(r"\d+|.", text):
        if part.isdigit() and part.isascii():
            digit = int(part)
        elif part in DIGITS:
            digit = DIGITS[part]
        elif part in UNITS:
            total, digit = total + (1 if digit is None else digit) * UNITS[part], None
        elif part in TENS:
            total, digit = total + TENS[part], None
        else:
            return None
    return total + (digit or 0)
