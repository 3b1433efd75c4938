"""Quantities with units and the limit expressions that hold them."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of units and the unit that each is.
UNITS = {
    "小時": "hour", "天": "day", "日": "day", "週": "week", "周": "week", "月": "month", "個月": "month", "年": "year", "次": "time",
    "u": "unit_u", "iu": "unit_u", "單位": "unit_u", "mcg": "microgram", "μg": "microgram", "微克": "microgram", "mg": "milligram", "毫克": "milligram",
    "g": "gram", "公克": "gram", "kg": "kilogram", "公斤": "kilogram", "ml": "millilitre", "毫升": "millilitre",
    "支": "item", "粒": "item", "瓶": "item", "錠": "item",
}
_SPELLINGS = "|".join(sorted(UNITS, key=lambda u: (-len(u), u)))
NUMBER = r"[0-9]+(?:\.[0-9]+)?"
#: A quantity: number and unit.
QUANTITY = rf"(?iu)({NUMBER})\s*({_SPELLINGS})"
#: Limit expressions that a quantity stands in.
LIMITS = {
    "periodic_cap": rf"(?iu)每[^，。；0-9]{{1,6}}上限為{NUMBER}\s*(?:{_SPELLINGS})",
    "total_cap": rf"(?iu)總量不超過{NUMBER}\s*(?:{_SPELLINGS})",
    "duration_cap": rf"(?iu)療程以{NUMBER}\s*(?:{_SPELLINGS})為限",
    "recurring_action": rf"(?iu)每{NUMBER}\s*(?:{_SPELLINGS})複查",
    "interval": rf"(?iu)間隔至少{NUMBER}\s*(?:{_SPELLINGS})",
}


def unit_of(spelling: Column, strict: bool = False) -> Column:
    """The unit of a spelling, whatever its width and case; null if there is none, or an error if ``strict``."""
    plain = F.lower(F.translate(F.trim(spelling), "ｇｋｌｍｃｕｉµＧＫＬＭＣＵＩ", "gklmcuiμGKLMCUI"))
    found = F.element_at(F.create_map(*[F.lit(x) for x in chain.from_iterable(UNITS.items())]), plain)
    return F.coalesce(found, F.when(spelling.isNotNull(), F.raise_error(F.concat(F.lit("no unit: "), spelling)))) if strict else found


def quantity_of(expression: Column) -> Column:
    """struct(value, unit) of the first quantity of an expression; nulls if it has none."""
    value = F.regexp_extract(expression, QUANTITY, 1)
    return F.struct(F.when(value != "", value.cast("double")).alias("value"), unit_of(F.nullif(F.regexp_extract(expression, QUANTITY, 2), F.lit(""))).alias("unit"))


def limit_expressions(text: Column) -> Column:
    """All limit expressions of a text: array of struct(kind, raw, value, unit), by kind and in the text's order."""
    each = lambda kind, rule: F.transform(F.regexp_extract_all(text, F.lit(rule), F.lit(0)), lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("raw"), quantity_of(x).alias("q")))
    found = F.concat(*[each(kind, rule) for kind, rule in LIMITS.items()])
    return F.transform(found, lambda x: F.struct(x["kind"].alias("kind"), x["raw"].alias("raw"), x["q"]["value"].alias("value"), x["q"]["unit"].alias("unit")))
