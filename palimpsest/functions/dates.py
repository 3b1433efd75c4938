"""Calendar dates of the Republic era, their markers in texts, and date facts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a marker of year, month and day parted by (full-width) slashes, not touching other digits.
MARKER = r"(?<![0-9])([0-9]{2,3})[ \t]*[/／][ \t]*([0-9]{1,2})[ \t]*[/／][ \t]*([0-9]{1,2})(?![0-9])"


def iso_seconds(seconds: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ`` of UTC epoch seconds, whatever the session's time zone."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int")).cast("string")
    rest = F.pmod(seconds, F.lit(86400))
    two = lambda c: F.lpad(F.floor(c).cast("string"), 2, "0")
    return F.concat(day, F.lit("T"), two(rest / 3600), F.lit(":"), two(rest % 3600 / 60), F.lit(":"), two(rest % 60), F.lit("Z"))


def republic_date(year: Column, month: Column, day: Column) -> Column:
    """The date of a year of the Republic (1911 added), null where the calendar has none."""
    text = F.format_string("%04d-%02d-%02d", year.cast("int") + 1911, month.cast("int"), day.cast("int"))
    return F.when(year.isNotNull() & month.isNotNull() & day.isNotNull(), F.try_to_date(text, "yyyy-MM-dd"))


def date_markers(text: Column) -> Column:
    """All date markers of a text, in order: ``raw, year, month, day, iso, status, start, end``.

    Invalid dates are kept with a null ``iso`` and status ``invalid``. The
    half-open offsets count code points; Spark gives none for matches, so the
    text is cut at each match and the lengths are summed.
    """
    raws = F.regexp_extract_all(text, F.lit(f"({MARKER})"), F.lit(1))
    rests = F.split(text, MARKER)
    where = F.transform(
        raws,
        lambda raw, i: F.struct(
            raw.alias("raw"),
            (
                F.aggregate(F.slice(rests, F.lit(1), i + 1), F.lit(0), lambda n, x: n + F.char_length(x))
                + F.aggregate(F.slice(raws, F.lit(1), i), F.lit(0), lambda n, x: n + F.char_length(x))
            ).alias("start"),
        ),
    )

    def fact(x: Column) -> Column:
        part = lambda k: F.regexp_extract(x["raw"], MARKER, k).cast("int")
        iso = republic_date(part(1), part(2), part(3))
        return F.struct(
            x["raw"].alias("raw"), part(1).alias("year"), part(2).alias("month"), part(3).alias("day"), iso.cast("string").alias("iso"),
            F.when(iso.isNull(), "invalid").otherwise("valid").alias("status"), x["start"].alias("start"), (x["start"] + F.char_length(x["raw"])).alias("end"),
        )

    return F.transform(where, fact)


def label_date(label: Column) -> Column:
    """Date and precision of an edition label such as ``105年1月版``: struct(value, precision), null if it has none."""
    year = F.regexp_extract(label, r"(?U)(\d{2,3})\s*年", 1)
    month = F.regexp_extract(label, r"(?U)\d{2,3}\s*年\s*(\d{1,2})\s*月", 1)
    by_year = F.format_string("%04d", F.try_to_number(F.concat(F.lit("0"), year), F.lit("9999")).cast("int") + 1911)
    by_month = F.concat(by_year, F.lit("-"), F.lpad(month, 2, "0"))
    return F.when(month != "", F.struct(by_month.alias("value"), F.lit("month").alias("precision"))).when(
        year != "", F.struct(by_year.alias("value"), F.lit("year").alias("precision"))
    )


def strict_iso_date(text: Column) -> Column:
    """struct(value, error): a strict ISO date, or ``missing`` or ``invalid``."""
    value = F.when(F.rlike(text, F.lit(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")), F.try_to_date(text, "yyyy-MM-dd"))
    error = F.when(text.isNull() | (text == ""), "missing").when(value.isNull(), "invalid")
    return F.struct(value.alias("value"), error.alias("error"))


def canonical_timestamp(ts: Column) -> Column:
    """``…Z`` in UTC, with microseconds only where they aren't zero."""
    micros = F.unix_micros(ts)
    whole = iso_seconds(F.floor(micros / 1_000_000))
    rest = F.pmod(micros, F.lit(1_000_000))
    return F.when(rest == 0, whole).otherwise(F.concat(F.regexp_replace(whole, "Z$", ""), F.lit("."), F.lpad(rest.cast("string"), 6, "0"), F.lit("Z")))


def year_partitions(first: Column, last: Column) -> Column:
    """All years from the first date to the last, as an array."""
    return F.sequence(F.year(first), F.year(last))
