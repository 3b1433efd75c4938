"""Text normalisers and text-shape functions.

Each normaliser serves one comparison; they differ on purpose. Null in, null
out. Arrow functions are used where Spark has no Unicode normalisation.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Single-quote variants that comparisons ignore.
SINGLE_QUOTES = "'‘’‛＇"
# Markdown characters that transcript comparison drops.
MARKDOWN = "#>*_`"


def _mapped(column: Column, function: Callable[[str], object], kind: str = "string") -> Column:
    """Apply ``function`` to every distinct value of an Arrow batch."""
    arrow = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}[kind]

    def run(values: pa.Array) -> pa.Array:
        encoded = values.dictionary_encode()
        made = pa.array([None if v is None else function(v) for v in encoded.dictionary.to_pylist()], arrow)
        return made.take(encoded.indices)

    return F.arrow_udf(run, kind)(column.cast("string"))


def _no_space(text: str) -> str:
    return "".join(text.split())


def display_text(column: Column) -> Column:
    """NFC, no-break and ideographic spaces as spaces, runs of blanks as one, trimmed."""
    composed = _mapped(column, lambda t: unicodedata.normalize("NFC", t))
    return F.trim(F.regexp_replace(F.translate(composed, " 　", "  "), r"[ \t]+", " "))


def comparison_key(column: Column) -> Column:
    """NFKC, case folded, without white space: equality of text states."""
    return _mapped(column, lambda t: _no_space(unicodedata.normalize("NFKC", t).casefold()))


def semantic_key(column: Column) -> Column:
    """:func:`comparison_key` without single quotes."""
    return F.translate(comparison_key(column), SINGLE_QUOTES, "")


def transcript_key(column: Column) -> Column:
    """NFKC without white space and Markdown characters, case kept."""
    return _mapped(column, lambda t: _no_space(unicodedata.normalize("NFKC", t)).translate(dict.fromkeys(map(ord, MARKDOWN))))


def fold_alias(text: str) -> str:
    """NFKC and case folding of each character by itself; white space stays."""
    if not text:
        raise ValueError("an alias must not be empty")
    return "".join(unicodedata.normalize("NFKC", c).casefold() for c in text)


def alias_key(column: Column) -> Column:
    """:func:`fold_alias` of a column; null for empty texts."""
    return _mapped(column, lambda t: fold_alias(t) if t else None)


def designation_key(column: Column) -> Column:
    """NFKC without white space; punctuation behind a final digit dropped."""
    flat = _mapped(column, lambda t: _no_space(unicodedata.normalize("NFKC", t)))
    return F.regexp_replace(flat, r"(?<=\d)[.．、。:：]+$", "")


def reader_key(column: Column) -> Column:
    """NFKC, lower case, no white space: substring search of readers."""
    return _mapped(column, lambda t: _no_space(unicodedata.normalize("NFKC", t).lower()))


def document_number(column: Column) -> Column:
    """The one ``…第…號`` frame of a text; null if there is none or more than one."""
    flat = F.regexp_replace(column, r"\s+", "")
    frames = F.regexp_extract_all(flat, F.lit(r"([^，。；、（）()\s]*?第[0-9A-Za-z]+號)"), F.lit(1))
    return F.when(F.size(frames) == 1, F.element_at(frames, 1))


def keyword_set(column: Column, separator: str = r"[,，;；\s]+") -> Column:
    """Distinct keywords of a query text in order, trimmed and without empty ones."""
    parts = F.transform(F.split(F.trim(column), separator), lambda x: F.trim(x))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def canonical_url(column: Column) -> Column:
    """Scheme and host in lower case, no default port, no fragment, ``/`` for an empty path."""

    def tidy(url: str) -> str | None:
        from urllib.parse import urlsplit, urlunsplit

        try:
            u = urlsplit(url.strip())
            port = u.port
        except ValueError:
            return None
        if not u.scheme or not u.hostname:
            return None
        scheme = u.scheme.lower()
        host = u.hostname.lower() + (f":{port}" if port and port != {"http": 80, "https": 443}.get(scheme) else "")
        return urlunsplit((scheme, host, u.path or "/", u.query, ""))

    return _mapped(column, tidy)


def build_url(base: str, **parameters: Column) -> Column:
    """A URL with encoded query parameters, in the order given."""
    pairs = [F.concat(F.lit(name + "="), F.url_encode(value.cast("string"))) for name, value in parameters.items()]
    return F.concat(F.lit(base + "?"), F.concat_ws("&", *pairs))


def canonical_code(designation: Column) -> Column:
    """struct(code, chapter, basis, error) of a designation.

    The n-th general rule is ``0.n`` of chapter 0 and ``assigned``; a dotted
    code stands for itself under its first number and is ``official``.
    Anything else has the error ``unsupported``, null is ``missing``.
    """
    ordinal = F.regexp_extract(designation, r"^通則\s*(?:第\s*)?([0-9]{1,3})\s*[條點項]?$", 1)
    chapter = F.regexp_extract(designation, r"^([0-9]{1,2})(?:\.[0-9]{1,3})+$", 1)
    general, dotted = ordinal != "", chapter != ""
    return F.struct(
        F.when(general, F.concat(F.lit("0."), ordinal.cast("int").cast("string"))).when(dotted, designation).alias("code"),
        F.when(general, 0).when(dotted, chapter.cast("int")).alias("chapter"),
        F.when(general, "assigned").when(dotted, "official").alias("basis"),
        F.when(designation.isNull(), "missing").when(~general & ~dotted, "unsupported").alias("error"),
    )


def display_title(column: Column, colon_within: int = 36, at_most: int = 48) -> Column:
    """The first line without closing punctuation, cut at an early colon, with an ellipsis when too long."""
    line = F.trim(F.regexp_replace(F.substring_index(column, "\n", 1), r"[。；;，,、.]+$", ""))
    colon = F.regexp_instr(line, F.lit("[:：]"))
    short = F.when((colon > 1) & (colon <= colon_within), F.left(line, colon - 1)).otherwise(line)
    return F.when(F.char_length(short) > at_most, F.concat(F.left(short, F.lit(at_most)), F.lit("…"))).otherwise(short)


def tokens(column: Column) -> Column:
    """Latin words, numbers, single ideographs, other characters and runs of spaces, losslessly in order."""
    return F.regexp_extract_all(column, F.lit(r"(?U)([A-Za-z]+|\d+(?:\.\d+)?|[㐀-鿿]|\s+|[^A-Za-z\d\s㐀-鿿])"), F.lit(1))


def outline_depth(column: Column) -> Column:
    """Depth of the outline marker that leads a line: ``1.`` 1, ``(1)`` 2, ``a.`` 3 and so on; null without one."""
    # Outline marker shapes from the outermost to the innermost.
    shapes = [r"^[一二三四五六七八九十百]+、", r"^\d+(?:\.\d+)*[.、]", r"^[（(]\d+[)）]", r"^[（(][一二三四五六七八九十]+[)）]", r"^[A-Za-z][.)]", r"^[Ⅰ-Ⅻⅰ-ⅻ][.、]"]
    depth = F.lit(None).cast("int")
    for level in range(len(shapes), 0, -1):
        depth = F.when(F.rlike(column, F.lit(shapes[level - 1])), level).otherwise(depth)
    return depth


def heading_terms(text: str, stop: frozenset[str] = frozenset()) -> list[str]:
    """Search terms of a heading: long Latin words, acronyms and ideograph chunks, first spelling of each kept."""
    found, seen = [], set()
    for m in re.finditer(r"[A-Za-z][A-Za-z-]*|[㐀-鿿]{2,}", unicodedata.normalize("NFKC", text)):
        word = m[0]
        latin = word[0].isascii()
        if latin and not (len(word) >= 5 or (len(word) >= 3 and word.isupper())):
            continue
        key = word.casefold()
        if key not in seen and key not in stop:
            seen.add(key)
            found.append(word)
    return found


def heading_terms_of(column: Column) -> Column:
    """:func:`heading_terms` of a column."""
    return F.arrow_udf(
        lambda values: pa.array([None if t is None else heading_terms(t) for t in values.to_pylist()], pa.list_(pa.string())), "array<string>"
    )(column)


def chinese_integer(column: Column) -> Column:
    """The integer that Chinese or mixed numerals spell, null if they don't."""
    from palimpsest.functions.numerals import chinese_number

    return _mapped(column, chinese_number, "bigint")


def soft_wrapped(previous: Column, line: Column) -> Column:
    """Whether a physical line continues the one before: that one has no closing punctuation, this one no outline marker."""
    return ~F.rlike(previous, F.lit(r"[。；：:!?！？]\s*$")) & outline_depth(line).isNull() & (F.char_length(previous) > 0)


def media_type(content: Column) -> Column:
    """Media type of binary content by its first bytes, ``application/octet-stream`` if unknown."""
    head = F.hex(F.substring(content, 1, 8))
    # Magic numbers.
    known = {"25504446": "application/pdf", "504B0304": "application/zip", "D0CF11E0": "application/x-ole-storage", "89504E47": "image/png", "FFD8FF": "image/jpeg", "47494638": "image/gif"}
    kind = F.lit("application/octet-stream")
    for magic, name in known.items():
        kind = F.when(F.startswith(head, F.lit(magic)), name).otherwise(kind)
    return kind


def public_text(column: Column) -> Column:
    """Whether a value is safe to publish: no credentials and no absolute local path."""
    return ~F.rlike(column, F.lit(r"(?i)(?:password|passwd|secret|token|api[_-]?key)\s*[=:]|://[^/\s:@]+:[^/\s@]+@|(?:^|[\s\"'])(?:/(?:home|root|Users|var|tmp)/|[A-Z]:\\)"))
