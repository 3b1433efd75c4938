"""Tagging of texts with a term dictionary at exact offsets."""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.text import fold_alias

# The better of two statuses of one span comes first.
RANK = {"admitted": 0, "candidate": 1, "blocked": 2}
#: Aliases of a dictionary that goes to the workers whole.
LARGEST_DICTIONARY = 1_000_000


def _folded(text: str) -> tuple[str, list[int]]:
    """Folded text, and for each of its characters the source character."""
    parts = [fold_alias(c) for c in text]
    return "".join(parts), [i for i, p in enumerate(parts) for _ in p]


def _is_word(char: str) -> bool:
    return char.isascii() and char.isalnum()


class Dictionary:
    """All aliases in one automaton; a text is scanned once for all of them."""

    def __init__(self, aliases: list[dict]):
        self.automaton = ahocorasick.Automaton()
        by_key = defaultdict(list)
        for alias in aliases:
            by_key[fold_alias(alias["alias_text"])].append(alias)
        for key, own in by_key.items():
            self.automaton.add_word(key, (key, own))
        if by_key:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[dict]:
        """Every occurrence of every alias, overlapping ones too, at token boundaries and whole source characters."""
        if not len(self.automaton) or not text:
            return []
        folded, source = _folded(text)
        found = []
        for last, (key, own) in self.automaton.iter(folded):
            first, after = last - len(key) + 1, last + 1
            if _is_word(key[0]) and first and _is_word(folded[first - 1]):
                continue
            if _is_word(key[-1]) and after < len(folded) and _is_word(folded[after]):
                continue
            start, end = source[first], source[last] + 1
            if fold_alias(text[start:end]) != key:
                continue  # it begins or ends inside an expanded character
            found.extend({**alias, "key": key, "start": start, "end": end} for alias in own)
        return found


def resolve(matches: list[dict]) -> list[dict]:
    """One status per concept and span.

    The best status of a concept's aliases on a span holds. A span of several
    concepts is blocked. Admitted ones are taken longest first; an alias that
    loses to an overlapping one is blocked wherever it stands in the text.
    """
    best: dict[tuple, dict] = {}
    for m in sorted(matches, key=lambda m: (RANK[m["status"]], -len(m["key"]), m["alias_id"])):
        best.setdefault((m["concept_id"], m["start"], m["end"]), {**m, "reason": m["status"]})
    spans = defaultdict(list)
    for m in best.values():
        spans[m["start"], m["end"]].append(m)
    for same in spans.values():
        if len(same) > 1:
            for m in same:
                m.update(status="blocked", reason="several_concepts")
    starts: list[int] = []
    ends: list[int] = []
    losers = set()
    admitted = [m for m in best.values() if m["status"] == "admitted"]
    for m in sorted(admitted, key=lambda m: (m["start"] - m["end"], m["start"], m["alias_id"])):
        # The kept spans are disjoint, so only the neighbours can overlap.
        i = bisect_left(starts, m["end"])
        if i and ends[i - 1] > m["start"]:
            losers.add(m["alias_id"])
        else:
            starts.insert(i, m["start"])
            ends.insert(i, m["end"])
    for m in admitted:
        if m["alias_id"] in losers:
            m.update(status="blocked", reason="overlap_lost")
    return sorted(best.values(), key=lambda m: (m["start"], m["end"], m["concept_id"], m["alias_id"]))


def highlight(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that a reader shows, as (start, end, priority): from left to right, of one start the longest, then the smallest priority; none overlap.

    This is another policy than :func:`resolve`: the leftmost span wins, not
    the longest.
    """
    shown: list[tuple[int, int, int]] = []
    for span in sorted(spans, key=lambda s: (s[0], -s[1], s[2])):
        if not shown or span[0] >= shown[-1][1]:
            shown.append(span)
    return shown


def tag_texts(blocks: DataFrame, aliases: DataFrame, *, block: str, text: str) -> DataFrame:
    """Occurrences of dictionary terms in texts.

    ``aliases`` has ``alias_id, concept_id, alias_text, status`` (``admitted``,
    ``candidate`` or ``blocked``). Result ``(block, alias_id, concept_id,
    status, reason, start, end, byte_start, byte_end, matched_text)`` with
    half-open offsets. Characters are compared by their own NFKC form, case
    folded. Null and empty texts have no occurrences. The dictionary goes to
    the workers whole and must have at most ``LARGEST_DICTIONARY`` aliases;
    the texts stay where they are read.
    """
    rows = aliases.select("alias_id", "concept_id", "alias_text", "status").where("alias_text <> ''").distinct().limit(LARGEST_DICTIONARY + 1).collect()
    if len(rows) > LARGEST_DICTIONARY:
        raise ValueError(f"the dictionary has more than {LARGEST_DICTIONARY} aliases")
    shared = blocks.sparkSession.sparkContext.broadcast([r.asDict() for r in rows])
    kind = dict(blocks.dtypes)[block]
    fields = ["alias_id", "concept_id", "status", "reason", "start", "end", "byte_start", "byte_end", "matched_text"]
    types = [pa.string()] * 4 + [pa.int32()] * 4 + [pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = Dictionary(shared.value)
        for batch in batches:
            at, out = [], {f: [] for f in fields}
            for row, body in enumerate(batch.column(1).to_pylist()):
                for m in resolve(dictionary.matches(body or "")):
                    at.append(row)
                    before, inside = len(body[: m["start"]].encode()), body[m["start"] : m["end"]]
                    m |= {"byte_start": before, "byte_end": before + len(inside.encode()), "matched_text": inside}
                    for f in fields:
                        out[f].append(m[f])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), *[pa.array(out[f], t) for f, t in zip(fields, types)]], names=["block", *fields])

    schema = f"block {kind}, " + ", ".join(f"`{f}` {'int' if t == pa.int32() else 'string'}" for f, t in zip(fields, types))
    return blocks.select(F.col(block), F.col(text)).mapInArrow(run, schema).withColumnRenamed("block", block)


def scan_receipts(blocks: DataFrame, occurrences: DataFrame, block: str) -> DataFrame:
    """Occurrence counts by status for every block, those without any included."""
    counts = occurrences.groupBy(block).agg(*[F.count_if(F.col("status") == s).alias(s) for s in RANK])
    filled = [F.coalesce(F.col(s), F.lit(0)).alias(s) for s in RANK]
    rows = blocks.select(block).distinct().join(counts, block, "left").select(block, *filled)
    return rows.withColumn("scan_status", F.when(F.col("admitted") + F.col("candidate") + F.col("blocked") > 0, "matched").otherwise("zero_match"))


def alias_status(aliases: DataFrame, allowed_abbreviations: list[str]) -> DataFrame:
    """Admission of aliases: a key of several concepts is blocked, then what needs context; unobserved ones are candidates; unlisted abbreviations blocked.

    ``aliases`` has ``alias_key, concept_id, needs_context, observed,
    is_abbreviation``; the result adds ``status`` and ``reason``.
    """
    clashes = aliases.groupBy("alias_key").agg((F.count_distinct("concept_id") > 1).alias("clash"))
    rows = aliases.join(clashes, "alias_key")
    reason = (
        F.when(F.col("clash"), "several_concepts")
        .when(F.col("needs_context"), "needs_context")
        .when(~F.col("observed"), "not_observed")
        .when(F.col("is_abbreviation") & ~F.col("alias_key").isin(allowed_abbreviations), "ambiguous_abbreviation")
        .otherwise("observed")
    )
    status = F.when(reason == "observed", "admitted").when(reason == "not_observed", "candidate").otherwise("blocked")
    return rows.withColumns({"status": status, "reason": reason}).drop("clash")


def inverted_index(documents: DataFrame, key: str, text: str) -> DataFrame:
    """Postings of a text: ``term, key, term_count, document_length`` with words, numbers and single ideographs as terms."""
    words = F.filter(F.transform(F.regexp_extract_all(F.col(text), F.lit(r"([A-Za-z]+|\p{Nd}+|[㐀-鿿])"), F.lit(1)), F.lower), lambda w: w != "")
    rows = documents.select(F.col(key), words.alias("__w")).withColumn("document_length", F.size("__w"))
    return rows.select(key, "document_length", F.explode("__w").alias("term")).groupBy("term", key, "document_length").agg(F.count("*").alias("term_count"))


def field_index(documents: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Postings over several text columns: ``term, field, key, term_count``; a null column has none."""
    words = lambda c: F.filter(F.transform(F.regexp_extract_all(F.col(c), F.lit(r"([A-Za-z]+|\p{Nd}+|[㐀-鿿])"), F.lit(1)), F.lower), lambda w: w != "")
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), words(c).alias("words")) for c in fields]))
    rows = documents.select(F.col(key), each.alias("x")).select(key, "x.field", F.explode("x.words").alias("term"))
    return rows.groupBy("term", "field", key).agg(F.count("*").alias("term_count"))


def lexicon_presence(documents: DataFrame, key: str, text: str, lexicon: Sequence[tuple[str, Sequence[str]]], codes: DataFrame, code: str) -> tuple[DataFrame, DataFrame]:
    """Which terms of a curated lexicon each text holds, and the lexicon's codes that the master list doesn't have.

    ``lexicon`` is a short list of ``(term, codes)`` kept with the caller.
    The first result is ``(key, terms, codes)`` of every text with any term,
    the arrays sorted and distinct; the second is ``(term, code)``.
    """
    entries = [F.struct(F.lit(term).alias("term"), F.array(*[F.lit(c) for c in of]).cast("array<string>").alias("codes")) for term, of in lexicon]
    held = F.filter(F.array(*entries), lambda e: F.contains(F.col(text), e["term"]))
    rows = documents.select(F.col(key), held.alias("held")).where(F.size("held") > 0)
    terms, found = F.transform("held", lambda e: e["term"]), F.flatten(F.transform("held", lambda e: e["codes"]))
    listed = documents.sparkSession.createDataFrame([(term, c) for term, of in lexicon for c in of], "term string, code string")
    unknown = listed.join(codes.select(F.col(code).alias("code")).distinct(), "code", "left_anti").select("term", "code")
    return rows.select(key, F.array_sort(F.array_distinct(terms)).alias("terms"), F.array_sort(F.array_distinct(found)).alias("codes")), unknown


def bm25(index: DataFrame, terms: list[str], key: str, documents: int, mean_length: float, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """BM25 scores of the documents that have any of the terms."""
    hits = index.where(F.col("term").isin([t.lower() for t in terms]))
    frequency = hits.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.ln(1 + (documents - F.col("df") + 0.5) / (F.col("df") + 0.5))
    tf = F.col("term_count") * (k1 + 1) / (F.col("term_count") + k1 * (1 - b + b * F.col("document_length") / mean_length))
    return hits.join(frequency, "term").groupBy(key).agg(F.sum(idf * tf).alias("score"))
