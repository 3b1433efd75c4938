"""Texts that were cut off before they ended, and how often each source cuts.

Discrete length hazards per source (in characters and in bytes) are tested
against the neighbouring hazards with false-discovery control; a text of a
significant length whose ending isn't complete is truncated. Cuts in
mid-transfer have no length of their own: for them the shape of the last line,
and how lines that begin like it end elsewhere, must show a sentence that was
left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.runtime import discard, materialize

#: Neighbouring lengths on each side that a length is tested against, and the nearest ones that are left out (a
#: limit in bytes that cuts no character apart stops up to three bytes short).
NEIGHBOURS, NEAREST = 20, 3
#: False discoveries among the significant lengths.
FALSE_DISCOVERIES = 0.01
#: Characters that one step of the search for the stop reads, and as many more as one piece behind a cut has.
WINDOW, PIECE = 128, 64
#: Lines with the same opener that are needed to know how such lines end, and the share that says so.
KNOWN, SURE = 10, 0.9
#: Share of the finished texts that are shorter than any text that is tested as a bare line.
SHORTEST = 0.01

# Blanks and characters without any mark, which may follow an ending.
BLANK = " \t\r\n\u000b\f\u0085 ­            ​‌‍‎‏  ‪‫‬‭‮  ⁠　﻿"
# Notations of the calendar.
MONTH = r"(?:January|February|March|April|May|June|July|August|September|October|November|December)"

TAG = r"</?[A-Za-z][A-Za-z0-9]*(?:\s[^<>]*)?/?>"
#: What may stand behind a cut without belonging to the text: markup, also half of it, entities, dots, an open bracket, replacement characters, ornaments, blanks.
BEHIND = (
    rf"(?:{TAG}|</?(?:[A-Za-z][A-Za-z0-9]*(?:\s+[A-Za-z-]*|\s[^<>]*=[^<>]*)?)?$|&#?[A-Za-z0-9]{{0,8}};?|[…⋯]|\.{{3,}}|[（(\[【<]"
    r"|[\x{FFFD}\p{So}\p{Cf}\p{Cs}]|[\s\x{3000}])+$"
)
CLOSERS = r"[」』”’\"'）)】》\]]*"
#: The end of a sentence.
SENTENCE = rf"(?:[。！？!?｡．]|[^\W\d_][）)\]”’\"']*\.|[%°]\.){CLOSERS}"
#: Letters between brackets or dashes, alone on the line or behind a finished sentence.
END_MARK = rf"(?:^|{SENTENCE}\s*)[－—–\-=*【\[（(〔]\s*\p{{L}}[\p{{L}} ]*[－—–\-=*】\]）)〕]$"
DATE_LINE = (
    rf"^(?:(?:中華民國|民國)?\s*\d{{2,4}}\s*年\s*\d{{1,2}}\s*月\s*\d{{1,2}}\s*日|\d{{2,4}}[/\-]\d{{1,2}}[/\-]\d{{1,2}}|\d{{1,2}} {MONTH} \d{{4}}|{MONTH} \d{{1,2}}, \d{{4}})"
    r"(?:[ T]\d{1,2}:\d{2}(?::\d{2})?)?$"
)
#: A sentence and more of the line behind it.
BEHIND_SENTENCE = r"[。！？!?｡]|\p{L}\.\s"
#: Marks between the clauses of a sentence.
CLAUSE = r"[，；、,;]"
#: Lines of code, tables and addresses are no sentences.
NO_SENTENCE = r"[|;{}]$|^\S*://\S*$"
#: A numbered or marked entry.
ENTRY = r"^(?:\d{1,3}(?:\.\s|[)、])|[（(]?[一二三四五六七八九十]{1,3}[）)、]|[-*•●]\s)"
LABEL = r"^[^\s:：]+(?: [^\s:：]+){0,2}\s?[:：]\s*[\p{L}\p{N}]"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _strip(part: Column) -> Column:
    return F.regexp_replace(part, F.lit(BEHIND), F.lit(""))


def _long_stop(bare: Column) -> Column:
    """A text up to its stop where more stands behind it than one window holds.

    Closed tags and runs of dots are one ornament each, however long they are;
    then window after window is stripped, from the end. A piece that a
    window's start cuts stays for the next one.
    """
    before = lambda kept: F.greatest(kept - WINDOW, F.lit(0))

    def ahead(whole: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            left = F.char_length(_strip(F.substring(whole, before(at["kept"]) + 1, at["kept"] - before(at["kept"]))))
            return F.when(at["done"], at).otherwise(
                _let(left, lambda n: F.struct((before(at["kept"]) + n).alias("kept"), ((n >= PIECE) | (at["kept"] <= WINDOW)).alias("done")))
            )

        start = F.struct(F.char_length(whole).alias("kept"), F.lit(False).alias("done"))
        rounds = F.sequence(F.lit(1), F.ceil(F.char_length(whole) / (WINDOW - PIECE)).cast("int") + 1)
        return F.substring(whole, F.lit(1), F.aggregate(rounds, start, step)["kept"])

    return _let(F.regexp_replace(F.regexp_replace(bare, F.lit(TAG), F.lit("★")), F.lit(r"\.{3,}"), F.lit("…")), ahead)


def _stopped(bare: Column) -> Column:
    """The text up to its stop, without all that stands behind it."""

    def near(end: Column) -> Column:
        # A tag that begins before the window would be taken for text.
        open_tag = F.endswith(end, F.lit(">")) & ~F.contains(end, F.lit("<"))
        whole = F.char_length(bare) <= WINDOW
        kept = F.char_length(bare) - F.least(F.char_length(bare), F.lit(WINDOW)) + F.char_length(end)
        return F.when(whole | ((F.char_length(end) >= PIECE) & ~open_tag), F.substring(bare, F.lit(1), kept)).otherwise(_long_stop(bare))

    return _let(_strip(F.right(bare, F.lit(WINDOW))), near)


def opener(line: Column) -> Column:
    """How a line begins: its first three characters, a number counting as one."""
    return F.left(F.regexp_replace(F.left(line, F.lit(24)), F.lit(r"\d+"), F.lit("0")), F.lit(3))


def _shape(text: Column, bare: Column, stop: Column, line: Column) -> Column:
    ends = lambda rule: F.rlike(line, F.lit(rule))
    single = ~F.contains(F.call_function("ltrim", F.lit(BLANK), stop), F.lit("\n"))
    state = (
        F.when(text.isNull() | (bare == ""), None)
        # Nothing but ornaments and markup is no sentence.
        .when((stop == "") | F.rlike(F.right(stop, F.lit(16)), F.lit(SENTENCE + "$")) | ends(END_MARK) | ends(DATE_LINE), "finished")
        .when(ends(NO_SENTENCE), "other")
        .when(ends(BEHIND_SENTENCE) | ends(f"{CLAUSE}.*{CLAUSE}"), "sentence")
        .when(ends(CLAUSE), "clause")
        .when(ends(LABEL), "label")
        .when(ends(ENTRY), "entry")
        .when(single, "title")
        .otherwise("line")
    )
    return F.struct(state.alias("shape"), opener(line).alias("opener"))


def ending_shape(text: Column) -> Column:
    """``(shape, opener)`` of a text's last line, as it stands before whatever follows the stop.

    ``finished``: a sentence end, an end mark or a date line (or ornaments
    alone). ``sentence``: an unfinished line that holds a sentence end or two
    clause marks. ``clause``: one clause mark. ``label``: a label and its
    value. ``entry``: a list entry. ``title``: the whole text is one line without any such mark.
    ``other``: code, table rows, addresses. ``line``: any other line. Null
    for a null, empty or blank text.
    """
    line = lambda stop: F.call_function("trim", F.lit(BLANK), F.substring_index(stop, "\n", -1))
    return _let(
        F.call_function("rtrim", F.lit(BLANK), text),
        lambda bare: _let(_stopped(bare), lambda stop: _let(line(stop), lambda last: _shape(text, bare, stop, last))),
    )


def line_openers(text: Column) -> Column:
    """Opener of every line of a text, and whether the line ends as a sentence."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.call_function("trim", F.lit(BLANK), x))
    lines = F.filter(lines, lambda x: x != "")
    return F.transform(lines, lambda x: F.struct(opener(x).alias("opener"), F.rlike(F.right(x, F.lit(16)), F.lit(SENTENCE + "$")).alias("sentence")))


def opener_habits(openers: DataFrame) -> DataFrame:
    """``(prefix, n, sentences)``: how lines of the corpus that begin alike end, for the first one, two and three characters.

    ``openers`` has one row per line: ``opener`` and ``sentence``.
    """
    counts = openers.groupBy("opener").agg(F.count("*").alias("n"), F.count_if("sentence").alias("s"))
    prefixes = F.explode(F.array_distinct(F.array(*[F.left("opener", F.lit(k)) for k in (1, 2, 3)]))).alias("prefix")
    return counts.select(prefixes, "n", "s").groupBy("prefix").agg(F.sum("n").alias("n"), F.sum("s").alias("sentences")).where(f"n > {KNOWN}")


def significant_lengths(rows: DataFrame) -> DataFrame:
    """Lengths at which a source stops far more often than at the lengths around.

    ``rows`` has ``source``, ``chars`` and ``bytes``. Result ``(source, unit,
    length, n, hazard, expected, p)``. The hazard of a length is the share of
    the texts of at least this length that have just this one. ``expected`` is
    the mean hazard of the lengths that occur among the ``NEIGHBOURS`` on
    either side (each weighed by its number at risk) times the number at risk;
    ``n`` is tested against it by a Chernoff bound of the Poisson tail.
    Benjamini-Hochberg keeps the false discoveries under
    ``FALSE_DISCOVERIES``; its ranks come from counts over p-value bins, whose
    number doesn't grow with the data.
    """
    units = F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("length")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("length"))))
    counts = rows.select("source", units.alias("u")).select("source", "u.*").groupBy("source", "unit", "length").agg(F.count("*").alias("n"))
    by = Window.partitionBy("source", "unit").orderBy("length")
    counts = counts.withColumn("at_risk", F.sum("n").over(by.rowsBetween(0, Window.unboundedFollowing)))
    ring = lambda what: F.coalesce(what.over(by.rangeBetween(-NEIGHBOURS, NEIGHBOURS)) - what.over(by.rangeBetween(-NEAREST, NEAREST)), F.lit(0))
    # Only lengths that occur count as neighbours: texts of three-byte characters alone leave two of three lengths in bytes empty.
    counts = counts.withColumn("stopped", ring(F.sum("n")) + 0.5).withColumn("passed", ring(F.sum("at_risk")))
    expected = F.when(F.col("passed") > 0, F.col("stopped") / F.col("passed") * F.col("at_risk")).otherwise(F.col("stopped"))
    tests = counts.select("source", "unit", "length", "n", (F.col("n") / F.col("at_risk")).alias("hazard"), expected.alias("expected"))
    tail = F.when(F.col("n") <= F.col("expected"), 0.0).otherwise(F.col("n") - F.col("expected") + F.col("n") * F.ln(F.col("expected") / F.col("n")))
    tests = tests.withColumn("log_p", F.least(tail, F.lit(0.0)))
    tests = tests.withColumn("bin", F.greatest(F.ceil(F.col("log_p") * 20), F.lit(-20000)))
    bins = tests.groupBy("bin").agg(F.count("*").alias("m"))
    upto = F.sum("m").over(Window.orderBy("bin"))
    total = F.sum("m").over(Window.partitionBy())
    passed = bins.select("bin", upto.alias("rank"), total.alias("total")).where(F.col("bin") / 20 <= F.ln(FALSE_DISCOVERIES * F.col("rank") / F.col("total")))
    limit = passed.agg(F.max("bin").alias("limit"))
    return tests.join(F.broadcast(limit), F.col("bin") <= F.col("limit")).select("source", "unit", "length", "n", "hazard", "expected", F.exp("log_p").alias("p"))


def find_truncated(documents: DataFrame, *, key: str, text: str, source: str) -> tuple[DataFrame, DataFrame]:
    """Truncated documents, and the significant lengths.

    The first result is ``(key, source, ending, at_limit, truncated, cut_by)``
    of every row with a text that isn't blank. ``ending`` is ``finished``,
    ``broken`` (a sentence that was left) or ``open`` (neither is certain);
    ``at_limit`` says that the length in characters or bytes is significant
    for the source. Truncated are the endings at a significant length that
    aren't finished (``cut_by`` is ``limit``), and the broken ones at any
    other length (``transfer``).

    A line is broken if it shows a sentence by itself, or if at least the
    share ``SURE`` of all lines of the corpus that begin like it end as
    sentences; a label whose like ends otherwise as often is finished. List
    entries, and texts of one bare line shorter than nearly all finished
    texts, have like lengths by themselves and take no part in the length
    test, which still decides them. Null sources are a source of their own;
    repeated rows stay repeated.
    """
    rows = documents.select(
        F.col(key).alias("__key"),
        F.coalesce(F.col(source), F.lit("")).alias("source"),
        F.char_length(text).cast("long").alias("chars"),
        F.octet_length(text).cast("long").alias("bytes"),
        ending_shape(F.col(text)).alias("end"),
        line_openers(F.col(text)).alias("lines"),
    ).where("end.shape is not null")
    # The texts are read once; what is left of a document are its lengths, its ending and the openers of its lines.
    rows = written = materialize(rows.select("__key", "source", "chars", "bytes", "end.*", "lines"), "endings")
    habits = opener_habits(rows.select(F.explode("lines").alias("x")).select("x.*"))
    done = rows.where("shape = 'finished'").select("__key", "source", "chars", "bytes", F.lit("finished").alias("ending"), F.lit(False).alias("alike"))
    left = rows.where("shape <> 'finished'").drop("lines")
    for k in (1, 2, 3):
        of = habits.select(F.col("prefix").alias(f"p{k}"), (F.col("sentences") / (F.col("n") - 1)).alias(f"share{k}"))
        left = left.withColumn(f"p{k}", F.left("opener", F.lit(k))).join(of, f"p{k}", "left")
    # The text's own line counts for nothing; the longest known opener holds.
    share = F.coalesce("share3", "share2", "share1")
    ending = (
        F.when(F.col("shape") == "sentence", "broken")
        .when((F.col("shape") == "label") & (share <= round(1 - SURE, 9)), "finished")
        .when(F.col("shape").isin("clause", "label", "entry", "line") & (share >= SURE), "broken")
        .otherwise("open")
    )
    shortest = done.agg(F.percentile("chars", F.lit(SHORTEST)).alias("shortest"))
    alike = (F.col("shape") == "entry") | F.coalesce((F.col("shape") == "title") & (F.col("chars") < F.col("shortest")), F.lit(False))
    left = left.join(F.broadcast(shortest)).select("__key", "source", "chars", "bytes", ending.alias("ending"), alike.alias("alike"))
    rows = materialize(done.unionByName(left), "ends")
    discard(written)
    limits = significant_lengths(rows.where("ending = 'finished' or not alike"))
    # A few lengths per source; each side of the join is one row per length and source.
    one = limits.select("source", "unit", F.col("length"), F.lit(True).alias("hit"))
    by_chars = one.where("unit = 'chars'").select("source", F.col("length").alias("chars"), F.col("hit").alias("hit_chars"))
    by_bytes = one.where("unit = 'bytes'").select("source", F.col("length").alias("bytes"), F.col("hit").alias("hit_bytes"))
    marked = rows.join(by_chars, ["source", "chars"], "left").join(by_bytes, ["source", "bytes"], "left")
    at_limit = F.col("hit_chars").isNotNull() | F.col("hit_bytes").isNotNull()
    cut_by = F.when((F.col("ending") != "finished") & at_limit, "limit").when(F.col("ending") == "broken", "transfer")
    return marked.select(F.col("__key").alias(key), "source", "ending", at_limit.alias("at_limit"), cut_by.isNotNull().alias("truncated"), cut_by.alias("cut_by")), limits
