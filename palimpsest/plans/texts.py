"""Queries of text functions, dates, ids, diffs, tagging and grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.functions import dates, ids, text
from palimpsest.operators import diff, grids, parity, tagging
from palimpsest.operators.timestamps import utc_start
from palimpsest.runtime import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return add


def _expressions(spark, sf_dir, *columns):
    return table(spark, sf_dir, "clause_document_expression").select(*columns).distinct()


def _hunks(spark, sf_dir, *columns):
    return table(spark, sf_dir, "clause_document_diff_hunk").select(*columns).distinct()


@query()
def f02_comparison_states(spark, sf_dir):
    """Texts that are equal under the comparison key, counted by key."""
    rows = _expressions(spark, sf_dir, "exact_text")
    return rows.groupBy(F.sha2(text.comparison_key(F.col("exact_text")), 256).alias("comparison_sha256")).agg(F.count("*").alias("texts"))


@query()
def f01_normalizers(spark, sf_dir):
    """All normalisers of the block texts."""
    t = F.col("raw_text")
    rows = table(spark, sf_dir, "current_clause_block").select("source_block_id", "raw_text").distinct()
    return rows.select(
        "source_block_id", text.display_text(t).alias("display"), text.comparison_key(t).alias("comparison"), text.semantic_key(t).alias("semantic"),
        text.alias_key(t).alias("alias"), text.transcript_key(t).alias("transcript"), text.designation_key(t).alias("designation"), text.reader_key(t).alias("reader"),
    )


@query("""SELECT event_id, regexp_extract(reference_number, '第([0-9A-Za-z]+)號', 1) AS number, CASE WHEN len(regexp_extract_all(reference_number, '第[0-9A-Za-z]+號')) = 1 THEN reference_number END AS frame
FROM (SELECT DISTINCT event_id, reference_number FROM official_event)""")
def f10_document_number(spark, sf_dir):
    """The one document number of a notice, isolated or null."""
    rows = table(spark, sf_dir, "official_event").select("event_id", "reference_number").distinct()
    return rows.select("event_id", F.regexp_extract("reference_number", "第([0-9A-Za-z]+)號", 1).alias("number"), text.document_number(F.col("reference_number")).alias("frame"))


@query("""SELECT expression_id, sha256('clause' || chr(31) || clause_work_id || chr(31) || source_edition_version_id) AS stable_id FROM (SELECT DISTINCT expression_id, clause_work_id, source_edition_version_id FROM clause_document_expression)""")
def f17_stable_ids(spark, sf_dir):
    """Content-derived ids over namespaced parts."""
    rows = _expressions(spark, sf_dir, "expression_id", "clause_work_id", "source_edition_version_id")
    return rows.select("expression_id", ids.stable_id("clause", F.col("clause_work_id"), F.col("source_edition_version_id")).alias("stable_id"))


@query("""WITH h AS (SELECT event_id, sha256('event' || chr(10) || event_id) AS h FROM (SELECT DISTINCT event_id FROM official_event))
SELECT event_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-8' || substr(h, 14, 3) || '-' || substr('89ab', CAST(instr('0123456789abcdef', substr(h, 17, 1)) - 1 AS INT) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uuid FROM h""")
def f19_uuid_v8(spark, sf_dir):
    """UUIDs of version 8 from a hash."""
    rows = table(spark, sf_dir, "official_event").select("event_id").distinct()
    return rows.select("event_id", ids.uuid_v8("event", F.col("event_id")).alias("uuid"))


@query("""WITH h AS (SELECT event_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(event_id)) AS h FROM (SELECT DISTINCT event_id FROM official_event))
SELECT event_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST(instr('0123456789abcdef', substr(h, 17, 1)) - 1 AS INT) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uuid FROM h""")
def f18_uuid_v5(spark, sf_dir):
    """Name-based UUIDs."""
    rows = table(spark, sf_dir, "official_event").select("event_id").distinct()
    return rows.select("event_id", ids.uuid_v5("6ba7b811-9dad-11d1-80b4-00c04fd430c8", F.col("event_id")).alias("uuid"))


@query("""WITH r AS (SELECT DISTINCT n_nationkey, n_name, n_regionkey FROM nation), h AS (SELECT n_regionkey, sha256('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}' || chr(10)) AS h FROM r)
SELECT n_regionkey, sha256(string_agg(h || chr(10), '' ORDER BY h)) AS fingerprint, count(*) AS row_count FROM h GROUP BY 1""")
def a20_row_set_fingerprint(spark, sf_dir):
    """Order-independent fingerprints of the nations of each region."""
    return ids.row_set_fingerprint(table(spark, sf_dir, "nation"), ["n_nationkey", "n_name", "n_regionkey"], ("n_regionkey",))


@query("""WITH r AS (SELECT DISTINCT n_nationkey, n_name, n_regionkey FROM nation), h AS (SELECT n_regionkey, sha256('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}') AS h FROM r)
SELECT n_regionkey, sha256(string_agg(h, chr(10) ORDER BY h)) AS fingerprint, count(*) AS row_count FROM h GROUP BY 1""")
def a21_portable_fingerprint(spark, sf_dir):
    """The portable variant of the fingerprint."""
    return ids.portable_fingerprint(table(spark, sf_dir, "nation"), ["n_nationkey", "n_name", "n_regionkey"], ("n_regionkey",))


_EXPRESSION = ["expression_id", "clause_work_id", "source_edition_version_id", "exact_text"]
_EXPRESSION_ROW = """'{"clause_work_id":' || to_json(clause_work_id) || ',"exact_text":' || to_json(exact_text) || ',"expression_id":' || to_json(expression_id) || ',"source_edition_version_id":' || to_json(source_edition_version_id) || '}'"""


@query(f"""WITH h AS (SELECT source_edition_version_id, sha256({_EXPRESSION_ROW} || chr(10)) AS h FROM clause_document_expression)
SELECT source_edition_version_id, sha256(string_agg(h || chr(10), '' ORDER BY h)) AS fingerprint, count(*) AS row_count FROM h GROUP BY 1""")
def a20_edition_fingerprints(spark, sf_dir):
    """Order-independent fingerprints of the clause texts of each edition."""
    return ids.row_set_fingerprint(table(spark, sf_dir, "clause_document_expression"), _EXPRESSION, ("source_edition_version_id",))


@query(f"""WITH h AS (SELECT source_edition_version_id, sha256({_EXPRESSION_ROW}) AS h FROM clause_document_expression)
SELECT source_edition_version_id, sha256(string_agg(h, chr(10) ORDER BY h)) AS fingerprint, count(*) AS row_count FROM h GROUP BY 1""")
def a21_edition_fingerprints(spark, sf_dir):
    """The portable variant of the fingerprints by edition."""
    return ids.portable_fingerprint(table(spark, sf_dir, "clause_document_expression"), _EXPRESSION, ("source_edition_version_id",))


@query()
def a22_table_fingerprints(spark, sf_dir):
    """Fingerprints of whole tables that combine map-side."""
    made = None
    for name in ("orders", "lineitem", "official_event", "clause_version_edge"):
        row = ids.row_sum_fingerprint(table(spark, sf_dir, name)).select(F.lit(name).alias("table_name"), F.col("fingerprint").cast("string").alias("fingerprint"), "row_count")
        made = row if made is None else made.unionByName(row)
    return made


@query("""WITH m AS (SELECT DISTINCT expression_id, unnest(regexp_extract_all(exact_text, '（[0-9]{2,3}/[0-9]{1,2}/[0-9]{1,2}）')) AS raw FROM (SELECT DISTINCT expression_id, exact_text FROM clause_document_expression)),
d AS (SELECT expression_id, raw, CAST(regexp_extract(raw, '([0-9]+)/([0-9]+)/([0-9]+)', 1) AS INT) + 1911 AS y, CAST(regexp_extract(raw, '([0-9]+)/([0-9]+)/([0-9]+)', 2) AS INT) AS mo, CAST(regexp_extract(raw, '([0-9]+)/([0-9]+)/([0-9]+)', 3) AS INT) AS da FROM m)
SELECT expression_id, raw, CAST(try_cast(printf('%04d-%02d-%02d', y, mo, da) AS DATE) AS VARCHAR) AS iso FROM d""")
def d01_bracketed_dates(spark, sf_dir):
    """Dates of the Republic in brackets, as ISO dates; invalid ones stay with a null."""
    rows = _expressions(spark, sf_dir, "expression_id", "exact_text")
    raws = rows.select("expression_id", F.explode(F.regexp_extract_all("exact_text", F.lit("(（[0-9]{2,3}/[0-9]{1,2}/[0-9]{1,2}）)"), F.lit(1))).alias("raw")).distinct()
    part = lambda k: F.regexp_extract("raw", "([0-9]+)/([0-9]+)/([0-9]+)", k).cast("int")
    return raws.select("expression_id", "raw", dates.republic_date(part(1), part(2), part(3)).cast("string").alias("iso"))


@query(r"""WITH e AS (SELECT DISTINCT expression_id, exact_text AS t FROM clause_document_expression),
x AS (SELECT expression_id, t, string_split_regex(t, '[0-9]{2,3}[ \t]*[/／][ \t]*[0-9]{1,2}[ \t]*[/／][ \t]*[0-9]{1,2}') AS p, regexp_extract_all(t, '[0-9]{2,3}[ \t]*[/／][ \t]*[0-9]{1,2}[ \t]*[/／][ \t]*[0-9]{1,2}') AS r FROM e),
y AS (SELECT expression_id, t, generate_subscripts(r, 1) AS i, unnest(r) AS raw, p, r FROM x),
z AS (SELECT expression_id, t, i, raw, list_sum(list_transform(p[:i], lambda q: length(q))) + coalesce(list_sum(list_transform(r[:i - 1], lambda q: length(q))), 0) AS a FROM y),
k AS (SELECT expression_id, raw, CAST(a AS INT) AS a, i, string_split_regex(raw, '[ \t]*[/／][ \t]*') AS d FROM z WHERE NOT regexp_matches(substring(t, CAST(a AS INT), CASE WHEN a = 0 THEN 0 ELSE 1 END), '[0-9]') AND NOT regexp_matches(substring(t, CAST(a AS INT) + length(raw) + 1, 1), '[0-9]')),
v AS (SELECT *, CAST(d[1] AS INT) AS year, CAST(d[2] AS INT) AS month, CAST(d[3] AS INT) AS day, try_cast(printf('%04d-%02d-%02d', CAST(d[1] AS INT) + 1911, CAST(d[2] AS INT), CAST(d[3] AS INT)) AS DATE) AS iso FROM k)
SELECT expression_id, CAST(row_number() OVER (PARTITION BY expression_id ORDER BY i) - 1 AS INT) AS ordinal, raw, year, month, day, CAST(iso AS VARCHAR) AS iso, CASE WHEN iso IS NULL THEN 'invalid' ELSE 'valid' END AS status, a AS "start", a + length(raw) AS "end" FROM v""")
def d03_date_markers(spark, sf_dir):
    """All date markers of the texts with offsets, ordinal, ISO date and status."""
    rows = _expressions(spark, sf_dir, "expression_id", "exact_text")
    found = rows.select("expression_id", F.posexplode(dates.date_markers(F.col("exact_text"))).alias("ordinal", "m"))
    return found.select("expression_id", "ordinal", "m.*")


@query("""SELECT source_edition_version_id, any_value(CAST(CAST(regexp_extract(edition_label, '([0-9]+)年', 1) AS INT) + 1911 AS VARCHAR) || '-' || lpad(regexp_extract(edition_label, '年([0-9]+)月', 1), 2, '0')) AS value FROM source_edition
WHERE regexp_matches(edition_label, '[0-9]{2,3}年[0-9]+月') GROUP BY 1""")
def d04_label_dates(spark, sf_dir):
    """Month of an edition from its label."""
    rows = table(spark, sf_dir, "source_edition").select("source_edition_version_id", "edition_label").distinct()
    return rows.select("source_edition_version_id", dates.label_date(F.col("edition_label"))["value"].alias("value")).where("value is not null")


@query("""SELECT event_id, CAST(CASE WHEN regexp_full_match(effective_from, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN try_cast(effective_from AS DATE) END AS VARCHAR) AS value,
CASE WHEN effective_from IS NULL OR effective_from = '' THEN 'missing' WHEN NOT regexp_full_match(effective_from, '[0-9]{4}-[0-9]{2}-[0-9]{2}') OR try_cast(effective_from AS DATE) IS NULL THEN 'invalid' END AS error FROM (SELECT DISTINCT event_id, effective_from FROM official_event)""")
def d06_strict_dates(spark, sf_dir):
    """Strict ISO dates with an error code."""
    rows = table(spark, sf_dir, "official_event").select("event_id", "effective_from").distinct()
    d = dates.strict_iso_date(F.col("effective_from"))
    return rows.select("event_id", d["value"].cast("string").alias("value"), d["error"].alias("error"))


@query("SELECT expression_id, CASE WHEN microsecond(recorded_at) % 1000000 = 0 THEN strftime(recorded_at, '%Y-%m-%dT%H:%M:%SZ') ELSE strftime(recorded_at, '%Y-%m-%dT%H:%M:%S.%fZ') END AS recorded FROM clause_document_expression")
def d08_canonical_timestamps(spark, sf_dir):
    """Canonical UTC timestamps, with microseconds where there are any."""
    rows = table(spark, sf_dir, "clause_document_expression")
    return rows.select("expression_id", dates.canonical_timestamp(F.col("recorded_at")).alias("recorded"))


@query("""WITH y AS (SELECT unnest(generate_series((SELECT min(year(o_orderdate)) FROM orders), (SELECT max(year(o_orderdate)) FROM orders))) AS y), o AS (SELECT DISTINCT o_custkey AS k, year(o_orderdate) AS y FROM orders)
SELECT c.k AS o_custkey, string_agg(CAST(y.y AS VARCHAR), ',' ORDER BY y.y) AS missing_years FROM (SELECT DISTINCT k FROM o) c CROSS JOIN y WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.k = c.k AND o.y = y.y) GROUP BY 1""")
def d09_missing_years(spark, sf_dir):
    """Years of the whole period in which a customer has no order."""
    orders = table(spark, sf_dir, "orders")
    # One row: the years of the period.
    period = orders.agg(dates.year_partitions(F.min("o_orderdate"), F.max("o_orderdate")).alias("every"))
    own = orders.groupBy("o_custkey").agg(F.collect_set(F.year("o_orderdate")).alias("own"))
    lacking = parity.set_difference(own.crossJoin(F.broadcast(period)), "every", "own")
    return lacking.where(F.size("left_only") > 0).select("o_custkey", F.array_join("left_only", ",").alias("missing_years"))


@query()
def x05_exact_segments(spark, sf_dir):
    """Character segments of replaced hunks with offsets; joined they give back both texts."""
    rows = _hunks(spark, sf_dir, "hunk_id", "old_exact_text", "new_exact_text").where("old_exact_text is not null and new_exact_text is not null")
    found = rows.select("hunk_id", F.posexplode(diff.exact_diff(F.col("old_exact_text"), F.col("new_exact_text"))).alias("segment_order", "s"))
    return found.select("hunk_id", "segment_order", "s.*")


@query()
def x03_semantic_diff(spark, sf_dir):
    """What each hunk changes in substance, and which form changes it ignores."""
    rows = _hunks(spark, sf_dir, "hunk_id", "old_exact_text", "new_exact_text")
    found = rows.select("hunk_id", diff.semantic_diff(F.col("old_exact_text"), F.col("new_exact_text")).alias("d"))
    return found.select("hunk_id", "d.change_kind", F.array_join("d.ignored_classes", ",").alias("ignored_classes"), F.size("d.segments").alias("segments"))


@query()
def x02_token_diff(spark, sf_dir):
    """Token segments of the hunks."""
    rows = _hunks(spark, sf_dir, "hunk_id", "old_exact_text", "new_exact_text")
    found = rows.select("hunk_id", F.posexplode(diff.token_diff(F.col("old_exact_text"), F.col("new_exact_text"))).alias("segment_order", "s"))
    return found.select("hunk_id", "segment_order", "s.*")


@query()
def x01_block_hunks(spark, sf_dir):
    """Changed paragraphs between the texts of each edge's older and newer version."""
    seen = table(spark, sf_dir, "clause_document_expression").where("source_version_id is not null").groupBy(F.col("source_version_id").alias("v")).agg(F.min("exact_text").alias("t"))
    blocks = F.split("t", "\n\n")
    edges = table(spark, sf_dir, "clause_version_edge").select("edge_id", F.col("older_clause_version_id").alias("o"), F.col("newer_clause_version_id").alias("n")).distinct()
    pairs = edges.join(seen.select(F.col("v").alias("o"), blocks.alias("old_blocks")), "o").join(seen.select(F.col("v").alias("n"), blocks.alias("new_blocks")), "n")
    return diff.block_hunks(pairs, "edge_id", "old_blocks", "new_blocks", lambda t: "".join(t.split()))


@query("""WITH b AS (SELECT DISTINCT run_id, clause_code, source_block_id, raw_text, block_kind FROM current_clause_block), o AS (SELECT * FROM b WHERE block_kind = 'paragraph'), n AS (SELECT * FROM b WHERE block_kind <> 'paragraph'),
ou AS (SELECT clause_code, raw_text, any_value(source_block_id) AS i FROM o GROUP BY 1, 2 HAVING count(*) = 1), nu AS (SELECT clause_code, raw_text, any_value(source_block_id) AS i FROM n GROUP BY 1, 2 HAVING count(*) = 1),
m AS (SELECT ou.clause_code, ou.i AS old_id, nu.i AS new_id FROM ou JOIN nu USING (clause_code, raw_text))
SELECT clause_code, old_id, new_id, 0 AS stage FROM m UNION ALL SELECT clause_code, source_block_id, NULL, NULL FROM o WHERE source_block_id NOT IN (SELECT old_id FROM m) UNION ALL SELECT clause_code, NULL, source_block_id, NULL FROM n WHERE source_block_id NOT IN (SELECT new_id FROM m)""")
def x06_unique_alignment(spark, sf_dir):
    """Paragraphs matched to list items and cells of the same code where a text is unique on both sides."""
    rows = table(spark, sf_dir, "current_clause_block").select("clause_code", "source_block_id", "raw_text", "block_kind").distinct()
    is_paragraph = F.col("block_kind") == "paragraph"
    return diff.unique_matches(rows.where(is_paragraph), rows.where(~is_paragraph), ["clause_code"], "source_block_id", "source_block_id", ["raw_text"])


_HUNK_TEXTS = "h AS (SELECT DISTINCT hunk_id, coalesce(old_exact_text, '') AS o, coalesce(new_exact_text, '') AS n FROM clause_document_diff_hunk)"


@query(f"""WITH {_HUNK_TEXTS}, s AS (SELECT DISTINCT hunk_id, segment_order, old_text, new_text FROM clause_document_inline_diff_segment WHERE segment_kind <> 'deleted'),
r AS (SELECT hunk_id, string_agg(coalesce(old_text, ''), '' ORDER BY segment_order) AS o, string_agg(coalesce(new_text, ''), '' ORDER BY segment_order) AS n FROM s GROUP BY 1)
SELECT h.hunk_id, CASE WHEN r.hunk_id IS NULL THEN 'no_segments' WHEN h.o <> r.o AND h.n <> r.n THEN 'both_texts' WHEN h.o <> r.o THEN 'old_text' ELSE 'new_text' END AS problem
FROM h LEFT JOIN r USING (hunk_id) WHERE r.hunk_id IS NULL OR h.o <> r.o OR h.n <> r.n""")
def x13_replay_gate(spark, sf_dir):
    """Hunks without segments, and those that their segments, without the deleted ones, don't give back."""
    segments = table(spark, sf_dir, "clause_document_inline_diff_segment").where("segment_kind <> 'deleted'").select("hunk_id", "segment_order", "old_text", "new_text")
    return diff.replay_problems(_hunks(spark, sf_dir, "hunk_id", "old_exact_text", "new_exact_text"), segments, "hunk_id", "segment_order", ("old_exact_text", "new_exact_text"), ("old_text", "new_text"))


_REPLAY_SQL = f"WITH {_HUNK_TEXTS} SELECT hunk_id, sha256(o) AS old_sha256, sha256(n) AS new_sha256 FROM h WHERE o <> '' OR n <> ''"


def _replay(rows, made):
    """Hashes of the texts that the pieces of a diff give back."""
    pieces = rows.select("hunk_id", F.posexplode(made).alias("segment_order", "s")).select("hunk_id", "segment_order", "s.old_text", "s.new_text")
    back = diff.replayed(pieces, ["hunk_id"], "segment_order", "old_text", "new_text")
    return back.select("hunk_id", F.sha2("old_text", 256).alias("old_sha256"), F.sha2("new_text", 256).alias("new_sha256"))


@query(_REPLAY_SQL)
def x05_replay(spark, sf_dir):
    """Both texts of every hunk, insertions and deletions included, from the pieces of the character diff."""
    rows = _hunks(spark, sf_dir, "hunk_id", "old_exact_text", "new_exact_text")
    return _replay(rows, diff.exact_diff(F.col("old_exact_text"), F.col("new_exact_text")))


@query(_REPLAY_SQL)
def x02_replay(spark, sf_dir):
    """Both texts of every hunk from the pieces of the token diff."""
    rows = _hunks(spark, sf_dir, "hunk_id", "old_exact_text", "new_exact_text")
    return _replay(rows, diff.token_diff(F.col("old_exact_text"), F.col("new_exact_text")))


def _terms(spark, sf_dir):
    """Aliases from the signature lines of the documents: the departments; those of few documents are candidates."""
    rows = table(spark, sf_dir, "documents").select(F.regexp_extract("text", r"承辦：(\S+)\s*$", 1).alias("alias_text")).where("alias_text <> ''")
    rows = rows.groupBy("alias_text").agg(F.when(F.count("*") >= 3, "admitted").otherwise("candidate").alias("s"))
    return rows.select(F.sha1("alias_text").alias("alias_id"), F.sha1("alias_text").alias("concept_id"), "alias_text", F.col("s").alias("status"))


@query()
def t05_tag_blocks(spark, sf_dir):
    """Terms of the notices in the clause blocks, with offsets and status."""
    blocks = table(spark, sf_dir, "current_clause_block").select("source_block_id", "raw_text").distinct()
    return tagging.tag_texts(blocks, _terms(spark, sf_dir), block="source_block_id", text="raw_text")


@query()
def t06_scan_receipts(spark, sf_dir):
    """Occurrences by status of every block, those without any included."""
    blocks = table(spark, sf_dir, "current_clause_block").select("source_block_id", "raw_text").distinct()
    return tagging.scan_receipts(blocks, tagging.tag_texts(blocks, _terms(spark, sf_dir), block="source_block_id", text="raw_text"), "source_block_id")


@query("""WITH a AS (SELECT DISTINCT regexp_extract(subject, '修正(.+?)給付規定', 1) AS k, issuer AS c, event_type FROM official_event WHERE regexp_extract(subject, '修正(.+?)給付規定', 1) <> ''),
n AS (SELECT k, count(DISTINCT c) > 1 AS clash FROM a GROUP BY 1)
SELECT a.k AS alias_key, a.c AS concept_id, CASE WHEN clash THEN 'blocked' WHEN bool_or(event_type = 'announcement') THEN 'admitted' ELSE 'candidate' END AS status FROM a JOIN n USING (k) GROUP BY 1, 2, clash""")
def t02_alias_status(spark, sf_dir):
    """Admission of aliases with cross-concept collisions."""
    name = F.regexp_extract("subject", "修正(.+?)給付規定", 1)
    rows = table(spark, sf_dir, "official_event").select(name.alias("alias_key"), F.col("issuer").alias("concept_id"), "event_type").where("alias_key <> ''")
    rows = rows.groupBy("alias_key", "concept_id").agg(F.bool_or(F.col("event_type") == "announcement").alias("observed"))
    rows = rows.select("*", F.lit(False).alias("needs_context"), F.lit(False).alias("is_abbreviation"))
    return tagging.alias_status(rows, []).select("alias_key", "concept_id", "status")


@query("""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+|\\p{Nd}+|[㐀-鿿]')) AS t FROM documents) SELECT t AS term, count(*) AS occurrences, count(DISTINCT doc_id) AS documents FROM w GROUP BY 1""")
def t10_term_index(spark, sf_dir):
    """Terms of the inverted index with their counts."""
    index = tagging.inverted_index(table(spark, sf_dir, "documents"), "doc_id", "text")
    return index.groupBy("term").agg(F.sum("term_count").alias("occurrences"), F.count("*").alias("documents"))


@query("SELECT doc_id, contains(lower(regexp_replace(text, '\\s', '', 'g')), 'casereview') AS hit FROM documents WHERE text IS NOT NULL")
def t11_reader_search(spark, sf_dir):
    """Substring search of readers: width, case and white space don't matter."""
    rows = table(spark, sf_dir, "documents").where("text is not null")
    return rows.select("doc_id", F.contains(text.reader_key(F.col("text")), F.lit("casereview")).alias("hit"))


@query("""WITH e AS (SELECT DISTINCT expression_id, exact_text FROM clause_document_expression), m AS (SELECT expression_id, unnest(regexp_extract_all(exact_text, '[0-9]+(?:個月|週|天|日內)')) AS v FROM e), d AS (SELECT DISTINCT expression_id, v FROM m)
SELECT expression_id, string_agg(v, ',' ORDER BY length(v) DESC, v) AS durations FROM d GROUP BY 1""")
def t15_duration_markers(spark, sf_dir):
    """Distinct duration markers of a text, longest first."""
    rows = _expressions(spark, sf_dir, "expression_id", "exact_text")
    found = F.array_distinct(F.regexp_extract_all("exact_text", F.lit("([0-9]+(?:個月|週|天|日內))"), F.lit(1)))
    ordered = F.transform(F.array_sort(F.transform(found, lambda v: F.struct((-F.char_length(v)).alias("n"), v.alias("v")))), lambda x: x["v"])
    return rows.select("expression_id", F.array_join(ordered, ",").alias("durations")).where("durations <> ''")


@query("""WITH e AS (SELECT DISTINCT expression_id, exact_text FROM clause_document_expression), m AS (SELECT expression_id, unnest(regexp_extract_all(exact_text, '(?:上限為|不超過)([0-9.]+)', 1)) AS v FROM e)
SELECT v AS quantity, count(*) AS occurrences, count(DISTINCT expression_id) AS expressions FROM m GROUP BY 1""")
def t16_quantity_markers(spark, sf_dir):
    """Quantities inside limit expressions, with their occurrences."""
    rows = _expressions(spark, sf_dir, "expression_id", "exact_text")
    found = rows.select("expression_id", F.explode(F.regexp_extract_all("exact_text", F.lit("(?:上限為|不超過)([0-9.]+)"), F.lit(1))).alias("quantity"))
    return found.groupBy("quantity").agg(F.count("*").alias("occurrences"), F.count_distinct("expression_id").alias("expressions"))


@query("""WITH b AS (SELECT DISTINCT source_block_id, trim(regexp_replace(string_split(raw_text, chr(10))[1], '[。；;，,、.]+$', '')) AS l FROM current_clause_block),
c AS (SELECT source_block_id, l, length(regexp_extract(l, '^[^:：]*')) AS k FROM b), t AS (SELECT source_block_id, CASE WHEN k < length(l) AND k BETWEEN 1 AND 35 THEN left(l, k) ELSE l END AS t FROM c)
SELECT source_block_id, CASE WHEN length(t) > 48 THEN left(t, 48) || '…' ELSE t END AS title FROM t""")
def f24_display_title(spark, sf_dir):
    """Short titles of the blocks."""
    rows = table(spark, sf_dir, "current_clause_block").select("source_block_id", "raw_text").distinct()
    return rows.select("source_block_id", text.display_title(F.col("raw_text")).alias("title"))


@query(r"""WITH s AS (SELECT DISTINCT subject, regexp_extract_all(subject, '[A-Za-z][A-Za-z-]*|[㐀-鿿]{2,}') AS w FROM official_event), t AS (SELECT subject, unnest(w) AS term, generate_subscripts(w, 1) AS i FROM s),
k AS (SELECT * FROM t WHERE NOT regexp_matches(term, '^[A-Za-z]') OR length(term) >= 5 OR (length(term) >= 3 AND term = upper(term))),
f AS (SELECT subject, lower(term) AS key, arg_min(term, i) AS term, min(i) AS i FROM k GROUP BY 1, 2) SELECT subject, CAST(row_number() OVER (PARTITION BY subject ORDER BY i) - 1 AS INT) AS term_order, term FROM f""")
def f28_heading_terms(spark, sf_dir):
    """Search terms of the notices' subjects."""
    rows = table(spark, sf_dir, "official_event").select("subject").distinct()
    return rows.select("subject", F.posexplode(text.heading_terms_of(F.col("subject"))).alias("term_order", "term"))


@query("""WITH n AS (SELECT DISTINCT unnest(regexp_extract_all(official_date_raw_value, '[一二三四五六七八九十百零]+')) AS n FROM source_edition),
d AS (SELECT n, regexp_extract(n, '^(.?)百', 1) AS h, contains(n, '百') AS hu, regexp_extract(n, '([^百零]?)十', 1) AS t, contains(n, '十') AS te, regexp_extract(n, '([^十百]?)$', 1) AS o, translate(n, '零一二三四五六七八九', '0123456789') AS p FROM n),
v AS (SELECT n, CASE WHEN NOT hu AND NOT te THEN CAST(p AS BIGINT) ELSE CASE WHEN hu THEN 100 * greatest(instr('一二三四五六七八九', h), 1) ELSE 0 END
  + CASE WHEN te THEN 10 * greatest(instr('一二三四五六七八九', t), 1) ELSE 0 END + CASE WHEN o = '' THEN 0 ELSE instr('一二三四五六七八九', o) END END AS x FROM d)
SELECT n AS numeral, CAST(x AS BIGINT) AS number FROM v""")
def f33_numerals(spark, sf_dir):
    """Chinese numerals of the raw edition dates as integers."""
    rows = table(spark, sf_dir, "source_edition").select("official_date_raw_value").distinct()
    found = rows.select(F.explode(F.regexp_extract_all("official_date_raw_value", F.lit("([一二三四五六七八九十百零]+)"), F.lit(1))).alias("numeral")).distinct()
    return found.select("numeral", text.chinese_integer(F.col("numeral")).alias("number"))


@query("""WITH c AS (SELECT DISTINCT run_id, clause_code, block_order, source_block_id, CASE WHEN block_kind = 'paragraph' THEN 2 ELSE 1 END AS w FROM current_clause_block),
p AS (SELECT run_id, clause_code, source_block_id, block_order AS origin_column, unnest(generate_series(block_order, block_order + w - 1)) AS column_index FROM c)
SELECT run_id, clause_code, CAST(column_index AS INT) AS column_index, arg_min(source_block_id, (column_index <> origin_column, origin_column)) AS value, min(column_index <> origin_column) AS inherited FROM p GROUP BY 1, 2, 3""")
def x11_grid(spark, sf_dir):
    """Blocks as one-row grids in which a paragraph spans two places."""
    rows = table(spark, sf_dir, "current_clause_block").select("run_id", "clause_code", "block_order", "source_block_id", "block_kind").distinct()
    cells = rows.select("run_id", "clause_code", F.lit(0).alias("r"), "block_order", F.when(F.col("block_kind") == "paragraph", 2).otherwise(1).alias("w"), "source_block_id")
    made = grids.normalized_grid(cells.withColumn("h", F.lit(1)), ["run_id", "clause_code"], "r", "block_order", "h", "w", "source_block_id")
    return made.select("run_id", "clause_code", "column_index", "value", "inherited")


@query()
def d10_utc_dates(spark, sf_dir):
    """Distinct raw dates of the events with the moment each means."""
    rows = table(spark, sf_dir, "official_event").select("effective_from", "clock_zone").distinct()
    return rows.select("effective_from", "clock_zone", utc_start(F.col("effective_from"), F.col("clock_zone")).alias("utc_start"))
