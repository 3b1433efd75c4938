"""Queries of receipts, inventories, evidence chains and reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from palimpsest.functions import ids, jsons, text
from palimpsest.operators import chains, gates, latest, parity
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


@query("""WITH s AS (SELECT DISTINCT hunk_id, segment_order, segment_kind FROM clause_document_inline_diff_segment), h AS (SELECT DISTINCT hunk_id, newer_expression_id AS x FROM clause_document_diff_hunk),
e AS (SELECT DISTINCT expression_id AS x, source_edition_version_id AS v FROM clause_document_expression), d AS (SELECT DISTINCT source_edition_version_id AS v, edition_label AS l FROM source_edition)
SELECT s.hunk_id, count(*) AS segments, count(DISTINCT d.l) AS labels, CASE WHEN count(DISTINCT d.l) = 0 THEN 'none' WHEN count(DISTINCT d.l) = 1 THEN 'unique' ELSE 'ambiguous' END AS label_class
FROM s LEFT JOIN h USING (hunk_id) LEFT JOIN e USING (x) LEFT JOIN d USING (v) GROUP BY 1""")
def j14_link_chain(spark, sf_dir):
    """Segments followed over hunk and expression to the edition's label, with the class of the result."""
    s = table(spark, sf_dir, "clause_document_inline_diff_segment").select("hunk_id", "segment_order", "segment_kind").distinct()
    h = table(spark, sf_dir, "clause_document_diff_hunk").select("hunk_id", F.col("newer_expression_id").alias("x")).distinct()
    e = table(spark, sf_dir, "clause_document_expression").select(F.col("expression_id").alias("x"), F.col("source_edition_version_id").alias("v")).distinct()
    d = table(spark, sf_dir, "source_edition").select(F.col("source_edition_version_id").alias("v"), F.col("edition_label").alias("l")).distinct()
    n = F.count_distinct("l")
    rows = s.join(h, "hunk_id", "left").join(e, "x", "left").join(d, "v", "left").groupBy("hunk_id").agg(F.count("*").alias("segments"), n.alias("labels"))
    return rows.withColumn("label_class", F.when(F.col("labels") == 0, "none").when(F.col("labels") == 1, "unique").otherwise("ambiguous"))


@query("""WITH e AS (SELECT DISTINCT event_id, supersedes_event_id, reference_number FROM official_event)
SELECT c.event_id, coalesce(c.reference_number, p.reference_number) AS reference_number, c.reference_number IS NULL AND p.reference_number IS NOT NULL AS inherited FROM e c LEFT JOIN e p ON c.supersedes_event_id = p.event_id""")
def j15_parent_number(spark, sf_dir):
    """A notice's number, or that of the notice it supersedes."""
    e = table(spark, sf_dir, "official_event").select("event_id", "supersedes_event_id", "reference_number").distinct()
    p = e.select(F.col("event_id").alias("supersedes_event_id"), F.col("reference_number").alias("r"))
    own = F.col("reference_number")
    return e.join(p, "supersedes_event_id", "left").select("event_id", F.coalesce(own, "r").alias("reference_number"), (own.isNull() & F.col("r").isNotNull()).alias("inherited"))


@query("""WITH x AS (SELECT DISTINCT clause_work_id AS w, source_edition_version_id AS e, source_lane AS l, sha256(exact_text) AS h FROM clause_document_expression),
a AS (SELECT w, e, min(h) AS h FROM x WHERE l = 'current_publication' GROUP BY 1, 2), b AS (SELECT w, e, min(h) AS h FROM x WHERE l = 'historical_edition' GROUP BY 1, 2)
SELECT CASE WHEN a.w IS NULL THEN 'right_only' WHEN b.w IS NULL THEN 'left_only' WHEN a.h = b.h THEN 'equal' ELSE 'different' END AS parity, count(*) AS n FROM a FULL JOIN b ON a.w = b.w AND a.e = b.e GROUP BY 1""")
def j17_pass_parity(spark, sf_dir):
    """Two lanes compared by clause and edition."""
    x = table(spark, sf_dir, "clause_document_expression").select(F.col("clause_work_id").alias("w"), F.col("source_edition_version_id").alias("e"), "source_lane", F.sha2("exact_text", 256).alias("h"))
    side = lambda lane, name: x.where(F.col("source_lane") == lane).groupBy("w", "e").agg(F.min("h").alias(name))
    both = side("current_publication", "a").join(side("historical_edition", "b"), ["w", "e"], "full_outer")
    kind = F.when(F.col("a").isNull(), "right_only").when(F.col("b").isNull(), "left_only").when(F.col("a") == F.col("b"), "equal").otherwise("different")
    return both.groupBy(kind.alias("parity")).agg(F.count("*").alias("n"))


@query("""WITH b AS (SELECT DISTINCT source_block_id, CAST(json_extract(source_locator, '$.page') AS INT) AS page, CAST(json_extract(source_locator, '$.char_start') AS INT) AS a, length(raw_text) AS n FROM current_clause_block)
SELECT source_block_id FROM (SELECT *, max(a + n) OVER (PARTITION BY page ORDER BY a, source_block_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM b WHERE page IS NOT NULL) WHERE m > a""")
def j20_span_exclusion(spark, sf_dir):
    """Blocks whose span on a page of the source overlaps an earlier one."""
    at = lambda k: F.get_json_object("source_locator", f"$.{k}").cast("int")
    rows = table(spark, sf_dir, "current_clause_block").select("source_block_id", at("page").alias("page"), at("char_start").alias("a"), (at("char_start") + F.char_length("raw_text")).alias("b")).distinct()
    return gates.overlapping_intervals(rows.where("page is not null"), ["page"], "a", "b", ["source_block_id"]).select("source_block_id")


@query("""WITH b AS (SELECT DISTINCT clause_code, source_block_id, block_order FROM current_clause_block), c AS (SELECT canonical_code AS clause_code, min(clause_work_id) AS w FROM clause_document_expression GROUP BY 1)
SELECT source_block_id, w AS clause_work_id, w IS NULL AS unbound FROM b LEFT JOIN c USING (clause_code)""")
def j24_block_binding(spark, sf_dir):
    """Blocks bound to a work of their code; the unbound are kept."""
    b = table(spark, sf_dir, "current_clause_block").select("clause_code", "source_block_id", "block_order").distinct()
    c = table(spark, sf_dir, "clause_document_expression").groupBy(F.col("canonical_code").alias("clause_code")).agg(F.min("clause_work_id").alias("clause_work_id"))
    return b.join(c, "clause_code", "left").select("source_block_id", "clause_work_id", F.col("clause_work_id").isNull().alias("unbound"))


@query("""WITH a AS (SELECT DISTINCT clause_code AS code, block_order AS o, sha256(raw_text) AS h FROM current_clause_block), e AS (SELECT canonical_code AS code, min(exact_text) AS t FROM clause_document_expression GROUP BY 1),
p AS (SELECT code, CAST(unnest(generate_series(0, len(string_split(t, chr(10) || chr(10))) - 1)) AS INT) AS o, t FROM e)
SELECT code, o AS block_order, h AS text_sha256, 'amendment' AS lane FROM a UNION ALL SELECT code, o, sha256(string_split(t, chr(10) || chr(10))[o + 1]), 'inherited' FROM p WHERE code NOT IN (SELECT code FROM a)""")
def j26_composition(spark, sf_dir):
    """Blocks of the current publication, and inherited paragraphs for codes without any, with their lane."""
    a = table(spark, sf_dir, "current_clause_block").select(F.col("clause_code").alias("code"), "block_order", F.sha2("raw_text", 256).alias("text_sha256"), F.lit("amendment").alias("lane")).distinct()
    e = table(spark, sf_dir, "clause_document_expression").groupBy(F.col("canonical_code").alias("code")).agg(F.min("exact_text").alias("t"))
    e = e.join(a.select("code").distinct(), "code", "left_anti").select("code", F.posexplode(F.split("t", "\n\n")).alias("block_order", "p"))
    return a.unionByName(e.select("code", "block_order", F.sha2("p", 256).alias("text_sha256"), F.lit("inherited").alias("lane")))


@query("""WITH v AS (SELECT clause_work_id AS w, count(DISTINCT effective_from) AS dates, count(DISTINCT source_version_id) AS versions FROM clause_document_expression GROUP BY 1)
SELECT w AS clause_work_id, greatest(1, dates) AS expected, versions AS reconstructed, greatest(0, greatest(1, dates) - versions) AS missing, CASE WHEN versions >= greatest(1, dates) THEN 'complete' ELSE 'incomplete' END AS inventory FROM v""")
def a14_version_inventory(spark, sf_dir):
    """Expected against found versions of each work."""
    v = table(spark, sf_dir, "clause_document_expression").groupBy("clause_work_id").agg(F.count_distinct("effective_from").alias("dates"), F.count_distinct("source_version_id").alias("reconstructed"))
    expected = F.greatest(F.lit(1).cast("bigint"), "dates")
    missing = F.greatest(F.lit(0).cast("bigint"), expected - F.col("reconstructed"))
    return v.select("clause_work_id", expected.alias("expected"), "reconstructed", missing.alias("missing"), F.when(missing == 0, "complete").otherwise("incomplete").alias("inventory"))


@query("""WITH v AS (SELECT clause_work_id AS w, count(DISTINCT effective_from) AS dates, count(DISTINCT source_version_id) AS versions FROM clause_document_expression GROUP BY 1)
SELECT count(*) AS works, CAST(sum(versions) AS BIGINT) AS versions, count(*) FILTER (dates = 0) AS undated, count(*) FILTER (versions > 1) AS changed FROM v""")
def a13_inventory_summary(spark, sf_dir):
    """The inventory in one row."""
    v = table(spark, sf_dir, "clause_document_expression").groupBy("clause_work_id").agg(F.count_distinct("effective_from").alias("dates"), F.count_distinct("source_version_id").alias("v"))
    return v.agg(F.count("*").alias("works"), F.sum("v").alias("versions"), F.count_if(F.col("dates") == 0).alias("undated"), F.count_if(F.col("v") > 1).alias("changed"))


@query("SELECT sha256(canonical_code || chr(31) || source_lane) AS key_hash, canonical_code, source_lane, count(*) AS n FROM clause_document_expression GROUP BY 2, 3")
def a19_counter_rows(spark, sf_dir):
    """Multiset counters with a hash of their key."""
    rows = table(spark, sf_dir, "clause_document_expression").groupBy("canonical_code", "source_lane").agg(F.count("*").alias("n"))
    return rows.select(F.sha2(F.concat_ws("\u001f", "canonical_code", "source_lane"), 256).alias("key_hash"), "canonical_code", "source_lane", "n")


@query("""SELECT CAST(n AS BIGINT) AS works_per_code, count(*) AS codes, min(c) AS first_code, max(c) AS last_code FROM (SELECT canonical_code AS c, count(DISTINCT clause_work_id) AS n FROM clause_document_expression GROUP BY 1) WHERE n > 1 GROUP BY 1""")
def a16_collision_summary(spark, sf_dir):
    """Codes that stand for several works, by their number."""
    rows = table(spark, sf_dir, "clause_document_expression").groupBy("canonical_code").agg(F.count_distinct("clause_work_id").alias("works_per_code")).where("works_per_code > 1")
    return rows.groupBy("works_per_code").agg(F.count("*").alias("codes"), F.min("canonical_code").alias("first_code"), F.max("canonical_code").alias("last_code"))


@query("SELECT canonical_code, strftime(max(recorded_at), '%Y-%m-%d %H:%M:%S') AS last_recorded FROM clause_document_expression GROUP BY 1")
def a26_latest_per_code(spark, sf_dir):
    """The last recording of each code."""
    return table(spark, sf_dir, "clause_document_expression").groupBy("canonical_code").agg(F.date_format(F.max("recorded_at"), "yyyy-MM-dd HH:mm:ss").alias("last_recorded"))


@query("""SELECT t AS table_name, n AS row_count, CASE WHEN n > 0 THEN 'loaded' ELSE 'empty' END AS status FROM (SELECT 'source_edition' AS t, count(*) AS n FROM source_edition UNION ALL SELECT 'official_event', count(*) FROM official_event UNION ALL SELECT 'clause_version_edge', count(*) FROM clause_version_edge)""")
def a27_count_gate(spark, sf_dir):
    """Row counts of loaded tables."""
    made = None
    for name in ("source_edition", "official_event", "clause_version_edge"):
        row = table(spark, sf_dir, name).agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count", F.when(F.col("row_count") > 0, "loaded").otherwise("empty").alias("status"))
        made = row if made is None else made.unionByName(row)
    return made


@query("""WITH e AS (SELECT DISTINCT edition_import_run_id AS r, source_edition_version_id AS e, chronology_order AS o FROM source_edition) SELECT r AS edition_import_run_id, e AS source_edition_version_id, CAST(row_number() OVER (PARTITION BY r ORDER BY o, e) AS INT) AS position,
CAST(row_number() OVER (PARTITION BY r ORDER BY o DESC, e DESC) AS INT) AS from_last FROM e""")
def l05_chronology(spark, sf_dir):
    """Position of each edition in its run, from the first and from the last."""
    rows = table(spark, sf_dir, "source_edition").select("edition_import_run_id", "source_edition_version_id", "chronology_order").distinct()
    w = Window.partitionBy("edition_import_run_id")
    up, down = w.orderBy("chronology_order", "source_edition_version_id"), w.orderBy(F.desc("chronology_order"), F.desc("source_edition_version_id"))
    return rows.select("edition_import_run_id", "source_edition_version_id", F.row_number().over(up).alias("position"), F.row_number().over(down).alias("from_last"))


@query("""WITH a AS (SELECT source_edition_version_id AS k, artifact_sha256 AS h FROM source_edition GROUP BY 1, 2) SELECT count(*) AS distinct_rows, count(*) - count(DISTINCT k) AS collisions, (SELECT count(*) FROM source_edition) - count(*) AS repeats FROM a""")
def u09_dedup_with_collisions(spark, sf_dir):
    """Exact repeats removed, with the number of keys of several contents."""
    df = table(spark, sf_dir, "source_edition")
    rows, clashes = parity.distinct_with_collisions(df, ["source_edition_version_id"], ["artifact_sha256"])
    facts = rows.agg(F.count("*").alias("distinct_rows"))
    more = clashes.agg(F.coalesce(F.sum(F.col("contents") - 1), F.lit(0)).alias("collisions"))
    # Three single rows.
    return facts.crossJoin(more).crossJoin(df.agg(F.count("*").alias("n"))).select("distinct_rows", "collisions", (F.col("n") - F.col("distinct_rows")).alias("repeats"))


@query("""WITH e AS (SELECT DISTINCT event_id, publication_date, effective_to, status FROM official_event) SELECT event_id, CASE WHEN status <> 'verified' THEN 'withheld' WHEN effective_to IS NOT NULL AND effective_to <= '2014-06-30' THEN 'expired'
WHEN CAST(publication_date AS VARCHAR) > '2014-06-30' THEN 'pending' ELSE 'authorized' END AS state FROM e""")
def w21_precedence_status(spark, sf_dir):
    """One state per notice by precedence at a given instant."""
    at = F.lit("2014-06-30")
    cases = [
        ("withheld", F.col("status") != "verified"), ("expired", F.coalesce(F.col("effective_to") <= at, F.lit(False))), ("pending", F.col("publication_date").cast("string") > at),
    ]
    rows = table(spark, sf_dir, "official_event").select("event_id", "publication_date", "effective_to", "status").distinct()
    return rows.select("event_id", latest.status_by_precedence(cases, "authorized").alias("state"))


@query("""WITH h AS (SELECT DISTINCT hunk_id, older_expression_id, newer_expression_id, exact_change_kind FROM clause_document_diff_hunk), n AS (SELECT older_expression_id AS a, newer_expression_id AS b, count(*) AS hunks FROM h GROUP BY 1, 2)
SELECT a AS older_expression_id, b AS newer_expression_id, hunks, greatest(hunks - 1, 0) AS further FROM n""")
def m04_edge_counts(spark, sf_dir):
    """Hunks per pair of expressions, and how many beyond the first."""
    h = table(spark, sf_dir, "clause_document_diff_hunk").select("hunk_id", "older_expression_id", "newer_expression_id").distinct()
    rows = h.groupBy("older_expression_id", "newer_expression_id").agg(F.count("*").alias("hunks"))
    return rows.withColumn("further", F.greatest(F.col("hunks") - 1, F.lit(0).cast("bigint")))


@query("""WITH b AS (SELECT DISTINCT run_id, clause_code, block_order, raw_text FROM current_clause_block) SELECT run_id, clause_code, sha256(string_agg(raw_text, chr(10) ORDER BY block_order)) AS text_sha256, count(*) AS blocks FROM b GROUP BY 1, 2""")
def x15_clause_receipts(spark, sf_dir):
    """Hash of each clause's joined text, with the number of its blocks."""
    b = table(spark, sf_dir, "current_clause_block").select("run_id", "clause_code", "block_order", "raw_text").distinct()
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_order", "raw_text"))), lambda x: x["raw_text"]), "\n")
    return b.groupBy("run_id", "clause_code").agg(F.sha2(joined, 256).alias("text_sha256"), F.count("*").alias("blocks"))


@query("""WITH c AS (SELECT DISTINCT canonical_code AS c FROM clause_document_expression), n AS (SELECT c, CAST(split_part(c, '.', 1) AS INT) AS a, list_transform(string_split(c, '.'), lambda x: CAST(x AS INT)) AS k FROM c),
o AS (SELECT c, a, CAST(row_number() OVER (ORDER BY k) - 1 AS INT) AS pos FROM n), f AS (SELECT a, min(pos) AS s FROM o GROUP BY 1)
SELECT a AS chapter, s AS range_start, coalesce(lead(s) OVER (ORDER BY a), (SELECT max(pos) + 1 FROM o)) AS range_end FROM f""")
def x16_section_ranges(spark, sf_dir):
    """Contiguous ranges of the chapters in the order of their codes; the last one ends with the document."""
    codes = table(spark, sf_dir, "clause_document_expression").select("canonical_code").distinct()
    numbers = F.transform(F.split("canonical_code", r"\."), lambda x: x.cast("int"))
    rows = codes.select(numbers.alias("k")).withColumn("chapter", F.col("k")[0])
    # Sizes per chapter first, so that the running sum is over chapters and not over codes.
    sizes = rows.groupBy("chapter").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy("chapter").rowsBetween(Window.unboundedPreceding, 0)).cast("int")
    return sizes.select("chapter", (upto - F.col("n").cast("int")).alias("range_start"), upto.alias("range_end"))


@query("""WITH c AS (SELECT DISTINCT canonical_code AS c FROM clause_document_expression UNION SELECT DISTINCT split_part(canonical_code, '.', 1) FROM clause_document_expression UNION SELECT DISTINCT split_part(canonical_code, '.', 1) || '.' || split_part(canonical_code, '.', 2) FROM clause_document_expression),
o AS (SELECT c, split_part(c, '.', 1) AS chapter, len(string_split(c, '.')) AS d, row_number() OVER (PARTITION BY split_part(c, '.', 1) ORDER BY list_transform(string_split(c, '.'), lambda x: CAST(x AS INT))) AS pos FROM c)
SELECT c AS code, CAST((SELECT max(b.pos) FROM o b WHERE b.chapter = a.chapter AND b.pos < a.pos AND b.d < a.d) AS INT) AS parent_order FROM o a""")
def x12_outline_tree(spark, sf_dir):
    """Parents of the outline that the dotted codes make."""
    parts = F.split("canonical_code", r"\.")
    codes = table(spark, sf_dir, "clause_document_expression").select("canonical_code").distinct()
    every = codes.select(F.explode(F.array("canonical_code", parts[0], F.concat_ws(".", parts[0], parts[1]))).alias("code")).distinct()
    numbers = F.transform(F.split("code", r"\."), lambda x: x.cast("int"))
    rows = every.select("code", F.split("code", r"\.")[0].alias("chapter"), F.size(F.split("code", r"\.")).alias("depth"), numbers.alias("n"))
    rows = rows.withColumn("pos", F.row_number().over(Window.partitionBy("chapter").orderBy("n")))
    return chains.outline_parents(rows, ["chapter"], "pos", "depth").select("code", "parent_order")


@query("""SELECT expression_id, regexp_matches(canonical_code, '^[1-9][0-9]?(\\.[1-9][0-9]?)+$') AS strict, starts_with(exact_text, canonical_code) AS leads FROM (SELECT DISTINCT expression_id, canonical_code, exact_text FROM clause_document_expression)""")
def x17_strict_headings(spark, sf_dir):
    """Whether a code is a strict dotted heading and leads its text."""
    rows = table(spark, sf_dir, "clause_document_expression").select("expression_id", "canonical_code", "exact_text").distinct()
    return rows.select("expression_id", F.rlike("canonical_code", F.lit(r"^[1-9][0-9]?(\.[1-9][0-9]?)+$")).alias("strict"), F.startswith("exact_text", "canonical_code").alias("leads"))


@query("""WITH t AS (SELECT DISTINCT issuer, event_type, status FROM official_event) SELECT issuer, string_agg(event_type || ':' || status, ',' ORDER BY event_type, status) AS codes, count(*) AS n FROM t GROUP BY 1""")
def t08_code_conservation(spark, sf_dir):
    """All codes of each concept, conserved in order."""
    t = table(spark, sf_dir, "official_event").select("issuer", "event_type", "status").distinct()
    pairs = F.transform(F.array_sort(F.collect_list(F.struct("event_type", "status"))), lambda x: F.concat(x["event_type"], F.lit(":"), x["status"]))
    return t.groupBy("issuer").agg(F.array_join(pairs, ",").alias("codes"), F.count("*").alias("n"))


@query("""SELECT '{"editions":' || (SELECT count(DISTINCT source_edition_version_id) FROM source_edition) || ',"orphan_edges":' || (SELECT count(*) FROM (SELECT DISTINCT edge_id, newer_clause_version_id AS n FROM clause_version_edge) WHERE n NOT IN (SELECT source_version_id FROM clause_document_expression WHERE source_version_id IS NOT NULL))
|| ',"wrong_hashes":' || (SELECT count(DISTINCT expression_id) FROM clause_document_expression WHERE exact_text_sha256 IS DISTINCT FROM sha256(exact_text)) || '}' AS report""")
def t09_release_report(spark, sf_dir):
    """A release report as one JSON object."""
    e = table(spark, sf_dir, "clause_document_expression")
    edges = table(spark, sf_dir, "clause_version_edge").select("edge_id", "newer_clause_version_id").distinct()
    editions = table(spark, sf_dir, "source_edition").agg(F.count_distinct("source_edition_version_id").alias("editions"))
    orphan = gates.orphans(edges, e, "newer_clause_version_id", "source_version_id").agg(F.count("*").alias("orphan_edges"))
    wrong = e.where(~F.col("exact_text_sha256").eqNullSafe(F.sha2("exact_text", 256))).agg(F.count_distinct("expression_id").alias("wrong_hashes"))
    # Single rows.
    return editions.crossJoin(orphan).crossJoin(wrong).select(F.to_json(F.struct("editions", "orphan_edges", "wrong_hashes")).alias("report"))


@query("""WITH e AS (SELECT DISTINCT exact_text AS t FROM clause_document_expression), m AS (SELECT unnest(regexp_extract_all(t, '每[^，。；]{1,6}上限為[0-9.]+|總量不超過[0-9.]+|療程以[0-9]+次為限')) AS x FROM e)
SELECT x AS expression, CASE WHEN starts_with(x, '療程') THEN 'duration_cap' WHEN starts_with(x, '總量') THEN 'total_cap' ELSE 'periodic_cap' END AS kind, CAST(regexp_extract(x, '([0-9]+(?:\\.[0-9]+)?)', 1) AS DOUBLE) AS value, count(*) AS occurrences FROM m GROUP BY 1""")
def t17_typed_expressions(spark, sf_dir):
    """Limit expressions as typed rows, each once with its occurrences."""
    texts = table(spark, sf_dir, "clause_document_expression").select("exact_text").distinct()
    found = texts.select(F.explode(F.regexp_extract_all("exact_text", F.lit("(每[^，。；]{1,6}上限為[0-9.]+|總量不超過[0-9.]+|療程以[0-9]+次為限)"), F.lit(1))).alias("expression"))
    kind = F.when(F.startswith("expression", F.lit("療程")), "duration_cap").when(F.startswith("expression", F.lit("總量")), "total_cap").otherwise("periodic_cap")
    value = F.regexp_extract("expression", r"([0-9]+(?:\.[0-9]+)?)", 1).cast("double")
    return found.groupBy("expression").agg(F.count("*").alias("occurrences")).select("expression", kind.alias("kind"), value.alias("value"), "occurrences")


@query("""SELECT event_id, concat_ws(',', CASE WHEN reference_number IS NULL THEN 'no_number' END, CASE WHEN effective_to IS NOT NULL AND effective_to < CAST(publication_date AS VARCHAR) THEN 'ends_before_publication' END, CASE WHEN length(subject) > 20 THEN 'long_subject' END) AS reasons
FROM (SELECT DISTINCT event_id, reference_number, effective_to, publication_date, subject FROM official_event)""")
def filter_p12_reason_codes(spark, sf_dir):
    """Reason codes of every gate that a notice fails."""
    rows = table(spark, sf_dir, "official_event").select("event_id", "reference_number", "effective_to", "publication_date", "subject").distinct()
    reasons = F.array_compact(
        F.array(
            F.when(F.col("reference_number").isNull(), F.lit("no_number")), F.when(F.col("effective_to") < F.col("publication_date").cast("string"), F.lit("ends_before_publication")),
            F.when(F.char_length("subject") > 20, F.lit("long_subject")),
        )
    )
    return rows.select("event_id", F.array_join(reasons, ",").alias("reasons"))


@query("SELECT source, count(*) FILTER (contains(lower(text), 'review')) AS relevant, count(*) AS documents FROM documents GROUP BY 1")
def filter_p08_relevance(spark, sf_dir):
    """Documents that a keyword rule calls relevant, per source."""
    hit = F.coalesce(F.contains(F.lower("text"), F.lit("review")), F.lit(False))
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count_if(hit).alias("relevant"), F.count("*").alias("documents"))


@query("SELECT source_block_id, json_type(source_locator) = 'OBJECT' AS is_object, CAST(len(json_keys(source_locator)) AS INT) AS members FROM (SELECT DISTINCT source_block_id, source_locator FROM current_clause_block)")
def n05_json_types(spark, sf_dir):
    """Type and members of the blocks' JSON locators."""
    rows = table(spark, sf_dir, "current_clause_block").select("source_block_id", "source_locator").distinct()
    return rows.select("source_block_id", (jsons.json_type(F.col("source_locator"), "$") == "object").alias("is_object"), F.size(F.json_object_keys("source_locator")).alias("members"))


@query("""SELECT event_id, CAST(max(len(string_split(t.fullkey, '.'))) AS INT) AS depth, CAST(count(*) AS INT) AS nodes, bool_or(coalesce(t.key IN ('secret', 'token'), false)) AS forbidden FROM events, json_tree(props) t GROUP BY 1""")
def n06_json_shape(spark, sf_dir):
    """Depth and nodes of the JSON properties, and whether a forbidden key occurs."""
    rows = table(spark, sf_dir, "events").select("event_id", "props")
    shape = jsons.json_shape(F.col("props"))
    return rows.select("event_id", shape["depth"].alias("depth"), shape["nodes"].alias("nodes"), jsons.has_key(F.col("props"), "secret", "token").alias("forbidden"))


@query("""WITH u AS (SELECT DISTINCT event_id, detail_url FROM official_event) SELECT event_id, regexp_extract(detail_url, '^(https?)://([^/]+)(/.*)?$', 2) AS host, regexp_extract(detail_url, '^(https?)://([^/]+)(/.*)?$', 3) AS path FROM u""")
def f13_canonical_urls(spark, sf_dir):
    """Hosts and paths of the notices' canonical addresses."""
    u = table(spark, sf_dir, "official_event").select("event_id", "detail_url").distinct().select("event_id", text.canonical_url(F.col("detail_url")).alias("u"))
    return u.select("event_id", F.try_parse_url("u", F.lit("HOST")).alias("host"), F.try_parse_url("u", F.lit("PATH")).alias("path"))


@query()
def k08_order_independence(spark, sf_dir):
    """Fingerprints of a table in its order and in another one; they are equal."""
    df = table(spark, sf_dir, "official_event")
    a = ids.row_sum_fingerprint(df).select(F.col("fingerprint").alias("a"))
    b = ids.row_sum_fingerprint(df.repartition("issuer").sortWithinPartitions(F.desc("event_id"))).select(F.col("fingerprint").alias("b"))
    # Single rows.
    return a.crossJoin(b).select((F.col("a") == F.col("b")).alias("equal"))


@query("""WITH k AS (SELECT 'event keys' AS gate, count(*) AS n FROM (SELECT event_id FROM official_event GROUP BY 1 HAVING count(*) <> 1)
UNION ALL SELECT 'hunk of segment', count(*) FROM (SELECT DISTINCT hunk_id, segment_order FROM clause_document_inline_diff_segment) WHERE hunk_id NOT IN (SELECT hunk_id FROM clause_document_diff_hunk)
UNION ALL SELECT 'segment numbers', count(*) FROM (SELECT hunk_id FROM (SELECT DISTINCT hunk_id, segment_order FROM clause_document_inline_diff_segment) GROUP BY 1 HAVING NOT (min(segment_order) = 0 AND max(segment_order) = count(*) - 1))
UNION ALL SELECT 'edition of expression', count(*) FROM clause_document_expression WHERE source_edition_version_id NOT IN (SELECT source_edition_version_id FROM source_edition))
SELECT gate, n AS violations, n = 0 AS passed FROM k""")
def k05_seal_report(spark, sf_dir):
    """All gates of a run before it is sealed."""
    segments = table(spark, sf_dir, "clause_document_inline_diff_segment").select("hunk_id", "segment_order").distinct()
    return gates.gate_report(
        {
            "event keys": gates.duplicate_keys(table(spark, sf_dir, "official_event"), ["event_id"]),
            "hunk of segment": gates.orphans(segments, table(spark, sf_dir, "clause_document_diff_hunk"), "hunk_id", "hunk_id"),
            "segment numbers": gates.broken_sequences(segments, ["hunk_id"], "segment_order"),
            "edition of expression": gates.orphans(
                table(spark, sf_dir, "clause_document_expression").select("source_edition_version_id"), table(spark, sf_dir, "source_edition"),
                "source_edition_version_id", "source_edition_version_id",
            ),
        }
    )


@query("""WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), v AS (SELECT user_id, ts, max(event_id) AS seen_id FROM events WHERE event_type <> 'purchase' GROUP BY 1, 2)
SELECT p.event_id, p.user_id, v.seen_id FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def g09_state_as_of(spark, sf_dir):
    """For every purchase the user's last other event at its time."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    bought = events.where("event_type = 'purchase'").drop("event_type")
    seen = events.where("event_type <> 'purchase'").select("user_id", "ts", F.col("event_id").alias("seen_id"))
    return latest.as_of(bought, seen, ["user_id"], "ts", ["seen_id"]).select("event_id", "user_id", "seen_id")


_MARK = r"^(?:[一二三四五六七八九十百]+、|[0-9]+(?:\.[0-9]+)*[.、]|[（(][0-9]+[)）]|[（(][一二三四五六七八九十]+[)）]|[A-Za-z][.)]|[Ⅰ-Ⅻⅰ-ⅻ][.、])"


@query(rf"""WITH l AS (SELECT doc_id, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS o, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, o, a[o + 1] AS t FROM l), p AS (SELECT *, lag(t) OVER (PARTITION BY doc_id ORDER BY o) AS b FROM t),
s AS (SELECT *, CASE WHEN coalesce(NOT regexp_matches(b, '[。；：:!?！？]\s*$') AND NOT regexp_matches(t, '{_MARK}') AND length(b) > 0, false) THEN 0 ELSE 1 END AS st FROM p),
g AS (SELECT *, sum(st) OVER (PARTITION BY doc_id ORDER BY o) - 1 AS blk FROM s)
SELECT doc_id, CAST(blk AS INT) AS block_order, CAST(min(o) AS INT) AS first_line, CAST(max(o) AS INT) AS last_line, sha256(string_agg(t, '' ORDER BY o)) AS text_sha256 FROM g GROUP BY 1, 2""")
def f26_logical_blocks(spark, sf_dir):
    """Lines of the documents folded into logical blocks."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t"))
    made = chains.logical_blocks(lines, ["doc_id"], "line", "t")
    return made.select("doc_id", "block_order", "first_line", "last_line", F.sha2("block_text", 256).alias("text_sha256"))
