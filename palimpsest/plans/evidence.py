"""Queries of closures, blockers, work units, typed quantities and gates over evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions import dates, ids, quantities, text
from palimpsest.operators import chains, diff, gates, links, tagging
from palimpsest.operators import resolution as R
from palimpsest.operators.intervals import merge_intervals
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


def _version_links(spark, sf_dir) -> DataFrame:
    """Edges of the versions, shortcuts over one version, and a way back where an edge crosses a gap: many-to-many, with cycles."""
    rows = table(spark, sf_dir, "clause_version_edge").select(F.col("older_clause_version_id").alias("a"), F.col("newer_clause_version_id").alias("b"), "crosses_known_gap").distinct()
    plain = rows.select("a", "b")
    over = plain.join(plain.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select("a", F.col("c").alias("b"))
    back = rows.where("crosses_known_gap").select(F.col("b").alias("a"), F.col("a").alias("b"))
    return plain.unionByName(over).unionByName(back)


_LINKS = """r AS (SELECT DISTINCT older_clause_version_id AS a, newer_clause_version_id AS b, crosses_known_gap AS g FROM clause_version_edge),
l AS (SELECT a, b FROM r UNION SELECT x.a, y.b FROM r x JOIN r y ON x.b = y.a UNION SELECT b, a FROM r WHERE g)"""


@query(f"""WITH RECURSIVE {_LINKS}, w AS (SELECT a AS node, b AS reached, [a, b] AS path FROM l
UNION ALL SELECT w.node, l.b, list_append(w.path, l.b) FROM w JOIN l ON l.a = w.reached WHERE w.reached <> w.node AND NOT list_contains(w.path[2:], l.b))
SELECT node, reached, CAST(min(len(path) - 1) AS INT) AS distance, array_to_string(arg_min(path, (len(path), path)), ' ') AS path, node = reached AS on_cycle FROM w GROUP BY 1, 2""")
def n08_paths(spark, sf_dir):
    """All versions that each one reaches, by the shortest path, and which are on a cycle."""
    found = links.closure(_version_links(spark, sf_dir), "a", "b")
    return found.withColumn("path", F.array_join("path", " "))


@query(f"""WITH RECURSIVE {_LINKS}, w AS (SELECT a AS member, b AS of FROM l UNION SELECT w.member, l.b FROM w JOIN l ON l.a = w.of)
SELECT member, count(*) AS memberships, bool_or(member = of) AS of_itself FROM w GROUP BY 1""")
def n09_memberships(spark, sf_dir):
    """How much each member belongs to, directly or through others, along many-to-many links."""
    found = links.closure(_version_links(spark, sf_dir), "a", "b")
    return found.groupBy(F.col("node").alias("member")).agg(F.count("*").alias("memberships"), F.bool_or("on_cycle").alias("of_itself"))


@query("""WITH s AS (SELECT DISTINCT hunk_id, segment_order, segment_kind, old_scalar_start, new_scalar_start FROM clause_document_inline_diff_segment)
SELECT hunk_id, '[' || string_agg('{"order":' || segment_order || ',"kind":"' || segment_kind || '","old":' || coalesce(CAST(old_scalar_start AS VARCHAR), 'null') || ',"new":' || coalesce(CAST(new_scalar_start AS VARCHAR), 'null') || '}', ',' ORDER BY segment_order) || ']' AS segments
FROM s GROUP BY 1""")
def a07_object_array(spark, sf_dir):
    """The segments of each hunk as one JSON array of objects, in order."""
    rows = table(spark, sf_dir, "clause_document_inline_diff_segment").select("hunk_id", "segment_order", "segment_kind", "old_scalar_start", "new_scalar_start").distinct()
    item = F.struct(F.col("segment_order").alias("order"), F.col("segment_kind").alias("kind"), F.col("old_scalar_start").alias("old"), F.col("new_scalar_start").alias("new"))
    return rows.groupBy("hunk_id").agg(F.to_json(F.array_sort(F.collect_list(item)), {"ignoreNullFields": "false"}).alias("segments"))


@query("""WITH c AS (SELECT DISTINCT canonical_code FROM clause_document_expression)
SELECT canonical_code, CAST(generate_subscripts(string_split(canonical_code, '.'), 1) AS INT) AS ordinality, unnest(string_split(canonical_code, '.')) AS part FROM c""")
def n02_ordinality(spark, sf_dir):
    """Parts of the codes with their place."""
    rows = table(spark, sf_dir, "clause_document_expression").select("canonical_code").distinct()
    return rows.select("canonical_code", F.posexplode(F.split("canonical_code", r"\.")).alias("at", "part")).select("canonical_code", (F.col("at") + 1).alias("ordinality"), "part")


@query("""WITH e AS (SELECT DISTINCT source_edition_version_id, official_date_precision AS p, clock_zone AS z FROM source_edition)
SELECT source_edition_version_id, p IS NOT NULL AS has_zone, z IS NOT NULL AND p IS NOT NULL AS zone_known FROM e""")
def filter_p05_key_presence(spark, sf_dir):
    """Presence of a key in JSON objects, where a null value isn't the lack of the key."""
    rows = table(spark, sf_dir, "source_edition").select("source_edition_version_id", "official_date_precision", "clock_zone").distinct()
    whole = F.to_json(F.struct("clock_zone"), {"ignoreNullFields": "false"})
    rows = rows.select("source_edition_version_id", F.when(F.col("official_date_precision").isNull(), "{}").otherwise(whole).alias("j"))
    return rows.select(
        "source_edition_version_id", F.array_contains(F.json_object_keys("j"), "clock_zone").alias("has_zone"), F.get_json_object("j", "$.clock_zone").isNotNull().alias("zone_known")
    )


@query("""WITH e AS (SELECT source_version_id AS v, min(exact_text) AS t FROM clause_document_expression WHERE source_version_id IS NOT NULL GROUP BY 1),
m AS (SELECT v, unnest(regexp_extract_all(t, '(?:^|[^0-9])([0-9]{2,3}[ \t]*[/／][ \t]*[0-9]{1,2}[ \t]*[/／][ \t]*[0-9]{1,2})', 1)) AS r FROM e),
p AS (SELECT v, string_split(regexp_replace(r, '[ \t]*[/／][ \t]*', '/', 'g'), '/') AS x FROM m),
d AS (SELECT DISTINCT v, try_cast(printf('%04d-%02d-%02d', CAST(x[1] AS INT) + 1911, CAST(x[2] AS INT), CAST(x[3] AS INT)) AS DATE) AS d FROM p),
g AS (SELECT DISTINCT edge_id, older_clause_version_id AS o, newer_clause_version_id AS n FROM clause_version_edge),
k AS (SELECT g.edge_id, count(d.d) AS c, max(d.d) AS latest FROM g JOIN e eo ON eo.v = g.o JOIN e en ON en.v = g.n
  LEFT JOIN d ON d.v = g.n AND d.d IS NOT NULL AND NOT EXISTS (SELECT 1 FROM d b WHERE b.v = g.o AND b.d = d.d) GROUP BY 1)
SELECT edge_id, CAST(c AS BIGINT) AS new_dates, greatest(1, c) AS distance, CASE WHEN c > 1 THEN 'older_version' ELSE 'previous_version' END AS compared_with,
CASE WHEN c > 0 THEN (year(latest) - 1911) || '年' || month(latest) || '月' END AS label FROM k""")
def d10_transition_labels(spark, sf_dir):
    """The month that names each step between versions: the latest date that only the newer text has, and how far apart the versions are."""
    texts = table(spark, sf_dir, "clause_document_expression").where("source_version_id is not null").groupBy(F.col("source_version_id").alias("v")).agg(F.min("exact_text").alias("t"))
    marks = texts.select("v", F.transform(dates.date_markers(F.col("t")), lambda x: x["iso"]).alias("dates"))
    edges = table(spark, sf_dir, "clause_version_edge").select("edge_id", F.col("older_clause_version_id").alias("o"), F.col("newer_clause_version_id").alias("n")).distinct()
    both = edges.join(marks.select(F.col("v").alias("o"), F.col("dates").alias("before")), "o").join(marks.select(F.col("v").alias("n"), F.col("dates").alias("after")), "n")
    return both.select("edge_id", chains.transition_label(F.col("before"), F.col("after")).alias("x")).select("edge_id", "x.*")


@query("""WITH m AS (SELECT DISTINCT expression_id AS marker, effective_from AS d, source_lane AS md, source_version_id IS NULL AS u FROM clause_document_expression),
e AS (SELECT DISTINCT event_id AS event, CAST(publication_date AS VARCHAR) AS d, CASE WHEN event_type = 'announcement' THEN NULL WHEN event_type = 'amendment' THEN 'current_publication' ELSE 'other' END AS ed, reference_number IS NULL AS u, status <> 'verified' AS c FROM official_event),
p AS (SELECT marker, event, CASE WHEN md IS NULL OR ed IS NULL THEN 'indeterminate' WHEN md = ed THEN 'compatible' ELSE 'incompatible' END AS fit, md IS NULL AS mo, ed IS NULL AS eo, m.u AS mu, e.u AS eu, e.c AS ec FROM m JOIN e USING (d))
SELECT marker, event, fit, concat_ws(',', CASE WHEN fit = 'incompatible' THEN 'designation_incompatible' END, CASE WHEN fit = 'indeterminate' THEN 'designation_indeterminate' END, CASE WHEN eo THEN 'event_designation_omitted' END,
  CASE WHEN ec THEN 'event_unverified' END, CASE WHEN eu THEN 'event_without_number' END, CASE WHEN mo THEN 'marker_designation_omitted' END, CASE WHEN mu THEN 'marker_without_version' END) AS blockers,
fit = 'compatible' AND NOT mu AND NOT eu AND NOT ec AS eligible FROM p""")
def g06_candidate_blockers(spark, sf_dir):
    """What keeps each pair of an expression and a notice of its day from being accepted."""
    markers = table(spark, sf_dir, "clause_document_expression").select("expression_id", F.col("effective_from").alias("d"), F.col("source_lane").alias("x"), F.col("source_version_id").isNull().alias("without_version")).distinct()
    kind = F.when(F.col("event_type") == "amendment", "current_publication").when(F.col("event_type") != "announcement", "other")
    events = table(spark, sf_dir, "official_event").select(
        "event_id", F.col("publication_date").cast("string").alias("d"), kind.alias("x"), F.col("reference_number").isNull().alias("without_number"), (F.col("status") != "verified").alias("unverified")
    ).distinct()
    found = R.candidate_blockers(markers, events, marker="expression_id", event="event_id", date="d", designation="x", marker_flags=["without_version"], event_flags=["without_number", "unverified"])
    return found.withColumn("blockers", F.array_join("blockers", ","))


@query("""WITH p AS (SELECT clause_work_id AS k, count(DISTINCT source_edition_version_id) AS editions, count(DISTINCT effective_from) AS dates FROM clause_document_expression GROUP BY 1),
c AS (SELECT clause_id AS k, count(DISTINCT edge_id) AS edges FROM clause_version_edge GROUP BY 1),
j AS (SELECT coalesce(p.k, c.k) AS k, p.k IS NULL AS orphan, editions, dates, edges FROM p FULL JOIN c ON p.k = c.k),
l AS (SELECT *, CASE WHEN orphan THEN 'unknown_pair' WHEN edges IS NULL AND editions > 1 THEN 'no_edges' WHEN dates = 0 THEN 'no_dates' WHEN edges >= editions THEN 'edges_without_edition' ELSE 'review' END AS lane FROM j)
SELECT k AS clause_work_id, sha256('gap-work-unit' || chr(31) || k) AS work_unit_id, lane, CASE lane WHEN 'unknown_pair' THEN 0 WHEN 'no_edges' THEN 1 WHEN 'no_dates' THEN 2 WHEN 'edges_without_edition' THEN 3 ELSE 9 END AS priority, editions, dates, edges,
sha256('{"clause_work_id":"' || k || '","dates":' || coalesce(CAST(dates AS VARCHAR), 'null') || ',"edges":' || coalesce(CAST(edges AS VARCHAR), 'null') || ',"editions":' || coalesce(CAST(editions AS VARCHAR), 'null') || '}') AS row_sha256, '2026-07-27' AS declared_cut FROM l""")
def g16_work_units(spark, sf_dir):
    """Units of work for clauses whose evidence doesn't fit together, with lane, priority and hash."""
    pairs = table(spark, sf_dir, "clause_document_expression").groupBy("clause_work_id").agg(F.count_distinct("source_edition_version_id").alias("editions"), F.count_distinct("effective_from").alias("dates"))
    edges = table(spark, sf_dir, "clause_version_edge").groupBy(F.col("clause_id").alias("clause_work_id")).agg(F.count_distinct("edge_id").alias("edges"))
    lanes = [("no_edges", 1, F.col("edges").isNull() & (F.col("editions") > 1)), ("no_dates", 2, F.col("dates") == 0), ("edges_without_edition", 3, F.col("edges") >= F.col("editions"))]
    return R.gap_work_units(pairs, edges, "clause_work_id", lanes, ("review", 9), "2026-07-27", ["editions", "dates", "edges"])


@query("""WITH e AS (SELECT DISTINCT clause_work_id AS k, effective_from AS v FROM clause_document_expression WHERE effective_from IS NOT NULL AND source_lane = 'current_publication'),
f AS (SELECT DISTINCT g.clause_id AS k, x.effective_from AS v FROM clause_version_edge g JOIN clause_document_expression x ON x.source_version_id = g.newer_clause_version_id WHERE x.effective_from IS NOT NULL AND g.clause_id IS NOT NULL),
n AS (SELECT DISTINCT clause_work_id AS k FROM clause_document_expression WHERE expression_completeness = 'source_complete'), c AS (SELECT DATE '2015-12-31' AS c),
ei AS (SELECT k, v FROM e WHERE v <= '2015-12-31'), fi AS (SELECT k, v FROM f WHERE v <= '2015-12-31'), a AS (SELECT k FROM ei UNION SELECT k FROM fi UNION SELECT k FROM e WHERE v > '2015-12-31'),
mi AS (SELECT * FROM ei EXCEPT SELECT * FROM fi), un AS (SELECT * FROM fi EXCEPT SELECT * FROM ei), po AS (SELECT * FROM e WHERE v > '2015-12-31')
SELECT (SELECT count(*) FROM n) AS known_keys, (SELECT count(*) FROM a) AS audited_keys,
 (SELECT count(*) FROM a WHERE k IN (SELECT k FROM ei) AND k IN (SELECT k FROM fi) AND k NOT IN (SELECT k FROM mi) AND k NOT IN (SELECT k FROM un) AND k NOT IN (SELECT k FROM po)) AS complete_keys,
 (SELECT count(*) FROM mi) AS missing_values, (SELECT count(*) FROM un) AS unexpected_values, (SELECT count(*) FROM po) AS post_cut_values,
 (SELECT count(*) FROM n WHERE k NOT IN (SELECT k FROM a)) AS without_rows, (SELECT count(*) FROM a WHERE k NOT IN (SELECT k FROM n)) AS orphan_keys""")
def a24_dataset_audit(spark, sf_dir):
    """Dates of the works against those that the version edges lead to, over the whole dataset, with orphans."""
    rows = table(spark, sf_dir, "clause_document_expression")
    expected = rows.where("effective_from is not null and source_lane = 'current_publication'").select("clause_work_id", "effective_from")
    edges = table(spark, sf_dir, "clause_version_edge").select(F.col("clause_id").alias("clause_work_id"), F.col("newer_clause_version_id").alias("source_version_id"))
    found = edges.join(rows.where("effective_from is not null").select("source_version_id", "effective_from"), "source_version_id").select("clause_work_id", "effective_from").distinct()
    known = rows.where("expression_completeness = 'source_complete'")
    return R.dataset_audit(expected, found, known, "clause_work_id", "effective_from", F.lit("2015-12-31"))


_UNIT_SQL = "(CASE replace(lower({0}), 'µ', 'μ') " + " ".join(f"WHEN '{s}' THEN '{u}'" for s, u in quantities.UNITS.items()) + " END)"
_SPELL = "個月|微克|毫克|公克|公斤|毫升|單位|小時|mcg|天|日|週|周|月|年|次|iu|μg|mg|kg|ml|u|g|支|粒|瓶|錠"
_NUM = r"[0-9]+(?:\.[0-9]+)?"
_LIMIT_SQL = f"""WITH e AS (SELECT DISTINCT exact_text AS t FROM clause_document_expression), x AS (
SELECT 'periodic_cap' AS kind, unnest(regexp_extract_all(t, '(?i)每[^，。；0-9]{{1,6}}上限為{_NUM}\\s*(?:{_SPELL})')) AS raw FROM e UNION ALL
SELECT 'total_cap', unnest(regexp_extract_all(t, '(?i)總量不超過{_NUM}\\s*(?:{_SPELL})')) FROM e UNION ALL
SELECT 'duration_cap', unnest(regexp_extract_all(t, '(?i)療程以{_NUM}\\s*(?:{_SPELL})為限')) FROM e UNION ALL
SELECT 'recurring_action', unnest(regexp_extract_all(t, '(?i)每{_NUM}\\s*(?:{_SPELL})複查')) FROM e UNION ALL
SELECT 'interval', unnest(regexp_extract_all(t, '(?i)間隔至少{_NUM}\\s*(?:{_SPELL})')) FROM e),
q AS (SELECT kind, raw, CAST(regexp_extract(raw, '({_NUM})\\s*(?:{_SPELL})', 1, 'i') AS DOUBLE) AS value, regexp_extract(raw, '{_NUM}\\s*({_SPELL})', 1, 'i') AS s FROM x),
u AS (SELECT kind, raw, value, {_UNIT_SQL.format("s")} AS unit FROM q)"""


def _limits(spark, sf_dir) -> DataFrame:
    texts = table(spark, sf_dir, "clause_document_expression").select("exact_text").distinct()
    return texts.select(F.explode(quantities.limit_expressions(F.col("exact_text"))).alias("x")).select("x.*")


@query(_LIMIT_SQL + " SELECT kind, raw, value, unit, count(*) AS occurrences FROM u GROUP BY 1, 2, 3, 4")
def t17_compound_expressions(spark, sf_dir):
    """Limits, caps, intervals and recurring actions as typed rows with value and unit, each once with its occurrences."""
    return _limits(spark, sf_dir).groupBy("kind", "raw", "value", "unit").agg(F.count("*").alias("occurrences"))


@query(_LIMIT_SQL + " SELECT value, unit, min(raw) AS spelling, count(DISTINCT raw) AS spellings, count(*) AS occurrences FROM u GROUP BY 1, 2")
def t16_typed_quantities(spark, sf_dir):
    """Quantities inside limit expressions by value and unit, whatever their spelling, with the first spelling of each."""
    return _limits(spark, sf_dir).groupBy("value", "unit").agg(F.min("raw").alias("spelling"), F.count_distinct("raw").alias("spellings"), F.count("*").alias("occurrences"))


@query(f"""WITH e AS (SELECT DISTINCT exact_text AS t FROM clause_document_expression), q AS (SELECT unnest(regexp_extract_all(t, '{_NUM}\\s*(?:{_SPELL}|[A-Za-z]+)', 0, 'i')) AS x FROM e),
s AS (SELECT regexp_extract(x, '{_NUM}\\s*(.+)', 1) AS s FROM q) SELECT s AS spelling, {_UNIT_SQL.format("s")} AS unit, count(*) AS occurrences FROM s GROUP BY 1, 2""")
def f32_units(spark, sf_dir):
    """Spellings behind numbers and the unit of each, null where it is none."""
    texts = table(spark, sf_dir, "clause_document_expression").select("exact_text").distinct()
    found = texts.select(F.explode(F.regexp_extract_all("exact_text", F.lit(rf"(?iu){_NUM}\s*({_SPELL}|[A-Za-z]+)"), F.lit(1))).alias("spelling"))
    return found.groupBy("spelling").agg(F.count("*").alias("occurrences")).select("spelling", quantities.unit_of(F.col("spelling")).alias("unit"), "occurrences")


@query("""WITH e AS (SELECT DISTINCT event_id, reference_number, effective_from, effective_to, supersedes_event_id, status FROM official_event),
t AS (SELECT event_id, CASE WHEN reference_number IS NULL THEN -1 ELSE 1 END AS a, CASE WHEN effective_to IS NULL THEN -1 WHEN effective_to > '2012-01-01' THEN 1 ELSE 0 END AS b, CASE WHEN supersedes_event_id IS NULL THEN 0 ELSE 1 END AS c, CASE WHEN status = 'verified' THEN 1 ELSE 0 END AS d FROM e),
n AS (SELECT event_id, (a = 1)::INT + (b = 1)::INT + (c = 1)::INT + (d = 1)::INT AS y, (a <> 0)::INT + (b <> 0)::INT + (c <> 0)::INT + (d <> 0)::INT AS m FROM t)
SELECT DISTINCT event_id, CASE WHEN y >= 3 THEN 1 WHEN m < 3 THEN 0 ELSE -1 END AS three_or_more, CASE WHEN y > 2 OR m < 2 THEN 0 WHEN y = m THEN 1 ELSE -1 END AS just_two FROM n""")
def g01_aggregates(spark, sf_dir):
    """How many facts of a notice hold, compared with a number, some facts being unknown."""
    rows = table(spark, sf_dir, "official_event").select("event_id", "reference_number", "effective_from", "effective_to", "supersedes_event_id", "status").distinct()
    known = lambda c: F.when(F.col(c).isNotNull(), True)
    facts = [R.truth(known("reference_number")), R.truth(F.col("effective_to") > "2012-01-01"), R.truth(F.col("supersedes_event_id").isNotNull()), R.truth(F.col("status") == "verified")]
    return rows.select("event_id", R.at_least(facts, 3).cast("int").alias("three_or_more"), R.exactly(facts, 2).cast("int").alias("just_two")).distinct()


@query("""WITH a AS (SELECT event_id, user_id, ts, event_type AS kind FROM events WHERE event_type IN ('purchase', 'click')), s AS (SELECT user_id, ts, max(event_type) AS state FROM events WHERE event_type NOT IN ('purchase', 'click') GROUP BY 1, 2),
j AS (SELECT a.*, s.state FROM a ASOF LEFT JOIN s ON a.user_id = s.user_id AND a.ts >= s.ts) SELECT event_id, user_id, kind, state FROM j WHERE NOT coalesce((kind = 'click' AND state IN ('view', 'signup')) OR (kind = 'purchase' AND state = 'view'), false)""")
def g09_disallowed_attempts(spark, sf_dir):
    """Purchases and clicks that the user's state at their time doesn't allow."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    acts = F.col("event_type").isin("purchase", "click")
    allowed = spark.createDataFrame([("click", "view"), ("click", "signup"), ("purchase", "view")], "kind string, state string")
    found = R.disallowed_attempts(events.where(acts).withColumnRenamed("event_type", "kind"), events.where(~acts).select("user_id", "ts", F.col("event_type").alias("state")), ["user_id"], "ts", "kind", "state", allowed)
    return found.select("event_id", "user_id", "kind", "state")


@query("""WITH r AS (SELECT expression_id AS x, min(exact_text_sha256) AS h, min(expression_completeness) AS s FROM clause_document_expression GROUP BY 1),
a AS (SELECT DISTINCT hunk_id, older_expression_id AS x, old_exact_text_sha256 AS h FROM clause_document_diff_hunk)
SELECT hunk_id, concat_ws(',', CASE WHEN r.x IS NOT NULL AND r.s IS DISTINCT FROM 'source_complete' THEN 'not_sealed' END, CASE WHEN r.x IS NOT NULL AND a.h IS DISTINCT FROM r.h THEN 'other_hash' END, CASE WHEN r.x IS NULL THEN 'unknown_run' END) AS reasons
FROM a LEFT JOIN r ON a.x = r.x WHERE r.x IS NULL OR r.s IS DISTINCT FROM 'source_complete' OR a.h IS DISTINCT FROM r.h""")
def k04_invalid_activations(spark, sf_dir):
    """Hunks that build on an expression that isn't there, isn't complete or has another hash."""
    runs = table(spark, sf_dir, "clause_document_expression").groupBy(F.col("expression_id").alias("x")).agg(F.min("exact_text_sha256").alias("h"), F.min("expression_completeness").alias("s"))
    acts = table(spark, sf_dir, "clause_document_diff_hunk").select("hunk_id", F.col("older_expression_id").alias("x"), F.col("old_exact_text_sha256").alias("h")).distinct()
    return gates.invalid_activations(acts, runs, "x", "h", "s", "source_complete").select("hunk_id", F.array_join("reasons", ",").alias("reasons"))


@query("""WITH b AS (SELECT DISTINCT run_id, clause_code, block_order, source_block_id, raw_text, raw_text_sha256 FROM current_clause_block), c AS (SELECT source_block_id, count(*) AS n FROM b GROUP BY 1)
SELECT source_block_id, concat_ws(',', CASE WHEN raw_text_sha256 IS NOT NULL AND raw_text_sha256 <> sha256(raw_text) THEN 'hash_of_another_text' END, CASE WHEN raw_text_sha256 IS NULL THEN 'no_hash' END, CASE WHEN n > 1 THEN 'repeated_identity' END) AS reasons
FROM b JOIN c USING (source_block_id) WHERE raw_text_sha256 IS NULL OR raw_text_sha256 <> sha256(raw_text) OR n > 1""")
def k03_block_inputs(spark, sf_dir):
    """Blocks whose hash isn't that of their text, or whose id stands for several blocks."""
    rows = table(spark, sf_dir, "current_clause_block").select("run_id", "clause_code", "block_order", "source_block_id", "raw_text", "raw_text_sha256").distinct()
    counts = rows.groupBy("source_block_id").agg(F.count("*").alias("n"))
    sha = F.col("raw_text_sha256")
    reasons = gates.reasons_of([("no_hash", sha.isNull()), ("hash_of_another_text", sha != F.sha2("raw_text", 256)), ("repeated_identity", F.col("n") > 1)])
    return rows.join(counts, "source_block_id").select("source_block_id", F.array_join(reasons, ",").alias("reasons")).where("reasons <> ''")


@query("""WITH o AS (SELECT o_custkey AS k, o_orderkey AS id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rank FROM orders), r AS (SELECT k, CAST(ceil(rank / 10.0) AS INT) AS page, CAST(rank AS INT) AS rank FROM o WHERE id % 97 <> 0),
p AS (SELECT k, page, count(*) AS n, min(rank) AS lo, max(rank) AS hi FROM r GROUP BY 1, 2), e AS (SELECT k, min(page) AS f, max(page) AS l, count(*) AS c, bool_or(lo <> (page - 1) * 10 + 1 OR hi <> (page - 1) * 10 + n) AS s, count(*) FILTER (n < 10) AS sh, arg_max(n, page) AS t FROM p GROUP BY 1)
SELECT k AS o_custkey, concat_ws(',', CASE WHEN sh > CASE WHEN t < 10 THEN 1 ELSE 0 END THEN 'page_short' END, CASE WHEN f <> 1 OR l <> c THEN 'pages_missing' END, CASE WHEN s THEN 'ranks_broken' END) AS reasons FROM e WHERE f <> 1 OR l <> c OR s OR sh > CASE WHEN t < 10 THEN 1 ELSE 0 END""")
def k06_broken_pages(spark, sf_dir):
    """Customers whose orders, as pages of ten of which some rows were lost, don't count on from page to page."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.row_number().over(w).alias("rank")).where("o_orderkey % 97 <> 0")
    rows = rows.withColumn("page", F.ceil(F.col("rank") / 10).cast("int"))
    return gates.broken_pages(rows, ["o_custkey"], "page", "rank", 10).select("o_custkey", F.array_join("reasons", ",").alias("reasons"))


@query("""WITH RECURSIVE ev AS (SELECT DISTINCT event_id AS e, supersedes_event_id AS p, datediff('day', DATE '1970-01-01', publication_date) AS s, CASE WHEN effective_to IS NOT NULL THEN datediff('day', DATE '1970-01-01', CAST(effective_to AS DATE)) END AS t FROM official_event),
u AS (SELECT e, min(p) AS p FROM ev GROUP BY 1), up AS (SELECT e, CASE WHEN p IN (SELECT e FROM u) THEN p END AS p FROM u),
w AS (SELECT e, e AS root FROM up WHERE p IS NULL UNION ALL SELECT up.e, w.root FROM up JOIN w ON up.p = w.e),
i AS (SELECT DISTINCT root, s, t FROM ev JOIN w USING (e) WHERE t IS NULL OR t > s),
m AS (SELECT *, max(coalesce(t, 9999999)) OVER (PARTITION BY root ORDER BY s, coalesce(t, 9999999) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM i),
g AS (SELECT *, sum(CASE WHEN before >= s THEN 0 ELSE 1 END) OVER (PARTITION BY root ORDER BY s, coalesce(t, 9999999)) AS island FROM m),
p AS (SELECT root, island, min(s) AS s, max(coalesce(t, 9999999)) AS t FROM g GROUP BY 1, 2)
SELECT root, 'period' AS kind, s AS starts_at, nullif(t, 9999999) AS ends_at FROM p
UNION ALL SELECT root, 'gap', t, nxt FROM (SELECT root, t, lead(s) OVER (PARTITION BY root ORDER BY s) AS nxt FROM p) WHERE nxt IS NOT NULL""")
def w24_continuous_periods(spark, sf_dir):
    """Continuous periods and gaps of every supersession chain, in days from publication to end."""
    day = lambda c: F.unix_date(F.col(c).cast("date")).cast("bigint")
    events = table(spark, sf_dir, "official_event").select("event_id", "supersedes_event_id", day("publication_date").alias("s"), day("effective_to").alias("t")).distinct()
    roots = links.follow_links(events, "event_id", "supersedes_event_id").select(F.col("node").alias("event_id"), "root")
    return merge_intervals(events.join(roots, "event_id"), "root", "s", "t", bucket_width=30).withColumnRenamed("entity", "root")


@query("""WITH c AS (SELECT DISTINCT canonical_code AS d FROM clause_document_expression UNION SELECT DISTINCT '通則第' || split_part(canonical_code, '.', 3) || '條' FROM clause_document_expression UNION SELECT DISTINCT edition_label FROM source_edition)
SELECT d AS designation, CASE WHEN regexp_full_match(d, '通則第[0-9]{1,3}條') THEN '0.' || CAST(regexp_extract(d, '[0-9]+') AS INT) WHEN regexp_full_match(d, '[0-9]{1,2}(\\.[0-9]{1,3})+') THEN d END AS code,
CASE WHEN regexp_full_match(d, '通則第[0-9]{1,3}條') THEN 0 WHEN regexp_full_match(d, '[0-9]{1,2}(\\.[0-9]{1,3})+') THEN CAST(split_part(d, '.', 1) AS INT) END AS chapter,
CASE WHEN NOT regexp_full_match(d, '通則第[0-9]{1,3}條|[0-9]{1,2}(\\.[0-9]{1,3})+') THEN 'unsupported' END AS error FROM c""")
def f30_canonical_codes(spark, sf_dir):
    """Codes, general rules and labels as canonical codes, or with the error of those that are none."""
    codes = table(spark, sf_dir, "clause_document_expression").select("canonical_code").distinct()
    general = codes.select(F.concat(F.lit("通則第"), F.split("canonical_code", r"\.")[2], F.lit("條")))
    every = codes.union(general).union(table(spark, sf_dir, "source_edition").select("edition_label")).distinct().toDF("designation")
    made = every.select("designation", text.canonical_code(F.col("designation")).alias("x"))
    return made.select("designation", "x.code", "x.chapter", "x.error")


@query("""WITH e AS (SELECT edition_import_run_id AS r, source_edition_version_id AS v, max(chronology_order) AS o FROM source_edition GROUP BY 1, 2), a AS (SELECT r, v FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY o DESC, v DESC) AS n FROM e) WHERE n = 1),
x AS (SELECT a.r, d.clause_work_id AS w, d.expression_id AS i, d.recorded_at AS t, d.reader_state AS s FROM clause_document_expression d JOIN a ON a.v = d.source_edition_version_id),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r, w ORDER BY t DESC, i DESC) AS n FROM x) WHERE n = 1)
SELECT r AS edition_import_run_id, w AS clause_work_id, i AS expression_id FROM l WHERE s = 'current_effective_complete'""")
def w03_chained_activation(spark, sf_dir):
    """Of each run's latest edition the latest expression of every clause, if that one is complete: a latest state chained on another."""
    editions = table(spark, sf_dir, "source_edition").select(F.col("edition_import_run_id").alias("r"), F.col("source_edition_version_id").alias("v"), F.col("chronology_order").alias("o"))
    active = editions.groupBy("r").agg(F.max(F.struct("o", "v"))["v"].alias("v"))
    rows = table(spark, sf_dir, "clause_document_expression").withColumnRenamed("source_edition_version_id", "v").join(active, "v")
    last = rows.groupBy("r", "clause_work_id").agg(F.max(F.struct("recorded_at", "expression_id", "reader_state")).alias("x"))
    found = last.where("x.reader_state = 'current_effective_complete'")
    return found.select(F.col("r").alias("edition_import_run_id"), "clause_work_id", F.col("x.expression_id").alias("expression_id"))


@query("""WITH i AS (SELECT DISTINCT event_id, 'initial' AS dispatch, issuer FROM official_event WHERE supersedes_event_id IS NULL), r AS (SELECT DISTINCT event_id, 'recovery' AS dispatch, issuer, supersedes_event_id AS p FROM official_event WHERE supersedes_event_id IS NOT NULL),
k AS (SELECT DISTINCT event_id AS p, event_type AS of FROM official_event)
SELECT event_id, dispatch, issuer, NULL AS recovers FROM i UNION ALL SELECT r.event_id, dispatch, issuer, coalesce(k.of, 'unknown') FROM r LEFT JOIN k USING (p)""")
def u02_dispatch_union(spark, sf_dir):
    """First notices and those that recover an earlier one under one schema, with the kind of what is recovered."""
    rows = table(spark, sf_dir, "official_event").select("event_id", "issuer", "supersedes_event_id", "event_type").distinct()
    first = rows.where("supersedes_event_id is null").select("event_id", F.lit("initial").alias("dispatch"), "issuer", F.lit(None).cast("string").alias("recovers")).distinct()
    kinds = rows.select(F.col("event_id").alias("supersedes_event_id"), F.col("event_type").alias("of")).distinct()
    again = rows.where("supersedes_event_id is not null").drop("event_type").distinct().join(kinds, "supersedes_event_id", "left")
    return first.unionByName(again.select("event_id", F.lit("recovery").alias("dispatch"), "issuer", F.coalesce("of", F.lit("unknown")).alias("recovers")))


@query("""WITH c AS (SELECT DISTINCT canonical_code AS k FROM clause_document_expression), e AS (SELECT DISTINCT expression_id AS i, exact_text AS t FROM clause_document_expression),
m AS (SELECT i, unnest(regexp_extract_all(t, '[0-9]{1,2}\\.[0-9]{1,3}\\.[0-9]{1,3}')) AS d FROM e)
SELECT i AS expression_id, d AS designation, count(*) AS occurrences, d IN (SELECT k FROM c) AS listed FROM m GROUP BY 1, 2""")
def t13_designations(spark, sf_dir):
    """Designations that the texts mention, and whether the master list has them."""
    rows = table(spark, sf_dir, "clause_document_expression")
    found = rows.select("expression_id", "exact_text").distinct().select("expression_id", F.explode(F.regexp_extract_all("exact_text", F.lit(r"([0-9]{1,2}\.[0-9]{1,3}\.[0-9]{1,3})"), F.lit(1))).alias("designation"))
    counts = found.groupBy("expression_id", "designation").agg(F.count("*").alias("occurrences"))
    listed = rows.select(F.col("canonical_code").alias("designation")).distinct().withColumn("hit", F.lit(True))
    return counts.join(listed, "designation", "left").select("expression_id", "designation", "occurrences", F.col("hit").isNotNull().alias("listed"))


# A small curated lexicon, terms and the chapters that they point to.
LEXICON = [("轉胺酶", ["8"]), ("骨髓", ["1", "4"]), ("白蛋白", ["3"]), ("血鈣", ["5", "99"]), ("biopsy", ["9"]), ("allergy", ["6"])]


@query("""WITH l(term, codes) AS (VALUES ('轉胺酶', ['8']), ('骨髓', ['1', '4']), ('白蛋白', ['3']), ('血鈣', ['5', '99']), ('biopsy', ['9']), ('allergy', ['6'])), e AS (SELECT DISTINCT expression_id AS i, exact_text AS t FROM clause_document_expression),
h AS (SELECT i, term, unnest(codes) AS code FROM e JOIN l ON contains(t, term)), m AS (SELECT DISTINCT split_part(canonical_code, '.', 1) AS code FROM clause_document_expression)
SELECT i AS expression_id, string_agg(DISTINCT term, ',' ORDER BY term) AS terms, string_agg(DISTINCT code, ',' ORDER BY code) AS codes, CAST(count(DISTINCT code) FILTER (code NOT IN (SELECT code FROM m)) AS INT) AS unknown_codes FROM h GROUP BY 1""")
def t14_lexicon_presence(spark, sf_dir):
    """Terms of the lexicon in each text with their chapters, and how many of these the codes don't have."""
    rows = table(spark, sf_dir, "clause_document_expression")
    chapters = rows.select(F.split("canonical_code", r"\.")[0].alias("code")).distinct()
    found, unknown = tagging.lexicon_presence(rows.select("expression_id", "exact_text").distinct(), "expression_id", "exact_text", LEXICON, chapters, "code")
    # One row: the lexicon's own few codes.
    missing = unknown.agg(F.collect_set("code").alias("missing"))
    found = found.crossJoin(F.broadcast(missing)).withColumn("unknown_codes", F.size(F.array_intersect("codes", "missing")))
    return found.select("expression_id", F.array_join("terms", ",").alias("terms"), F.array_join("codes", ",").alias("codes"), "unknown_codes")


_FIELDS = ["subject", "issuer", "reference_number", "event_type", "status", "detail_url"]


@query("WITH e AS (SELECT DISTINCT event_id, " + ", ".join(_FIELDS) + " FROM official_event), w AS (" + " UNION ALL ".join(
    f"SELECT event_id, '{c}' AS field, unnest(regexp_extract_all(lower({c}), '[a-z]+|\\p{{Nd}}+|[㐀-鿿]')) AS term FROM e" for c in _FIELDS
) + ") SELECT term, field, count(*) AS occurrences, count(DISTINCT event_id) AS events FROM w GROUP BY 1, 2")
def t10_field_index(spark, sf_dir):
    """The inverted index over six text columns of the notices."""
    index = tagging.field_index(table(spark, sf_dir, "official_event").select("event_id", *_FIELDS).distinct(), "event_id", _FIELDS)
    return index.groupBy("term", "field").agg(F.sum("term_count").alias("occurrences"), F.count_distinct("event_id").alias("events"))


@query("""WITH r AS (SELECT DISTINCT clause_work_id AS w, effective_from AS d, source_lane AS l, expression_completeness AS f FROM clause_document_expression WHERE effective_from IS NOT NULL)
SELECT w AS clause_work_id, d AS effective_from, CASE WHEN bool_or(f = 'source_complete') AND bool_or(f <> 'source_complete') THEN 'both' WHEN bool_or(f = 'source_complete') THEN 'native_only' ELSE 'derived_only' END AS evidence, count(DISTINCT l) AS lanes FROM r GROUP BY 1, 2""")
def j13_lane_evidence(spark, sf_dir):
    """For every work and date whether native, derived or both kinds of texts show it."""
    native = F.col("expression_completeness") == "source_complete"
    rows = table(spark, sf_dir, "clause_document_expression").where("effective_from is not null").groupBy("clause_work_id", "effective_from")
    made = rows.agg(F.bool_or(native).alias("n"), F.bool_or(~native).alias("o"), F.count_distinct("source_lane").alias("lanes"))
    return made.select("clause_work_id", "effective_from", F.when(F.col("n") & F.col("o"), "both").when(F.col("n"), "native_only").otherwise("derived_only").alias("evidence"), "lanes")


@query("""WITH b AS (SELECT DISTINCT source_block_id, block_order FROM current_clause_block), c(lo, hi, doc) AS (VALUES (0, 2, 'cover'), (2, 5, 'body'), (5, 9, 'annex'))
SELECT source_block_id, coalesce(doc, 'unassigned') AS document, CASE WHEN doc IS NOT NULL THEN doc || '#' || (block_order - lo) END AS locator FROM b LEFT JOIN c ON block_order >= lo AND block_order < hi""")
def j22_render_locators(spark, sf_dir):
    """Blocks with the document that a table of ranges of their orders names, and their place in it."""
    ranges = [(0, 2, "cover"), (2, 5, "body"), (5, 9, "annex")]
    rows = table(spark, sf_dir, "current_clause_block").select("source_block_id", "block_order").distinct()
    doc, place = F.lit(None).cast("string"), F.lit(None).cast("int")
    for lo, hi, name in ranges:
        inside = (F.col("block_order") >= lo) & (F.col("block_order") < hi)
        doc, place = F.when(inside, name).otherwise(doc), F.when(inside, F.col("block_order") - lo).otherwise(place)
    return rows.select("source_block_id", F.coalesce(doc, F.lit("unassigned")).alias("document"), F.concat(doc, F.lit("#"), place.cast("string")).alias("locator"))


@query("""WITH n AS (SELECT sha256(string_agg(h, chr(10) ORDER BY h)) AS f FROM (SELECT sha256('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || '}') AS h FROM nation)),
r AS (SELECT sha256(string_agg(h, chr(10) ORDER BY h)) AS f FROM (SELECT sha256('{"r_name":"' || r_name || '","r_regionkey":' || r_regionkey || '}') AS h FROM region)),
s AS (SELECT sha256(string_agg(h, chr(10) ORDER BY h)) AS f FROM (SELECT sha256('{"s_name":"' || s_name || '","s_suppkey":' || s_suppkey || '}') AS h FROM supplier))
SELECT sha256('nation=' || n.f || chr(10) || 'region=' || r.f || chr(10) || 'supplier=' || s.f) AS fingerprint, 3 AS parts FROM n, r, s""")
def a22_object_fingerprint(spark, sf_dir):
    """One fingerprint of three tables together."""
    made = None
    for name, columns in (("supplier", ["s_suppkey", "s_name"]), ("nation", ["n_nationkey", "n_name"]), ("region", ["r_regionkey", "r_name"])):
        row = ids.portable_fingerprint(table(spark, sf_dir, name), columns).select(F.lit(name).alias("name"), "fingerprint")
        made = row if made is None else made.unionByName(row)
    return ids.object_fingerprint(made, "name", "fingerprint")


@query("""WITH b AS (SELECT DISTINCT clause_code AS k, source_block_id AS i, raw_text AS t, regexp_extract(raw_text, '^[^，。]{0,8}') AS m, block_kind = 'paragraph' AS p FROM current_clause_block),
o AS (SELECT * FROM b WHERE p), n AS (SELECT * FROM b WHERE NOT p),
m1 AS (SELECT k, x.i AS old_id, y.i AS new_id FROM (SELECT k, t, any_value(i) AS i FROM o GROUP BY 1, 2 HAVING count(*) = 1) x JOIN (SELECT k, t, any_value(i) AS i FROM n GROUP BY 1, 2 HAVING count(*) = 1) y USING (k, t)),
o2 AS (SELECT * FROM o WHERE i NOT IN (SELECT old_id FROM m1)), n2 AS (SELECT * FROM n WHERE i NOT IN (SELECT new_id FROM m1)),
m2 AS (SELECT k, x.i AS old_id, y.i AS new_id FROM (SELECT k, m, any_value(i) AS i FROM o2 GROUP BY 1, 2 HAVING count(*) = 1) x JOIN (SELECT k, m, any_value(i) AS i FROM n2 GROUP BY 1, 2 HAVING count(*) = 1) y USING (k, m))
SELECT k AS clause_code, old_id, new_id, 0 AS stage FROM m1 UNION ALL SELECT k, old_id, new_id, 1 FROM m2
UNION ALL SELECT k, i, NULL, NULL FROM o2 WHERE i NOT IN (SELECT old_id FROM m2) UNION ALL SELECT k, NULL, i, NULL FROM n2 WHERE i NOT IN (SELECT new_id FROM m2)""")
def x07_staged_alignment(spark, sf_dir):
    """Paragraphs and other blocks of a code matched by text, then by kind and opening, each only where unique on both sides."""
    marker = F.regexp_extract("raw_text", "^[^，。]{0,8}", 0)
    rows = table(spark, sf_dir, "current_clause_block").select("clause_code", "source_block_id", "raw_text", "block_kind", marker.alias("marker")).distinct()
    is_paragraph = F.col("block_kind") == "paragraph"
    return diff.unique_matches(rows.where(is_paragraph), rows.where(~is_paragraph), ["clause_code"], "source_block_id", "source_block_id", ["raw_text", "marker"])
