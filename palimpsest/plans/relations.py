"""Queries of joins, aggregates, sets, reconciliation, gates and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.operators import gates, parity
from palimpsest.operators import resolution as R
from palimpsest.operators.links import follow_links
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


EDGES = "(SELECT DISTINCT edge_id, clause_id, older_clause_version_id AS o, newer_clause_version_id AS n FROM clause_version_edge)"
SEEN = "(SELECT source_version_id AS v, min(effective_from) AS f, count(DISTINCT expression_id) AS k FROM clause_document_expression WHERE source_version_id IS NOT NULL GROUP BY 1)"


def _versions(spark, sf_dir):
    rows = table(spark, sf_dir, "clause_document_expression").where("source_version_id is not null")
    return rows.groupBy(F.col("source_version_id").alias("v")).agg(F.min("effective_from").alias("f"), F.count_distinct("expression_id").alias("k"))


def _edges(spark, sf_dir):
    return table(spark, sf_dir, "clause_version_edge").select("edge_id", "clause_id", F.col("older_clause_version_id").alias("o"), F.col("newer_clause_version_id").alias("n")).distinct()


@query("SELECT n_name, r_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2")
def j01_equi_join(spark, sf_dir):
    """Inner joins along keys."""
    t = lambda n: table(spark, sf_dir, n)
    rows = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy("n_name", "r_name").agg(F.count("*").alias("customers"))


@query(f"SELECT e.edge_id, a.f AS older_from, b.f AS newer_from, a.k AS older_count, b.k AS newer_count FROM {EDGES} e JOIN {SEEN} a ON e.o = a.v JOIN {SEEN} b ON e.n = b.v")
def j02_edge_ends(spark, sf_dir):
    """Edges with both of their versions."""
    v = _versions(spark, sf_dir)
    older = v.select(F.col("v").alias("o"), F.col("f").alias("older_from"), F.col("k").alias("older_count"))
    newer = v.select(F.col("v").alias("n"), F.col("f").alias("newer_from"), F.col("k").alias("newer_count"))
    return _edges(spark, sf_dir).join(older, "o").join(newer, "n").select("edge_id", "older_from", "newer_from", "older_count", "newer_count")


@query(f"SELECT e.edge_id, a.v IS NOT NULL AS mapped FROM {EDGES} e LEFT JOIN {SEEN} a ON e.n = a.v")
def j03_mapped_flag(spark, sf_dir):
    """Edges, and whether some expression shows their newer version."""
    seen = _versions(spark, sf_dir).select(F.col("v").alias("n"), F.lit(True).alias("hit"))
    return _edges(spark, sf_dir).join(seen, "n", "left").select("edge_id", F.col("hit").isNotNull().alias("mapped"))


@query("""SELECT c.c_custkey, count(o.o_orderkey) AS orders, max(o.o_orderdate) AS last_order FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY 1""")
def j04_lateral_aggregate(spark, sf_dir):
    """Customers with aggregates of their orders, those without included; aggregated before the join."""
    facts = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.max("o_orderdate").alias("last_order"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(facts, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("orders"), "last_order")


@query("SELECT p_partkey, p_brand FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R')")
def j06_semi_join(spark, sf_dir):
    """Parts that were returned."""
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand").join(returned, "p_partkey", "left_semi")


@query("SELECT p_partkey, p_name FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity > 40)")
def j07_anti_join(spark, sf_dir):
    """Parts of which no large quantity was returned (backlog)."""
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' and l_quantity > 40").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, sf_dir, "part").select("p_partkey", "p_name").join(returned, "p_partkey", "left_anti")


@query(f"""WITH a AS (SELECT DISTINCT v FROM {SEEN}), b AS (SELECT o AS v FROM {EDGES} UNION SELECT n FROM {EDGES})
SELECT coalesce(a.v, b.v) AS v, CASE WHEN a.v IS NULL THEN 'right' ELSE 'left' END AS side FROM a FULL JOIN b ON a.v = b.v WHERE a.v IS NULL OR b.v IS NULL""")
def j08_membership_difference(spark, sf_dir):
    """Versions that only the expressions or only the edges name."""
    e = _edges(spark, sf_dir)
    named = e.select(F.col("o").alias("v")).union(e.select("n"))
    return gates.membership_difference(_versions(spark, sf_dir).select("v"), named, ["v"])


@query("""WITH s AS (SELECT hunk_id, segment_order, old_text, new_text, segment_kind FROM clause_document_inline_diff_segment GROUP BY ALL),
a AS (SELECT hunk_id, segment_order, old_text AS t FROM s WHERE segment_kind <> 'inserted'), b AS (SELECT hunk_id, segment_order, new_text AS t FROM s WHERE segment_kind <> 'deleted')
SELECT coalesce(a.hunk_id, b.hunk_id) AS hunk_id, coalesce(a.segment_order, b.segment_order) AS segment_order FROM a FULL JOIN b USING (hunk_id, segment_order)
WHERE a.t IS DISTINCT FROM b.t OR a.hunk_id IS NULL OR b.hunk_id IS NULL""")
def j09_replay_difference(spark, sf_dir):
    """Steps at which the old and new sides of the diff segments differ."""
    rows = table(spark, sf_dir, "clause_document_inline_diff_segment").select("hunk_id", "segment_order", "old_text", "new_text", "segment_kind").distinct()
    old = rows.where("segment_kind <> 'inserted'").select("hunk_id", "segment_order", F.col("old_text").alias("t"))
    new = rows.where("segment_kind <> 'deleted'").select("hunk_id", "segment_order", F.col("new_text").alias("t"))
    return gates.replay_difference(old, new, ["hunk_id"], "segment_order", ["t"])


@query("""WITH m AS (SELECT DISTINCT expression_id AS marker, effective_from AS d, canonical_code AS md FROM clause_document_expression),
e AS (SELECT DISTINCT event_id AS event, CAST(publication_date AS VARCHAR) AS d, CASE WHEN event_type = 'announcement' THEN NULL ELSE '1' END AS ed FROM official_event),
p AS (SELECT m.*, e.event, CASE WHEN e.event IS NULL THEN NULL WHEN md IS NULL OR ed IS NULL THEN 'indeterminate' WHEN md = ed THEN 'compatible' ELSE 'incompatible' END AS fit FROM m LEFT JOIN e USING (d)),
f AS (SELECT marker, bool_or(d IS NULL) AS nod, count(event) AS c, count(*) FILTER (fit = 'compatible') AS k, count(*) FILTER (fit = 'indeterminate') AS u,
 array_to_string(list_sort(list(DISTINCT event) FILTER (fit <> 'incompatible')), ',') AS ids FROM p GROUP BY 1)
SELECT marker, CASE WHEN nod THEN 'invalid_date' WHEN c = 0 THEN 'no_match' WHEN k + u = 0 THEN 'no_compatible' WHEN k + u > 1 THEN 'ambiguous' WHEN u = 1 THEN 'indeterminate' ELSE 'resolved' END AS status,
c AS candidates, k AS compatible, coalesce(ids, '') AS event_ids FROM f""")
def g04_resolve_markers(spark, sf_dir):
    """Expressions' dates against the notices published that day, with a status lattice."""
    markers = table(spark, sf_dir, "clause_document_expression").select(F.col("expression_id").alias("marker"), F.col("effective_from").alias("d"), F.col("canonical_code").alias("md")).distinct()
    events = table(spark, sf_dir, "official_event").select(F.col("event_id").alias("event"), F.col("publication_date").cast("string").alias("d"), F.when(F.col("event_type") != "announcement", "1").alias("ed")).distinct()
    found = R.resolve_markers(markers.withColumnRenamed("md", "x"), events.withColumnRenamed("ed", "x"), marker="marker", event="event", date="d", designation="x")
    return found.withColumn("event_ids", F.array_join("event_ids", ","))


@query("""WITH a AS (SELECT DISTINCT canonical_code AS k, source_edition_version_id AS f FROM clause_document_expression WHERE effective_from IS NOT NULL),
b AS (SELECT DISTINCT canonical_code AS k, source_edition_version_id AS f FROM clause_document_expression WHERE source_version_id IS NOT NULL),
j AS (SELECT a.k, count(*) AS n, array_to_string(list_sort(list(a.f)), ',') AS fs FROM a JOIN b USING (k, f) GROUP BY 1), u AS (SELECT k FROM a UNION SELECT k FROM b)
SELECT u.k AS code, coalesce(fs, '') AS artifacts, CAST(coalesce(n, 0) AS INT) AS joint_count, CASE WHEN coalesce(n, 0) = 0 THEN 'none' WHEN n = 1 THEN 'unique' ELSE 'ambiguous' END AS joint_class FROM u LEFT JOIN j USING (k)""")
def j12_joint_artifacts(spark, sf_dir):
    """Per code the editions that hold both a dated and a versioned expression."""
    rows = table(spark, sf_dir, "clause_document_expression").select(F.col("canonical_code").alias("code"), F.col("source_edition_version_id").alias("f"), "effective_from", "source_version_id")
    found = R.joint_artifacts(rows.where("effective_from is not null"), rows.where("source_version_id is not null"), "code", "f")
    return found.withColumn("artifacts", F.coalesce(F.array_join("artifacts", ","), F.lit("")))


@query("""WITH RECURSIVE ev AS (SELECT DISTINCT event_id AS e, supersedes_event_id AS p FROM official_event), up AS (
SELECT e, CASE WHEN p IN (SELECT e FROM ev) THEN p END AS p FROM ev), walk AS (
SELECT e AS node, e AS root, 0 AS depth FROM up WHERE p IS NULL UNION ALL SELECT u.e, w.root, w.depth + 1 FROM up u JOIN walk w ON u.p = w.node)
SELECT node, root, CAST(depth AS BIGINT) AS depth FROM walk""")
def n08_closure(spark, sf_dir):
    """Root and depth of every event along the supersession links (pointer doubling instead of recursion)."""
    return follow_links(table(spark, sf_dir, "official_event"), "event_id", "supersedes_event_id")


@query("""WITH l AS (SELECT o_custkey AS k, list_sort(list(DISTINCT o_orderpriority)) AS v, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
r AS (SELECT o_custkey AS k, list_sort(list(DISTINCT o_orderpriority)) AS v, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT coalesce(l.k, r.k) AS o_custkey, coalesce(array_to_string(l.v, ','), '') AS left_values, coalesce(array_to_string(r.v, ','), '') AS right_values, coalesce(l.n, 0) AS left_count, coalesce(r.n, 0) AS right_count,
CASE WHEN l.k IS NULL THEN 'right_only' WHEN r.k IS NULL THEN 'left_only' ELSE 'both' END AS status, coalesce(l.n, 0) > 1 OR coalesce(r.n, 0) > 1 AS collides FROM l FULL JOIN r ON l.k = r.k""")
def j16_grouped_reconcile(spark, sf_dir):
    """Finished against open orders by customer, grouped on both sides."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus")
    found = parity.grouped_reconcile(orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus = 'O'"), "o_custkey", "o_orderpriority", "o_orderpriority")
    flat = {c: F.coalesce(F.array_join(c, ","), F.lit("")) for c in ("left_values", "right_values")}
    return found.withColumns(flat)


@query("""WITH g AS (SELECT year(o_orderdate) AS y, o_custkey AS k, bool_or(o_orderstatus = 'F') AS f, bool_or(o_orderstatus = 'O') AS o FROM orders GROUP BY 1, 2)
SELECT CAST(y AS INT) AS year, count(*) FILTER (f AND o) AS both_sides, count(*) FILTER (f AND NOT o) AS left_only, count(*) FILTER (o AND NOT f) AS right_only FROM g GROUP BY 1""")
def a17_year_overlap(spark, sf_dir):
    """Per year, customers with finished, open or both kinds of orders."""
    f, o = F.col("f"), F.col("o")
    rows = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"), "o_custkey").agg(F.bool_or(F.col("o_orderstatus") == "F").alias("f"), F.bool_or(F.col("o_orderstatus") == "O").alias("o"))
    return rows.groupBy("year").agg(F.count_if(f & o).alias("both_sides"), F.count_if(f & ~o).alias("left_only"), F.count_if(o & ~f).alias("right_only"))


@query("""SELECT s.l_suppkey, l.l_linestatus, l.n AS n FROM (SELECT DISTINCT l_suppkey FROM lineitem) s JOIN (SELECT l_suppkey, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2) l USING (l_suppkey)""")
def j10_grouped_lateral(spark, sf_dir):
    """Per supplier the line counts by status."""
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_linestatus").agg(F.count("*").alias("n"))


@query("""WITH o AS (SELECT o_custkey AS k, o_orderkey AS i, o_orderdate AS s, o_orderdate + INTERVAL 30 DAY AS e FROM orders)
SELECT i AS o_orderkey FROM (SELECT *, max(e) OVER (PARTITION BY k ORDER BY s, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM o) WHERE m > s""")
def j18_overlap_guard(spark, sf_dir):
    """Orders whose 30-day interval overlaps an earlier one of the customer."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("s"), (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("e"))
    return gates.overlapping_intervals(rows, ["o_custkey"], "s", "e", ["o_orderkey"]).select("o_orderkey")


@query("""WITH x AS (SELECT DISTINCT l_partkey AS p FROM lineitem WHERE l_returnflag = 'R') SELECT p_partkey, CASE WHEN x.p IS NULL THEN 'default' ELSE 'exception' END AS lane FROM part LEFT JOIN x ON x.p = p_partkey""")
def j23_exception_lane(spark, sf_dir):
    """Parts with the lane of listed exceptions or the default."""
    listed = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey")).distinct().withColumn("x", F.lit(True))
    return table(spark, sf_dir, "part").select("p_partkey").join(listed, "p_partkey", "left").select("p_partkey", F.when(F.col("x"), "exception").otherwise("default").alias("lane"))


@query("""WITH c AS (SELECT DISTINCT canonical_code AS c FROM clause_document_expression UNION SELECT DISTINCT split_part(canonical_code, '.', 1) || '.' || split_part(canonical_code, '.', 2) FROM clause_document_expression)
SELECT c AS code FROM c a WHERE NOT EXISTS (SELECT 1 FROM c b WHERE starts_with(b.c, a.c || '.'))""")
def filter_p09_leaf_codes(spark, sf_dir):
    """Codes with no longer code below them (prefix join as an equi-join)."""
    code = F.col("canonical_code")
    parts = F.split(code, r"\.")
    rows = table(spark, sf_dir, "clause_document_expression").select(F.explode(F.array(code, F.concat_ws(".", parts[0], parts[1]))).alias("code")).distinct()
    return gates.leaf_mismatches(rows, [], "code")


@query("""SELECT count(*) AS row_count, count(*) FILTER (status = 'verified') AS verified, count(*) FILTER (effective_to IS NULL) AS open_ended, count(DISTINCT issuer) AS issuers,
count(DISTINCT CASE WHEN status = 'verified' THEN issuer END) AS verified_issuers, CAST(min(publication_date) AS VARCHAR) AS first_date, CAST(max(publication_date) AS VARCHAR) AS last_date FROM official_event""")
def a01_filtered_counts(spark, sf_dir):
    """Global counts with filters, distinct counts and extremes in one pass."""
    verified = F.col("status") == "verified"
    return table(spark, sf_dir, "official_event").agg(
        F.count("*").alias("row_count"), F.count_if(verified).alias("verified"), F.count_if(F.col("effective_to").isNull()).alias("open_ended"), F.count_distinct("issuer").alias("issuers"),
        F.count_distinct(F.when(verified, F.col("issuer"))).alias("verified_issuers"), F.min("publication_date").cast("string").alias("first_date"), F.max("publication_date").cast("string").alias("last_date"),
    )


@query("""SELECT k.kind, count(e.event_id) AS n FROM (VALUES ('amendment'), ('announcement'), ('correction'), ('withdrawal')) k(kind) LEFT JOIN (SELECT DISTINCT event_id, event_type FROM official_event) e ON e.event_type = k.kind GROUP BY 1""")
def a02_counts_with_zero_groups(spark, sf_dir):
    """Counts by kind, with zero for kinds that don't occur."""
    kinds = spark.createDataFrame([("amendment",), ("announcement",), ("correction",), ("withdrawal",)], "kind string")
    counts = table(spark, sf_dir, "official_event").select("event_id", F.col("event_type").alias("kind")).distinct().groupBy("kind").agg(F.count("*").alias("n"))
    return kinds.join(counts, "kind", "left").select("kind", F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderdate, o_orderkey) AS order_list, count(*) AS n FROM orders GROUP BY 1")
def a05_ordered_aggregate(spark, sf_dir):
    """Order keys of each customer in order of date."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey"))), lambda x: x["o_orderkey"].cast("string"))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_join(listed, ",").alias("order_list"), F.count("*").alias("n"))


@query("""WITH s AS (SELECT DISTINCT hunk_id, segment_order, new_text FROM clause_document_inline_diff_segment) SELECT hunk_id, coalesce(string_agg(coalesce(new_text, ''), '' ORDER BY segment_order), '') AS new_text FROM s GROUP BY 1""")
def a06_text_replay(spark, sf_dir):
    """The new text of each hunk, joined from its segments."""
    rows = table(spark, sf_dir, "clause_document_inline_diff_segment").select("hunk_id", "segment_order", F.coalesce("new_text", F.lit("")).alias("t")).distinct()
    joined = F.transform(F.array_sort(F.collect_list(F.struct("segment_order", "t"))), lambda x: x["t"])
    return rows.groupBy("hunk_id").agg(F.array_join(joined, "").alias("new_text"))


@query("SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2 HAVING count(DISTINCT c_name) > 1")
def a09_collisions(spark, sf_dir):
    """Keys that stand for more than one thing."""
    rows = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count_distinct("c_name").alias("names"), F.count("*").alias("n"))
    return rows.where("names > 1").drop("names")


@query("SELECT event_id, count(*) AS row_count FROM official_event GROUP BY 1 HAVING count(*) <> 1")
def a10_uniqueness_gate(spark, sf_dir):
    """Keys that were delivered more than once."""
    return gates.duplicate_keys(table(spark, sf_dir, "official_event"), ["event_id"])


@query("SELECT source, bool_or(text IS NULL) AS any_null, coalesce(sum(c - 1), 0) AS collapsed FROM (SELECT source, text, count(*) AS c FROM documents GROUP BY 1, 2) GROUP BY 1")
def a11_duplicate_collapse(spark, sf_dir):
    """Per source whether a text is missing, and how many rows are repeats of another."""
    rows = table(spark, sf_dir, "documents").groupBy("source", F.xxhash64(F.col("text").isNull(), "text").alias("h"), F.xxhash64(F.lit(1), "text").alias("h2")).agg(F.count("*").alias("c"), F.bool_or(F.col("text").isNull()).alias("empty"))
    return rows.groupBy("source").agg(F.bool_or("empty").alias("any_null"), F.sum(F.col("c") - 1).alias("collapsed"))


@query("""WITH s AS (SELECT DISTINCT run_id, clause_code, block_order FROM current_clause_block WHERE block_kind <> 'table_cell'),
f AS (SELECT run_id, clause_code, min(block_order) AS lowest, max(block_order) AS highest, count(*) AS row_count, count(DISTINCT block_order) AS distinct_count FROM s GROUP BY 1, 2)
SELECT * FROM f WHERE NOT (lowest = 0 AND highest = row_count - 1 AND distinct_count = row_count)""")
def a15_contiguity_gate(spark, sf_dir):
    """Clauses whose paragraphs and list items, table cells aside, aren't numbered 0, 1, 2 and so on."""
    rows = table(spark, sf_dir, "current_clause_block").where("block_kind <> 'table_cell'").select("run_id", "clause_code", "block_order").distinct()
    return gates.broken_sequences(rows, ["run_id", "clause_code"], "block_order")


@query("""SELECT CAST(n AS BIGINT) AS candidates, count(*) AS keys FROM (SELECT canonical_code, count(DISTINCT clause_work_id) AS n FROM clause_document_expression GROUP BY 1) GROUP BY 1""")
def a18_candidate_histogram(spark, sf_dir):
    """How many codes have how many works."""
    return table(spark, sf_dir, "clause_document_expression").groupBy("canonical_code").agg(F.count_distinct("clause_work_id").alias("candidates")).groupBy("candidates").agg(F.count("*").alias("keys"))


@query("""WITH s AS (SELECT clause_work_id AS k, effective_from AS d FROM clause_document_expression WHERE effective_from IS NOT NULL AND effective_from <= '2015-12-31'),
e AS (SELECT k, list_sort(list(DISTINCT d)) AS v FROM s GROUP BY 1), f AS (SELECT clause_work_id AS k, list_sort(list(DISTINCT effective_from)) AS v FROM clause_document_expression WHERE source_lane = 'current_publication' AND effective_from <= '2015-12-31' GROUP BY 1),
p AS (SELECT clause_work_id AS k, list_sort(list(DISTINCT effective_from)) AS v FROM clause_document_expression WHERE effective_from > '2015-12-31' GROUP BY 1),
j AS (SELECT coalesce(e.k, f.k, p.k) AS k, coalesce(e.v, []) AS ev, coalesce(f.v, []) AS fv, coalesce(p.v, []) AS pv FROM e FULL JOIN f ON e.k = f.k FULL JOIN p ON coalesce(e.k, f.k) = p.k),
d AS (SELECT *, list_filter(ev, lambda x: NOT list_contains(fv, x)) AS m, list_filter(fv, lambda x: NOT list_contains(ev, x)) AS u FROM j)
SELECT k AS clause_work_id, array_to_string(m, ',') AS missing, array_to_string(u, ',') AS unexpected, array_to_string(pv, ',') AS post_cut,
concat_ws(',', CASE WHEN len(fv) = 0 THEN 'no_evidence' END, CASE WHEN len(ev) = 0 THEN 'not_expected' END, CASE WHEN len(m) > 0 THEN 'values_missing' END, CASE WHEN len(u) > 0 THEN 'values_unexpected' END, CASE WHEN len(pv) > 0 THEN 'values_after_cut' END) AS reasons FROM d""")
def a23_coverage_audit(spark, sf_dir):
    """Dates of a clause in all lanes against those of the current publication, with reasons."""
    rows = table(spark, sf_dir, "clause_document_expression").where("effective_from is not null").select("clause_work_id", "effective_from", "source_lane")
    found = R.coverage_audit(rows, rows.where("source_lane = 'current_publication'"), "clause_work_id", "effective_from", F.lit("2015-12-31"))
    return found.select("clause_work_id", *[F.array_join(c, ",").alias(c) for c in ("missing", "unexpected", "post_cut", "reasons")])


@query("SELECT edge_id, CASE WHEN older_last_observed_order IS DISTINCT FROM newer_first_observed_order THEN 1 ELSE 0 END AS differs FROM (SELECT DISTINCT edge_id, older_last_observed_order, newer_first_observed_order FROM clause_version_edge)")
def filter_p03_null_safe(spark, sf_dir):
    """Null-safe inequality of two nullable columns."""
    rows = table(spark, sf_dir, "clause_version_edge").select("edge_id", "older_last_observed_order", "newer_first_observed_order").distinct()
    return rows.select("edge_id", F.when(~F.col("older_last_observed_order").eqNullSafe(F.col("newer_first_observed_order")), 1).otherwise(0).alias("differs"))


@query("SELECT expression_id FROM (SELECT DISTINCT expression_id, exact_text_sha256 FROM clause_document_expression) WHERE exact_text_sha256 IS NULL OR NOT regexp_full_match(exact_text_sha256, '[0-9a-f]{64}')")
def filter_p02_pattern_gate(spark, sf_dir):
    """Expressions whose hash is missing or in another notation."""
    rows = table(spark, sf_dir, "clause_document_expression").select("expression_id", "exact_text_sha256").distinct()
    return rows.where("exact_text_sha256 is null or not exact_text_sha256 rlike '^[0-9a-f]{64}$'").select("expression_id")


@query("SELECT DISTINCT expression_id FROM clause_document_expression WHERE exact_text_sha256 IS DISTINCT FROM sha256(exact_text)")
def f15_text_hash_gate(spark, sf_dir):
    """Expressions whose stored hash isn't that of their text."""
    rows = table(spark, sf_dir, "clause_document_expression")
    return rows.where(~F.col("exact_text_sha256").eqNullSafe(F.sha2("exact_text", 256))).select("expression_id").distinct()


@query("SELECT event_id FROM (SELECT DISTINCT event_id, publication_date, effective_to FROM official_event) WHERE publication_date <= DATE '2012-06-01' AND (effective_to IS NULL OR effective_to > '2012-06-01')")
def filter_p11_valid_at(spark, sf_dir):
    """Events that run on a given day (half-open, a null end is open)."""
    from palimpsest.operators.latest import valid_at

    rows = table(spark, sf_dir, "official_event").select("event_id", "publication_date", "effective_to").distinct()
    return rows.where(valid_at(F.col("publication_date").cast("string"), F.col("effective_to"), F.lit("2012-06-01"))).select("event_id")


@query("""WITH l AS (SELECT l_returnflag AS k, year(l_shipdate) AS s, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2), r AS (SELECT l_returnflag AS k, year(l_shipdate) AS s, count(*) AS n FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2)
SELECT coalesce(l.k, r.k) AS l_returnflag, CAST(coalesce(l.s, r.s) AS INT) AS ship_year, least(coalesce(l.n, 0), coalesce(r.n, 0)) AS common, greatest(coalesce(l.n, 0) - coalesce(r.n, 0), 0) AS left_only, greatest(coalesce(r.n, 0) - coalesce(l.n, 0), 0) AS right_only FROM l FULL JOIN r ON l.k = r.k AND l.s = r.s""")
def u05_bag_parity(spark, sf_dir):
    """Multiset intersection and differences of finished and open lines by return flag and year."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", F.year("l_shipdate").alias("ship_year"), "l_linestatus")
    return parity.bag_parity(rows.where("l_linestatus = 'F'"), rows.where("l_linestatus = 'O'"), ["l_returnflag", "ship_year"])


@query("""WITH a AS (SELECT o_custkey AS k, o_orderpriority AS p FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT o_custkey AS k, o_orderpriority AS p FROM orders WHERE o_orderstatus = 'O')
SELECT k, p, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT k, p, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def u03_relation_difference(spark, sf_dir):
    """EXCEPT ALL both ways between two relations."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("p"), "o_orderstatus")
    return parity.relation_difference(rows.where("o_orderstatus = 'F'").drop("o_orderstatus"), rows.where("o_orderstatus = 'O'").drop("o_orderstatus"))


@query("""SELECT 'customer' AS kind, CAST(c_custkey AS VARCHAR) AS code, c_name AS name FROM customer UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_name FROM supplier UNION ALL SELECT 'part', CAST(p_partkey AS VARCHAR), p_name FROM part""")
def u01_tagged_union(spark, sf_dir):
    """Three code systems under one schema with their tag."""
    one = lambda n, k, v: table(spark, sf_dir, n).select(F.lit(n).alias("kind"), F.col(k).cast("string").alias("code"), F.col(v).alias("name"))
    return one("customer", "c_custkey", "c_name").unionByName(one("supplier", "s_suppkey", "s_name")).unionByName(one("part", "p_partkey", "p_name"))


@query("""WITH m AS (SELECT 'customer' AS kind, c_custkey AS code FROM customer UNION ALL SELECT 'supplier', s_suppkey FROM supplier), u AS (SELECT 'customer' AS kind, o_custkey AS code, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'supplier', l_suppkey, count(*) FROM lineitem GROUP BY 2)
SELECT kind, code, n, EXISTS (SELECT 1 FROM m WHERE m.kind = u.kind AND m.code = u.code) AS known FROM u""")
def j21_code_lookup(spark, sf_dir):
    """Used codes against the master list of their system."""
    m = table(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("code")).unionByName(table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("code"))).distinct()
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("code")).agg(F.count("*").alias("n")).select(F.lit("customer").alias("kind"), "code", "n")
    s = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("code")).agg(F.count("*").alias("n")).select(F.lit("supplier").alias("kind"), "code", "n")
    return o.unionByName(s).join(m.withColumn("hit", F.lit(True)), ["kind", "code"], "left").select("kind", "code", "n", F.col("hit").isNotNull().alias("known"))


@query("""WITH t AS (SELECT DISTINCT event_type FROM events), p AS (SELECT user_id, list(DISTINCT event_type) AS v FROM events GROUP BY 1)
SELECT user_id, array_to_string(list_sort(list_filter((SELECT list(event_type) FROM t), lambda x: NOT list_contains(v, x))), ',') AS lacking FROM p""")
def u07_set_difference(spark, sf_dir):
    """Event types that a user never had."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type")
    every = events.agg(F.collect_set("event_type").alias("every"))
    own = events.groupBy("user_id").agg(F.collect_set("event_type").alias("own"))
    # One row: the handful of event types.
    return parity.set_difference(own.crossJoin(F.broadcast(every)), "every", "own").select("user_id", F.array_join("left_only", ",").alias("lacking"))


@query("SELECT DISTINCT o.o_orderkey FROM orders o WHERE o.o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def k06_orphan_gate(spark, sf_dir):
    """Orders without a line."""
    lines = table(spark, sf_dir, "lineitem")
    return gates.orphans(table(spark, sf_dir, "orders").select("o_orderkey"), lines, "o_orderkey", "l_orderkey")


@query("""WITH s AS (SELECT DISTINCT s.hunk_id, s.segment_order, s.old_text, s.old_scalar_start AS a, s.old_scalar_end AS b, h.t FROM clause_document_inline_diff_segment s
JOIN (SELECT DISTINCT d.hunk_id, e.exact_text AS t FROM clause_document_diff_hunk d JOIN clause_document_expression e ON e.expression_id = d.older_expression_id) h USING (hunk_id) WHERE s.old_text IS NOT NULL)
SELECT DISTINCT hunk_id, segment_order FROM s WHERE substring(t, a + 1, b - a) IS DISTINCT FROM old_text""")
def k02_slice_gate(spark, sf_dir):
    """Segments whose offsets don't give their text in the whole older expression."""
    s = table(spark, sf_dir, "clause_document_inline_diff_segment").where("old_text is not null").select("hunk_id", "segment_order", "old_text", "old_scalar_start", "old_scalar_end").distinct()
    h = table(spark, sf_dir, "clause_document_diff_hunk").select("hunk_id", F.col("older_expression_id").alias("expression_id")).distinct()
    whole = h.join(table(spark, sf_dir, "clause_document_expression").select("expression_id", "exact_text").distinct(), "expression_id")
    return gates.wrong_slices(s.join(whole, "hunk_id"), "exact_text", "old_scalar_start", "old_scalar_end", "old_text").select("hunk_id", "segment_order").distinct()


@query("""WITH b AS (SELECT DISTINCT run_id, clause_code, block_order, source_block_id, raw_text FROM current_clause_block)
SELECT source_block_id, coalesce(sum(length(raw_text) + 1) OVER w, 0) AS scalar_start, coalesce(sum(length(raw_text) + 1) OVER w, 0) + length(raw_text) AS scalar_end,
coalesce(sum(strlen(raw_text) + 1) OVER w, 0) AS byte_start, coalesce(sum(strlen(raw_text) + 1) OVER w, 0) + strlen(raw_text) AS byte_end
FROM b WINDOW w AS (PARTITION BY run_id, clause_code ORDER BY block_order ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def f31_assembled_ranges(spark, sf_dir):
    """Offsets of every block in the joined text of its clause, in code points and bytes."""
    rows = table(spark, sf_dir, "current_clause_block").select("run_id", "clause_code", "block_order", "source_block_id", "raw_text").distinct()
    return gates.assembled_ranges(rows, ["run_id", "clause_code"], "block_order", "raw_text", "\n").select("source_block_id", "scalar_start", "scalar_end", "byte_start", "byte_end")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, list_contains(json_keys(props), 'k') AS has_k FROM events")
def n04_json_path(spark, sf_dir):
    """A value and its presence in JSON properties."""
    k = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select("event_id", k.cast("int").alias("k"), F.array_contains(F.json_object_keys("props"), "k").alias("has_k"))


@query("""SELECT user_id, '{' || string_agg('"' || event_type || '":' || n, ',' ORDER BY event_type) || '}' AS counts FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1""")
def a08_object_aggregate(spark, sf_dir):
    """Counts by type as one JSON object per user, keys in order."""
    rows = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return rows.groupBy("user_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("event_type", "n"))))).alias("counts"))


@query("""SELECT event_id, CASE WHEN k IS NULL THEN -1 WHEN k >= 50 THEN 1 ELSE 0 END AS large, CASE WHEN event_type = 'purchase' AND k IS NULL THEN -1 WHEN event_type = 'purchase' AND k >= 50 THEN 1 ELSE 0 END AS large_purchase,
CASE WHEN event_type = 'purchase' OR k >= 50 THEN 1 WHEN k IS NULL THEN -1 ELSE 0 END AS large_or_purchase FROM (SELECT event_id, event_type, CASE WHEN value < 10 THEN NULL ELSE CAST(json_extract(props, '$.k') AS INT) END AS k FROM events)""")
def g01_three_valued(spark, sf_dir):
    """Comparison, conjunction and disjunction with unknown values."""
    k = F.when(F.col("value") >= 10, F.get_json_object("props", "$.k").cast("int"))
    large, bought = R.compare_truth(k, ">=", F.lit(50)), R.truth(F.col("event_type") == "purchase")
    rows = table(spark, sf_dir, "events")
    return rows.select("event_id", large.cast("int").alias("large"), R.all_of([bought, large]).cast("int").alias("large_purchase"), R.any_of([bought, large]).cast("int").alias("large_or_purchase"))


@query("""WITH s AS (SELECT event_id, user_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS f, event_type AS t FROM events)
SELECT event_id, f AS from_state, t AS to_state FROM s WHERE NOT (f IS NULL OR f = t OR (f = 'view' AND t = 'click') OR (f = 'click' AND t = 'purchase'))""")
def g08_illegal_transitions(spark, sf_dir):
    """Steps of the users' logs that the table of allowed steps doesn't have."""
    kinds = table(spark, sf_dir, "events").select("event_type").distinct()
    same = kinds.select(F.col("event_type").alias("from_state"), F.col("event_type").alias("to_state"))
    first = kinds.select(F.lit(None).cast("string").alias("from_state"), F.col("event_type").alias("to_state"))
    steps = spark.createDataFrame([("view", "click"), ("click", "purchase")], "from_state string, to_state string")
    found = R.illegal_transitions(table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type"), ["user_id"], ["ts", "event_id"], "event_type", same.unionByName(first).unionByName(steps))
    return found.select("event_id", "from_state", "to_state")


@query("""WITH c AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2)
SELECT event_type, CAST(day AS VARCHAR) AS day, n, n < ceil(before * 0.5) AND before >= 4 AS collapsed FROM (SELECT *, lag(n, 1, 0) OVER (PARTITION BY event_type ORDER BY day) AS before FROM c)""")
def m01_collapse_guard(spark, sf_dir):
    """Days on which a type of event fell under half of its day before."""
    from pyspark.sql import Window

    from palimpsest.streaming.feeds import collapsed_feed

    rows = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    rows = rows.withColumn("before", F.lag("n", 1, 0).over(Window.partitionBy("event_type").orderBy("day")))
    return rows.select("event_type", F.col("day").cast("string").alias("day"), "n", collapsed_feed(F.col("n"), F.col("before"), 0.5).alias("collapsed"))


@query("SELECT c_custkey, greatest(1, CAST(ceil(count(o_orderkey) / 10.0) AS BIGINT)) AS pages FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def m02_page_count(spark, sf_dir):
    """Pages of ten rows, at least one."""
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    rows = table(spark, sf_dir, "customer").select("c_custkey").join(n, "c_custkey", "left")
    return rows.select("c_custkey", F.greatest(F.lit(1).cast("bigint"), F.ceil(F.coalesce("n", F.lit(0)) / 10)).alias("pages"))
