"""Queries of version chains, latest states, windows and sorting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.operators import chains, latest
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


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per clause work and edition, with the edition's order and label."""
    editions = table(spark, sf_dir, "source_edition").select("source_edition_version_id", "chronology_order", "edition_label").distinct()
    rows = table(spark, sf_dir, "clause_document_expression").select("clause_work_id", "source_edition_version_id", "exact_text").distinct()
    return rows.join(editions, "source_edition_version_id")


OBSERVED = """
obs AS (SELECT DISTINCT e.clause_work_id, s.chronology_order, s.edition_label, e.exact_text
        FROM (SELECT DISTINCT clause_work_id, source_edition_version_id, exact_text FROM clause_document_expression) e
        JOIN (SELECT DISTINCT source_edition_version_id, chronology_order, edition_label FROM source_edition) s USING (source_edition_version_id)),
flag AS (SELECT *, CASE WHEN lag(exact_text) OVER w IS NOT DISTINCT FROM exact_text AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS st
         FROM obs WINDOW w AS (PARTITION BY clause_work_id ORDER BY chronology_order)),
isl AS (SELECT *, sum(st) OVER (PARTITION BY clause_work_id ORDER BY chronology_order) - 1 AS so FROM flag),
states AS (SELECT clause_work_id, so, min(chronology_order) AS fo, max(chronology_order) AS lo, count(*) AS n,
                  string_agg(edition_label, '|' ORDER BY chronology_order) AS labels, any_value(exact_text) AS t
           FROM isl GROUP BY 1, 2)
"""


@query(f"WITH {OBSERVED} SELECT clause_work_id, CAST(so AS INT) AS state_order, fo AS first_order, lo AS last_order, n AS observation_count, labels, sha256(t) AS text_sha256 FROM states")
def w13_text_states(spark, sf_dir):
    """Runs of editions with the same text of a clause (gaps and islands), with labels."""
    states = chains.text_states(observations(spark, sf_dir), ["clause_work_id"], "chronology_order", F.col("exact_text"), "edition_label")
    return states.select(
        "clause_work_id", "state_order", "first_order", "last_order", "observation_count", F.array_join("labels", "|").alias("labels"), F.sha2("state_value", 256).alias("text_sha256")
    )


@query(f"""WITH {OBSERVED}
SELECT * FROM (SELECT clause_work_id, CAST(so AS INT) AS older_state, CAST(lead(so) OVER w AS INT) AS newer_state, lo AS older_last_order,
       lead(fo) OVER w AS newer_first_order, lead(fo) OVER w > lo + 1 AS crosses_gap
FROM states WINDOW w AS (PARTITION BY clause_work_id ORDER BY so)) WHERE newer_state IS NOT NULL""")
def w14_state_edges(spark, sf_dir):
    """Adjacent states of a clause as edges."""
    states = chains.text_states(observations(spark, sf_dir), ["clause_work_id"], "chronology_order", F.col("exact_text"))
    return chains.state_edges(states, ["clause_work_id"])


@query(f"""WITH {OBSERVED}
SELECT clause_work_id, min(chronology_order) AS first_order, max(chronology_order) AS last_order, count(DISTINCT chronology_order) AS observed,
       count(DISTINCT exact_text) AS unique_values, max(chronology_order) - min(chronology_order) + 1 = count(DISTINCT chronology_order) AS contiguous
FROM obs GROUP BY 1""")
def w17_presence(spark, sf_dir):
    """Presence of each clause over the editions, and whether it is contiguous."""
    return chains.presence(observations(spark, sf_dir), ["clause_work_id"], "chronology_order", "exact_text")


@query("""SELECT event_id, user_id, CASE WHEN row_number() OVER w = 1 THEN 'first'
WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER w THEN 'same' ELSE 'changed' END AS relation
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def w01_change_relation(spark, sf_dir):
    """Relation of each event to the user's event before it."""
    return chains.change_relation(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "user_id", "relation")


@query("""WITH s AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS st
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
i AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS so FROM s)
SELECT user_id, CAST(so AS INT) AS state_order, any_value(event_type) AS state_value, min(event_id) AS first_order, max(event_id) AS last_order, count(*) AS observation_count
FROM i GROUP BY 1, 2""")
def w15_event_runs(spark, sf_dir):
    """Runs of one event type per user with their first and last event."""
    return chains.text_states(table(spark, sf_dir, "events"), ["user_id"], "event_id", F.col("event_type"))


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def w04_latest_event(spark, sf_dir):
    """The latest event of each user."""
    return latest.latest_rows(table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value"), ["user_id"], ["ts", "event_id"]).drop("ts")


@query("""SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1 AND event_type = 'purchase'""")
def w06_latest_then_filter(spark, sf_dir):
    """Users whose latest event is a purchase: latest first, then the filter."""
    rows = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return latest.latest_then(rows, ["user_id"], ["ts", "event_id"], F.col("event_type") == "purchase").select("user_id", "event_id")


@query("SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def w10_latest_of_all(spark, sf_dir):
    """The one latest event."""
    return latest.latest_rows(table(spark, sf_dir, "events").select("ts", "event_id", "user_id", "event_type"), [], ["ts", "event_id"]).drop("ts")


@query("""SELECT DISTINCT ON (user_id, event_type) user_id, event_type, event_id FROM events ORDER BY user_id, event_type, ts DESC, event_id DESC""")
def w09_latest_per_generation(spark, sf_dir):
    """The latest event per user and type (composite key)."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    return latest.latest_rows(rows, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("""SELECT canonical_code, expression_id FROM (SELECT *, row_number() OVER (PARTITION BY canonical_code ORDER BY CASE source_lane WHEN 'current_publication' THEN 0 ELSE 1 END,
effective_from DESC NULLS LAST, expression_id) AS rn FROM (SELECT DISTINCT canonical_code, expression_id, source_lane, effective_from FROM clause_document_expression)) WHERE rn = 1""")
def j05_preferred_expression(spark, sf_dir):
    """Per code the expression of the preferred lane, then the latest date."""
    rows = table(spark, sf_dir, "clause_document_expression").select("canonical_code", "expression_id", "source_lane", "effective_from").distinct()
    lane = F.when(F.col("source_lane") == "current_publication", 0).otherwise(1)
    return latest.preferred_rows(rows, ["canonical_code"], [lane, F.col("effective_from").desc_nulls_last(), F.col("expression_id")]).select("canonical_code", "expression_id")


@query("""WITH v AS (SELECT DISTINCT source_version_id, effective_from FROM clause_document_expression WHERE source_version_id IS NOT NULL AND effective_from IS NOT NULL)
SELECT source_version_id, any_value(effective_from) AS effective_from FROM v GROUP BY 1 HAVING count(*) = 1""")
def w23_single_candidate_date(spark, sf_dir):
    """Versions with exactly one candidate date; the others are no result."""
    rows = table(spark, sf_dir, "clause_document_expression").select("source_version_id", "effective_from").where("source_version_id is not null and effective_from is not null").distinct()
    return latest.exactly_one(rows, ["source_version_id"])[0]


@query("""WITH ed AS (SELECT edition_import_run_id AS r, source_edition_version_id AS e, min(chronology_order) AS o, any_value(artifact_sha256) AS h FROM source_edition GROUP BY 1, 2)
SELECT r AS edition_import_run_id, e AS newer, lag(e) OVER w AS older, h IS DISTINCT FROM lag(h) OVER w AS artifact_differs FROM ed
WINDOW w AS (PARTITION BY r ORDER BY o, e) QUALIFY lag(e) OVER w IS NOT NULL""")
def w16_adjacent_editions(spark, sf_dir):
    """Adjacent editions of a run, and whether the delivered file differs."""
    rows = table(spark, sf_dir, "source_edition").groupBy("edition_import_run_id", "source_edition_version_id").agg(F.min("chronology_order").alias("o"), F.first("artifact_sha256").alias("h"))
    w = Window.partitionBy("edition_import_run_id").orderBy("o", "source_edition_version_id")
    return (
        rows.select("edition_import_run_id", F.col("source_edition_version_id").alias("newer"), F.lag("source_edition_version_id").over(w).alias("older"), (~F.col("h").eqNullSafe(F.lag("h").over(w))).alias("artifact_differs"))
        .where("older is not null")
    )


@query("""WITH b AS (SELECT DISTINCT run_id, clause_code, block_order, block_kind FROM current_clause_block),
m AS (SELECT *, max(CASE WHEN block_kind = 'paragraph' THEN block_order END) OVER (PARTITION BY run_id, clause_code ORDER BY block_order ROWS UNBOUNDED PRECEDING) AS segment FROM b)
SELECT run_id, clause_code, block_order, segment FROM m""")
def w18_carry_heading(spark, sf_dir):
    """Blocks with the last paragraph at or before them carried forward."""
    rows = table(spark, sf_dir, "current_clause_block").select("run_id", "clause_code", "block_order", "block_kind").distinct()
    heading = F.when(F.col("block_kind") == "paragraph", F.col("block_order"))
    return chains.carry_heading(rows, ["run_id", "clause_code"], "block_order", heading).select("run_id", "clause_code", "block_order", "segment")


@query("""WITH d AS (SELECT user_id, event_type, CAST(date_trunc('day', ts) AS DATE) AS day FROM events),
s AS (SELECT user_id, day, list_sort(list(DISTINCT event_type)) AS types FROM d GROUP BY 1, 2),
l AS (SELECT *, lag(types) OVER (PARTITION BY user_id ORDER BY day) AS before FROM s)
SELECT user_id, CAST(day AS VARCHAR) AS day, array_to_string(list_sort(list_filter(types, lambda x: before IS NULL OR NOT list_contains(before, x))), ',') AS new_types FROM l""")
def w19_new_values(spark, sf_dir):
    """Event types of a user's day that the active day before doesn't have."""
    rows = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.array_sort(F.collect_set("event_type")).alias("types"))
    return chains.new_values(rows, ["user_id"], "day", "types").select("user_id", F.col("day").cast("string").alias("day"), F.array_join("new_values", ",").alias("new_types"))


@query("""WITH h AS (SELECT DISTINCT canonical_code AS c, split_part(canonical_code, '.', 1) AS chapter, length(canonical_code) - length(replace(canonical_code, '.', '')) + 1 AS depth FROM clause_document_expression
UNION SELECT DISTINCT split_part(canonical_code, '.', 1), split_part(canonical_code, '.', 1), 1 FROM clause_document_expression
UNION SELECT DISTINCT split_part(canonical_code, '.', 1) || '.' || split_part(canonical_code, '.', 2), split_part(canonical_code, '.', 1), 2 FROM clause_document_expression),
o AS (SELECT *, row_number() OVER (PARTITION BY chapter ORDER BY list_transform(string_split(c, '.'), lambda x: CAST(x AS INT))) AS pos FROM h)
SELECT a.c AS code, CAST(a.pos AS INT) AS range_start, CAST((SELECT min(b.pos) FROM o b WHERE b.chapter = a.chapter AND b.pos > a.pos AND b.depth <= a.depth) AS INT) AS range_end FROM o a""")
def x18_nested_ranges(spark, sf_dir):
    """Ranges of nested headings: each ends at the next one of its depth or above."""
    parts = F.split("canonical_code", r"\.")
    codes = table(spark, sf_dir, "clause_document_expression").select("canonical_code").distinct()
    every = codes.select(F.explode(F.array("canonical_code", parts[0], F.concat_ws(".", parts[0], parts[1]))).alias("code")).distinct()
    numbers = F.transform(F.split("code", r"\."), lambda x: x.cast("int"))
    rows = every.select("code", F.split("code", r"\.")[0].alias("chapter"), F.size(F.split("code", r"\.")).alias("depth"), numbers.alias("n"))
    rows = rows.withColumn("pos", F.row_number().over(Window.partitionBy("chapter").orderBy("n")))
    return chains.nested_ranges(rows, ["chapter"], "pos", "depth").select("code", F.col("pos").alias("range_start"), "range_end")


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 200000 THEN 'A' WHEN o_orderpriority = '1-URGENT' THEN 'B' WHEN o_totalprice > 200000 THEN 'C' ELSE 'D' END AS lane FROM orders""")
def l02_priority_lane(spark, sf_dir):
    """Orders by the first lane whose condition holds."""
    urgent, large = F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") > 200000
    lane = latest.status_by_precedence([("A", urgent & large), ("B", urgent), ("C", large)], "D")
    return table(spark, sf_dir, "orders").select("o_orderkey", lane.alias("lane"))


@query("SELECT o_orderpriority, o_orderkey, CAST(row_number() OVER (ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS INT) AS rank FROM orders QUALIFY rank <= 25")
def l01_ranked_queue(spark, sf_dir):
    """The first 25 orders of a queue by several sort keys with a tie-breaker (a top-k report)."""
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice", "o_orderkey")
    top = rows.orderBy("o_orderpriority", F.col("o_totalprice").desc(), "o_orderkey").limit(25)
    w = Window.orderBy("o_orderpriority", F.col("o_totalprice").desc(), "o_orderkey")
    return top.select("o_orderpriority", "o_orderkey", F.row_number().over(w).alias("rank"))


@query("""SELECT event_id, CASE WHEN effective_from IS NULL THEN 'undated' WHEN CAST(publication_date AS VARCHAR) > '2012-01-01' THEN 'later' WHEN effective_to IS NOT NULL AND effective_to <= '2012-01-01' THEN 'ended' ELSE 'running' END AS lifecycle
FROM (SELECT DISTINCT event_id, effective_from, publication_date, effective_to FROM official_event)""")
def w22_lifecycle(spark, sf_dir):
    """Lifecycle of events at a given day, by precedence; the day is a parameter, not the clock."""
    at = "2012-01-01"
    cases = [
        ("undated", F.col("effective_from").isNull()), ("later", F.col("publication_date").cast("string") > at),
        ("ended", F.coalesce(F.col("effective_to") <= at, F.lit(False))),
    ]
    rows = table(spark, sf_dir, "official_event").select("event_id", "effective_from", "publication_date", "effective_to").distinct()
    return rows.select("event_id", latest.status_by_precedence(cases, "running").alias("lifecycle"))
