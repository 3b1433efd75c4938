"""Queries of the general problems: history, snapshots, timestamps, intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.operators.history import version_history
from palimpsest.operators.intervals import merge_intervals
from palimpsest.operators.links import follow_links
from palimpsest.operators.snapshots import consecutive_editions, snapshot_changes
from palimpsest.operators.timestamps import iso_seconds, utc_epoch, utc_start
from palimpsest.runtime import materialize, table


#: Attributes of a clause version that its history keeps.
ATTRIBUTES = ["clause_work_id", "canonical_code", "source_lane", "expression_completeness", "reader_state"]


def _clause_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return version_history(
        table(spark, sf_dir, "clause_document_expression"),
        table(spark, sf_dir, "clause_version_edge"),
        version="source_version_id",
        valid_from="effective_from",
        older="older_clause_version_id",
        newer="newer_clause_version_id",
        attributes=ATTRIBUTES,
        observed=["recorded_at", "expression_id"],
    )


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity of every clause version that has a date."""
    return _clause_history(spark, sf_dir).select(
        "clause_work_id", F.col("version").alias("clause_version_id"), "valid_from", F.coalesce("valid_to", F.lit("")).alias("valid_to")
    )


def p1_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attributes that held in each period, as they were first recorded."""
    return _clause_history(spark, sf_dir).select(F.col("version").alias("clause_version_id"), "valid_from", *ATTRIBUTES)


P1_ATTRIBUTES_SQL = """
SELECT source_version_id AS clause_version_id, min(effective_from) AS valid_from, arg_min(clause_work_id, o) AS clause_work_id, arg_min(canonical_code, o) AS canonical_code,
  arg_min(source_lane, o) AS source_lane, arg_min(expression_completeness, o) AS expression_completeness, arg_min(reader_state, o) AS reader_state
FROM (SELECT *, (recorded_at, expression_id) AS o FROM clause_document_expression WHERE source_version_id IS NOT NULL) GROUP BY 1 HAVING min(effective_from) IS NOT NULL
"""

P1_FOUND_SQL = """
WITH RECURSIVE dated AS (
  SELECT source_version_id AS v, min(clause_work_id) AS w, min(effective_from) AS f
  FROM clause_document_expression WHERE source_version_id IS NOT NULL GROUP BY 1),
edge AS (SELECT DISTINCT older_clause_version_id AS o, newer_clause_version_id AS n FROM clause_version_edge),
walk AS (
  SELECT d.v, e.n AS at, x.f FROM dated d JOIN edge e ON e.o = d.v LEFT JOIN dated x ON x.v = e.n WHERE d.f IS NOT NULL
  UNION ALL
  SELECT k.v, e.n, x.f FROM walk k JOIN edge e ON e.o = k.at LEFT JOIN dated x ON x.v = e.n WHERE k.f IS NULL)
SELECT any_value(d.w) AS clause_work_id, d.v AS clause_version_id, any_value(d.f) AS valid_from, coalesce(min(k.f), '') AS valid_to
FROM dated d LEFT JOIN walk k ON k.v = d.v AND k.f IS NOT NULL
WHERE d.f IS NOT NULL GROUP BY d.v
"""


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clauses that each edition added, removed or changed against the one before."""
    pairs = consecutive_editions(
        table(spark, sf_dir, "source_edition"), "edition_import_run_id", "source_edition_version_id", "chronology_order"
    )
    rows = snapshot_changes(
        table(spark, sf_dir, "clause_document_expression"), pairs, "source_edition_version_id", "clause_work_id", ["exact_text"]
    )
    return rows.select(
        F.col("series").alias("edition_import_run_id"),
        F.col("newer").alias("source_edition_version_id"),
        F.col("key").alias("clause_work_id"),
        "change_kind",
    )


P2_FOUND_SQL = """
WITH ed AS (
  SELECT edition_import_run_id AS r, source_edition_version_id AS e, min(chronology_order) AS o FROM source_edition GROUP BY 1, 2),
pair AS (SELECT * FROM (SELECT r, e, lag(e) OVER (PARTITION BY r ORDER BY o, e) AS p FROM ed) WHERE p IS NOT NULL),
doc AS (SELECT DISTINCT source_edition_version_id AS e, clause_work_id AS w, exact_text AS t FROM clause_document_expression),
older AS (SELECT r, pair.e AS newer, w, t FROM pair JOIN doc ON doc.e = pair.p),
newer AS (SELECT r, pair.e AS newer, w, t FROM pair JOIN doc ON doc.e = pair.e)
SELECT coalesce(n.r, o.r) AS edition_import_run_id, coalesce(n.newer, o.newer) AS source_edition_version_id,
       coalesce(n.w, o.w) AS clause_work_id,
       CASE WHEN o.w IS NULL THEN 'added' WHEN n.w IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
FROM newer n FULL JOIN older o ON n.r = o.r AND n.newer = o.newer AND n.w = o.w
WHERE n.t IS DISTINCT FROM o.t
"""


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edition dates and event starts as UTC moments."""
    edition = table(spark, sf_dir, "source_edition").select(
        F.lit("source_edition").alias("table_name"),
        F.col("source_edition_version_id").alias("record_id"),
        F.col("official_date_raw_value").alias("v"),
        F.col("clock_zone").alias("z"),
        F.col("official_date_precision").alias("p"),
    )
    event = table(spark, sf_dir, "official_event").select(
        F.lit("official_event").alias("table_name"),
        F.col("event_id").alias("record_id"),
        F.col("effective_from").alias("v"),
        F.col("clock_zone").alias("z"),
        F.lit(None).cast("string").alias("p"),
    )
    rows = edition.unionByName(event).where("v is not null")
    rows = rows.select("table_name", "record_id", utc_start(F.col("v"), F.col("z"), F.col("p")).alias("utc_start"))
    return rows.where("utc_start is not null").distinct()


def event_intervals(events: DataFrame) -> DataFrame:
    """``(event_id, supersedes_event_id, s, t)``: each event's interval in UTC seconds, ``s`` null if it has none."""
    rows = events.select("event_id", "supersedes_event_id", "effective_from", "clock_zone", "effective_to").distinct()
    until = F.when(F.col("effective_to").isNotNull(), utc_epoch(F.col("effective_to")))
    rows = rows.withColumn("s", utc_epoch(F.col("effective_from"), F.col("clock_zone"))).withColumn("t", until)
    # An end that can't be read is no open one.
    usable = F.col("effective_to").isNull() | F.col("t").isNotNull()
    return rows.select("event_id", "supersedes_event_id", F.when(usable, F.col("s")).alias("s"), "t")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuous periods and gaps of every supersession chain."""
    events = materialize(event_intervals(table(spark, sf_dir, "official_event")), "events")
    roots = follow_links(events, "event_id", "supersedes_event_id")
    rows = events.join(roots.select(F.col("node").alias("event_id"), "root"), "event_id")
    merged = merge_intervals(materialize(rows.select("root", "s", "t"), "intervals"), "root", "s", "t")
    return merged.select(
        F.col("entity").alias("chain_root_event_id"),
        "kind",
        iso_seconds(F.col("starts_at")).alias("starts_at"),
        F.coalesce(iso_seconds(F.col("ends_at")), F.lit("")).alias("ends_at"),
    )


QUERIES = {"p1_found": p1_found, "p1_attributes": p1_attributes, "p2_found": p2_found, "p6_found": p6_found, "p7_found": p7_found}
SQL = {"p1_found": P1_FOUND_SQL, "p1_attributes": P1_ATTRIBUTES_SQL, "p2_found": P2_FOUND_SQL}
