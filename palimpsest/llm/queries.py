"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.leakage import find_leaks
from palimpsest.llm.lookalike import same_look_pairs, same_look_parts, same_look_successors
from palimpsest.llm.neardup import near_duplicate_groups, near_duplicates
from palimpsest.llm.sql import SQL  # noqa: F401
from palimpsest.llm.spans import shared_share, shared_spans
from palimpsest.llm.tokenize import encode_table
from palimpsest.llm.truncation import find_truncated
from palimpsest.operators.snapshots import consecutive_editions
from palimpsest.runtime import table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that look the same but differ in their characters."""
    expressions = table(spark, sf_dir, "clause_document_expression")
    pairs = consecutive_editions(
        table(spark, sf_dir, "source_edition"), "edition_import_run_id", "source_edition_version_id", "chronology_order"
    )
    blocks = same_look_pairs(table(spark, sf_dir, "current_clause_block"), "source_block_id", "raw_text")
    successive = same_look_successors(
        expressions, pairs, record="expression_id", entity="clause_work_id", edition="source_edition_version_id", text="exact_text"
    )
    parts = same_look_parts(
        table(spark, sf_dir, "clause_document_diff_hunk"), expressions,
        part="hunk_id", part_text="old_exact_text", of="older_expression_id", whole="expression_id", whole_text="exact_text",
    )
    return blocks.unionByName(successive).unionByName(parts).distinct()


def _hunk_texts(spark: SparkSession, sf_dir: str, hunks: DataFrame) -> DataFrame:
    """Add the work of each hunk's newer expression."""
    works = table(spark, sf_dir, "clause_document_expression").select(F.col("expression_id").alias("newer_expression_id"), "clause_work_id").distinct()
    return hunks.join(works, "newer_expression_id")


def _texts_of_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of works, and new texts of hunks with the work of the newer expression."""
    works = table(spark, sf_dir, "clause_document_expression").select(
        F.lit("work").alias("record_kind"), F.col("clause_work_id").alias("record"), "clause_work_id", F.col("exact_text").alias("text")
    )
    hunks = table(spark, sf_dir, "clause_document_diff_hunk").where("new_exact_text is not null")
    hunks = _hunk_texts(spark, sf_dir, hunks.select("hunk_id", "newer_expression_id", "new_exact_text"))
    return works.unionByName(hunks.select(F.lit("hunk").alias("record_kind"), F.col("hunk_id").alias("record"), "clause_work_id", F.col("new_exact_text").alias("text")))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works and hunks with nearly the same texts."""
    return near_duplicates(_texts_of_records(spark, sf_dir), scope="record_kind", record="record", owner="clause_work_id", text="text")


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of works and of hunks that nearly the same texts connect."""
    return near_duplicate_groups(_texts_of_records(spark, sf_dir), scope="record_kind", record="record", owner="clause_work_id", text="text")


def _passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of works, and new texts of the hunks' segments with the work of each hunk's newer expression."""
    works = table(spark, sf_dir, "clause_document_expression").select(
        F.lit("work").alias("record_kind"), F.col("clause_work_id").alias("record"), "clause_work_id", F.col("exact_text").alias("text")
    )
    segments = table(spark, sf_dir, "clause_document_inline_diff_segment").select("hunk_id", "new_text").where("char_length(new_text) >= 60")
    hunks = _hunk_texts(spark, sf_dir, table(spark, sf_dir, "clause_document_diff_hunk").select("hunk_id", "newer_expression_id").distinct())
    hunks = segments.join(hunks, "hunk_id").select(F.lit("hunk").alias("record_kind"), F.col("hunk_id").alias("record"), "clause_work_id", F.col("new_text").alias("text"))
    return works.unionByName(hunks)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works and hunks that share long passages verbatim."""
    return shared_spans(_passages(spark, sf_dir), scope="record_kind", record="record", owner="clause_work_id", text="text")


def p5_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each work and hunk stands verbatim in others."""
    return shared_share(_passages(spark, sf_dir), scope="record_kind", record="record", owner="clause_work_id", text="text")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encode_table(table(spark, sf_dir, "documents"), "doc_id", "text")


def _leaks(spark: SparkSession, sf_dir: str, short: bool = False) -> DataFrame:
    return find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "heldout_item"),
        doc_key="doc_id", doc_text="text", item_key="item_id", item_text="text", short=short,
    )


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the held-out items that leak into them."""
    return _leaks(spark, sf_dir).select("doc_id", "item_id").distinct()


def p9_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each held-out item leaked, short ones as wholes: documents, and the most of it that one document has."""
    return _leaks(spark, sf_dir, short=True).groupBy("item_id").agg(F.count_distinct("doc_id").alias("documents"), F.max("covered").alias("most_covered"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text was cut."""
    rows, _ = find_truncated(table(spark, sf_dir, "documents"), key="doc_id", text="text", source="source")
    return rows.where("truncated").select("doc_id").distinct()


def p10_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source's share of cut documents, and the lengths at which it cuts."""
    rows, limits = find_truncated(table(spark, sf_dir, "documents"), key="doc_id", text="text", source="source")
    shares = rows.groupBy("source").agg(
        F.count("*").alias("documents"), F.count_if(F.col("cut_by") == "limit").alias("cut_by_limit"),
        F.count_if(F.col("cut_by") == "transfer").alias("cut_in_transfer"), (F.count_if("truncated") / F.count("*")).alias("share"),
    )
    # A source has few significant lengths: of n texts at most 1/n of them can be.
    each = F.transform(F.sort_array(F.collect_list(F.struct("unit", "length", "n"))), lambda x: F.concat_ws(":", x["unit"], x["length"], x["n"]))
    return shares.join(limits.groupBy("source").agg(F.concat_ws(",", each).alias("limits")), "source", "left")


QUERIES = {"p5_found": p5_found, "p5_shares": p5_shares, "p4_found": p4_found, "p4_groups": p4_groups, "p3_found": p3_found, "p8_ids": p8_ids, "p9_found": p9_found, "p9_items": p9_items, "p10_found": p10_found, "p10_sources": p10_sources}

