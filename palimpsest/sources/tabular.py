"""JSONL and CSV with explicit contracts, run partitions, canonical export."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from palimpsest.functions.ids import canonical_row, row_hash, row_sum_fingerprint
from palimpsest.operators.gates import duplicate_keys, orphans, require_empty, wrong_schema
from palimpsest.operators.parity import relation_difference

CORRUPT = "_corrupt"


def read_jsonl(spark: SparkSession, path: str, schema: StructType, key: Sequence[str] = (), strict: bool = True) -> DataFrame:
    """JSON lines under an explicit schema; a bad line, and with ``key`` a repeated key, is an error."""
    df = spark.read.schema(schema).option("mode", "FAILFAST" if strict else "PERMISSIVE").json(path)
    if key:
        require_empty(duplicate_keys(df, key), f"keys of {path} that aren't unique")
    return df


def read_jsonl_quarantined(spark: SparkSession, path: str, schema: StructType, rule: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that parse and pass ``rule``, and the raw lines of the others."""
    wide = StructType([*schema.fields]).add(CORRUPT, "string")
    lines = spark.read.text(path).select(F.col("value"), F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    parsed = lines.select("value", "r.*")
    good = F.col(CORRUPT).isNull() & F.coalesce(rule, F.lit(False))
    return parsed.where(good).drop("value", CORRUPT), parsed.where(~good).select(F.col("value").alias("line"), F.col(CORRUPT).isNull().alias("parsed"))


def append_jsonl(df: DataFrame, path: str, schema: StructType, rule: Column, key: Sequence[str] = ()) -> int:
    """Append rows as JSON lines if all of them have the schema, pass ``rule`` and, with ``key``, are new and unique.

    Nothing is written otherwise. Returns the number of rows.
    """
    wrong = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    if df.dtypes != wrong:
        raise ValueError(f"{path}: columns {df.dtypes} instead of {wrong}")
    require_empty(df.where(~F.coalesce(rule, F.lit(False))), f"rows for {path} that break the rule")
    if key:
        require_empty(duplicate_keys(df, key), f"keys for {path} that aren't unique")
        if _exists(df.sparkSession, path):
            require_empty(df.join(df.sparkSession.read.schema(schema).json(path).select(*key), list(key), "left_semi"), f"keys that {path} has already")
    rows = Observation("append")
    df.observe(rows, F.count("*").alias("n")).write.mode("append").option("ignoreNullFields", False).json(path)
    return rows.get["n"]


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    place, system = _file_system(spark, path)
    return system.exists(place)


def read_csv(spark: SparkSession, path: str, header: Sequence[str], key: str | None = None) -> DataFrame:
    """CSV with exactly this header, all strings; drifted headers, ragged rows, missing keys and no rows are errors."""
    first = spark.read.option("wholetext", False).text(path).limit(1).collect()
    if not first:
        raise ValueError(f"{path} is empty")
    found = [c.strip().strip('"') for c in first[0][0].lstrip("﻿").split(",")]
    if found != list(header):
        raise ValueError(f"{path}: header {wrong_schema(found, header)}")
    schema = ", ".join(f"`{c}` string" for c in header)
    df = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("enforceSchema", True).option("escape", '"').option("multiLine", True).csv(path)
    if df.isEmpty():
        raise ValueError(f"{path} has no rows")
    if key:
        require_empty(df.where(F.coalesce(F.trim(F.col(key)) == "", F.lit(True))).select(key), f"{path}: rows without {key}")
    return df


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, distinct values and empty values per column, in one pass."""
    facts = [F.struct(F.lit(c).alias("column"), F.count_distinct(c).alias("distinct_values"), F.count_if(F.col(c).isNull() | (F.col(c).cast("string") == "")).alias("empty_values")).alias(c) for c in columns]
    one = df.agg(F.count("*").alias("row_count"), *facts)
    return one.select("row_count", F.explode(F.array(*columns)).alias("x")).select("x.column", "row_count", "x.distinct_values", "x.empty_values")


def write_run(df: DataFrame, root: str, table: str, run_id: str) -> str:
    """Write one immutable partition of a run; an existing one is an error."""
    path = f"{root}/{table}/run_id={run_id}"
    df.write.mode("errorifexists").parquet(path)
    return path


def seal(spark: SparkSession, root: str, tables: Sequence[str], run_id: str) -> DataFrame:
    """Manifest of a run: per table its rows and the fingerprint of what was written."""
    made = None
    for name in tables:
        df = spark.read.parquet(f"{root}/{name}/run_id={run_id}")
        row = row_sum_fingerprint(df).select(F.lit(name).alias("table_name"), F.lit(run_id).alias("run_id"), "row_count", F.col("fingerprint").cast("string").alias("fingerprint"))
        made = row if made is None else made.unionByName(row)
    return made


def verify_seal(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """Tables that no longer are what the manifest says, by reading them again."""
    made = None
    for row in manifest.select("table_name", "run_id").collect():
        now = seal(spark, root, [row.table_name], row.run_id)
        made = now if made is None else made.unionByName(now)
    return relation_difference(manifest, made)


def write_canonical_jsonl(df: DataFrame, path: str) -> None:
    """Canonical JSON lines (sorted keys, compact, nulls kept), sorted; one file per partition."""
    df.select(canonical_row(df).alias("value")).orderBy("value").write.mode("errorifexists").text(path)


def write_documents(df: DataFrame, key: str, order: str, path: str) -> None:
    """One JSON document per key with its rows in order, partitioned by key hash."""
    rest = [c for c in df.columns if c != key]
    docs = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, *[c for c in rest if c != order]))).alias("rows"))
    docs.select(F.to_json(F.struct(key, "rows")).alias("value")).write.mode("errorifexists").text(path)


def export_sqlite(df: DataFrame, table: str, path: str, limit: int = 5_000_000) -> int:
    """A portable SQLite table; rows come over in partitions and must not be more than ``limit``."""
    import sqlite3

    names = df.columns
    scalar = df.select(*[F.col(n).cast("int").alias(n) if t == "boolean" else F.to_json(n).alias(n) if t.startswith(("array", "struct", "map")) else F.col(n) if t in ("int", "bigint", "double") else F.col(n).cast("string").alias(n) for n, t in df.dtypes])
    count = scalar.count()
    if count > limit:
        raise ValueError(f"{count} rows are too many for a portable snapshot")
    with sqlite3.connect(path) as db:
        db.execute(f"CREATE TABLE {table} ({', '.join(names)})")
        db.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(names))})", (tuple(r) for r in scalar.toLocalIterator()))
    return count


def foreign_key_gate(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> None:
    """Fail on child rows without a parent."""
    require_empty(orphans(child, parent, child_key, parent_key).select(child_key), f"{child_key} without {parent_key}")


def blobs(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Raw files with their content hash and the content-addressed name they belong under."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    digest = F.sha2("content", 256)
    return files.select("path", "length", "content", digest.alias("sha256"), F.concat(F.lit("raw/sha256/"), F.substring(digest, 1, 2), F.lit("/"), digest).alias("blob_path"))


def put_blob(spark: SparkSession, root: str, content: bytes) -> tuple[str, bool]:
    """Store content under its SHA-256: the name, and whether it was new.

    Content that is there already is read again and compared, never written
    anew; new content is written aside and then renamed, so that no reader
    sees a part of it.
    """
    digest = hashlib.sha256(content).hexdigest()
    name = f"raw/sha256/{digest[:2]}/{digest}"
    place, system = _file_system(spark, f"{root}/{name}")
    if not system.exists(place):
        aside, _ = _file_system(spark, f"{root}/{name}.{uuid.uuid4().hex}.part")
        out = system.create(aside, False)
        out.write(bytearray(content))
        out.close()
        if system.rename(aside, place):
            return name, True
        # Someone else was first.
        system.delete(aside, False)
    if spark.read.format("binaryFile").load(str(place)).select(F.sha2("content", 256)).first()[0] != digest:
        raise ValueError(f"{name} holds other content")
    return name, False


def export_stage(tables: Mapping[str, DataFrame], root: str, run_id: str, sqlite_limit: int = 5_000_000) -> DataFrame:
    """Write a read-only snapshot of tables as canonical JSON lines and one SQLite file, and its manifest.

    Files go to ``root/run_id`` (a local folder for SQLite); an existing run is
    an error. Result and manifest: ``table_name, run_id, row_count,
    fingerprint``, of what was written, in ``manifest.jsonl``.
    """
    place = f"{root}/{run_id}"
    manifest = None
    for name, df in tables.items():
        spark = df.sparkSession
        write_canonical_jsonl(df, f"{place}/{name}")
        export_sqlite(df, name, f"{place}/snapshot.sqlite", sqlite_limit)
        written = spark.read.schema(StructType(sorted(df.schema.fields, key=lambda f: f.name))).json(f"{place}/{name}")
        row = row_sum_fingerprint(written).select(F.lit(name).alias("table_name"), F.lit(run_id).alias("run_id"), "row_count", F.col("fingerprint").cast("string").alias("fingerprint"))
        manifest = row if manifest is None else manifest.unionByName(row)
    write_canonical_jsonl(manifest, f"{place}/manifest.jsonl")
    return manifest


def verify_blobs(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Blobs that are missing, unknown, or of another length than the manifest says: ``sha256, problem``."""
    m = manifest.select("sha256", F.col("byte_length").alias("expected"))
    f = files.groupBy("sha256").agg(F.max("length").alias("length"))
    problem = F.when(F.col("length").isNull(), "missing").when(F.col("expected").isNull(), "unknown").when(F.col("length") != F.col("expected"), "length")
    return m.join(f, "sha256", "full_outer").select("sha256", problem.alias("problem")).where("problem is not null")


def rows_with_hash(df: DataFrame) -> DataFrame:
    """Rows with the SHA-256 of their canonical JSON line."""
    return df.withColumn("row_sha256", row_hash(df))
