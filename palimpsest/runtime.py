"""Session helpers: lineage cuts in the shared folder and table loading."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_OWN_DIR: dict[str, str] = {}
_SHIPPED: set[str] = set()
_WRITTEN: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: Folders that :func:`materialize` made and nothing has deleted yet.
_FOLDERS: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    made = tempfile.TemporaryDirectory(prefix="palimpsest-code-")
    atexit.register(made.cleanup)
    package = Path(__file__).resolve().parent
    if package.is_dir():
        shutil.copytree(package, f"{made.name}/code/{package.name}", ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(f"{made.name}/{package.name}-code", "zip", f"{made.name}/code"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Only where the session names none (tests, local runs) is a folder of our
    own made; a local master has no other machine that would need it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIR:
        made = tempfile.TemporaryDirectory(prefix="palimpsest-")
        atexit.register(made.cleanup)
        _OWN_DIR[app] = "file://" + made.name
    return _OWN_DIR[app]


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    It cuts the lineage with data that outlives any executor, and, unlike a
    cached plan, later stages read only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    made = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[made] = path
    _FOLDERS.add(path)
    return made


def materialize_counted(df: DataFrame, label: str, *metrics: Column) -> tuple[DataFrame, list]:
    """:func:`materialize`, with aggregates of the rows that come out of the same write."""
    observed = Observation(f"{label}-{uuid.uuid4().hex}")
    names = [f"m{i}" for i in range(len(metrics))]
    made = materialize(df.observe(observed, *[m.alias(n) for m, n in zip(metrics, names)]), label)
    values = observed.get
    return made, [values[n] for n in names]


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    _FOLDERS.discard(path)


def discard(df: DataFrame) -> None:
    """Delete the files behind a materialized DataFrame that nothing reads any more."""
    if path := _WRITTEN.pop(df, None):
        _delete(df.sparkSession, path)


def discard_all(spark: SparkSession) -> int:
    """Delete all that :func:`materialize` has written in this process; call it when no result is read any more."""
    paths = list(_FOLDERS)
    for path in paths:
        _delete(spark, path)
    return len(paths)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
