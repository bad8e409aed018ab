"""Where intermediate tables go, and how a plan is cut.

Work shared by several consumers is written once as Parquet below the checkpoint
folder that the session names, then read back.  Unlike cached blocks it outlives
the executors that made it, keeps column pruning and carries real size statistics.
"""

from __future__ import annotations

import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

# A session that names no checkpoint folder: its folder, by application.
_fallback: dict[str, str] = {}

_shipped: set[str] = set()

# Folders of staged tables by reader, and those that end with a block (``passing``), by thread.
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_blocks = threading.local()

# What is written here and in the sinks is read back many times, and disk is what a long run is short of.
CODEC = "zstd"
SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        archive = shutil.make_archive(
            str(Path(tempfile.mkdtemp(prefix="voltledger-ship-")) / root.name), "zip", root.parent, root.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


def _own_folder(spark: SparkSession) -> str:
    """Below the warehouse, which all executors reach; a folder of this machine only in local mode."""
    local = spark.sparkContext.master.split("[")[0] == "local"
    if local:
        return tempfile.mkdtemp(prefix="voltledger-")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    default = spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if warehouse.startswith("file:") or ("://" not in warehouse and default.startswith("file:")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return f"{warehouse.rstrip('/')}/_scratch"


def scratch_root(spark: SparkSession) -> str:
    """Shared scratch folder of this application."""
    app = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = _fallback.get(app) or _fallback.setdefault(app, _own_folder(spark))
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/voltledger-{app}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage", *more: DataFrame) -> DataFrame:
    """Write ``df``, and ``more`` of the same columns one after the other, once; return a reader of the written table."""
    path = scratch_path(df.sparkSession, label)
    for made in getattr(_blocks, "made", [])[-1:]:
        made.append(path)
    df.write.mode("errorifexists").parquet(path, compression=CODEC)
    for part in more:
        part.write.mode("append").parquet(path, compression=CODEC)
    reader = df.sparkSession.read.schema(df.schema).parquet(path)
    _folders[reader] = path
    return reader


def _delete(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def discard(*staged: DataFrame) -> None:
    """Delete staged tables that nothing reads any more; frames that ``stage`` did not return are left alone."""
    for df in staged:
        if path := _folders.pop(df, None):
            _delete(df.sparkSession, path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What is staged in this block by this thread is deleted at its end, also if it fails.

    Results are published, collected or reduced to literals before: frames over what was staged fail afterwards.
    """
    made: list[str] = []
    blocks = _blocks.__dict__.setdefault("made", [])
    blocks.append(made)
    try:
        yield
    finally:
        blocks.pop()
        for path in made:
            _delete(spark, path)


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """In this block the shuffle files of a query go as it ends, and not when the driver happens to collect garbage."""
    before = spark.conf.get(SWEEP, None)
    spark.conf.set(SWEEP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SWEEP) if before is None else spark.conf.set(SWEEP, before)


def release(spark: SparkSession) -> bool:
    """Delete everything this application staged; call when its results are consumed."""
    return _delete(spark, scratch_root(spark))
