"""Shared scratch space and size checks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neardup.config import MAX_BROADCAST_BYTES


def checkpoint_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if root:
        return root
    root = sc.getCheckpointDir()
    if root:
        return root
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="neardup-checkpoint-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/neardup-{name}-{uuid.uuid4().hex}"


# Per context: runs in two threads do not delete each other's tables.
_open_scope: ContextVar[list[str] | None] = ContextVar("open_scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables written inside; results must be stored before the end."""
    written: list[str] = []
    outer = _open_scope.set(written)
    try:
        yield
    finally:
        _open_scope.reset(outer)
        for path in written:
            fs, target = hadoop_path(spark, path)
            fs.delete(target, True)


def hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a stage output was committed."""
    fs, marker = hadoop_path(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def brief_session(spark: SparkSession) -> SparkSession:
    """A session whose shuffles are removed as soon as the table they feed is written."""
    own = spark.newSession()
    own.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    partitions = "spark.sql.shuffle.partitions"
    own.conf.set(partitions, spark.conf.get(partitions))
    return own


def stage_path(spark: SparkSession, name: str) -> str:
    """A scratch path whose table goes with the open scope, if there is one."""
    path = scratch_path(spark, name)
    written = _open_scope.get()
    if written is not None:
        written.append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared scratch folder and read it back.

    Cuts the lineage, survives lost executors and, unlike an RDD checkpoint,
    keeps column pruning for the readers.
    """
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(rows: int, bytes_per_row: int) -> bool:
    return rows * bytes_per_row <= MAX_BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, bytes_per_row: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows fit the limit, else unhinted."""
    return F.broadcast(df) if fits_broadcast(df.count(), bytes_per_row) else df
