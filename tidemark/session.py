"""Session set-up and the few run-time helpers every plan shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# The JVM never compiles methods of more than 8000 bytes; wide claim expressions fused into one
# generated method would run interpreted, so such stages are generated in smaller methods instead.
_HUGE_METHODS = ("spark.sql.codegen.hugeMethodLimit", "8000")


def build_session(app: str = "tidemark", master: str | None = None, partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with the settings the library expects. On a cluster pass no master/partitions."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(*_HUGE_METHODS)
    )
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the run-time settings the operators rely on; safe to call on any session."""
    for key, value in (("spark.sql.session.timeZone", "UTC"), _HUGE_METHODS):
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for hand-over tables: the one the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder; on a cluster that is an error, since
    executors do not see each other's disks.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; Spark deletes it when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


# Else shuffle files stay until the driver happens to collect its garbage, beside those of the next steps.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read from there; the shuffle files of the write are deleted at its end."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Store ``df`` as Parquet in the shared folder and read it back.

    This drops its lineage and survives lost executors, and later reads take only the columns and rows
    they need.
    """
    return _stored(df, work_path(df.sparkSession, "cut"))


@contextmanager
def stores() -> Iterator[Callable[..., DataFrame]]:
    """A function that stores frames like ``cut`` for the length of a ``with`` block; the files are deleted after it.

    With ``instead_of`` a frame that it gave before, which is read for the last time now, is deleted at once.
    """
    paths: dict[DataFrame, tuple[SparkSession, str]] = {}

    def store(df: DataFrame, instead_of: DataFrame | None = None) -> DataFrame:
        spark, path = df.sparkSession, work_path(df.sparkSession, "kept")
        out = _stored(df, path)
        paths[out] = spark, path
        if instead_of is not None:
            _removed(*paths.pop(instead_of))
        return out

    try:
        yield store
    finally:
        for spark, path in paths.values():
            _removed(spark, path)


def _removed(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
