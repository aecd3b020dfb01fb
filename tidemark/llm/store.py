"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`. Unset, a temporary one is made on a local master; on a cluster that is an error."""
    configured = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    made = tempfile.mkdtemp(prefix="tidemark-llm-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; Spark removes it when the application ends."""
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(context._jsc.hadoopConfiguration()).delete(hadoop, True)


def written(df: DataFrame, name: str) -> str:
    """Write a frame as Parquet to a fresh path and return the path."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once as Parquet and read it back: lineage is cut, later reads are pruned."""
    return df.sparkSession.read.schema(df.schema).parquet(written(df, name))


def boxed(df: DataFrame, *used: str) -> DataFrame:
    """The columns an operator uses, and all others inside the struct `_rest`, where their names cannot clash."""
    others = [c for c in df.columns if c not in used]
    return df.select(*used, (F.struct(*(F.col(f"`{c}`") for c in others)) if others else F.lit(0)).alias("_rest"))


def unboxed(df: DataFrame, columns: list[str], *used: str) -> DataFrame:
    """The columns of `boxed` in their first order."""
    return df.select(*(F.col(c) if c in used else F.col("_rest").getField(c).alias(c) for c in columns))
