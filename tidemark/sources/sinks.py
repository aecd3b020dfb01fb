"""Sinks: streaming tables, partitioned tables and file exports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def write_stream_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append", trigger: str | None = None,
                       partition_by: list[str] | None = None, name: str | None = None) -> StreamingQuery:
    """Append a stream to a parquet table. Without ``trigger`` all available data is taken once."""
    writer = df.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return _started(writer, trigger, partition_by, name)


def write_stream_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
                         trigger: str | None = None, name: str | None = None) -> StreamingQuery:
    """Hand each micro-batch to ``write(batch, batch_id)``; a batch may come twice after a failure."""
    writer = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    return _started(writer, trigger, None, name)


def _started(writer, trigger, partition_by, name) -> StreamingQuery:
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return (writer.queryName(name) if name else writer).start()


def write_batch_once(batch: DataFrame, batch_id: int, path: str) -> None:
    """Write a micro-batch to its own folder, so that a repeated batch replaces itself."""
    batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def partitioned_table_write(df: DataFrame, path: str, partitions: dict[str, Column], mode: str = "overwrite",
                            rows_per_file: int = 0) -> None:
    """Write a parquet table partitioned by real columns made from expressions.

    Rows are rebalanced by the partition columns first: every value gets few files, and adaptive
    execution splits a value that holds much of the data over several tasks.
    """
    prepared = df.withColumns(partitions).hint("rebalance", *[F.col(c) for c in partitions])
    writer = prepared.write.mode(mode).partitionBy(*partitions)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def export_files(df: DataFrame, path: str, file_format: str = "json", single_file: bool = False,
                 partition_by: list[str] | None = None) -> str:
    """Export to json, csv (with header) or parquet files.

    One file means one task writes everything, so it has to be asked for.
    """
    writer = (df.coalesce(1) if single_file else df).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if file_format == "csv":
        writer.option("header", True).csv(path)
    elif file_format == "json":
        writer.json(path)
    elif file_format == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown export format {file_format!r}")
    return path


def read_export(spark: SparkSession, path: str, file_format: str, schema) -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(path) if file_format == "csv" else reader.format(file_format).load(path)
