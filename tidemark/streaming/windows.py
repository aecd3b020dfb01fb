"""Gold figures as stateful streaming aggregates over windows of the claim time.

The watermark bounds the state: figures of a window are kept until the watermark passes its end, and no stored claim is
read again. In append mode a window is written once, when it is over; in update mode each batch writes the windows that
it changes, as newer versions. Claims that come after their window is over are not in its figures; a stream of its own
counts them. Percentiles need the stored claims and are left to the batch tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.windows import null_safe_join
from tidemark.operators import gold
from tidemark.sources.sinks import write_batch_once, write_stream_batches, write_stream_table
from tidemark.streaming.tracking import use_rocksdb

AT = "claim_date"
BOUNDS = ["window_start", "window_end"]


@dataclass(frozen=True)
class Windowed:
    """Windows of one length, their keys and figures."""

    length: str
    keys: tuple[str, ...]
    figures: Callable[[], list[Column]]


TABLES = {
    "daily_claims_summary": Windowed("1 day", ("claim_type",), gold.summary_figures),
    "fraud_metrics": Windowed("1 hour", (), gold.fraud_figures),
    "operational_kpis": Windowed("1 day", (), gold.operational_figures),
    "daily_summary_lite": Windowed("1 day", ("claim_type",), gold.lite_figures),
}


def windowed(claims: DataFrame, table: str, delay: str) -> DataFrame:
    """Figures per window and keys; claims without a time are in no window."""
    made = TABLES[table]
    figures = claims.withWatermark(AT, delay).groupBy(F.window(AT, made.length), *made.keys).agg(*made.figures())
    return figures.select(F.col("window.start").alias(BOUNDS[0]), F.col("window.end").alias(BOUNDS[1]), *[c for c in figures.columns if c != "window"])


def closed_windows_stream(claims: DataFrame, table: str, path: str, checkpoint: str, delay: str = "7 days",
                          trigger: str | None = None, name: str | None = None) -> StreamingQuery:
    """Append mode: each window once, when the watermark has passed its end."""
    use_rocksdb(claims.sparkSession)
    return write_stream_table(windowed(claims, table, delay), path, checkpoint, trigger=trigger, name=name)


def open_windows_stream(claims: DataFrame, table: str, path: str, checkpoint: str, delay: str = "7 days",
                        trigger: str | None = None, name: str | None = None) -> StreamingQuery:
    """Update mode: the windows that a batch changes, as newer versions; ``newest_windows`` picks them."""
    use_rocksdb(claims.sparkSession)
    return write_stream_batches(windowed(claims, table, delay), lambda batch, n: write_batch_once(batch, n, path), checkpoint, "update", trigger, name)


def newest_windows(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The newest version of every window."""
    by = [*BOUNDS, *TABLES[table].keys]
    versions = spark.read.parquet(path)
    newest = versions.groupBy(*by).agg(F.max("batch").alias("batch"))
    return null_safe_join(versions, newest, [*by, "batch"], "left_semi").drop("batch")


def late_claims_stream(claims: DataFrame, table: str, path: str, checkpoint: str, delay: str = "7 days",
                       trigger: str | None = None, name: str | None = None) -> StreamingQuery:
    """Claims per window that the windows' streams leave out, as their window was over: ``late_claims``.

    The watermark of a batch follows from the latest claim times of the batches before it, one stored row each, so a
    repeated batch finds the same. The source and trigger have to be those of the windows' stream. Claims without a time
    are counted under a null window.
    """
    made = TABLES[table]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        write_batch_once(batch.agg(F.max(AT).alias("latest")), batch_id, f"{path}/marks")
        mark = (spark.read.schema("latest timestamp, batch int").parquet(f"{path}/marks").where(F.col("batch") < batch_id)
                .agg((F.max("latest") - F.expr(f"INTERVAL {delay}")).alias("mark")))
        bounds = F.when(F.col(AT).isNotNull(), F.window(F.coalesce(AT, F.timestamp_seconds(F.lit(0))), made.length))
        rows = batch.withColumn("_w", bounds).join(F.broadcast(mark))  # one row
        late = rows.where(F.col("_w").isNull() | (F.col("_w.end") <= F.col("mark")))
        counted = late.groupBy(F.col("_w.start").alias(BOUNDS[0]), F.col("_w.end").alias(BOUNDS[1]), *made.keys).agg(F.count("*").alias("late_claims"))
        write_batch_once(counted, batch_id, f"{path}/late")

    return write_stream_batches(claims, write, checkpoint, trigger=trigger, name=name)


def late_claims(spark: SparkSession, path: str, table: str) -> DataFrame:
    """All late claims per window and keys."""
    return spark.read.parquet(f"{path}/late").groupBy(*BOUNDS, *TABLES[table].keys).agg(F.sum("late_claims").alias("late_claims"))
