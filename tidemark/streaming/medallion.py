"""The layers as Structured Streaming queries.

The operators are the batch ones. What a file sink cannot update in place is written by ``foreachBatch``: each
batch to its own folder, which a repeated batch replaces, or the days a batch touches, made anew from the stored claims.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.config import AnomalyConfig
from tidemark.operators import anomaly, bronze, gold, silver
from tidemark.schemas import SILVER_CLAIM
from tidemark.session import stores
from tidemark.sources.sinks import write_batch_once, write_stream_batches

MONTH_COLUMN = "claim_month_part"


@contextmanager
def held(batch: DataFrame):
    """Keep a micro-batch cached while it is read more than once."""
    batch.persist()
    try:
        yield batch
    finally:
        batch.unpersist()


def _decoded(events: DataFrame, ingested_at: Column | None) -> DataFrame:
    stamp = ingested_at if ingested_at is not None else F.current_timestamp()
    return bronze.decode_events(bronze.event_metadata(events)).withColumn("_ingestion_timestamp", stamp)


def bronze_stream(events: DataFrame, bronze_path: str, checkpoint: str, ingested_at: Column | None = None,
                  delay: str = "10 minutes", trigger: str | None = None, name: str | None = None) -> StreamingQuery:
    """Decodable events to checked claims, de-duplicated by claim id within the watermark of the time of ingestion."""
    unique = (_decoded(events, ingested_at).where("is_valid").withColumn("_identity", F.col("event.claim_id"))
              .withWatermark("_ingestion_timestamp", delay).dropDuplicatesWithinWatermark(["_identity"]))

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch_once(bronze.dq_score(bronze.typed_claims(batch, F.col("_ingestion_timestamp"))), batch_id, bronze_path)

    return write_stream_batches(unique, write, checkpoint, trigger=trigger, name=name)


def dead_letter_stream(events: DataFrame, dead_letter_path: str, checkpoint: str, ingested_at: Column | None = None,
                       trigger: str | None = None, name: str | None = None) -> StreamingQuery:
    """Every event that cannot be decoded, however late and however alike: no state stands in between."""
    invalid = bronze.dead_letter(_decoded(events, ingested_at).where("NOT is_valid"), F.col("_ingestion_timestamp"))
    return write_stream_batches(invalid, lambda batch, n: write_batch_once(batch, n, dead_letter_path), checkpoint, trigger=trigger, name=name)


def routed_stream(envelopes: DataFrame, handlers: dict[str, Callable[[DataFrame], DataFrame]], path: str, checkpoint: str,
                  trigger: str | None = None, name: str | None = None) -> StreamingQuery:
    """Each micro-batch of envelope lines to the handlers of its event types (``*``: all readable ones).

    The rows a handler returns go to the folder of its event type. The batch is stored while the handlers read it, as the
    executors have no memory to keep its lines in.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        with stores() as store:
            lines = store(batch)
            for kind, handler in handlers.items():
                folder = "all" if kind == "*" else kind
                write_batch_once(handler(bronze.route(lines, kind)), batch_id, f"{path}/{folder}")

    return write_stream_batches(envelopes, write, checkpoint, trigger=trigger, name=name)


def table_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """A stored table as a stream; written files are taken once."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def _month(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM")


def silver_stream(bronze_claims: DataFrame, silver_path: str, alerts_path: str, checkpoint: str,
                  processed_at: Column | None = None, trigger: str | None = None, name: str | None = None) -> StreamingQuery:
    """Bronze claims to silver claims, by claim month, and high-risk alerts out of one pass."""
    claims = silver.silver_claims(bronze_claims, processed_at)

    def write(batch: DataFrame, batch_id: int) -> None:
        with held(batch):
            months = batch.withColumn(MONTH_COLUMN, F.coalesce(_month(F.col("claim_date")), F.lit("none"))).hint("rebalance", F.col(MONTH_COLUMN))
            months.write.mode("overwrite").partitionBy(MONTH_COLUMN).parquet(f"{silver_path}/batch={batch_id}")
            write_batch_once(silver.high_risk_alerts(batch), batch_id, alerts_path)

    return write_stream_batches(claims, write, checkpoint, trigger=trigger, name=name)


def stored_silver(spark: SparkSession, silver_path: str) -> DataFrame:
    """The silver claims written so far; a condition on the month column reads only those folders."""
    return spark.read.schema(StructType([*SILVER_CLAIM.fields, StructField(MONTH_COLUMN, StringType())])).parquet(silver_path)


GOLD = {
    "daily_claims_summary": (gold.daily_claims_summary, "summary_date"),
    "fraud_metrics": (gold.fraud_metrics, "metric_date"),
    "operational_kpis_wide": (gold.operational_kpis_wide, "kpi_date"),
    "operational_kpis": (gold.operational_kpis, "kpi_date"),
    "daily_summary_lite": (gold.daily_summary_lite, "summary_date"),
}


def gold_stream(silver_claims: DataFrame, silver_path: str, table: str, path: str, checkpoint: str,
                trigger: str | None = None, name: str | None = None) -> StreamingQuery:
    """A daily gold table kept up to date: the days that a batch touches are made anew from the stored claims.

    No state is kept and late claims need no watermark. Claims without a date are a day of their own. The rows of the touched days are written as a newer version;
    ``gold_table`` reads the newest of each day, so readers never find a day missing.
    """
    make, day = GOLD[table]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        touched = batch.select(F.coalesce(_month(F.col("claim_date")), F.lit("none")).alias("_month"),
                               F.to_date("claim_date").alias("_day")).distinct()
        claims = stored_silver(spark, silver_path).withColumn("_touched", F.to_date("claim_date"))
        own = (F.col(MONTH_COLUMN) == F.col("_month")) & F.col("_touched").eqNullSafe(F.col("_day"))
        write_batch_once(make(claims.join(touched, own, "left_semi")), batch_id, path)

    return write_stream_batches(silver_claims, write, checkpoint, trigger=trigger, name=name)


def gold_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The newest version of every day's rows."""
    day = GOLD[table][1]
    versions = spark.read.parquet(path)
    newest = versions.groupBy(day).agg(F.max("batch").alias("batch"))
    return anomaly.null_safe_join(versions, newest, [day, "batch"], "left_semi").drop("batch")


def profile_stream(silver_claims: DataFrame, silver_path: str, path: str, checkpoint: str, trigger: str | None = None,
                   name: str | None = None) -> StreamingQuery:
    """Customer risk profiles: those of a batch's customers anew, as a newer version; ``latest_rows`` picks it."""
    def write(batch: DataFrame, batch_id: int) -> None:
        customers = batch.select("customer_id").distinct()
        claims = anomaly.null_safe_join(stored_silver(batch.sparkSession, silver_path), customers, ["customer_id"], "left_semi")
        write_batch_once(gold.customer_risk_profiles(claims), batch_id, path)

    return write_stream_batches(silver_claims, write, checkpoint, trigger=trigger, name=name)


def _reaches(cfg: AnomalyConfig) -> list[tuple[list[str], int, int]]:
    """Keys by which claims affect others, and the days before and after a claim that it is seen from."""
    return [(["claim_type"], 0, 1), (["postcode_district", "claim_type"], 0, cfg.geo_days),
            (["customer_id"], 0, cfg.customer_days), (["incident_postcode"], cfg.network_days, cfg.network_days)]


def _day(at: Column) -> Column:
    return F.unix_date(F.to_date(at))


def _around(days: DataFrame, before: int, after: int, *keys: str) -> DataFrame:
    """The days from ``before`` a row's `_day` to ``after`` it, and one more for the hours; a null day stays."""
    return days.select(*keys, F.explode_outer(F.sequence(F.col("_day") - before, F.col("_day") + after + 1)).alias("_day")).distinct()


def affected_claims(new: DataFrame, history: DataFrame, cfg: AnomalyConfig) -> DataFrame:
    """New claims and the stored ones whose look-backs and surroundings they change.

    A claim counts in the windows of later claims of its type (a day), of its district and type (a week) and of its
    customer (90 days), and of claims around it at its postcode (three days). New claims are combined per (key, day)
    before the join and a stored claim looks its own day up, so no pairs of claims are formed. Claims without a date
    count in one another's windows.
    """
    dated = history.withColumn("_day", _day(F.col("claim_date")))
    found = None
    for keys, before, after in _reaches(cfg):
        reached = _around(new.select(*keys, _day(F.col("claim_date")).alias("_day")).distinct(), before, after, *keys)
        around = anomaly.null_safe_join(dated, reached, [*keys, "_day"], "left_semi").select("claim_id")
        found = around if found is None else found.union(around)
    return history.join(found.union(new.select("claim_id")).distinct(), "claim_id", "left_semi")


def touched_history(batch: DataFrame, stored: DataFrame, cfg: AnomalyConfig) -> DataFrame:
    """The stored claims that scoring the claims affected by ``batch`` may look at: of touched days only.

    An affected claim is up to ``customer_days`` after a new one, or ``network_days`` around it, and looks back as far.
    The days come from the days of the new claims (one row each, however many claims), so a claim of 1970 adds the days
    that it reaches and not the time since. Their months, at most one row a month, are collected for the scan, which
    opens no other folder.
    """
    reach = max(cfg.customer_days, cfg.geo_days) + cfg.network_days + 1
    days = _around(batch.select(_day(F.col("claim_date")).alias("_day")).distinct(), reach + cfg.network_days, reach)
    month = F.coalesce(_month(F.date_from_unix_date("_day")), F.lit("none"))
    months = [r[0] for r in days.select(month).distinct().collect()]
    claims = stored.where(F.col(MONTH_COLUMN).isin(months)).withColumn("_day", _day(F.col("claim_date")))
    return anomaly.null_safe_join(claims, days, ["_day"], "left_semi").drop("_day")


def refresh_baselines(spark: SparkSession, silver_path: str, baselines_path: str, as_of: Column | None = None,
                      cfg: AnomalyConfig = AnomalyConfig()) -> None:
    """Make the table of baselines anew; a job of its own, as they change slowly and read ``history_days`` of claims."""
    claims = stored_silver(spark, silver_path)
    if as_of is not None:
        first = F.date_sub(F.to_date(as_of), cfg.history_days)
        claims = claims.where(F.col(MONTH_COLUMN) >= _month(first))
    anomaly.statistical_baselines(claims, as_of, cfg).write.mode("overwrite").parquet(baselines_path)


def anomaly_stream(silver_claims: DataFrame, silver_path: str, baselines_path: str, scores_path: str, checkpoint: str,
                   detected_at: Column | None = None, cfg: AnomalyConfig = AnomalyConfig(), trigger: str | None = None,
                   name: str | None = None) -> StreamingQuery:
    """Scores of new claims, and again of the stored claims they affect, batch by batch.

    Window functions over history cannot run on a stream, so each batch reads the days of stored claims that the
    affected rows look at, keeps the keys these rows have and scores them against the stored baselines. A claim scored
    again gets a newer version; ``latest_rows`` picks it. The new claims, their history, the affected claims and what
    each detector gives are stored for the length of the batch: as one plan, every detector repeats the steps before it,
    and the driver's memory does not hold that.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with stores() as store:
            new = store(batch.select(*anomaly.INPUT_COLUMNS))
            history = store(touched_history(new, stored_silver(spark, silver_path), cfg).select(*anomaly.INPUT_COLUMNS))
            rows = store(affected_claims(new, history, cfg))
            last: list[DataFrame] = []

            def relayed(scored: DataFrame) -> DataFrame:
                last[:] = [store(scored, *last)]
                return last[0]

            stamp = detected_at if detected_at is not None else F.current_timestamp()
            scored = anomaly.score_claims(rows, spark.read.parquet(baselines_path), cfg, history, True, relayed)
            write_batch_once(scored.select(*anomaly.OUTPUT_COLUMNS, stamp.alias("anomaly_detection_timestamp")), batch_id, scores_path)

    return write_stream_batches(silver_claims, write, checkpoint, trigger=trigger, name=name)


def latest_rows(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The newest version of every key's row, combined map-side."""
    versions = spark.read.parquet(path)
    values = F.struct(*[c for c in versions.columns if c not in (key, "batch")])
    newest = versions.groupBy(key).agg(F.max_by(values, "batch").alias("row"))
    return newest.select(key, "row.*")


def latest_scores(spark: SparkSession, scores_path: str) -> DataFrame:
    return latest_rows(spark, scores_path, "claim_id")
