"""Streams over several micro-batches, with late, repeated and bad rows in every order."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.config import AnomalyConfig
from tidemark.operators import anomaly, gold
from tidemark.plans.catalogue.ingest import scored_bronze
from tidemark.plans.claims import as_of, silver_frame
from tidemark.schemas import SILVER_CLAIM
from tidemark.session import work_path
from tidemark.sources import events
from tidemark.streaming import medallion

SF_DIR = "/root/testdata/sf0.001"


def test_every_bad_line_of_a_text_file_is_a_dead_letter(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    dead, checkpoint = str(tmp_path / "dead"), str(tmp_path / "checkpoint")
    for n, lines in enumerate([["broken {", "broken {", "null"], ["[]", "broken {"]]):
        (folder / f"{n}.txt").write_text("\n".join(lines) + "\n")
        source = events.stream_source(spark, str(folder), "text")
        medallion.dead_letter_stream(source, dead, checkpoint).awaitTermination()
    assert sorted(r.raw_data for r in spark.read.parquet(dead).collect()) == ["[]", "broken {", "broken {", "broken {", "null"]


def test_claims_are_taken_once_whatever_the_order(spark, tmp_path):
    body = '{{"claim_id":"C{}","claim_amount":{}.0}}'
    lines = [body.format(i % 40, i) for i in range(100)] + ["broken"] * 5
    random.Random(2).shuffle(lines)
    folder = tmp_path / "lines"
    folder.mkdir()
    table, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "checkpoint")
    for n in range(3):
        (folder / f"{n}.txt").write_text("\n".join(lines[n::3]) + "\n")
        medallion.bronze_stream(events.stream_source(spark, str(folder), "text"), table, checkpoint).awaitTermination()
    assert sorted(r.claim_id for r in spark.read.parquet(table).collect()) == sorted(f"C{i}" for i in range(40))


def arrive(spark, order, after):
    """Silver claims written by the stream in three loads, the given order first to last; ``after`` runs on the table."""
    claims = scored_bronze(spark, SF_DIR)
    load = {"old_first": F.ntile(3), "new_first": F.ntile(3)}[order]
    from pyspark.sql.window import Window
    at = F.col("claim_date").asc() if order == "old_first" else F.col("claim_date").desc()
    parted = claims.withColumn("_load", load.over(Window.orderBy(at, "claim_id"))).cache()
    folder, table, alerts, checkpoint = (work_path(spark, n) for n in ("bronze", "silver", "alerts", "checkpoint"))
    for n in (1, 2, 3):
        parted.where(F.col("_load") == n).drop("_load").write.mode("append").parquet(folder)
        medallion.silver_stream(medallion.table_stream(spark, folder, claims.schema), table, alerts, checkpoint,
                                F.col("_silver_timestamp")).awaitTermination()
        after(table)
    return table


def same(left, right, columns):
    rounded = lambda df: df.select(*[F.round(c, 6).alias(c) if df.schema[c].dataType.simpleString() == "double" else F.col(c) for c in columns])
    a, b = rounded(left), rounded(right)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_scores_are_made_anew_where_late_claims_change_them(spark):
    baselines, scores, checkpoint = (work_path(spark, n) for n in ("baselines", "scores", "checkpoint"))
    anomaly.statistical_baselines(silver_frame(spark, SF_DIR), as_of()).write.parquet(baselines)
    arrive(spark, "new_first", lambda table: medallion.anomaly_stream(
        medallion.table_stream(spark, table, SILVER_CLAIM), table, baselines, scores, checkpoint, as_of()).awaitTermination())
    whole = anomaly.score_claims(silver_frame(spark, SF_DIR), spark.read.parquet(baselines))
    same(medallion.latest_scores(spark, scores), whole, ["claim_id", "composite_anomaly_score", "customer_anomaly_score",
                                                         "geographic_anomaly_score", "network_anomaly_score", "time_series_anomaly_score"])


def test_baselines_job_reads_the_stored_claims(spark):
    table = arrive(spark, "old_first", lambda table: None)
    path = work_path(spark, "baselines")
    medallion.refresh_baselines(spark, table, path, as_of())
    rows = lambda df: {r.claim_type: (r.mean_amount, r.stddev_amount, r.median_amount) for r in df.collect()}
    found, whole = rows(spark.read.parquet(path)), rows(anomaly.statistical_baselines(silver_frame(spark, SF_DIR), as_of()))
    assert set(found) == set(whole)
    for kind, figures in whole.items():
        assert found[kind] == pytest.approx(figures, rel=1e-9)


def test_gold_days_are_replaced_and_others_left(spark):
    path, checkpoint = work_path(spark, "gold"), work_path(spark, "checkpoint")
    arrive(spark, "new_first", lambda table: medallion.gold_stream(
        medallion.table_stream(spark, table, SILVER_CLAIM), table, "daily_claims_summary", path, checkpoint).awaitTermination())
    same(medallion.gold_table(spark, path, "daily_claims_summary"), gold.daily_claims_summary(silver_frame(spark, SF_DIR)),
         ["summary_date", "claim_type", "total_claims", "median_amount", "fraud_detected_count"])


def test_files_do_not_start_at_the_latest(spark, tmp_path):
    with pytest.raises(ValueError, match="modifiedAfter"):
        events.stream_source(spark, str(tmp_path), "text", start="latest")


def test_claims_without_date_or_customer_reach_every_stream(spark, monkeypatch):
    nulled = lambda c, r: F.when(F.pmod(F.xxhash64("claim_id"), F.lit(7)) != r, F.col(c))
    monkeypatch.setitem(globals(), "scored_bronze", lambda s, d, make=scored_bronze: make(s, d).withColumns(
        {"claim_date": nulled("claim_date", 0), "customer_id": nulled("customer_id", 1)}))
    paths = {n: (work_path(spark, n), work_path(spark, f"{n}-checkpoint")) for n in ("daily", "profile", "scores")}
    baselines = work_path(spark, "baselines")
    anomaly.statistical_baselines(silver_frame(spark, SF_DIR), as_of()).write.parquet(baselines)

    def after(table):
        source = lambda: medallion.table_stream(spark, table, SILVER_CLAIM)
        medallion.gold_stream(source(), table, "daily_claims_summary", *paths["daily"]).awaitTermination()
        medallion.profile_stream(source(), table, *paths["profile"]).awaitTermination()
        medallion.anomaly_stream(source(), table, baselines, *paths["scores"], as_of()).awaitTermination()

    silver = medallion.stored_silver(spark, arrive(spark, "new_first", after)).cache()
    assert silver.where("claim_date IS NULL").count() > 0 and silver.where("customer_id IS NULL").count() > 0
    same(medallion.gold_table(spark, paths["daily"][0], "daily_claims_summary"), gold.daily_claims_summary(silver),
         ["summary_date", "claim_type", "total_claims", "median_amount", "fraud_detected_count"])
    same(medallion.latest_rows(spark, paths["profile"][0], "customer_id"), gold.customer_risk_profiles(silver), ["customer_id", "total_claims"])
    whole = anomaly.score_claims(silver, spark.read.parquet(baselines))
    same(medallion.latest_scores(spark, paths["scores"][0]), whole, ["claim_id", "composite_anomaly_score", "customer_anomaly_score",
                                                                     "geographic_anomaly_score", "network_anomaly_score", "time_series_anomaly_score"])


def test_history_is_read_by_touched_days(spark):
    """A claim of 1970 and one of far ahead add their own months to the scan, not the time between."""
    path, cfg = work_path(spark, "silver"), AnomalyConfig()
    claims = silver_frame(spark, SF_DIR).where("claim_date < '2024-03-01'")
    old = claims.limit(1).withColumns({"claim_date": F.lit("1970-06-15 12:00:00").cast("timestamp"), "claim_id": F.lit("old")})
    far = old.withColumns({"claim_date": F.lit("2090-06-15 12:00:00").cast("timestamp"), "claim_id": F.lit("far")})
    undated = old.withColumns({"claim_date": F.lit(None).cast("timestamp"), "claim_id": F.lit("undated")})
    stored = claims.unionByName(old).unionByName(far).unionByName(undated)
    month = F.coalesce(F.date_format("claim_date", "yyyy-MM"), F.lit("none"))
    stored.withColumn(medallion.MONTH_COLUMN, month).write.partitionBy(medallion.MONTH_COLUMN).parquet(f"{path}/batch=0")

    def read(*ids):
        batch = stored.where(F.col("claim_id").isin(*ids))
        found = medallion.touched_history(batch, medallion.stored_silver(spark, path), cfg)
        kept = found._jdf.queryExecution().optimizedPlan().toString()
        months = re.search(rf"{medallion.MONTH_COLUMN}#\d+ (?:IN \(|INSET |= )([^)\n]*)", kept)[1]
        return {r.claim_id for r in found.select("claim_id").collect()}, set(months.replace(" ", "").split(","))

    rows, months = read("old", "far")
    assert rows == {"old", "far"}
    assert months <= {f"{year}-{month:02}" for year in (1970, 2090) for month in range(1, 13)}
    rows, months = read("undated")
    assert rows == {"undated"} and months == {"none"}
    rows, months = read("old", claims.first().claim_id)
    assert "far" not in rows and len(rows) > 2 and "1970-06" in months and len(months) < 20


def test_a_batch_is_scored_in_stored_steps_that_go_again(spark, monkeypatch):
    """What is written last is a plan of its own, without the steps before it, and its tables are deleted."""
    path, baselines, checkpoint = (work_path(spark, n) for n in ("silver", "baselines", "checkpoint"))
    claims = silver_frame(spark, SF_DIR).where("claim_date < '2024-02-01'").cache()
    anomaly.statistical_baselines(claims).write.parquet(baselines)
    claims.withColumn(medallion.MONTH_COLUMN, F.date_format("claim_date", "yyyy-MM")).write.partitionBy(
        medallion.MONTH_COLUMN).parquet(f"{path}/batch=0")
    written = []
    monkeypatch.setattr(medallion, "write_batch_once", lambda df, n, path: written.append(
        (df.count(), df._jdf.queryExecution().executedPlan().toString().count("Exchange"))))
    medallion.anomaly_stream(medallion.table_stream(spark, path, SILVER_CLAIM), path, baselines, "", checkpoint, as_of()).awaitTermination()
    assert written == [(claims.count(), 0)]
    assert not [f for f in os.listdir(spark.conf.get("spark.checkpoint.dir")) if f.startswith("kept-")]


def test_routed_batches_are_not_kept_in_memory(spark, monkeypatch):
    folder, table, checkpoint = (work_path(spark, n) for n in ("envelopes", "routed", "checkpoint"))
    lines = spark.createDataFrame([('{"event_id": "%d", "event_type": "%s"}' % (n, "ab"[n % 2]),) for n in range(9)] + [("broken {",)], "value string")
    lines.write.parquet(folder)
    plans, write = [], medallion.write_batch_once
    monkeypatch.setattr(medallion, "write_batch_once", lambda df, n, path: (
        plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, n, path)))
    handlers = {"a": lambda rows: rows.select("event_id"), "*": lambda rows: rows.select("event_id")}
    medallion.routed_stream(medallion.table_stream(spark, folder, lines.schema), handlers, table, checkpoint).awaitTermination()
    assert [sorted(int(r.event_id) for r in spark.read.parquet(f"{table}/{k}").collect()) for k in ("a", "all")] == [[0, 2, 4, 6, 8], [*range(9)]]
    assert len(plans) == 2 and not any("InMemoryTableScan" in plan for plan in plans)
    assert not [f for f in os.listdir(spark.conf.get("spark.checkpoint.dir")) if f.startswith("kept-")]
