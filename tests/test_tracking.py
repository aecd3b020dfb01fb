"""Holder tracking with state that ends, in bounded memory."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.session import work_path
from tidemark.sources import sinks
from tidemark.streaming import tracking
from tidemark.streaming.medallion import table_stream

SCHEMA = "policyholder_id string, claim_id string, incident_date timestamp, fraud_score double"


class Counting(dict):
    """Map state in memory that knows how many rows were outside of it."""

    def updateValue(self, key, value):
        self[key] = value

    def containsKey(self, key):
        return key in self

    def getValue(self, key):
        return self[key]

    def removeKey(self, key):
        del self[key]


def test_runs_merge_in_bounded_memory():
    rng = random.Random(1)
    claims = [(rng.choice([None, rng.randrange(500)]), rng.choice([None, f"c{rng.randrange(3000)}"]), rng.random()) for _ in range(20_000)]
    state, total, high = Counting(), len(claims), 0
    out = []
    for claim in tracking.Runs(state, 700, 50).ordered(claims):
        out.append(claim)
        inside = sum(len(v[0]) for v in state.values())
        high = max(high, total - len(out) - inside)
    assert sorted(out, key=tracking._rank) == out and sorted(map(str, out)) == sorted(map(str, claims))
    assert not state
    assert high <= 700 + 50 * (20_000 // 700 + 1)  # the last run, and a block of each other


def tracked(spark, loads, **options):
    folder, table, checkpoint = (work_path(spark, n) for n in ("claims", "tracked", "checkpoint"))
    delay = options.pop("delay", None)
    for rows in loads:
        frame = rows if hasattr(rows, "write") else spark.createDataFrame(rows, "p string, c string, d string, s double").select(
            F.col("p").alias("policyholder_id"), F.col("c").alias("claim_id"), F.to_timestamp("d").alias("incident_date"), F.col("s").alias("fraud_score"))
        frame.write.mode("append").parquet(folder)
        source = table_stream(spark, folder, SCHEMA)
        source = source.withWatermark("incident_date", delay) if delay else source
        sinks.write_stream_table(tracking.track_scores(source, **options), table, checkpoint).awaitTermination()
    return spark.read.parquet(table), checkpoint


LOADS = [
    [("a", "c1", "2024-01-01", 0.9), ("b", "c2", "2024-01-02", 0.9), ("a", "c3", "2024-01-03", 0.9), (None, "c9", "2024-01-01", 0.1)],
    [("b", "c4", "2024-06-01", 0.9)],
    [("a", "c5", "2024-06-02", 0.9), ("b", "c6", "2024-06-02", 0.9), ("a", "c7", "2024-06-03", None)],
]


def test_idle_holders_are_forgotten(spark):
    rows, checkpoint = tracked(spark, LOADS, idle_days=90, delay="0 seconds")
    assert {r.claim_id: (r.policyholder_id, r.claim_number, r.blacklists_holder) for r in rows.collect()} == {
        "c1": ("a", 1, False), "c3": ("a", 2, False), "c5": ("a", 1, False), "c7": ("a", 2, False),
        "c2": ("b", 1, False), "c4": ("b", 1, False), "c6": ("b", 2, False), "c9": (None, 1, False)}
    left = spark.read.format("statestore").option("stateVarName", "claims").load(checkpoint).select("key.policyholder_id").collect()
    assert {r[0] for r in left} == {"a", "b"}  # the holder without id was not seen again


def test_without_end_nothing_is_forgotten(spark):
    rows, checkpoint = tracked(spark, LOADS)
    assert numbers(rows) == UNENDING
    assert spark.read.format("statestore").option("stateVarName", "claims").load(checkpoint).count() == 3
    with pytest.raises(ValueError, match="not by both"):
        tracking.track_scores(rows, idle_days=1, ttl_hours=1)


UNENDING = {"c1": (1, None, False), "c3": (2, None, False), "c5": (3, pytest.approx(0.9), True), "c7": (4, None, False),
            "c2": (1, None, False), "c4": (2, None, False), "c6": (3, pytest.approx(0.9), True), "c9": (1, None, False)}


def numbers(rows):
    return {r.claim_id: (r.claim_number, r.recent_mean, r.blacklists_holder) for r in rows.collect()}


def test_state_with_a_time_to_live(spark):
    """By the clock; the stream runs until it is stopped."""
    folder, table, checkpoint = (work_path(spark, n) for n in ("claims", "tracked", "checkpoint"))
    spark.createDataFrame(sum(LOADS, []), "p string, c string, d string, s double").select(
        F.col("p").alias("policyholder_id"), F.col("c").alias("claim_id"), F.to_timestamp("d").alias("incident_date"), F.col("s").alias("fraud_score")
    ).write.parquet(folder)
    query = sinks.write_stream_table(tracking.track_scores(table_stream(spark, folder, SCHEMA), ttl_hours=1), table, checkpoint, trigger="1 second")
    try:
        end = time.time() + 60
        while time.time() < end and not any(p["numInputRows"] for p in query.recentProgress):
            time.sleep(0.5)
    finally:
        query.stop()
    assert numbers(spark.read.parquet(table)) == UNENDING


def test_one_holder_with_very_many_claims(spark):
    """More claims than a run holds, in an order of their own."""
    n = 200_000
    claims = spark.range(n, numPartitions=6).select(
        F.lit("hot").alias("policyholder_id"), F.format_string("c%07d", F.pmod(F.col("id") * 7919, F.lit(n))).alias("claim_id"),
        F.timestamp_seconds(F.pmod(F.col("id") * 7919, F.lit(n)) * 60).alias("incident_date"), F.lit(0.5).alias("fraud_score"))
    rows, _ = tracked(spark, [claims], run_rows=20_000)
    wrong = rows.where(F.col("claim_number") != F.substring("claim_id", 2, 7).cast("long") + 1).count()
    assert (rows.count(), wrong) == (n, 0)
