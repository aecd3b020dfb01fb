"""Sequential scores, rings and components against brute force; golden levels."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.folds import _lower_envelope, sequential_scores
from tidemark.operators import fraud, scenarios


def test_sequential_scores_do_not_depend_on_chunks(spark):
    rng = random.Random(3)
    rows, expected = [], {}
    for key, n in (("hot", 137), ("warm", 9), ("one", 1)):
        total = 0.0
        for i in range(1, n + 1):
            base, risk = rng.choice([0.0, 0.2, 0.7, 0.88, 0.93, 1.2]), rng.choice([0.0, 0.4, 0.95, 1.05])
            seen = min(risk if i == 1 else (risk + total / (i - 1)) / 2, 1.0)
            score = min(base + 0.15 * seen, 1.0)
            total += score
            rows.append((key, f"{key}{i:04d}", i, base, risk))
            expected[f"{key}{i:04d}"] = (seen, score)
    df = spark.createDataFrame(rows, "k string, id string, n long, base double, risk double").repartition(4)
    for chunk in (2, 5, 50, 1000):
        got = sequential_scores(df, "k", "n", "base", "risk", 0.15, "seen", "score", chunk=chunk).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r["seen"], r["score"]) == pytest.approx(expected[r["id"]], abs=1e-9)


def test_lower_envelope_keeps_the_minimum():
    rng = random.Random(1)
    for _ in range(200):
        lines = [(1 + rng.random(), rng.random() * 3 - 1) for _ in range(6)]
        kept = _lower_envelope(lines, 4.0)
        for x in (0.0, 0.3, 1.7, 2.9, 4.0):
            assert min(s * x + o for s, o in kept) == pytest.approx(min(s * x + o for s, o in lines))


def test_components_against_union_find(spark):
    rng = random.Random(8)
    edges = [(f"n{rng.randrange(60):02d}", f"n{rng.randrange(60):02d}") for _ in range(45)]
    edges += [(f"c{i:02d}", f"c{i + 1:02d}") for i in range(30)]          # a long chain
    edges += [("hub", f"s{i:02d}") for i in range(40)]                     # a hub
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    expected = {x: find(x) for x in list(parent)}
    df = spark.createDataFrame(edges, "src string, dst string")
    got = {r["node"]: r["component"] for r in scenarios.ring_components(df).collect()}
    assert got == expected


def test_ring_needs_distinct_holders_and_close_claims(spark):
    hour = 3600
    rows = [("a1", "h1", 0), ("a2", "h2", 40), ("a3", "h3", 80), ("b1", "h4", 200), ("b2", "h4", 210), ("b3", "h4", 220)]
    df = spark.createDataFrame([(c, h, "collision", 9000.0, 0.5, "E1 1AA", t * hour) for c, h, t in rows],
                               "claim_id string, policyholder_id string, claim_type string, claim_amount double, "
                               "fraud_score double, incident_postcode string, s long")
    df = df.withColumn("incident_date", F.timestamp_seconds("s"))
    members = scenarios.ring_members(df)
    assert {r["claim_id"] for r in members.collect()} == {"a1", "a2", "a3"}
    assert scenarios.detect_fraud_rings(members).count() == 1
    assert {(r["src"], r["dst"]) for r in scenarios.ring_edges(members).collect()} == {("h1", "h2"), ("h1", "h3")}


@pytest.mark.parametrize("score,level,action", [
    (0.95, "CRITICAL", "IMMEDIATE_INVESTIGATION_REQUIRED"), (0.9, "CRITICAL", "IMMEDIATE_INVESTIGATION_REQUIRED"),
    (0.8, "HIGH", "MANUAL_REVIEW_REQUIRED"), (0.6, "MEDIUM", "ADDITIONAL_DOCUMENTATION_REQUIRED"),
    (0.3, "LOW", "STANDARD_PROCESSING_WITH_MONITORING"), (0.29, "MINIMAL", "STANDARD_PROCESSING")])
def test_levels_and_actions(spark, score, level, action):
    found = fraud.risk_level(F.lit(score))
    row = spark.range(1).select(found.alias("level"), fraud.recommended_action(found).alias("action")).first()
    assert (row["level"], row["action"]) == (level, action)
