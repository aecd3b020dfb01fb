"""Detection of known fraud scenarios, and the rings that connect policyholders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timing import days_24h
from tidemark.functions.windows import neighbour, null_safe_join, running_stats, sliding_stats
from tidemark.session import cut

HOUR, DAY = 3600, 86400


def detect_early_claims(cases: DataFrame, days: int = 30, score: float = 0.7) -> DataFrame:
    """Highly scored claims soon after the start of the policy."""
    age = days_24h(F.col("incident_date"), F.col("start_date"))
    return cases.where((age < days) & (F.col("fraud_score") >= score)).withColumn("policy_age_days", age)


def detect_inflated_claims(cases: DataFrame, share: float = 0.8) -> DataFrame:
    """Claims for most of the sum insured."""
    ratio = F.try_divide("claim_amount", "sum_insured")
    return cases.where(ratio >= share).withColumn("insured_share", ratio)


def ring_members(claims: DataFrame, gap_hours: int = 48, amounts: tuple = (8000, 12000), size: int = 3) -> DataFrame:
    """Claims of alike amount, type and area that follow each other closely, by at least ``size`` holders.

    A ring continues as long as the next claim comes within the gap. Rings are chained over the distinct
    seconds of an (area, type), in buckets as long as the gap, so that no group holds more rows than a gap
    has seconds; the claims look their second's ring up, and ring totals are combined map-side.
    """
    at, keys = "_incident_s", ["postcode_area", "claim_type"]
    alike = (
        claims.where(F.col("claim_amount").between(*amounts))
        .withColumn("postcode_area", F.regexp_extract("incident_postcode", "^([A-Z]{1,2})[0-9]", 1))
        .where(F.col("postcode_area") != "")
        .select(*keys, "claim_id", "policyholder_id", "claim_amount", "fraud_score",
                F.unix_timestamp("incident_date").alias(at)))
    gap = gap_hours * HOUR
    linked = neighbour(alike.select(*keys, at).distinct(), keys, at, [], gap, {"_before": at})
    opens = F.col("_before").isNull() | (F.col(at) - F.col("_before") > gap)
    chained = running_stats(linked, keys, at, [], gap, {"ring_start_s": ("max", F.when(opens, F.col(at)))}).drop("_before")
    ringed = null_safe_join(alike, chained, [*keys, at], "inner")
    ring = [*keys, "ring_start_s"]
    big = (ringed.groupBy(*ring).agg(F.count_distinct("policyholder_id").alias("ring_holders"))
           .where(F.col("ring_holders") >= size))
    return ringed.join(big, ring)


def detect_fraud_rings(members: DataFrame) -> DataFrame:
    """One row per ring."""
    return members.groupBy("postcode_area", "claim_type", "ring_start_s").agg(
        F.count("*").alias("claims"),
        F.max("ring_holders").alias("holders"),
        F.sum("claim_amount").alias("total_amount"),
        F.min("_incident_s").alias("first_s"), F.max("_incident_s").alias("last_s"),
        F.avg("fraud_score").alias("avg_score"))


def ring_edges(members: DataFrame) -> DataFrame:
    """Links between the holders of a ring: each to the ring's first holder, instead of all pairs."""
    ring = ["postcode_area", "claim_type", "ring_start_s"]
    hub = members.groupBy(*ring).agg(F.min("policyholder_id").alias("src"))
    return (members.select(*ring, F.col("policyholder_id").alias("dst")).join(hub, ring)
            .where("src <> dst").select("src", "dst").distinct())


def ring_components(edges: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """Connected components of an undirected edge table: (node, component = its smallest node).

    Alternates two rewirings until nothing changes: every node sends its larger neighbours to its
    smallest one, then its smaller neighbours likewise. Both keep components intact, shorten paths
    geometrically and only ever take a minimum per node, so a hub with many links is combined
    map-side. Each round is written to the checkpoint folder, which bounds the plan and survives the
    loss of executors; the driver only sees two totals per round. ``max_rounds`` makes it an error to need more.
    """
    links = edges.select(F.col("src").alias("u"), F.col("dst").alias("v")).where("u <> v")
    nodes = links.select(F.col("u").alias("node")).union(links.select("v")).distinct()

    def both_ways(frame):
        return frame.select("u", "v").union(frame.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def rewire(frame, larger):
        lowest = frame.groupBy("u").agg(F.min("v").alias("_low")).withColumn("_low", F.least("_low", "u"))
        joined = frame.join(lowest, "u")
        moved = joined.where("v > u").select("v", "_low") if larger else joined.select("v", "_low")
        own = None if larger else lowest.where("_low <> u").select(F.col("u").alias("v"), "_low")
        kept = moved if own is None else moved.union(own)
        return kept.where("v <> _low").select(F.col("v").alias("u"), F.col("_low").alias("v")).distinct()

    def signature(frame):
        row = frame.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return row["n"], row["h"]

    current = cut(links.distinct())
    seen = signature(current)
    rounds = 0
    while True:
        if rounds == max_rounds:
            raise RuntimeError(f"components did not settle within {max_rounds} rounds")
        rounds += 1
        spread = rewire(both_ways(current), larger=True)
        # Small step: each node with its smaller neighbours only.
        down = spread.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        current = cut(rewire(down, larger=False))
        now = signature(current)
        if now == seen:
            break
        seen = now
    return nodes.join(current.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"))


def detect_repeat_offenders(cases: DataFrame, window_days: int = 120, claims: int = 3, policy_types: int = 1,
                            score: float = 0.6) -> DataFrame:
    """Flagged claims that bring their holder to several flagged ones within the window."""
    at = "_incident_s"
    flagged = cases.where(F.col("fraud_score") > score).withColumn(at, F.unix_timestamp("incident_date"))
    stats = sliding_stats(flagged.select("policyholder_id", "policy_type", at), ["policyholder_id"], at,
                          window_days * DAY, count="flagged_claims", distinct=("flagged_types", "policy_type"))
    return (null_safe_join(flagged, stats, ["policyholder_id", at]).drop(at)
            .where((F.col("flagged_claims") >= claims) & (F.col("flagged_types") >= policy_types)))


def detect_phantom_claims(cases: DataFrame, delay_days: int = 30, amounts: tuple = (10000, 25000)) -> DataFrame:
    """Late reported thefts of mid-size value without witnesses."""
    delay = days_24h(F.col("reported_date"), F.col("incident_date"))
    return cases.where(
        (F.col("claim_type") == "theft") & (delay >= delay_days) & F.col("claim_amount").between(*amounts)
        & F.lower("description").contains("no witnesses")).withColumn("reporting_delay_days", delay)


def detect_opportunistic(cases: DataFrame, factor: float = 2.0) -> DataFrame:
    """Collisions claimed far above the assessed amount."""
    inflation = F.try_divide("claim_amount", "approved_amount")
    return (cases.where((F.col("claim_type") == "collision") & (inflation >= factor))
            .withColumns({"inflation_factor": inflation,
                          "excess_amount": F.col("claim_amount") - F.col("approved_amount")}))


_SCENARIO_COLUMNS = [
    "claim_id", "policyholder_id", "policy_type", "claim_type", "claim_amount", "approved_amount", "sum_insured",
    "fraud_score", "start_date", "incident_date", "reported_date", "incident_postcode", "description",
]


def scenario_summary(cases: DataFrame, detected_above: float = 0.7, ring_amounts: tuple = (8000, 12000)) -> DataFrame:
    """All detections together: claims, amount, scores and detection rate per scenario.

    The cases are read by every detection, so the columns they need are stored once.
    """
    cases = cut(cases.select(*_SCENARIO_COLUMNS))
    found = {
        "early_claim_fraud": detect_early_claims(cases),
        "inflated_claim_fraud": detect_inflated_claims(cases),
        "fraud_ring": ring_members(cases, amounts=ring_amounts),
        "repeat_offender": detect_repeat_offenders(cases),
        "phantom_claim": detect_phantom_claims(cases),
        "opportunistic_fraud": detect_opportunistic(cases),
    }
    tagged = [df.select(F.lit(name).alias("scenario"), "claim_amount", "fraud_score") for name, df in found.items()]
    return reduce(DataFrame.unionByName, tagged).groupBy("scenario").agg(
        F.count("*").alias("claims"),
        F.sum("claim_amount").alias("total_amount"),
        F.max("fraud_score").alias("max_score"),
        F.avg("fraud_score").alias("avg_score"),
        (F.count_if(F.col("fraud_score") > detected_above) / F.count("*")).alias("detection_rate"))
