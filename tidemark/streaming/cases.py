"""Claims with the policies that arrive beside them: an interval join of two streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import fraud
from tidemark.streaming.tracking import use_rocksdb

TERMS = ["policy_type", "start_date", "end_date", "sum_insured", "deductible"]


def policy_cases(claims: DataFrame, policies: DataFrame, *, claims_delay: str = "1 day", policies_delay: str = "1 day",
                 before_start_days: int = 200, after_start_days: int = 600) -> DataFrame:
    """Each claim with the terms of its policy, which may come before or after it.

    A policy belongs to incidents from ``before_start_days`` before its start to ``after_start_days`` after it, so both
    sides are dropped from the state once the watermarks leave no partner possible. Then a claim whose policy never came
    passes with null terms. A claim of no policy number waits in the same way. There is one row per policy.
    """
    use_rocksdb(claims.sparkSession)
    left = claims.withWatermark("incident_date", claims_delay).alias("c")
    right = (policies.select(F.col("policy_number").alias("_policy"), *TERMS).withWatermark("start_date", policies_delay).alias("p"))
    together = F.expr(
        f"c.policy_number = p._policy AND p.start_date >= c.incident_date - INTERVAL {after_start_days} DAYS "
        f"AND p.start_date <= c.incident_date + INTERVAL {before_start_days} DAYS")
    return left.join(right, together, "left_outer").drop("_policy")


def policy_signals(cases: DataFrame, holders: DataFrame) -> DataFrame:
    """Timing, amount and geographic signals of streamed cases; ``holders`` is a stored table."""
    homes = holders.select("policyholder_id", "holder_postcode")
    scored = fraud.signal_geographic(fraud.signal_amount(fraud.signal_timing(cases.join(homes, "policyholder_id", "left"))))
    return scored.select("claim_id", "policyholder_id", F.col("start_date").isNotNull().alias("has_policy"), "timing", "amount", "geographic")
