"""The rule engine: which rules apply to a claim, their results and the resulting action."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import refdata
from tidemark.functions import rules


def apply_rule(df: DataFrame, rule: Column) -> DataFrame:
    """One rule on every claim: claim id and the fields of its result."""
    return df.select("claim_id", rule.alias("result")).select("claim_id", "result.*")


def applicable_rules(df: DataFrame, as_of: Column, include_syndicates: bool = False) -> list[tuple[Column, Column]]:
    """(applies, rule) pairs in evaluation order; rules whose columns are missing are left out."""
    have = set(df.columns)
    filled = lambda *names: [F.col(n).isNotNull() for n in names]
    both = lambda tests: F.array_min(F.array(*tests))
    pairs = []
    if {"claim_amount", "policy_limit"} <= have:
        pairs.append((both(filled("claim_amount", "policy_limit")), rules.amount_limit()))
    if {"claim_type", "incident_location", "fault_percentage", "witness_count",
            "medical_report_delay_days", "accident_type"} <= have:
        pairs.append((F.col("claim_type") == "motor", rules.motor_fraud()))
    if {"claim_type", "weather_event"} <= have:
        pairs.append((F.col("claim_type").isin(refdata.ENGINE_WEATHER_TYPES), rules.weather()))
    if "customer_age" in have:
        pairs.append((F.col("customer_age").isNotNull(), rules.fca_vulnerable()))
    pairs.append((F.lit(True), rules.gdpr(as_of)))
    if {"incident_date", "claim_date", "policy_end_date"} <= have:
        pairs.append((both(filled("incident_date", "claim_date", "policy_end_date")), rules.claim_timing()))
    if include_syndicates and "underwriter" in have:
        pairs.append((F.col("underwriter").isNotNull(), rules.lloyds_market()))
    return pairs


def evaluate_all_rules(df: DataFrame, as_of: Column, include_syndicates: bool = False) -> DataFrame:
    """Add ``rule_results``, the array of the results of all rules that apply."""
    pairs = applicable_rules(df, as_of, include_syndicates)
    return df.withColumn("rule_results", F.array_compact(F.array(*[F.when(test, rule) for test, rule in pairs])))


def rule_results_long(evaluated: DataFrame) -> DataFrame:
    """One row per claim and evaluated rule."""
    return evaluated.select("claim_id", F.explode("rule_results").alias("r")).select("claim_id", "r.*")


def determine_claim_action(evaluated: DataFrame) -> DataFrame:
    """The strongest action among the failed rules, and the escalations asked for by passed ones."""
    rank_of = F.create_map(*[F.lit(part) for pair in refdata.ACTION_PRIORITY for part in pair])
    name_of = F.create_map(*[F.lit(part) for action, rank in refdata.ACTION_PRIORITY for part in (rank, action)])
    results = F.col("rule_results")
    failed = F.filter(results, lambda r: ~r["passed"])
    strongest = F.array_min(F.transform(failed, lambda r: F.try_element_at(rank_of, r["action"])))
    action = (F.when(F.size(results) == 0, "CONTINUE").when(F.size(failed) == 0, "AUTO_APPROVE")
              .otherwise(F.try_element_at(name_of, strongest)))
    escalated = F.filter(results, lambda r: r["passed"] & (r["action"] == "ESCALATE"))
    return evaluated.withColumns({
        "claim_action": action,
        "failed_rules": F.transform(failed, lambda r: r["rule_id"]),
        "escalations": F.transform(escalated, lambda r: r["rule_id"]),
    })


def rule_summary(evaluated: DataFrame) -> DataFrame:
    """Failures per rule, severity and action."""
    return (rule_results_long(evaluated).where("NOT passed").groupBy("rule_id", "severity", "action")
            .agg(F.count("*").alias("failures")))
