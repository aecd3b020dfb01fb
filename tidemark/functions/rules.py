"""Business rules as column expressions.

Each rule gives one struct (passed, rule_id, rule_name, severity, message, action, metadata). The
outcomes of a rule are listed in order and the first whose condition holds is taken.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import refdata
from tidemark.functions.timing import days_24h


def _money(value: Column) -> Column:
    return F.format_number(value, 2)


def _one_place(value: Column) -> Column:
    return F.replace(F.format_number(value, 1), F.lit(","), F.lit(""))


def _outcome(passed: bool, rule_id: str, name: str, severity: str, message, action: str, data: dict | None = None) -> Column:
    text = message if isinstance(message, Column) else F.lit(message)
    pairs = [part for key, value in (data or {}).items() for part in (F.lit(key), value.cast("string"))]
    metadata = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")
    return F.struct(
        F.lit(passed).alias("passed"), F.lit(rule_id).alias("rule_id"), F.lit(name).alias("rule_name"),
        F.lit(severity).alias("severity"), text.alias("message"), F.lit(action).alias("action"),
        metadata.alias("metadata"))


def _first(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    chain = F
    for condition, outcome in cases:
        chain = chain.when(condition, outcome)
    return chain.otherwise(otherwise)


def _true(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def amount_limit(product: str = "product") -> Column:
    """Claim amount against the policy limit and the typical amount of the product."""
    amount, limit = F.col("claim_amount"), F.col("policy_limit")
    pairs = [F.lit(part) for kind, _, _, typical in refdata.POLICY_LIMITS for part in (kind, typical)]
    typical = F.try_element_at(F.create_map(*pairs), F.col(product))
    return _first([
        (amount > limit, _outcome(
            False, "CLAIM_001", "Claim Exceeds Policy Limit", "CRITICAL",
            F.concat(F.lit("Claim amount £"), _money(amount), F.lit(" exceeds policy limit £"), _money(limit)),
            "AUTO_REJECT", {"excess_amount": amount - limit})),
        (amount > limit * 0.95, _outcome(
            False, "CLAIM_002", "Suspicious Amount Near Limit", "HIGH",
            F.concat(F.lit("Claim amount is "), _one_place(amount / limit * 100), F.lit("% of policy limit")),
            "MANUAL_REVIEW")),
        (amount > typical * 3, _outcome(
            False, "CLAIM_003", "Unusually High Claim", "MEDIUM",
            F.concat(F.lit("Claim amount exceeds typical "), F.col(product), F.lit(" claim by "),
                     _one_place(amount / typical), F.lit("x")), "MANUAL_REVIEW")),
    ], _outcome(True, "CLAIM_001", "Claim Amount Valid", "INFO", "Claim amount within acceptable limits", "CONTINUE"))


def motor_fraud_patterns() -> Column:
    """Array of the motor fraud patterns a claim shows."""
    place = F.coalesce("incident_location", F.lit(""))
    at_hotspot = F.lit(False)
    for prefix in refdata.STAGED_ACCIDENT_HOTSPOTS:
        at_hotspot = at_hotspot | place.startswith(prefix)
    fault, witnesses = (F.coalesce(c, F.lit(0)) for c in ("fault_percentage", "witness_count"))
    delay = F.coalesce("medical_report_delay_days", F.lit(0))
    rear_end = F.coalesce(F.col("accident_type") == "rear_end", F.lit(False))
    patterns = [
        ("POSSIBLE_STAGED_ACCIDENT", at_hotspot & (fault == 100) & (witnesses == 0)),
        ("DELAYED_WHIPLASH_CLAIM", rear_end & (delay > 14)),
        ("EXCESSIVE_WITNESSES", (fault == 0) & (witnesses > 3)),
    ]
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in patterns]))


def motor_fraud() -> Column:
    found = motor_fraud_patterns()
    return _first([
        (F.coalesce(F.col("claim_type") != "motor", F.lit(True)), _outcome(
            True, "MOTOR_001", "Not Motor Claim", "INFO", "Rule applies only to motor claims", "CONTINUE")),
        (F.size(found) > 0, _outcome(
            False, "MOTOR_002", "Motor Fraud Indicators Detected", "HIGH",
            F.concat(F.lit("Fraud patterns detected: "), F.array_join(found, ", ")), "FRAUD_INVESTIGATION",
            {"fraud_indicators": F.array_join(found, ",")})),
    ], _outcome(True, "MOTOR_002", "No Motor Fraud Indicators", "INFO", "No motor fraud patterns detected", "CONTINUE"))


def weather() -> Column:
    """Flood claims outside the risk areas and claims tied to a weather event."""
    kind, place = F.col("claim_type"), F.coalesce("incident_location", F.lit(""))
    prefix = F.when(F.length(place) >= 2, F.substring(place, 1, 2)).otherwise("")
    event = F.col("weather_event")
    return _first([
        (~F.coalesce(kind.isin(refdata.WEATHER_CLAIM_TYPES), F.lit(False)), _outcome(
            True, "WEATHER_001", "Not Weather Claim", "INFO", "Not a weather-related claim", "CONTINUE")),
        ((kind == "flood") & ~prefix.isin(refdata.FLOOD_AREAS), _outcome(
            False, "WEATHER_002", "Flood Claim Outside Risk Zone", "MEDIUM",
            F.concat(F.lit("Flood claim in area "), prefix, F.lit(" not typically at flood risk")), "MANUAL_REVIEW")),
        ((F.length(event) > 0) & F.col("claim_date").isNotNull(), _outcome(
            False, "WEATHER_003", "Immediate Weather Claim", "MEDIUM",
            "Claim filed immediately after weather event", "MANUAL_REVIEW", {"weather_event": event})),
    ], _outcome(True, "WEATHER_001", "Weather Claim Valid", "INFO", "Weather claim appears legitimate", "CONTINUE"))


def fca_vulnerable() -> Column:
    """Vulnerable customers: passed, but to be escalated."""
    reasons = F.array_compact(F.array(*[F.when(test, F.lit(text)) for text, test in [
        ("elderly customer", F.col("customer_age") > 80), ("disability", _true("has_disability")),
        ("financial difficulty", _true("financial_difficulty")),
        ("recent bereavement", _true("recent_bereavement"))]]))
    return _first([
        (F.size(reasons) > 0, _outcome(
            True, "FCA_001", "Vulnerable Customer Identified", "HIGH",
            F.concat(F.lit("FCA vulnerable customer: "), F.array_join(reasons, ", ")), "ESCALATE",
            {"vulnerability_reasons": F.array_join(reasons, ",")})),
    ], _outcome(True, "FCA_001", "Standard Customer", "INFO", "No vulnerability indicators", "CONTINUE"))


def gdpr(as_of: Column) -> Column:
    """Consent present, not older than a year, and a retention period within the guideline."""
    age = days_24h(as_of, F.col("consent_date"))
    years = F.coalesce("data_retention_years", F.lit(7))
    return _first([
        (~_true("gdpr_consent"), _outcome(
            False, "GDPR_001", "No GDPR Consent", "CRITICAL", "Cannot process claim without GDPR consent", "AUTO_REJECT")),
        (age > 365, _outcome(
            False, "GDPR_002", "Expired Consent", "HIGH",
            F.concat(F.lit("GDPR consent expired ("), age.cast("string"), F.lit(" days old)")), "MANUAL_REVIEW")),
        (years > 7, _outcome(
            False, "GDPR_003", "Excessive Data Retention", "MEDIUM",
            F.concat(F.lit("Data retention period ("), years.cast("string"), F.lit(" years) exceeds guidelines")),
            "MANUAL_REVIEW")),
    ], _outcome(True, "GDPR_001", "GDPR Compliant", "INFO", "GDPR requirements satisfied", "CONTINUE"))


def lloyds_market() -> Column:
    """Small direct claims on a syndicate's policy are unusual."""
    amount, writer = F.col("claim_amount"), F.col("underwriter")
    pairs = [F.lit(part) for row in refdata.SYNDICATES for part in row]
    syndicate = F.try_element_at(F.create_map(*pairs), writer)
    return _first([
        (syndicate.isNull(), _outcome(
            True, "LLOYDS_001", "Not Lloyd's Claim", "INFO", "Not a Lloyd's market claim", "CONTINUE")),
        ((amount < 50000) & ~_true("is_reinsurance"), _outcome(
            False, "LLOYDS_002", "Unusual Lloyd's Small Claim", "MEDIUM",
            F.concat(F.lit("Small claim (£"), _money(amount), F.lit(") unusual for Lloyd's syndicate "), syndicate),
            "MANUAL_REVIEW", {"syndicate": syndicate})),
    ], _outcome(True, "LLOYDS_001", "Valid Lloyd's Claim", "INFO",
                F.concat(F.lit("Lloyd's syndicate "), syndicate, F.lit(" claim validated")), "CONTINUE"))


def claim_timing() -> Column:
    """Late claims, claims near the end of the policy and backdated claims, in this order."""
    delay = days_24h(F.col("claim_date"), F.col("incident_date"))
    left = days_24h(F.col("policy_end_date"), F.col("claim_date"))
    filed = F.concat(F.lit("Claim filed "), delay.cast("string"), F.lit(" days after incident"))
    return _first([
        (delay > 90, _outcome(False, "TIMING_001", "Excessively Delayed Claim", "HIGH", filed, "MANUAL_REVIEW")),
        (left.between(0, 30), _outcome(
            False, "TIMING_002", "Claim Near Policy Expiry", "MEDIUM",
            F.concat(F.lit("Claim filed "), left.cast("string"), F.lit(" days before policy expires")), "MANUAL_REVIEW")),
        (delay < 0, _outcome(False, "TIMING_003", "Backdated Claim", "CRITICAL",
                             "Claim date is before incident date", "FRAUD_INVESTIGATION")),
    ], _outcome(True, "TIMING_001", "Valid Claim Timing", "INFO", filed, "CONTINUE"))
