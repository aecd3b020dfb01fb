"""Silver layer: enrichment, fraud indicators, validation and routing of claims.

Every function is stateless (or joins a constant table), so it runs unchanged on batch and stream.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import refdata
from tidemark.config import LiteConfig, QualityConfig, SilverConfig
from tidemark.functions.ranks import Ranked, with_percentiles
from tidemark.schemas import SILVER_CLAIM

FULL_POSTCODE = r"^[A-Z]{1,2}[0-9]{1,2}[A-Z]?\s?[0-9][A-Z]{2}$"


def quality_gate(df: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """Drop claims whose quality score does not exceed the gate."""
    return df.where(F.col("dq_score") > cfg.gate)


def postcode_parts(df: DataFrame, column: str = "incident_postcode") -> DataFrame:
    """Add postcode district and area; text without one gives an empty string."""
    return df.withColumns({
        "postcode_district": F.regexp_extract(column, r"^([A-Z]{1,2}\d{1,2})", 1),
        "postcode_area": F.regexp_extract(column, "^([A-Z]{1,2})", 1),
    })


def claim_derivations(df: DataFrame, cfg: SilverConfig = SilverConfig()) -> DataFrame:
    """Add amount, timing and size-band columns."""
    amount, filed = F.col("claim_amount"), F.col("claim_date")
    weekend = F.dayofweek(filed).isin(1, 7)
    band = (F.when(amount < cfg.small_below, "small").when(amount < cfg.medium_below, "medium")
            .when(amount < cfg.large_below, "large").otherwise("exceptional"))
    return df.withColumns({
        "claim_amount_gbp": amount,
        "days_to_claim": F.datediff(filed, F.col("incident_date")),
        "claim_amount_category": band,
        "is_weekend_claim": weekend,
        "claim_hour": F.hour(filed),
        "is_business_hours": F.hour(filed).between(9, 17) & ~weekend,
    })


def enrich_region(df: DataFrame) -> DataFrame:
    """Left join of the region by postcode area."""
    regions = refdata.inline_table(df.sparkSession, "postcode_area STRING, region STRING", refdata.AREA_REGIONS)
    return df.join(F.broadcast(regions), "postcode_area", "left")


def enrich_bank_holiday(df: DataFrame) -> DataFrame:
    """Flag claims filed on a known bank holiday."""
    days = refdata.inline_table(df.sparkSession, "holiday DATE, holiday_name STRING", refdata.BANK_HOLIDAYS)
    return (
        df.join(F.broadcast(days.select("holiday")), F.to_date("claim_date") == F.col("holiday"), "left")
        .withColumn("is_bank_holiday", F.col("holiday").isNotNull()).drop("holiday")
    )


def enrich_postcode_risk(df: DataFrame) -> DataFrame:
    """Left join of the fraud multiplier by postcode district, 1.0 where none is known."""
    risk = refdata.inline_table(df.sparkSession, "postcode_district STRING, multiplier DOUBLE",
                                refdata.DISTRICT_MULTIPLIERS)
    return (
        df.join(F.broadcast(risk), "postcode_district", "left")
        .withColumn("postcode_fraud_risk", F.coalesce("multiplier", F.lit(1.0))).drop("multiplier")
    )


def indicator_rules(cfg: SilverConfig = SilverConfig()) -> list[tuple[str, Column]]:
    """Name and condition of each fraud indicator, in reporting order."""
    low, high = cfg.whiplash_band
    return [
        ("QUICK_CLAIM", F.col("days_to_claim") < cfg.quick_claim_days),
        ("HIGH_VALUE", F.col("claim_amount") > cfg.high_value),
        ("SUSPICIOUS_TIMING", F.col("is_weekend_claim") | F.col("is_bank_holiday")),
        ("ODD_HOURS", F.col("claim_hour").isin(*cfg.odd_hours)),
        ("HIGH_RISK_LOCATION", F.col("postcode_fraud_risk") > cfg.location_multiplier),
        ("WHIPLASH_PATTERN", (F.col("claim_type") == "motor") & F.col("claim_amount").between(low, high)),
        ("STORM_CHASER", (F.col("claim_type") == "home") & (F.col("days_to_claim") < cfg.storm_days)),
    ]


def labels_of(rules: list[tuple[str, Column]]) -> Column:
    """Array of the names whose condition holds (never null, nulls count as not holding)."""
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules]))


def fraud_indicators(df: DataFrame, cfg: SilverConfig = SilverConfig()) -> DataFrame:
    return df.withColumn("fraud_indicators", labels_of(indicator_rules(cfg)))


def adjusted_fraud_score(df: DataFrame, cfg: SilverConfig = SilverConfig()) -> DataFrame:
    """Score scaled by location and by the number of indicators, capped at 1."""
    boost = 1 + F.size("fraud_indicators") * cfg.indicator_weight
    return df.withColumn(
        "adjusted_fraud_score",
        F.least(F.col("fraud_score") * F.col("postcode_fraud_risk") * boost, F.lit(1.0)))


def review_flags(df: DataFrame, cfg: SilverConfig = SilverConfig()) -> DataFrame:
    score = F.col("adjusted_fraud_score")
    return df.withColumns({
        "is_high_risk": score > cfg.high_risk,
        "requires_manual_review": (score > cfg.review_score) | (F.col("claim_amount") > cfg.review_amount)
        | (F.size("fraud_indicators") > cfg.review_indicators),
    })


def validation_flags() -> dict[str, Column]:
    amount, kind = F.col("claim_amount"), F.col("claim_type")
    within = reduce(lambda chain, item: chain.when(kind == item[0], amount <= item[1]),
                    refdata.CLAIM_TYPE_LIMITS.items(), F.when(F.lit(False), F.lit(True))).otherwise(True)
    flags = {
        "amount_within_limit": within,
        "valid_claim_timing": F.col("days_to_claim") >= 0,
        "has_policy": F.col("policy_number").isNotNull(),
        "has_customer": F.col("customer_id").isNotNull(),
        "valid_postcode": F.col("incident_postcode").rlike(FULL_POSTCODE),
    }
    return {name: F.coalesce(flag, F.lit(False)) for name, flag in flags.items()}


def validate_business_rules(df: DataFrame) -> DataFrame:
    """Add ``validation_score``, the share of the five checks that hold."""
    flags = [flag.cast("int") for flag in validation_flags().values()]
    return df.withColumn("validation_score", reduce(lambda a, b: a + b, flags) / F.lit(float(len(flags))))


def processing_status(df: DataFrame, cfg: SilverConfig = SilverConfig()) -> DataFrame:
    """Route each claim; the first matching status wins."""
    status = (F.when(F.col("validation_score") < cfg.reject_below, "REJECTED")
              .when(F.col("requires_manual_review"), "MANUAL_REVIEW")
              .when(F.col("is_high_risk"), "FRAUD_INVESTIGATION").otherwise("AUTO_APPROVED"))
    return df.withColumn("processing_status", status)


def silver_pii_columns(df: DataFrame, as_of: Column | None = None, cfg: SilverConfig = SilverConfig()) -> DataFrame:
    """Add the hashed customer id and the consent and retention dates."""
    today = F.to_date(as_of) if as_of is not None else F.current_date()
    return df.withColumns({
        "customer_id_hash": F.sha2("customer_id", 256),
        "gdpr_consent": F.lit(True),
        "gdpr_consent_date": today,
        "data_retention_date": F.date_add(today, cfg.retention_days),
    })


def silver_output(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Latency and the final silver columns. ``processed_at`` defaults to the current time."""
    stamp = processed_at if processed_at is not None else F.current_timestamp()
    return df.withColumns({
        "_silver_timestamp": stamp,
        "_processing_time_ms": (F.unix_timestamp(stamp) - F.unix_timestamp("_ingestion_timestamp")) * 1000,
        "data_quality_score": F.col("dq_score"),
    }).select(*SILVER_CLAIM.fieldNames())


def silver_claims(df: DataFrame, processed_at: Column | None = None, cfg: SilverConfig = SilverConfig()) -> DataFrame:
    """The whole silver step on quality-scored bronze claims: one scan, no shuffle."""
    return (
        df.transform(quality_gate).transform(postcode_parts).transform(claim_derivations, cfg)
        .transform(enrich_region).transform(enrich_bank_holiday).transform(enrich_postcode_risk)
        .transform(fraud_indicators, cfg).transform(adjusted_fraud_score, cfg).transform(review_flags, cfg)
        .transform(validate_business_rules).transform(processing_status, cfg)
        .transform(silver_output, processed_at)
    )


def silver_lite(df: DataFrame, processed_at: Column | None = None, cfg: LiteConfig = LiteConfig()) -> DataFrame:
    """The reduced rule set: raw score thresholds, two indicators, constant quality."""
    score, amount = F.col("fraud_score"), F.col("claim_amount")
    days = F.datediff("claim_date", "incident_date")
    return df.withColumns({
        "claim_amount_gbp": amount,
        "days_to_claim": days,
        "postcode_district": F.regexp_extract("incident_postcode", r"^([A-Z]{1,2}\d{1,2})", 1),
        "is_high_risk": score > cfg.high_risk,
        "requires_manual_review": (score > cfg.review_score) | (amount > cfg.review_amount),
        "processing_status": F.when(score > cfg.high_risk, "FRAUD_INVESTIGATION")
        .when(amount > cfg.status_amount, "MANUAL_REVIEW").otherwise("AUTO_APPROVED"),
        "fraud_indicators": labels_of([("QUICK_CLAIM", days < cfg.quick_claim_days),
                                       ("HIGH_VALUE", amount > cfg.high_value)]),
        "data_quality_score": F.lit(cfg.quality_score),
        "_silver_timestamp": processed_at if processed_at is not None else F.current_timestamp(),
    })


# ------------------------------------------------------------------------------- reports

def silver_monitoring(df: DataFrame, as_of: Column) -> DataFrame:
    """Hourly figures per status and type over the 24 hours before ``as_of``."""
    stamp = F.col("_silver_timestamp")
    recent = df.where(stamp >= as_of - F.expr("INTERVAL 24 HOURS"))
    keys = {"processing_date": F.to_date(stamp), "processing_hour": F.hour(stamp),
            "processing_status": F.col("processing_status"), "claim_type": F.col("claim_type")}
    figures = recent.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(
        F.count("*").alias("claim_count"),
        F.avg("claim_amount_gbp").alias("avg_amount"),
        F.max("claim_amount_gbp").alias("max_amount"),
        F.avg("adjusted_fraud_score").alias("avg_fraud_score"),
        F.count_if("is_high_risk").alias("high_risk_count"),
        F.count_if("requires_manual_review").alias("manual_review_count"),
        F.avg("_processing_time_ms").alias("avg_processing_time_ms"),
    )
    return with_percentiles(figures, recent, keys, Ranked(F.col("_processing_time_ms"), {"p95_processing_time_ms": 0.95}))


def status_summary(df: DataFrame) -> DataFrame:
    """Count and means per processing status."""
    return df.groupBy("processing_status").agg(
        F.count("*").alias("claim_count"),
        F.avg("claim_amount_gbp").alias("avg_amount"),
        F.avg("adjusted_fraud_score").alias("avg_fraud_score"),
    )


def fraud_pattern_analysis(df: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Occurrences, means and affected districts per fraud indicator."""
    recent = df.where(F.col("_silver_timestamp") >= as_of - F.make_interval(days=F.lit(days)))
    return (
        recent.select(F.explode("fraud_indicators").alias("fraud_indicator"), "claim_amount_gbp",
                      "adjusted_fraud_score", "postcode_district")
        .groupBy("fraud_indicator")
        .agg(
            F.count("*").alias("occurrence_count"),
            F.avg("claim_amount_gbp").alias("avg_claim_amount"),
            F.avg("adjusted_fraud_score").alias("avg_fraud_score"),
            F.sort_array(F.collect_set("postcode_district")).alias("affected_postcodes"),
        )
    )


def high_risk_alerts(df: DataFrame, cfg: SilverConfig = SilverConfig()) -> DataFrame:
    """Claims that need immediate attention."""
    urgent = (F.col("is_high_risk") | (F.col("claim_amount_gbp") > cfg.alert_amount)
              | (F.size("fraud_indicators") > cfg.alert_indicators))
    return df.where(urgent).select("claim_id", "claim_date", "customer_id", "claim_amount_gbp",
                                   "adjusted_fraud_score", "fraud_indicators", "processing_status")


# -------------------------------------------------------------------- claims with personal data

def pii_silver_derive(df: DataFrame, when_column: str = "claim_date") -> DataFrame:
    """Region, value, timing and risk columns of the personal-data claims table."""
    code, score = F.col("postcode"), F.col("fraud_score")
    region = reduce(lambda chain, row: chain.when(code.startswith(row[0]), row[1]),
                    refdata.PREFIX_REGIONS, F.when(F.lit(False), F.lit(""))).otherwise("Other")
    return df.withColumns({
        "uk_region": region,
        "high_value_claim": F.col("claim_amount") > 10000,
        "suspicious_timing": F.hour(when_column).between(0, 6),
        "is_suspicious": score > 0.7,
        "risk_level": F.when(score > 0.8, "HIGH").when(score > 0.5, "MEDIUM").when(score > 0.3, "LOW")
        .otherwise("NONE"),
    })


def pii_silver_totals(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_claims"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.avg("claim_amount").alias("avg_claim_amount"),
        F.count_if("is_suspicious").alias("suspicious_claims"),
        F.count_if("high_value_claim").alias("high_value_claims"),
    )


def pii_silver_checks(df: DataFrame, top: int = 20) -> DataFrame:
    """The most frequent (region, type, risk) combinations."""
    keys = ["uk_region", "claim_type", "risk_level"]
    return (df.groupBy(*keys).agg(F.count("*").alias("claim_count"))
            .orderBy(F.desc("claim_count"), *keys).limit(top))
