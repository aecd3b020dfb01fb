"""Policy, customer and postcode tables, KPI trends and model quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.windows import neighbour

DAY = 86400


def age_on(born: Column, day: Column) -> Column:
    """Completed years between a birth date and a day."""
    before_birthday = F.date_format(day, "MMdd") < F.date_format(born, "MMdd")
    return F.year(day) - F.year(born) - before_birthday.cast("int")


def _active(as_of: Column) -> Column:
    return (as_of >= F.col("start_date")) & (as_of < F.col("end_date"))


def policy_enrichment(policies: DataFrame, claims: DataFrame, as_of: Column) -> DataFrame:
    """Duration, monthly premium, state, claim totals and loss ratio per policy.

    Claims are totalled per policy before the join, with partial sums ahead of the shuffle.
    """
    totals = claims.where(F.col("policy_number").isNotNull()).groupBy("policy_number").agg(
        F.count("*").alias("claims_count"), F.sum("claim_amount_gbp").alias("total_claims_amount"))
    premium = F.col("premium_amount")
    return policies.join(totals, "policy_number", "left").withColumns({
        "policy_duration_days": F.datediff("end_date", "start_date"),
        "premium_monthly": premium / F.lit(12.0),
        "is_active": _active(as_of),
        "days_until_renewal": F.datediff("end_date", as_of),
        "claims_count": F.coalesce("claims_count", F.lit(0)),
        "total_claims_amount": F.coalesce("total_claims_amount", F.lit(0.0)),
    }).withColumn("loss_ratio", F.try_divide("total_claims_amount", premium))


def policy_scd2(versions: DataFrame, key: str, at: str, tracked: list[str], ties: list[str] | None = None,
                bucket_seconds: int = 30 * DAY) -> DataFrame:
    """Validity intervals of the versions that changed something.

    A row opens a version when any tracked column differs from the row before it; the version ends
    where the next one starts.
    """
    ties = ties or []
    clocked = versions.withColumn("_at", F.unix_timestamp(at))
    before = neighbour(clocked, [key], "_at", ties, bucket_seconds,
                       {**{f"_b_{c}": c for c in tracked}, "_b_at": "_at"})
    changed = F.col("_b_at").isNull()
    for column in tracked:
        changed = changed | ~F.col(column).eqNullSafe(F.col(f"_b_{column}"))
    opened = before.where(changed).select(*versions.columns, "_at")
    closed = neighbour(opened, [key], "_at", ties, bucket_seconds, {"_scd_end_date": at}, forward=True)
    return (closed.withColumn("_scd_start_date", F.col(at))
            .withColumn("_scd_is_current", F.col("_scd_end_date").isNull()).drop("_at"))


def customer_360(holders: DataFrame, policies: DataFrame, claims: DataFrame, as_of: Column) -> DataFrame:
    """One row per customer: age and value bands, policy and claim totals, segment."""
    held = policies.groupBy("policyholder_id").agg(
        F.count("*").alias("total_policies"), F.count_if(_active(as_of)).alias("active_policies"),
        F.sum("premium_amount").alias("lifetime_value"))
    claimed = claims.groupBy(F.col("customer_id").alias("policyholder_id")).agg(
        F.count("*").alias("total_claims"), F.sum("claim_amount_gbp").alias("total_claims_amount"),
        F.avg("claim_amount_gbp").alias("average_claim_amount"),
        F.max("adjusted_fraud_score").alias("fraud_risk_score"))
    joined = holders.join(held, "policyholder_id", "left").join(claimed, "policyholder_id", "left")
    age, value = age_on(F.col("date_of_birth"), as_of), F.col("lifetime_value")
    zero_filled = {c: F.coalesce(c, F.lit(0)) for c in
                   ("total_policies", "active_policies", "total_claims")}
    return joined.withColumns({
        **zero_filled,
        "lifetime_value": F.coalesce(value, F.lit(0.0)),
        "total_claims_amount": F.coalesce("total_claims_amount", F.lit(0.0)),
    }).select(
        F.col("policyholder_id").alias("customer_id"),
        F.sha2("policyholder_id", 256).alias("customer_hash"),
        F.when(age < 25, "18-24").when(age < 35, "25-34").when(age < 50, "35-49").when(age < 65, "50-64")
        .otherwise("65+").alias("age_band"),
        "total_policies", "active_policies", "lifetime_value",
        F.when(value < 1000, "LOW").when(value < 3000, "MEDIUM").otherwise("HIGH").alias("lifetime_value_band"),
        "total_claims", "total_claims_amount", "average_claim_amount", "fraud_risk_score",
        F.when(F.col("fraud_risk_score") > 0.7, "WATCH").when(value >= 3000, "PREMIUM").otherwise("STANDARD")
        .alias("customer_segment"),
    )


def claim_to_premium_ratio(claims: DataFrame, policies: DataFrame, holders: DataFrame) -> DataFrame:
    """Claim amount over premium and the customer's age on the claim date."""
    premium = policies.select("policy_number", "premium_amount")
    born = holders.select(F.col("policyholder_id").alias("customer_id"), "date_of_birth")
    rows = claims.select("claim_id", "policy_number", "customer_id", "claim_date", "claim_amount_gbp")
    # Claims without a policy number have nothing to join; in the join they would meet in one task.
    without = rows.where("policy_number IS NULL").withColumn("premium_amount", F.lit(None).cast(premium.schema["premium_amount"].dataType))
    rated = rows.where("policy_number IS NOT NULL").join(premium, "policy_number", "left").unionByName(without)
    return (
        rated.join(born, "customer_id", "left")
        .select("claim_id", F.try_divide("claim_amount_gbp", "premium_amount").alias("claim_to_premium_ratio"),
                age_on(F.col("date_of_birth"), F.col("claim_date")).alias("customer_age_at_claim"))
    )


def postcode_history(claims: DataFrame) -> DataFrame:
    """Claims per policy, mean amount and mean score per postcode district."""
    return claims.where(F.col("postcode_district") != "").groupBy("postcode_district").agg(
        F.count("*").alias("claim_count"),
        F.count_distinct("policy_number").alias("policies"),
        F.avg("claim_amount_gbp").alias("historical_claim_severity"),
        F.avg("adjusted_fraud_score").alias("risk_score"),
    ).withColumn("historical_claim_frequency", F.try_divide("claim_count", "policies"))


def kpi_trend(kpis: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Trend of each KPI against its mean over the previous 7 and 30 days.

    The input holds one row per KPI and day, so a window partition has as many rows as days.
    """
    dated = kpis.withColumn("_day", F.unix_date("kpi_date"))

    def label(days):
        mean = F.avg("kpi_value").over(Window.partitionBy("kpi_name").orderBy("_day").rangeBetween(-days, -1))
        return (F.when(mean.isNull() | F.col("kpi_value").isNull(), None)
                .when(F.col("kpi_value") > mean * (1 + tolerance), "UP")
                .when(F.col("kpi_value") < mean * (1 - tolerance), "DOWN").otherwise("STABLE"))

    return dated.withColumns({"trend_7_day": label(7), "trend_30_day": label(30)}).drop("_day")


def fraud_model_quality(df: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    """Confusion counts, precision, recall and F1 of a fraud decision against confirmed outcomes."""
    counts = df.agg(
        F.count("*").alias("evaluated"),
        F.count_if(predicted & actual).alias("confirmed_fraud_cases"),
        F.count_if(predicted & ~actual).alias("false_positive_count"),
        F.count_if(~predicted & actual).alias("false_negative_count"),
    )
    hit, wrong, missed = (F.col(c) for c in
                          ("confirmed_fraud_cases", "false_positive_count", "false_negative_count"))
    return counts.withColumns({
        "precision_score": F.try_divide(hit, hit + wrong),
        "recall_score": F.try_divide(hit, hit + missed),
        "f1_score": F.try_divide(hit * 2.0, hit * 2 + wrong + missed),
    })
