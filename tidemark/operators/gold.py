"""Gold layer: KPIs, rankings, dashboards and customer risk profiles over silver claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import refdata
from tidemark.functions.ranks import Ranked, with_percentiles
from tidemark.functions.windows import running_stats

HOUR = 3600


def _share(condition) -> Column:
    return F.count_if(condition) / F.count("*")


def _days_back(as_of: Column, days: int) -> Column:
    return F.date_sub(F.to_date(as_of), days)


def summary_figures() -> list[Column]:
    """Volume, amount, fraud, routing, latency and quality figures of a group of claims."""
    amount, risky = F.col("claim_amount_gbp"), F.col("is_high_risk")
    status = lambda s: F.count_if(F.col("processing_status") == s)
    return [
        F.count("*").alias("total_claims"),
        F.sum(amount).alias("total_amount"),
        F.avg(amount).alias("average_amount"),
        F.min(amount).alias("min_amount"),
        F.max(amount).alias("max_amount"),
        F.stddev(amount).alias("stddev_amount"),
        F.count_if(risky).alias("fraud_detected_count"),
        F.sum(F.when(risky, amount).otherwise(0)).alias("fraud_detected_amount"),
        F.avg("adjusted_fraud_score").alias("avg_fraud_score"),
        F.count_if("requires_manual_review").alias("manual_review_count"),
        status("AUTO_APPROVED").alias("auto_approved_count"),
        status("REJECTED").alias("rejected_count"),
        F.avg("_processing_time_ms").alias("processing_time_avg_ms"),
        F.avg("data_quality_score").alias("avg_data_quality"),
        F.avg("validation_score").alias("avg_validation_score"),
    ]


def daily_claims_summary(df: DataFrame) -> DataFrame:
    """``summary_figures`` per claim day and type, with exact percentiles and rates."""
    keys = {"summary_date": F.to_date("claim_date"), "claim_type": F.col("claim_type")}
    summary = df.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(*summary_figures())
    return with_percentiles(
        summary, df, keys, Ranked(F.col("claim_amount_gbp"), {"median_amount": 0.5}),
        Ranked(F.col("_processing_time_ms"), {"processing_time_p95_ms": 0.95, "processing_time_p99_ms": 0.99})).withColumns({
            "fraud_rate": F.col("fraud_detected_count") / F.col("total_claims"),
            "auto_approval_rate": F.col("auto_approved_count") / F.col("total_claims"),
        })


def fraud_figures() -> list[Column]:
    """Fraud volumes, score distribution, prevented amounts and patterns of a group of claims."""
    risky, amount, score = F.col("is_high_risk"), F.col("claim_amount_gbp"), F.col("adjusted_fraud_score")
    first_indicator = F.get("fraud_indicators", F.lit(0))
    return [
        F.count("*").alias("total_claims_evaluated"),
        F.count_if(score > 0.5).alias("fraud_alerts_generated"),
        F.count_if(risky).alias("high_risk_flagged"),
        F.count_if(F.col("processing_status") == "FRAUD_INVESTIGATION").alias("sent_to_investigation"),
        F.avg("fraud_score").alias("avg_original_fraud_score"),
        F.avg(score).alias("avg_adjusted_fraud_score"),
        F.max(score).alias("max_fraud_score"),
        F.sum(F.when(risky, amount).otherwise(0)).alias("total_fraud_prevented_gbp"),
        F.avg(F.when(risky, amount)).alias("avg_fraud_amount_gbp"),
        F.sort_array(F.collect_set(first_indicator)).alias("top_fraud_patterns"),
        F.sort_array(F.collect_set(F.when(risky, F.col("postcode_district")))).alias("high_risk_postcodes"),
        F.avg(F.when(risky, F.col("_processing_time_ms"))).alias("avg_detection_time_ms"),
    ]


def fraud_metrics(df: DataFrame) -> DataFrame:
    """``fraud_figures`` per claim hour, with the exact percentile of the scores and rates."""
    keys = {"metric_date": F.to_date("claim_date"), "metric_hour": F.hour("claim_date")}
    metrics = df.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(*fraud_figures())
    return with_percentiles(metrics, df, keys, Ranked(F.col("adjusted_fraud_score"), {"p90_fraud_score": 0.9})).withColumns({
        "fraud_detection_rate": F.col("high_risk_flagged") / F.col("total_claims_evaluated"),
        "alert_to_investigation_rate": F.when(
            F.col("fraud_alerts_generated") > 0,
            F.try_divide("sent_to_investigation", "fraud_alerts_generated")).otherwise(0.0),
    })


def operational_figures() -> list[Column]:
    """Processing, routing, quality and value figures of a group of claims."""
    return [
        F.avg("_processing_time_ms").alias("avg_processing_time_ms"),
        _share(F.col("processing_status") == "AUTO_APPROVED").alias("auto_approval_rate"),
        _share(F.col("requires_manual_review")).alias("manual_review_rate"),
        _share(F.col("is_high_risk")).alias("fraud_detection_rate"),
        F.avg("adjusted_fraud_score").alias("avg_fraud_confidence"),
        F.avg("data_quality_score").alias("data_quality_score"),
        F.avg("validation_score").alias("validation_score"),
        F.count("*").alias("total_claims_processed"),
        (F.count("*") / F.lit(24.0)).alias("claims_per_hour"),
        F.sum("claim_amount_gbp").alias("total_claim_value"),
        F.avg("claim_amount_gbp").alias("avg_claim_value"),
    ]


def daily_figures(df: DataFrame) -> DataFrame:
    """One row of operational figures per claim day, without the percentile."""
    return df.groupBy(F.to_date("claim_date").alias("kpi_date")).agg(*operational_figures())


def operational_kpis_wide(df: DataFrame) -> DataFrame:
    """One row of operational figures per claim day."""
    slow = Ranked(F.col("_processing_time_ms"), {"p95_processing_time_ms": 0.95})
    return with_percentiles(daily_figures(df), df, {"kpi_date": F.to_date("claim_date")}, slow)


def kpi_report(wide: DataFrame) -> DataFrame:
    """Daily figures in long form with target, variance and traffic light."""
    names = [name for name, _ in refdata.KPI_TARGETS]
    targets = refdata.inline_table(wide.sparkSession, "kpi_name STRING, kpi_target DOUBLE", refdata.KPI_TARGETS)
    value, target = F.col("kpi_value"), F.col("kpi_target")
    lower_is_better = F.col("kpi_name") == "avg_processing_time_ms"
    graded = (
        F.when(target.isNull() | value.isNull(), "NO_TARGET")
        .when(lower_is_better, F.when(value <= target, "GREEN").when(value <= target * 1.2, "AMBER").otherwise("RED"))
        .when(value >= target, "GREEN").when(value >= target * 0.9, "AMBER").otherwise("RED")
    )
    return (
        wide.unpivot("kpi_date", names, "kpi_name", "kpi_value")
        .join(F.broadcast(targets), "kpi_name", "left")
        .withColumns({"variance_from_target": F.try_divide(value - target, target) * 100, "kpi_status": graded})
        .select("kpi_date", "kpi_name", "kpi_value", "kpi_target", "variance_from_target", "kpi_status")
    )


def operational_kpis(df: DataFrame) -> DataFrame:
    return kpi_report(daily_figures(df))


def customer_running_history(df: DataFrame, bucket_seconds: int = HOUR) -> DataFrame:
    """Claims so far per customer at each claim, in the order of claim date and claim id."""
    seconds = df.withColumn("_at", F.unix_timestamp("claim_date"))
    running = running_stats(seconds, ["customer_id"], "_at", ["claim_id"], bucket_seconds, {
        "claims_count": ("count", None),
        "total_claimed": ("sum", F.col("claim_amount_gbp")),
        "_amounts": ("sum", F.col("claim_amount_gbp").isNotNull().cast("long")),
        "max_fraud_score": ("max", F.col("adjusted_fraud_score")),
        "fraud_flags_count": ("sum", F.coalesce(F.col("is_high_risk"), F.lit(False)).cast("long")),
    })
    return (running.withColumn("avg_claim_amount", F.try_divide("total_claimed", "_amounts"))
            .drop("_at", "_amounts"))


def customer_risk_profiles(df: DataFrame, lookback_days: int | None = None, as_of: Column | None = None) -> DataFrame:
    """One risk profile per customer out of the running history.

    ``avg_claim_amount`` is the highest running average a customer has reached; ``final_avg`` is the
    plain average.
    """
    if lookback_days is not None:
        df = df.where(F.col("claim_date") >= _days_back(as_of, lookback_days))
    profile = customer_running_history(df).groupBy("customer_id").agg(
        F.max("claims_count").alias("total_claims"),
        F.max("total_claimed").alias("total_claimed_amount"),
        F.max("avg_claim_amount").alias("avg_claim_amount"),
        F.avg("claim_amount_gbp").alias("final_avg"),
        F.max("max_fraud_score").alias("fraud_risk_score"),
        F.max("fraud_flags_count").alias("fraud_incidents"),
        F.max("claim_date").alias("last_claim_date"),
    )
    score, frequency = F.col("fraud_risk_score"), F.col("claims_frequency_score")
    segment = (F.when((score > 0.7) | (F.col("fraud_incidents") > 2), "HIGH_RISK")
               .when((score > 0.4) | (frequency > 5), "MEDIUM_RISK").otherwise("LOW_RISK"))
    by_segment = lambda high, medium, low: (
        F.when(F.col("risk_segment") == "HIGH_RISK", high).when(F.col("risk_segment") == "MEDIUM_RISK", medium)
        .otherwise(low))
    return (
        profile.withColumn("claims_frequency_score", F.col("total_claims") / F.lit(3.0))
        .withColumn("claims_severity_score", F.col("avg_claim_amount"))
        .withColumn("risk_segment", segment)
        .withColumn("overall_risk_rating", by_segment("DECLINE", "REVIEW", "ACCEPT"))
        .withColumn("recommended_premium_adjustment", by_segment(1.5, 1.2, 1.0))
    )


# ------------------------------------------------------------------------------- dashboards

def realtime_dashboard(df: DataFrame, as_of: Column) -> DataFrame:
    """Today's totals, last-hour latency and queue sizes in a single pass."""
    today = F.to_date("claim_date") == F.to_date(as_of)
    last_hour = F.col("_silver_timestamp") >= as_of - F.expr("INTERVAL 1 HOUR")
    return df.agg(
        F.count_if(today).alias("claims_today"),
        F.sum(F.when(today, F.col("claim_amount_gbp"))).alias("total_value_today"),
        F.avg(F.when(today, F.col("adjusted_fraud_score"))).alias("avg_fraud_score_today"),
        F.avg(F.when(last_hour, F.col("_processing_time_ms"))).alias("avg_processing_time_1h"),
        F.count_if(today & F.col("is_high_risk")).alias("fraud_detected_today"),
        F.count_if(F.col("requires_manual_review") & (F.col("processing_status") == "MANUAL_REVIEW"))
        .alias("manual_review_queue"),
        F.count_if(F.col("processing_status") == "FRAUD_INVESTIGATION").alias("fraud_investigation_queue"),
    )


def top_claims_attention(df: DataFrame, as_of: Column, days: int = 7, top: int = 10) -> DataFrame:
    """The largest and the most suspicious recent claims. Each ranking is a distributed top-k."""
    recent = df.where(F.col("claim_date") >= _days_back(as_of, days)).select(
        "claim_id", "customer_id", "claim_date", "claim_type", "claim_amount_gbp", "adjusted_fraud_score",
        "processing_status")

    def ranked(category, column):
        best = recent.orderBy(F.desc_nulls_last(column), "claim_id").limit(top)
        return best.select(F.lit(category).alias("category"), "*")

    return (ranked("HIGH_VALUE", "claim_amount_gbp").unionByName(ranked("HIGH_FRAUD_RISK", "adjusted_fraud_score"))
            .orderBy("category", F.desc("claim_amount_gbp")))


def regional_metrics(df: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Recent totals, fraud share, latency and customers per region."""
    recent = df.where((F.col("claim_date") >= _days_back(as_of, days)) & F.col("region").isNotNull())
    return recent.groupBy("region").agg(
        F.count("*").alias("claim_count"),
        F.sum("claim_amount_gbp").alias("total_claimed"),
        F.avg("claim_amount_gbp").alias("avg_claim_amount"),
        F.avg("adjusted_fraud_score").alias("avg_fraud_score"),
        F.count_if("is_high_risk").alias("fraud_cases"),
        (_share(F.col("is_high_risk")) * 100).alias("fraud_rate_percent"),
        F.avg("_processing_time_ms").alias("avg_processing_time"),
        F.count_distinct("customer_id").alias("unique_customers"),
    ).orderBy(F.desc("total_claimed"))


def regional_performance(df: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Recent count and means per region, unknown regions included."""
    return df.where(F.col("claim_date") >= _days_back(as_of, days)).groupBy("region").agg(
        F.count("*").alias("claim_count"),
        F.avg("claim_amount_gbp").alias("avg_amount"),
        F.avg("fraud_score").alias("avg_fraud_score"),
    )


def executive_dashboard(kpis: DataFrame, summary: DataFrame, as_of: Column) -> DataFrame:
    """One row joining the day's KPIs with the day's claim totals."""
    day = F.to_date(as_of)
    kpi = lambda name: F.max(F.when(F.col("kpi_name") == name, F.col("kpi_value")))
    current = kpis.where(F.col("kpi_date") == day).agg(
        kpi("claims_per_hour").alias("claims_per_hour"),
        (kpi("auto_approval_rate") * 100).alias("auto_approval_percent"),
        (kpi("fraud_detection_rate") * 100).alias("fraud_detection_percent"),
        kpi("avg_processing_time_ms").alias("avg_processing_time_ms"),
    )
    totals = summary.where(F.col("summary_date") == day).agg(
        F.sum("total_claims").alias("total_claims_today"),
        F.sum("total_amount").alias("total_amount_today"),
        F.sum("fraud_detected_amount").alias("fraud_prevented_today"),
        (F.avg("fraud_rate") * 100).alias("fraud_rate_percent"),
    )
    # Two single-row aggregates: joined on a constant, so no row is ever paired with many.
    return (current.withColumn("_one", F.lit(1)).join(totals.withColumn("_one", F.lit(1)), "_one").drop("_one"))


def recent_high_value_claims(claims: DataFrame, customers: DataFrame, as_of: Column, days: int = 7,
                             above: float = 10000) -> DataFrame:
    """Recent large claims with the customer's segment and lifetime value."""
    recent = claims.where((F.col("claim_date") >= _days_back(as_of, days)) & (F.col("claim_amount_gbp") > above))
    return (
        recent.join(customers.select("customer_id", "customer_segment", "lifetime_value"), "customer_id")
        .select("claim_id", "claim_date", "customer_id", "claim_amount_gbp", "claim_type", "fraud_score",
                "fraud_indicators", "customer_segment", "lifetime_value")
        .orderBy(F.desc("claim_amount_gbp"), "claim_id")
    )


def fraud_investigation_queue(claims: DataFrame, postcode_risk: DataFrame, above: float = 0.7) -> DataFrame:
    """Claims to investigate, most suspicious first, with the risk of their district.

    ``postcode_risk`` has one row per district (bounded by geography); Spark broadcasts it when its
    measured size allows.
    """
    open_claims = claims.where(F.col("requires_manual_review") | (F.col("fraud_score") > above))
    risk = postcode_risk.select("postcode_district", F.col("risk_score").alias("postcode_risk_score"))
    return (
        open_claims.join(risk, "postcode_district", "left")
        .select("claim_id", "claim_date", "customer_id", "claim_amount_gbp", "fraud_score", "fraud_indicators",
                "incident_postcode", "postcode_risk_score")
        .orderBy(F.desc("fraud_score"), F.desc("claim_amount_gbp"), "claim_id")
    )


def lite_figures() -> list[Column]:
    amount = F.col("claim_amount_gbp")
    return [
        F.count("*").alias("total_claims"),
        F.sum(amount).alias("total_amount"),
        F.avg(amount).alias("average_amount"),
        F.count_if("is_high_risk").alias("fraud_detected_count"),
        F.sum(F.when(F.col("is_high_risk"), amount).otherwise(0)).alias("fraud_detected_amount"),
        F.count_if(F.col("processing_status") == "AUTO_APPROVED").alias("auto_approved_count"),
        F.count_if("requires_manual_review").alias("manual_review_count"),
    ]


def daily_summary_lite(df: DataFrame) -> DataFrame:
    """The reduced daily summary."""
    return df.groupBy(F.to_date("claim_date").alias("summary_date"), "claim_type").agg(*lite_figures())


def weekly_kpis(summary: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Roll the daily summary of the last days up to one row per day."""
    return summary.where(F.col("summary_date") >= _days_back(as_of, days)).groupBy("summary_date").agg(
        F.sum("total_claims").alias("total_claims"),
        F.sum("total_amount").alias("total_value"),
        F.avg("average_amount").alias("avg_claim"),
        F.sum("fraud_detected_count").alias("fraud_cases"),
        (F.sum("auto_approved_count") * 100.0 / F.sum("total_claims")).alias("auto_approval_rate"),
    )


def claims_dashboard_metrics(df: DataFrame, city: str = "incident_location", status: str = "claim_status",
                             fraud_above: float = 0.7, high_risk_above: float = 0.8) -> DataFrame:
    """Totals and the splits by type, status, city and hour, out of one aggregation.

    Grouping sets share the scan and the partial aggregation; ``metric_group`` names the split.
    """
    prepared = df.select(
        F.col("claim_type"), F.col(status).alias("status"), F.col(city).alias("city"),
        F.date_format("claim_date", "yyyy-MM-dd HH:00").alias("hour"), "claim_amount", "fraud_score")
    splits = ["claim_type", "status", "city", "hour"]
    sets = [[], *[[F.col(s)] for s in splits]]
    grouped = prepared.groupingSets(sets, *splits).agg(
        F.grouping_id().alias("_gid"),
        F.count("*").alias("claims"),
        F.sum("claim_amount").alias("total_amount"),
        F.avg("fraud_score").alias("avg_fraud_score"),
        F.count_if(F.col("fraud_score") > fraud_above).alias("fraud_cases"),
        F.count_if(F.col("fraud_score") > high_risk_above).alias("high_risk_claims"),
    )
    full = 2 ** len(splits) - 1
    group = F.when(F.col("_gid") == full, "total")
    item = F.when(F.col("_gid") == full, "all")
    for position, name in enumerate(splits):
        only = full - 2 ** (len(splits) - 1 - position)
        group, item = group.when(F.col("_gid") == only, name), item.when(F.col("_gid") == only, F.col(name))
    return grouped.select(group.alias("metric_group"), F.coalesce(item, F.lit("(none)")).alias("item"), "claims",
                          "total_amount", "avg_fraud_score", "fraud_cases", "high_risk_claims")


def recent_claims_topn(df: DataFrame, n: int = 10, red_above: float = 0.7, amber_above: float = 0.4) -> DataFrame:
    """The latest claims with a traffic light on the fraud score."""
    score = F.col("fraud_score")
    light = F.when(score > red_above, "RED").when(score > amber_above, "AMBER").otherwise("GREEN")
    return (df.orderBy(F.desc("claim_date"), "claim_id").limit(n)
            .select("claim_id", "claim_type", "claim_amount", "fraud_score", "claim_status", "incident_location",
                    "claim_date", light.alias("traffic_light")))


def top_cities(df: DataFrame, n: int = 5, city: str = "incident_location") -> DataFrame:
    """The cities with most claims."""
    return (df.groupBy(F.coalesce(F.col(city), F.lit("Unknown")).alias("city")).agg(F.count("*").alias("claims"))
            .orderBy(F.desc("claims"), "city").limit(n))
