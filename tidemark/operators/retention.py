"""Retention of claims, erasure and export requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import refdata
from tidemark.sources.sinks import export_files, read_export

_DAYS = {kind: days for category, kind, days, _ in refdata.RETENTION_POLICIES if category == "claims"}


def retention_policies(spark) -> DataFrame:
    return refdata.inline_table(spark, "category STRING, policy_type STRING, retention_days INT, description STRING",
                                refdata.RETENTION_POLICIES).withColumn("active", F.lit(True))


def claims_retention(claims: DataFrame, as_of: Column) -> DataFrame:
    """Claims with their retention category, period, end date and days left.

    Only ``deletion_schedule`` reads the sensitivity; the claims bring it along if they are classified.
    """
    category = (F.when(F.col("fraud_score") > 0.8, "fraud").when(F.col("claim_status") == "REJECTED", "declined")
                .otherwise("standard"))
    period = F
    for kind, days in _DAYS.items():
        period = period.when(F.col("retention_category") == kind, days)
    return (
        claims.withColumns({"days_since_claim": F.datediff(F.to_date(as_of), F.to_date("claim_date")), "retention_category": category})
        .withColumn("retention_days", period)
        .withColumns({
            "retention_end_date": F.date_add(F.to_date("claim_date"), F.col("retention_days")),
            "past_retention": F.col("days_since_claim") > F.col("retention_days"),
            "days_until_deletion": F.col("retention_days") - F.col("days_since_claim"),
        })
    )


def policies_in_force(retained: DataFrame) -> DataFrame:
    """The policy table with how many claims each claims policy holds."""
    held = retained.groupBy(F.col("retention_category").alias("policy_type")).agg(F.count("*").alias("claims_held"))
    held = held.withColumn("category", F.lit("claims"))
    return (retention_policies(retained.sparkSession).join(held, ["category", "policy_type"], "left")
            .withColumn("claims_held", F.coalesce("claims_held", F.lit(0))))


def retention_counts(retained: DataFrame) -> DataFrame:
    return retained.groupBy("retention_category", "past_retention").agg(F.count("*").alias("records"))


def retention_summary(retained: DataFrame) -> DataFrame:
    """Overdue and due records, ages and date range per category, most overdue first."""
    return retained.groupBy("retention_category").agg(
        F.count("*").alias("total_records"), F.count_if("past_retention").alias("overdue_records"),
        F.count_if(F.col("days_until_deletion").between(0, 30)).alias("due_soon"),
        F.round(F.avg("days_since_claim"), 0).alias("avg_age_days"),
        F.min("claim_date").alias("oldest_claim"), F.max("claim_date").alias("newest_claim"),
    ).withColumn("overdue_percentage", F.round(F.col("overdue_records") * 100.0 / F.col("total_records"), 2)).orderBy(
        F.desc("overdue_percentage"), "retention_category")


def deletion_candidates(retained: DataFrame) -> DataFrame:
    return retained.where("past_retention").select(
        "claim_id", "customer_id", "claim_date", "retention_category", "retention_days", "days_since_claim")


def deletion_schedule(retained: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Records per deletion date over the next days."""
    due = retained.where(F.col("days_until_deletion").between(0, days))
    return due.groupBy(F.date_add(F.to_date(as_of), F.col("days_until_deletion")).alias("deletion_date")).agg(
        F.count("*").alias("records_to_delete"),
        F.sort_array(F.collect_set("retention_category")).alias("categories"),
        F.count_if(F.col("overall_sensitivity") == "HIGH").alias("high_sensitivity_records"))


def retention_compliance(retained: DataFrame) -> DataFrame:
    """Records per category and urgency, most urgent first."""
    left = F.col("days_until_deletion")
    status = F.when(left < 0, "OVERDUE").when(left < 30, "DUE_SOON").when(left < 180, "UPCOMING").otherwise("COMPLIANT")
    order = F.when(F.col("status") == "OVERDUE", 1).when(F.col("status") == "DUE_SOON", 2).when(
        F.col("status") == "UPCOMING", 3).otherwise(4)
    return retained.groupBy("retention_category", status.alias("status")).agg(
        F.count("*").alias("record_count"), F.min(left).alias("min_days"), F.max(left).alias("max_days")).orderBy(
        order, "retention_category")


def legal_holds(claims: DataFrame, requests: DataFrame) -> DataFrame:
    """Requesting customers that must not be erased, with the number of claims that hold them."""
    held = claims.where((F.col("fraud_score") > 0.8) | (F.col("claim_status") == "DISPUTED"))
    asked = requests.select("customer_id").distinct()
    return held.join(asked, "customer_id", "left_semi").groupBy("customer_id").agg(F.count("*").alias("hold_count"))


def erasure(claims: DataFrame, requests: DataFrame, erased_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(anonymised claims, one log row per request) for a table of erasure requests.

    Customers with claims under legal hold are refused as a whole. Requests are joined as a table, so
    any number of them takes one pass over the claims.
    """
    asked = requests.groupBy("customer_id").agg(F.min("reason").alias("reason"))
    holds = legal_holds(claims, requests)
    granted = asked.join(holds, "customer_id", "left_anti")
    affected = claims.join(granted, "customer_id", "left_semi")
    anonymised = affected.select(
        "claim_id", F.concat(F.lit("DELETED_"), "claim_id").alias("customer_id"),
        "claim_amount", "claim_date", "claim_type", "claim_status", *[F.lit(v).alias(c) for c, v in refdata.ERASED_VALUES.items()])
    counts = affected.groupBy("customer_id").agg(F.count("*").alias("records_affected"))
    refused = F.col("hold_count") > 0
    log = (asked.join(holds, "customer_id", "left").join(counts, "customer_id", "left").select(
        "customer_id", "reason", F.coalesce("records_affected", F.lit(0)).alias("records_affected"),
        F.coalesce("hold_count", F.lit(0)).alias("hold_count"),
        F.when(refused, "REFUSED_LEGAL_HOLD").otherwise("ANONYMIZATION").alias("deletion_type"),
        F.lit(False).alias("retention_override"),
        (erased_at if erased_at is not None else F.current_timestamp()).alias("deletion_timestamp")))
    return anonymised, log


EXPORTED = ["claim_id", "policy_number", "customer_id", "customer_name", "customer_email", "customer_phone", "customer_address",
            "claim_amount", "claim_date", "claim_type", "claim_status", "incident_location", "incident_description"]


def export_customer_data(claims: DataFrame, requests: DataFrame) -> DataFrame:
    """All classified claims of the requesting customers."""
    asked = requests.select("customer_id").distinct()
    return claims.select(*EXPORTED, "overall_sensitivity", "gdpr_risk_score").join(asked, "customer_id", "left_semi")


EXPORT_PART = "export_part"


def write_export(exported: DataFrame, path: str, file_format: str = "json") -> str:
    """Write the exported claims in folders by a prefix of the customer id's hash; a customer lies in one of them."""
    parted = exported.withColumn(EXPORT_PART, F.left(F.sha2("customer_id", 256), F.lit(2)))
    return export_files(parted.hint("rebalance", F.col(EXPORT_PART)), path, file_format, partition_by=[EXPORT_PART])


def export_log(spark: SparkSession, path: str, file_format: str = "json", exported_at: Column | None = None) -> DataFrame:
    """One row per customer found in the written files, with the folder that holds the data."""
    written = read_export(spark, path, file_format, f"customer_id string, {EXPORT_PART} string")
    return written.groupBy("customer_id", EXPORT_PART).agg(F.count("*").alias("records_exported")).withColumns({
        "export_timestamp": exported_at if exported_at is not None else F.current_timestamp(),
        "format": F.lit(file_format),
        "export_path": F.concat(F.lit(f"{path}/{EXPORT_PART}="), EXPORT_PART),
        "gdpr_article": F.lit("Article 20 - Data Portability"),
    })
