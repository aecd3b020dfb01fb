"""Databases, tables and views of the layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import TABLES

VIEWS = {
    "v_recent_high_value_claims": """
        SELECT c.claim_id, c.claim_date, c.customer_id, c.claim_amount_gbp, c.claim_type, c.fraud_score, c.fraud_indicators,
               u.customer_segment, u.lifetime_value
        FROM {silver}.claims c JOIN {silver}.customers u ON c.customer_id = u.customer_id
        WHERE c.claim_day >= current_date() - INTERVAL 7 DAYS AND c.claim_amount_gbp > 10000""",
    "v_fraud_investigation_queue": """
        SELECT c.claim_id, c.claim_date, c.customer_id, c.claim_amount_gbp, c.fraud_score, c.fraud_indicators,
               c.incident_postcode, r.risk_score AS postcode_risk_score
        FROM {silver}.claims c LEFT JOIN {silver}.dim_postcode_risk r ON c.postcode_district = r.postcode_district
        WHERE c.requires_manual_review OR c.fraud_score > 0.7""",
    "v_executive_dashboard": """
        WITH kpi AS (
          SELECT max(kpi_value) FILTER (WHERE kpi_name = 'claims_per_hour') AS claims_per_hour,
                 max(kpi_value) FILTER (WHERE kpi_name = 'auto_approval_rate') * 100 AS auto_approval_percent,
                 max(kpi_value) FILTER (WHERE kpi_name = 'fraud_detection_rate') * 100 AS fraud_detection_percent,
                 max(kpi_value) FILTER (WHERE kpi_name = 'avg_processing_time_ms') AS avg_processing_time_ms
          FROM {gold}.operational_kpis WHERE kpi_date = current_date()),
        day AS (
          SELECT sum(total_claims) AS total_claims_today, sum(total_amount) AS total_amount_today,
                 sum(fraud_detected_amount) AS fraud_prevented_today, avg(fraud_rate) * 100 AS fraud_rate_percent
          FROM {gold}.daily_claims_summary WHERE summary_date = current_date())
        SELECT current_timestamp() AS dashboard_timestamp, kpi.*, day.* FROM kpi CROSS JOIN day""",
}


def catalog_setup(spark: SparkSession, prefix: str, location: str, with_views: bool = True) -> list[str]:
    """Create the databases, tables and views that do not exist yet; gives the database names."""
    names = {layer: f"{prefix}_{layer}" for layer in TABLES}
    for layer, tables in TABLES.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {names[layer]} LOCATION '{location}/{layer}'")
        for table, (schema, partitions) in tables.items():
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            parted = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
            spark.sql(f"CREATE TABLE IF NOT EXISTS {names[layer]}.{table} ({columns}) USING parquet{parted}"
                      f" LOCATION '{location}/{layer}/{table}'")
    if with_views:
        for view, text in VIEWS.items():
            spark.sql(f"CREATE OR REPLACE VIEW {names['gold']}.{view} AS {text.format(**names)}")
    return list(names.values())


def list_tables(spark: SparkSession, prefix: str) -> DataFrame:
    """Layer, table and column count of everything the set-up created."""
    rows = []
    for layer in TABLES:
        for table in spark.catalog.listTables(f"{prefix}_{layer}"):
            columns = len(spark.table(f"{prefix}_{layer}.{table.name}").columns)
            rows.append((layer, table.name, table.tableType, columns))
    return spark.createDataFrame(rows, "layer string, table_name string, table_type string, columns int")


def drop_catalog(spark: SparkSession, prefix: str) -> None:
    for layer in TABLES:
        spark.sql(f"DROP DATABASE IF EXISTS {prefix}_{layer} CASCADE")
