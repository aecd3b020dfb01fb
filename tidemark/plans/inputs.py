"""Domain tables derived from the given TPC-H-like tables.

Each table is a list of plain SQL expressions over one given table. The same text builds the Spark
frame (``selectExpr``) and the checking query, so both sides read identical rows; everything is
integer arithmetic on keys, with no clock and no randomness. Epoch seconds are canonical.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


CLAIMS_AS_OF = "2025-04-08 00:00:00"
AUDIT_AS_OF = "2024-01-31 00:00:00"
RETENTION_AS_OF = "2004-01-01"

_AREA = """CASE o_custkey % 15 WHEN 0 THEN 'E' WHEN 1 THEN 'EC' WHEN 2 THEN 'N' WHEN 3 THEN 'NW' WHEN 4 THEN 'SE'
 WHEN 5 THEN 'SW' WHEN 6 THEN 'W' WHEN 7 THEN 'WC' WHEN 8 THEN 'B' WHEN 9 THEN 'M' WHEN 10 THEN 'L' WHEN 11 THEN 'G'
 WHEN 12 THEN 'EH' WHEN 13 THEN 'CF' ELSE 'BT' END"""
_POSTCODE = f"""CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 50 = 0 THEN 'INVALID' ELSE {_AREA}
 || cast(1 + o_orderkey % 3 AS STRING) || ' ' || cast(o_orderkey % 10 AS STRING) || 'AA' END"""
_SCORE = "((o_orderkey * 7919 + o_custkey * 104729) % 1000) / 1e3"
_INCIDENT_S = "1704067200 + 86400 * ((o_orderkey * 37) % 365) + 3600 * (o_orderkey % 24)"
_CLAIM_S = ("1704067200 + 86400 * ((o_orderkey * 37) % 365 + (o_orderkey * 7) % 100 - 2)"
            " + 3600 * ((o_orderkey * 5) % 24)")
_CITY = ("CASE o_custkey % 7 WHEN 0 THEN 'London' WHEN 1 THEN 'Birmingham' WHEN 2 THEN 'Manchester'"
         " WHEN 3 THEN 'Glasgow' WHEN 4 THEN 'Liverpool' WHEN 5 THEN 'Edinburgh' ELSE 'Bristol' END")

BRONZE = [
    "'CLM_' || lpad(cast(o_orderkey AS STRING), 12, '0') AS claim_id",
    "CASE WHEN o_orderkey % 89 = 0 THEN NULL"
    " ELSE 'POL_' || lpad(cast(o_custkey AS STRING), 12, '0') END AS policy_number",
    "'CUST_' || lpad(cast(o_custkey AS STRING), 12, '0') AS customer_id",
    "floor(o_totalprice * 2e1) / 1e2 AS claim_amount",
    f"{_CLAIM_S} AS claim_s",
    f"{_INCIDENT_S} AS incident_s",
    f"{_CITY} AS incident_location",
    f"{_POSTCODE} AS incident_postcode",
    "CASE o_orderkey % 5 WHEN 0 THEN 'motor' WHEN 1 THEN 'home' WHEN 2 THEN 'travel' WHEN 3 THEN 'pet'"
    " ELSE 'life' END AS claim_type",
    "CASE WHEN o_orderkey % 13 = 0 THEN 'REJECTED' WHEN o_orderkey % 17 = 0 THEN 'DISPUTED'"
    " WHEN o_orderstatus = 'O' THEN 'OPEN' WHEN o_orderstatus = 'P' THEN 'PROCESSING'"
    " ELSE 'SETTLED' END AS claim_status",
    f"({_SCORE}) * ({_SCORE}) AS fraud_score",
    f"{_CLAIM_S} + 1 + o_orderkey % 5 AS ingestion_s",
    f"{_CLAIM_S} + 1 + o_orderkey % 5 + o_orderkey % 3 AS silver_s",
]

# A messy feed: duplicates, broken JSON, a literal null, missing ids, bad dates, huge amounts.
EVENT_LINES = [
    "o_orderkey AS seq",
    "o_orderkey % 4 AS partition_id",
    "o_orderkey * 10 AS stream_offset",
    "1704067200 + o_orderkey AS enqueued_s",
    f"""CASE WHEN o_orderkey % 101 = 0 THEN '{{"claim_id": "CLM_' || cast(o_orderkey AS STRING)
 WHEN o_orderkey % 103 = 0 THEN 'null'
 ELSE '{{' || CASE WHEN o_orderkey % 107 = 0 THEN '' ELSE '"claim_id":"CLM_'
   || lpad(cast(CASE WHEN o_orderkey % 20 = 7 THEN o_orderkey - 1 ELSE o_orderkey END AS STRING), 12, '0') || '",' END
 || CASE WHEN o_orderkey % 89 = 0 THEN '"policy_number":null,' ELSE '"policy_number":"POL_'
   || lpad(cast(o_custkey AS STRING), 12, '0') || '",' END
 || '"customer_id":"CUST_' || lpad(cast(o_custkey AS STRING), 12, '0')
 || '","claim_amount":' || CASE WHEN o_orderkey % 211 = 0 THEN '123456789012.5'
   WHEN o_orderkey % 223 = 0 THEN '-5.0' ELSE cast(o_orderkey % 1500000 AS STRING) || '.25' END
 || ',"claim_date":"' || CASE WHEN o_orderkey % 109 = 0 THEN 'yesterday'
   ELSE '2024-' || lpad(cast(1 + o_orderkey % 12 AS STRING), 2, '0') || '-15 10:00:00' END
 || '","incident_date":"2024-' || lpad(cast(1 + o_custkey % 12 AS STRING), 2, '0') || '-10 08:30:00"'
 || ',"incident_location":"' || {_CITY} || '","incident_postcode":"' || {_AREA} || cast(1 + o_orderkey % 3 AS STRING)
 || ' 1AA","claim_type":"motor","claim_status":"OPEN","fraud_score":' || cast(o_orderkey % 10 AS STRING) || 'e-1'
 || ',"fraud_indicators":["a","b"],"description":"line ' || cast(o_orderkey AS STRING)
 || '","metadata":{{"k":"v"}}}}' END AS body""",
]

POLICIES = [
    "'POL_' || lpad(cast(c_custkey AS STRING), 12, '0') AS policy_number",
    "'CUST_' || lpad(cast(c_custkey AS STRING), 12, '0') AS policyholder_id",
    "CASE c_custkey % 8 WHEN 0 THEN 'motor' WHEN 1 THEN 'property' WHEN 2 THEN 'liability'"
    " WHEN 3 THEN 'professional_indemnity' WHEN 4 THEN 'cyber' WHEN 5 THEN 'marine' WHEN 6 THEN 'aviation'"
    " ELSE 'directors_officers' END AS policy_type",
    "1688169600 + 86400 * ((c_custkey * 13) % 365) AS start_s",
    "1688169600 + 86400 * ((c_custkey * 13) % 365 + CASE WHEN c_custkey % 53 = 0 THEN 0 ELSE 365 END) AS end_s",
    "(300 + (c_custkey * 29) % 4700) * 1e0 AS premium_amount",
    "(300 + (c_custkey * 29) % 4700) * CASE WHEN c_custkey % 9 = 0 THEN 12e1 ELSE 5e1 END AS sum_insured",
    "(300 + (c_custkey * 29) % 4700) * 1e0 AS deductible",
    "CASE c_custkey % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE 'unknown' END AS risk_profile",
    "CASE c_custkey % 5 WHEN 0 THEN 'Hiscox' WHEN 1 THEN 'Beazley' WHEN 2 THEN 'Aviva' WHEN 3 THEN 'Amlin'"
    " ELSE 'Zurich' END AS underwriter",
]

HOLDERS = [
    "'CUST_' || lpad(cast(c_custkey AS STRING), 12, '0') AS policyholder_id",
    "c_name AS full_name",
    "'customer.' || cast(c_custkey AS STRING) || '@example.com' AS email",
    "'07' || lpad(cast(c_custkey AS STRING), 9, '0') AS phone",
    "-1104537600 + 86400 * ((c_custkey * 97) % 25000) AS dob_s",
    "((c_custkey * 31) % 100) / 1e2 AS risk_score",
    "c_custkey % 10 < 3 AS is_corporate",
    "CASE WHEN c_custkey % 10 < 3 THEN 'REG' || cast(c_custkey % 997 AS STRING) END AS company_registration",
    """CASE c_custkey % 16 WHEN 0 THEN 'E' WHEN 1 THEN 'EC' WHEN 2 THEN 'N' WHEN 3 THEN 'OX' WHEN 4 THEN 'SE'
 WHEN 5 THEN 'SW' WHEN 6 THEN 'W' WHEN 7 THEN 'WC' WHEN 8 THEN 'B' WHEN 9 THEN 'M' WHEN 10 THEN 'L' WHEN 11 THEN 'YO'
 WHEN 12 THEN 'EH' WHEN 13 THEN 'CF' WHEN 14 THEN 'ZZ' ELSE 'GU' END || cast(1 + c_custkey % 3 AS STRING) || ' '
 || cast(c_custkey % 10 AS STRING) || CASE WHEN c_custkey % 41 = 0 THEN 'A' ELSE 'AB' END AS holder_postcode""",
]

# The normalised claim of the fraud and rating operators.
CLAIMS = [
    "'CLM_' || lpad(cast(o_orderkey AS STRING), 12, '0') AS claim_id",
    "'POL_' || lpad(cast(o_custkey AS STRING), 12, '0') AS policy_number",
    "'CUST_' || lpad(cast(o_custkey AS STRING), 12, '0') AS policyholder_id",
    "CASE o_orderkey % 10 WHEN 0 THEN 'collision' WHEN 1 THEN 'theft' WHEN 2 THEN 'fire' WHEN 3 THEN 'flood'"
    " WHEN 4 THEN 'storm' WHEN 5 THEN 'liability_injury' WHEN 6 THEN 'liability_damage' WHEN 7 THEN 'cyber_breach'"
    " WHEN 8 THEN 'professional_error' ELSE 'other' END AS claim_type",
    "CASE o_orderkey % 9 WHEN 0 THEN 'submitted' WHEN 1 THEN 'under_review' WHEN 2 THEN 'investigation'"
    " WHEN 3 THEN 'approved' WHEN 4 THEN 'rejected' WHEN 5 THEN 'paid' WHEN 6 THEN 'closed' WHEN 7 THEN 'reopened'"
    " ELSE 'lost' END AS claim_state",
    f"{_INCIDENT_S} AS incident_s",
    f"{_INCIDENT_S} + 86400 * (o_orderkey % 61 - 1) AS reported_s",
    "CASE WHEN o_orderkey % 19 = 0 THEN 500e0 * (1 + o_orderkey % 30)"
    " ELSE floor(o_totalprice * 2e1) / 1e2 END AS claim_amount",
    "floor(o_totalprice * 2e1) / 1e2 / (1 + o_orderkey % 3) AS approved_amount",
    f"({_SCORE}) * ({_SCORE}) AS fraud_score",
    f"{_POSTCODE} AS incident_postcode",
    f"{_CITY} AS city",
    "CASE o_orderkey % 12 WHEN 0 THEN 'Total loss, no witnesses and no evidence' WHEN 1 THEN 'Items stolen while away, no witnesses'"
    " WHEN 2 THEN 'Minor scratch' WHEN 3 THEN 'Everything destroyed, all items disappeared, cannot remember, complete damage'"
    " ELSE 'Routine report ' || cast(o_orderkey AS STRING) END AS description",
    "o_orderkey AS claim_key",
]

# Extra attributes of the rule engine's input.
RULE_ATTRIBUTES = [
    "'CLM_' || lpad(cast(o_orderkey AS STRING), 12, '0') AS claim_id",
    "'POL_' || lpad(cast(o_custkey AS STRING), 12, '0') AS policy_number",
    "floor(o_totalprice * 2e1) / 1e2 AS claim_amount",
    "CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE 25000e0 * (1 + o_orderkey % 4) END AS policy_limit",
    "CASE o_orderkey % 6 WHEN 0 THEN 'motor' WHEN 1 THEN 'home' WHEN 2 THEN 'travel' WHEN 3 THEN 'pet'"
    " WHEN 4 THEN 'life' ELSE 'cyber' END AS product",
    "CASE o_orderkey % 7 WHEN 0 THEN 'motor' WHEN 1 THEN 'flood' WHEN 2 THEN 'storm_damage' WHEN 3 THEN 'motor'"
    " WHEN 4 THEN 'wind_damage' WHEN 5 THEN 'theft' ELSE 'weather' END AS claim_type",
    f"CASE WHEN o_orderkey % 23 = 0 THEN 'GL5 1AA' ELSE {_POSTCODE} END AS incident_location",
    "(o_orderkey % 3) * 50 AS fault_percentage",
    "o_orderkey % 6 AS witness_count",
    "o_orderkey % 30 AS medical_report_delay_days",
    "CASE WHEN o_orderkey % 4 = 0 THEN 'rear_end' ELSE 'side' END AS accident_type",
    "CASE WHEN o_orderkey % 8 = 1 THEN 'Storm Babet' END AS weather_event",
    "CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE 18 + o_custkey % 80 END AS customer_age",
    "o_orderkey % 29 = 0 AS has_disability",
    "o_orderkey % 43 = 0 AS financial_difficulty",
    "o_orderkey % 47 = 0 AS recent_bereavement",
    "o_orderkey % 11 <> 0 AS gdpr_consent",
    "CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE 1744070400 - 86400 * (o_orderkey % 400) - 3600 END AS consent_s",
    "CASE WHEN o_orderkey % 14 = 0 THEN 9 ELSE 7 END AS data_retention_years",
    f"{_CLAIM_S} AS claim_s",
    f"{_INCIDENT_S} AS incident_s",
    "CASE o_custkey % 5 WHEN 0 THEN 'Hiscox' WHEN 1 THEN 'Beazley' WHEN 2 THEN 'Aviva' WHEN 3 THEN 'Amlin'"
    " ELSE 'Zurich' END AS underwriter",
    "o_orderkey % 2 = 0 AS is_reinsurance",
]

AUDIT_LOG = [
    "cast(event_id AS STRING) AS audit_id",
    "ts AS event_timestamp",
    "CASE WHEN event_type IN ('click', 'view') THEN 'DATA_ACCESS' ELSE 'DATA_MODIFICATION' END AS event_type",
    "'user_' || cast(user_id AS STRING) AS user_id",
    "CASE event_type WHEN 'click' THEN 'READ' WHEN 'view' THEN 'READ' WHEN 'purchase' THEN 'UPDATE'"
    " WHEN 'signup' THEN 'EXPORT' ELSE 'DELETE' END AS action",
    "CASE event_id % 4 WHEN 0 THEN 'claims' WHEN 1 THEN 'customers' WHEN 2 THEN 'policies' ELSE 'reports' END AS resource_type",
    "'res_' || cast(event_id % 500 AS STRING) AS resource_id",
    "CASE WHEN event_id % 10 = 0 THEN 'HIGH' WHEN event_id % 3 = 0 THEN 'MEDIUM' ELSE 'LOW' END AS sensitivity_level",
    "event_id % 20 <> 0 AS success",
]

METRICS = [
    "CASE event_type WHEN 'click' THEN 'processing_latency_ms' WHEN 'view' THEN 'throughput_per_second'"
    " WHEN 'purchase' THEN 'bronze_ingestion_rate' WHEN 'signup' THEN 'fraud_detection_rate' ELSE 'error_rate' END AS name",
    "CASE event_type WHEN 'signup' THEN value / 1e4 WHEN 'error' THEN value / 1e4 ELSE value END AS value",
    "ts",
    "event_id AS point_id",
]
# The same points spread over every metric the health checks know.
LAYER_METRICS = [
    "CASE event_id % 8 WHEN 0 THEN 'bronze_ingestion_rate' WHEN 1 THEN 'bronze_data_quality' WHEN 2 THEN 'bronze_dlq_count'"
    " WHEN 3 THEN 'silver_processing_latency' WHEN 4 THEN 'silver_validation_rate' WHEN 5 THEN 'silver_enrichment_success'"
    " WHEN 6 THEN 'gold_aggregation_lag' ELSE 'gold_kpi_calculation_time' END AS name",
    "CASE WHEN event_id % 8 IN (1, 4, 5) THEN 9e-1 + value / 1e4 ELSE value END AS value",
    "ts",
    "event_id AS point_id",
]

USAGE = [
    "'svc_' || cast(l_suppkey % 7 AS STRING) AS service",
    "cast(l_shipdate AS DATE) AS usage_date",
    "floor(l_extendedprice) / 1e4 AS cost",
]

# Claims carrying personal data; claim_date is the order date, so that retention has old rows.
PERSONAL = [
    "'CLM_' || lpad(cast(o_orderkey AS STRING), 12, '0') AS claim_id",
    "'POL_' || lpad(cast(o_custkey AS STRING), 12, '0') AS policy_number",
    "'CUST_' || lpad(cast(o_custkey AS STRING), 12, '0') AS customer_id",
    "CASE o_custkey % 4 WHEN 0 THEN 'Customer ' || cast(o_custkey AS STRING) WHEN 1 THEN 'John Smith'"
    " WHEN 2 THEN 'Cher' ELSE NULL END AS customer_name",
    "CASE WHEN o_custkey % 6 = 0 THEN 'ab@example.com' WHEN o_custkey % 6 = 1 THEN 'no at sign'"
    " ELSE 'customer.' || cast(o_custkey AS STRING) || '@example.com' END AS customer_email",
    "CASE WHEN o_custkey % 5 = 0 THEN '0' || cast(o_custkey AS STRING)"
    " ELSE '07' || lpad(cast(o_custkey AS STRING), 9, '0') END AS customer_phone",
    "CASE o_custkey % 3 WHEN 0 THEN cast(o_custkey AS STRING) || ' High Street, London, SW1A 2AA'"
    " WHEN 1 THEN 'Flat 2, Nowhere' ELSE 'Manor' END AS customer_address",
    f"{_POSTCODE} AS postcode",
    "floor(o_totalprice * 2e1) / 1e2 AS claim_amount",
    "cast(o_orderdate AS DATE) AS claim_date",
    f"{_CLAIM_S} AS claim_s",
    "CASE o_orderkey % 5 WHEN 0 THEN 'motor' WHEN 1 THEN 'home' WHEN 2 THEN 'travel' WHEN 3 THEN 'pet'"
    " ELSE 'life' END AS claim_type",
    "CASE WHEN o_orderkey % 13 = 0 THEN 'REJECTED' WHEN o_orderkey % 17 = 0 THEN 'DISPUTED' ELSE 'OPEN' END AS claim_status",
    f"({_SCORE}) * ({_SCORE}) AS fraud_score",
    f"{_CITY} AS incident_location",
    "CASE o_orderkey % 9 WHEN 0 THEN 'NI number AB123456C was given' WHEN 1 THEN 'NHS 943 476 5919 on file'"
    " WHEN 2 THEN 'licence MORGA657054SM9 shown' WHEN 3 THEN 'account 12-34-56-12345678'"
    " WHEN 4 THEN 'card 4111 1111 1111 1111' WHEN 5 THEN 'call 07123456789 ref 12345'"
    " WHEN 6 THEN 'parcel 17 lost' WHEN 7 THEN NULL ELSE '12' END AS incident_description",
    "CASE o_orderkey % 4 WHEN 0 THEN 'contact: 0' || lpad(cast(o_custkey AS STRING), 9, '1') || ', ref'"
    " WHEN 1 THEN 'mail ' || 'c.' || cast(o_custkey AS STRING) || '@example.com' WHEN 2 THEN '' ELSE '7' END AS claim_notes",
]

# Requests for erasure and export, one row per requesting customer.
REQUESTS = [
    "'CUST_' || lpad(cast(c_custkey AS STRING), 12, '0') AS customer_id",
    "'Customer request' AS reason",
]

EDGES = [
    "'CUST_' || lpad(cast(c_custkey AS STRING), 12, '0') AS src",
    "'CUST_' || lpad(cast(c_custkey - c_custkey % 10 AS STRING), 12, '0') AS dst",
]

SOURCES = {
    "bronze": ("orders", BRONZE, None),
    "event_lines": ("orders", EVENT_LINES, None),
    "policies": ("customer", POLICIES, None),
    "holders": ("customer", HOLDERS, None),
    "claims": ("orders", CLAIMS, None),
    "rule_attributes": ("orders", RULE_ATTRIBUTES, None),
    "audit_log": ("events", AUDIT_LOG, None),
    "metrics": ("events", METRICS, None),
    "layer_metrics": ("events", LAYER_METRICS, None),
    "usage": ("lineitem", USAGE, None),
    "personal": ("orders", PERSONAL, None),
    "requests": ("customer", REQUESTS, "c_custkey % 10 = 3"),
    "edges": ("customer", EDGES, None),
}


def source_sql(name: str) -> str:
    table, columns, where = SOURCES[name]
    return f"SELECT {', '.join(columns)} FROM {table}" + (f" WHERE {where}" if where else "")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table as SQL expressions give it (epoch seconds, no timestamps)."""
    table, columns, where = SOURCES[name]
    df = read(spark, sf_dir, table)
    if where:
        df = df.where(where)
    return df.selectExpr(*columns)


def stamped(df: DataFrame, **columns: str) -> DataFrame:
    """Turn epoch-second columns into UTC timestamps: ``stamped(df, claim_date="claim_s")``."""
    for name, seconds in columns.items():
        df = df.withColumn(name, F.timestamp_seconds(seconds))
    return df.drop(*columns.values())


def bronze_claims(spark, sf_dir):
    return stamped(derived(spark, sf_dir, "bronze"), claim_date="claim_s", incident_date="incident_s",
                   _ingestion_timestamp="ingestion_s", _silver_timestamp="silver_s")


def normal_claims(spark, sf_dir):
    return stamped(derived(spark, sf_dir, "claims"), incident_date="incident_s", reported_date="reported_s")


def policies(spark, sf_dir):
    return stamped(derived(spark, sf_dir, "policies"), start_date="start_s", end_date="end_s")


def holders(spark, sf_dir):
    return stamped(derived(spark, sf_dir, "holders"), date_of_birth="dob_s")


def rule_input(spark, sf_dir):
    claims = stamped(derived(spark, sf_dir, "rule_attributes"), claim_date="claim_s",
                     incident_date="incident_s", consent_date="consent_s")
    terms = policies(spark, sf_dir).select("policy_number", F.col("end_date").alias("policy_end_date"))
    return claims.join(terms, "policy_number", "left")


def audit_log(spark, sf_dir):
    return derived(spark, sf_dir, "audit_log").withColumn(
        "event_timestamp", F.col("event_timestamp").cast("timestamp"))


def metrics(spark, sf_dir, name="metrics"):
    return derived(spark, sf_dir, name).withColumn("ts", F.col("ts").cast("timestamp"))


def personal_claims(spark, sf_dir):
    return stamped(derived(spark, sf_dir, "personal"), submitted_at="claim_s")
