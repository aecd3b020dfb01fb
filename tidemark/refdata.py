"""Reference tables and constants.

Everything in this module is a *fixed value*: limits, lookup rows, patterns and word lists whose
content defines the results of the operators. They are small by construction (the largest has 24
rows), so joining them with a broadcast hint is always safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: UK bank holidays known to the silver layer --------------------------------
BANK_HOLIDAYS = [
    ("2024-01-01", "New Year's Day"),
    ("2024-03-29", "Good Friday"),
    ("2024-04-01", "Easter Monday"),
    ("2024-05-06", "Early May bank holiday"),
    ("2024-05-27", "Spring bank holiday"),
    ("2024-08-26", "Summer bank holiday"),
    ("2024-12-25", "Christmas Day"),
    ("2024-12-26", "Boxing Day"),
]

# --- fixed values: postcode area -> region ---------------------------------------------------
AREA_REGIONS = [
    ("E", "London"), ("EC", "London"), ("N", "London"), ("NW", "London"),
    ("SE", "London"), ("SW", "London"), ("W", "London"), ("WC", "London"),
    ("B", "Birmingham"), ("M", "Manchester"), ("L", "Liverpool"), ("G", "Glasgow"),
    ("EH", "Edinburgh"), ("CF", "Cardiff"), ("BT", "Belfast"),
]

# --- fixed values: postcode district -> fraud multiplier -------------------------------------
DISTRICT_MULTIPLIERS = [("B1", 2.5), ("M1", 2.3), ("L1", 2.8), ("E1", 2.1), ("SE1", 2.0)]

# --- fixed values: region by postcode prefix, first match wins (personal-data claims table) ----
PREFIX_REGIONS = [
    ("SW", "London"), ("E", "London"), ("M", "Manchester"),
    ("B", "Birmingham"), ("L", "Liverpool"), ("G", "Glasgow"),
]

# --- fixed values: validation limits by claim type (types not listed are unlimited) ------------
CLAIM_TYPE_LIMITS = {"motor": 100000, "home": 500000, "travel": 50000}

# --- fixed values: policy limits by product: (type, min, max, typical) -------------------------
POLICY_LIMITS = [
    ("motor", 100.0, 100000.0, 5000.0),
    ("home", 500.0, 500000.0, 15000.0),
    ("travel", 50.0, 50000.0, 2000.0),
    ("pet", 50.0, 10000.0, 1000.0),
    ("life", 1000.0, 1000000.0, 100000.0),
]

# --- fixed values: rule engine ---------------------------------------------------------------
STAGED_ACCIDENT_HOTSPOTS = ["B1", "B2", "B3", "M1", "M2", "M3", "L1", "L2", "L3"]
FLOOD_AREAS = ["YO", "HG", "CA", "GL", "SO", "BA", "TA"]
WEATHER_CLAIM_TYPES = ["storm_damage", "flood", "wind_damage", "weather"]
ENGINE_WEATHER_TYPES = ["storm_damage", "flood", "wind_damage"]
SYNDICATES = [("Hiscox", "33"), ("Beazley", "2623"), ("Catlin", "2003"), ("Amlin", "2001")]
ACTION_PRIORITY = [
    ("AUTO_REJECT", 1), ("FRAUD_INVESTIGATION", 2), ("ESCALATE", 3),
    ("MANUAL_REVIEW", 4), ("AUTO_APPROVE", 5), ("CONTINUE", 6),
]

# --- fixed values: entity enumerations ---------------------------------------------------------
POLICY_TYPES = [
    "motor", "property", "liability", "professional_indemnity",
    "cyber", "marine", "aviation", "directors_officers",
]
CLAIM_STATUSES = [
    "submitted", "under_review", "investigation", "approved",
    "rejected", "paid", "closed", "reopened",
]
CLAIM_TYPES = [
    "collision", "theft", "fire", "flood", "storm", "liability_injury",
    "liability_damage", "cyber_breach", "professional_error", "other",
]
RISK_PROFILES = ["low", "medium", "high", "very_high"]
ENTITY_POSTCODE = r"^[A-Z]{1,2}[0-9][A-Z0-9]? ?[0-9][A-Z]{2}$"

# --- fixed values: claim types a policy type may carry -----------------------------------------
ALLOWED_CLAIM_TYPES = {
    "motor": ["collision", "theft", "liability_injury", "liability_damage", "other"],
    "property": ["fire", "flood", "storm", "theft", "liability_damage", "other"],
    "liability": ["liability_injury", "liability_damage", "other"],
    "professional_indemnity": ["professional_error", "liability_damage", "other"],
    "cyber": ["cyber_breach", "liability_damage", "other"],
    "marine": ["collision", "storm", "theft", "other"],
    "aviation": ["collision", "liability_injury", "liability_damage", "other"],
    "directors_officers": ["professional_error", "liability_damage", "other"],
}

# --- fixed values: rating tables ---------------------------------------------------------------
# (policy type, premium min, premium max, insured multiple min, max, deductible share min, max)
RATING = [
    ("motor", 300.0, 5000.0, 50.0, 200.0, 0.01, 0.05),
    ("property", 200.0, 3000.0, 100.0, 500.0, 0.005, 0.02),
    ("liability", 500.0, 10000.0, 100.0, 1000.0, 0.01, 0.05),
    ("professional_indemnity", 1000.0, 50000.0, 50.0, 500.0, 0.02, 0.10),
    ("cyber", 2000.0, 100000.0, 100.0, 2000.0, 0.05, 0.15),
    ("marine", 5000.0, 500000.0, 50.0, 300.0, 0.01, 0.05),
    ("aviation", 10000.0, 1000000.0, 100.0, 500.0, 0.02, 0.10),
    ("directors_officers", 3000.0, 200000.0, 100.0, 1000.0, 0.05, 0.15),
]
# (claim type, claimed share of sum insured min, max)
SEVERITY_BANDS = [
    ("collision", 0.1, 0.8), ("theft", 0.2, 1.0), ("fire", 0.3, 1.0), ("flood", 0.2, 0.9),
    ("storm", 0.1, 0.7), ("liability_injury", 0.05, 0.5), ("liability_damage", 0.1, 0.6),
    ("cyber_breach", 0.2, 0.9), ("professional_error", 0.1, 0.8), ("other", 0.05, 0.4),
]
DEFAULT_SEVERITY_BAND = (0.1, 0.5)

# --- fixed values: fraud detector --------------------------------------------------------------
SUSPICIOUS_PHRASES = [
    "total loss", "complete damage", "everything destroyed",
    "no witnesses", "cannot remember", "stolen", "disappeared",
    "no evidence", "all items",
]
HIGH_RISK_AREAS = ["E", "SE", "EC", "WC", "B", "M", "L"]

# --- fixed values: postcode parsing ------------------------------------------------------------
POSTCODE_PARTS = r"^([A-Z]{1,2})(\d{1,2}[A-Z]?)\s?(\d)([A-Z]{2})$"

# --- fixed values: postcode area profiles ------------------------------------------------------
PROFILE_COLUMNS = (
    "area STRING, region STRING, risk_zone STRING, base_risk_score DOUBLE, crime_rate DOUBLE, "
    "flood_risk DOUBLE, average_income DOUBLE, population_density DOUBLE, "
    "motor_theft_rate DOUBLE, burglary_rate DOUBLE, latitude DOUBLE, longitude DOUBLE, "
    "major_city STRING"
)
AREA_PROFILES = [
    ("E", "East London", "high", 0.7, 95, 0.4, 35000, 5500, 12, 8, 51.5423, 0.0098, "London"),
    ("EC", "City of London", "very_high", 0.8, 110, 0.3, 75000, 3000, 8, 5, 51.5155, -0.0922, "London"),
    ("N", "North London", "medium", 0.6, 85, 0.2, 45000, 7000, 10, 7, 51.5654, -0.1062, "London"),
    ("NW", "North West London", "medium", 0.6, 80, 0.2, 48000, 6500, 9, 6, 51.5496, -0.1997, "London"),
    ("SE", "South East London", "high", 0.65, 90, 0.35, 38000, 5000, 11, 8, 51.4759, 0.0585, "London"),
    ("SW", "South West London", "low", 0.4, 55, 0.25, 65000, 4500, 5, 4, 51.4333, -0.1885, "London"),
    ("W", "West London", "medium", 0.5, 70, 0.2, 55000, 8000, 7, 5, 51.5136, -0.2209, "London"),
    ("WC", "Central London", "high", 0.7, 100, 0.2, 60000, 10000, 6, 5, 51.5185, -0.1188, "London"),
    ("B", "Birmingham", "medium", 0.55, 75, 0.15, 32000, 4200, 9, 7, 52.4862, -1.8904, "Birmingham"),
    ("M", "Manchester", "medium", 0.6, 80, 0.25, 34000, 4000, 10, 7, 53.4808, -2.2426, "Manchester"),
    ("L", "Liverpool", "medium", 0.6, 78, 0.3, 30000, 3500, 11, 8, 53.4084, -2.9916, "Liverpool"),
    ("G", "Glasgow", "medium", 0.5, 70, 0.2, 32000, 3400, 8, 6, 55.8642, -4.2518, "Glasgow"),
    ("EH", "Edinburgh", "low", 0.4, 50, 0.15, 42000, 1900, 4, 3, 55.9533, -3.1883, "Edinburgh"),
    ("CF", "Cardiff", "medium", 0.5, 65, 0.35, 33000, 2500, 7, 5, 51.4816, -3.1791, "Cardiff"),
    ("BS", "Bristol", "medium", 0.45, 60, 0.3, 38000, 3800, 6, 5, 51.4545, -2.5879, "Bristol"),
    ("OX", "Oxford", "low", 0.3, 45, 0.25, 45000, 2200, 3, 3, 51.7520, -1.2577, "Oxford"),
    ("CB", "Cambridge", "low", 0.3, 40, 0.2, 48000, 2000, 3, 2, 52.2053, 0.1218, "Cambridge"),
    ("BA", "Bath", "very_low", 0.25, 35, 0.2, 50000, 1800, 2, 2, 51.3758, -2.3599, "Bath"),
    ("YO", "York", "low", 0.35, 48, 0.4, 36000, 1500, 4, 3, 53.9591, -1.0815, "York"),
    ("RG", "Reading", "low", 0.35, 50, 0.3, 52000, 2800, 4, 3, 51.4543, -0.9781, "Reading"),
    ("GU", "Guildford", "very_low", 0.25, 30, 0.15, 58000, 1600, 2, 2, 51.2365, -0.5703, "Guildford"),
    ("BN", "Brighton", "medium", 0.45, 62, 0.25, 35000, 3200, 6, 5, 50.8225, -0.1372, "Brighton"),
    ("SO", "Southampton", "medium", 0.45, 58, 0.35, 34000, 2800, 6, 4, 50.9097, -1.4044, "Southampton"),
    ("PO", "Portsmouth", "medium", 0.5, 65, 0.4, 32000, 3100, 7, 5, 50.8198, -1.0880, "Portsmouth"),
]
DEFAULT_RISK = 0.5

# --- fixed values: underwriting risk by postcode area (areas not listed take the default) -------
UNDERWRITING_RISK = [
    ("E", 0.7), ("SE", 0.6), ("SW", 0.4), ("W", 0.5), ("NW", 0.6), ("N", 0.6), ("EC", 0.8),
    ("WC", 0.7), ("B", 0.5), ("M", 0.6), ("L", 0.6), ("G", 0.5), ("EH", 0.4), ("OX", 0.3),
    ("CB", 0.3), ("BA", 0.3), ("YO", 0.4), ("RG", 0.3), ("GU", 0.3),
]

# --- fixed values: personal-data patterns (type, pattern, sensitivity, category), scan order ----
PII_PATTERNS = [
    ("ni_number", r"\b[A-Z]{2}\d{6}[A-Z]\b", "HIGH", "Government_ID"),
    ("nhs_number", r"\b\d{3}\s?\d{3}\s?\d{4}\b", "HIGH", "Healthcare_ID"),
    ("driving_license", r"\b[A-Z]{2,5}\d{6}[A-Z0-9]{3}\b", "HIGH", "Government_ID"),
    ("email", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "MEDIUM", "Contact_Info"),
    ("uk_phone", r"\b(?:0[1-9]\d{8,9}|\+44\s?\d{10}|07\d{9})\b", "MEDIUM", "Contact_Info"),
    ("bank_account", r"\b\d{2}-\d{2}-\d{2}-\d{8}\b", "HIGH", "Financial"),
    ("credit_card", r"\b(?:\d{4}[\s-]?){3}\d{4}\b", "HIGH", "Financial"),
    ("postcode", r"\b[A-Z]{1,2}\d{1,2}[A-Z]?\s?\d[A-Z]{2}\b", "LOW", "Location"),
    ("person_name", r"\b[A-Z][a-z]+\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+)?\b", "MEDIUM", "Personal"),
]
SENSITIVITY_RISK = {"NONE": 0.0, "LOW": 0.2, "MEDIUM": 0.5, "HIGH": 1.0}

# --- fixed values: masking ---------------------------------------------------------------------
MASK_POSTCODE = r"\b[A-Z]{1,2}\d{1,2}[A-Z]?\s?\d[A-Z]{2}\b"
MASK_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}"
MASK_DIGITS = r"\b\d{3,}\b"
ID_SALT = "gdpr_salt_2024"
MASKING_REASONS = {
    "HIGH": "GDPR Article 9 - Special Category Data",
    "MEDIUM": "GDPR Article 6 - Personal Data",
    "LOW": "GDPR - Minimal Risk Data",
}
# (policy, action at HIGH, MEDIUM, LOW, NONE)
MASKING_POLICIES = [
    ("email_policy", "FULL_MASK", "PARTIAL_MASK", "NO_MASK", "NO_MASK"),
    ("phone_policy", "FULL_MASK", "PARTIAL_MASK", "NO_MASK", "NO_MASK"),
    ("name_policy", "INITIALS_ONLY", "PARTIAL_MASK", "NO_MASK", "NO_MASK"),
    ("id_policy", "HASH", "NO_MASK", "NO_MASK", "NO_MASK"),
]

# --- fixed values: audit -----------------------------------------------------------------------
GDPR_ARTICLES = [
    ("READ", "Article 15 - Right of Access"),
    ("UPDATE", "Article 16 - Right to Rectification"),
    ("DELETE", "Article 17 - Right to Erasure"),
    ("EXPORT", "Article 20 - Right to Data Portability"),
    ("MASK", "Article 25 - Data Protection by Design"),
    ("CONSENT", "Article 7 - Consent"),
    ("BREACH", "Article 33 - Breach Notification"),
]
DEFAULT_ARTICLE = "Article 5 - Principles"
AUDIT_RETENTION_DAYS = [
    ("DATA_ACCESS", 730), ("DATA_MODIFICATION", 2555), ("DATA_DELETION", 3650),
    ("CONSENT_CHANGE", 2555), ("SECURITY_EVENT", 3650), ("SAR_REQUEST", 1095),
]
DEFAULT_AUDIT_RETENTION = 730

# --- fixed values: retention (category, policy type, days, description) --------------------------
RETENTION_POLICIES = [
    ("claims", "standard", 2555, "Insurance claims retention per FCA requirements"),
    ("claims", "fraud", 3650, "Insurance claims retention per FCA requirements"),
    ("claims", "declined", 1095, "Insurance claims retention per FCA requirements"),
    ("audit_logs", "standard", 3650, "Audit log retention for regulatory compliance"),
    ("audit_logs", "access", 730, "Audit log retention for regulatory compliance"),
    ("audit_logs", "deletion", 3650, "Audit log retention for regulatory compliance"),
    ("customer_data", "active", 364635, "Customer PII retention based on consent"),
    ("customer_data", "inactive", 2555, "Customer PII retention based on consent"),
    ("customer_data", "marketing", 730, "Customer PII retention based on consent"),
    ("operational", "logs", 90, "Operational data with short retention"),
    ("operational", "temp", 30, "Operational data with short retention"),
    ("operational", "cache", 7, "Operational data with short retention"),
]

# --- fixed values: KPI targets -----------------------------------------------------------------
KPI_TARGETS = [
    ("avg_processing_time_ms", 200.0), ("auto_approval_rate", 0.75),
    ("fraud_detection_rate", 0.035), ("data_quality_score", 0.9), ("claims_per_hour", 100.0),
]

# --- fixed values: service levels (metric, target, comparison, window minutes, severity) ---------
SLA_TARGETS = [
    ("processing_latency_ms", 200.0, "less_than", 5, "ERROR"),
    ("processing_latency_p95_ms", 500.0, "less_than", 5, "WARNING"),
    ("error_rate", 0.01, "less_than", 5, "ERROR"),
    ("throughput_per_second", 100.0, "greater_than", 5, "WARNING"),
    ("auto_approval_rate", 0.75, "greater_than", 15, "INFO"),
    ("fraud_detection_rate", 0.035, "equal", 30, "INFO"),
    ("data_quality_score", 0.9, "greater_than", 10, "WARNING"),
]

# --- fixed values: layer health (layer, check, metric, statistic, healthy when, bound, otherwise) -
HEALTH_CHECKS = [
    ("bronze", "ingestion_rate", "bronze_ingestion_rate", "avg", "above", 10.0, "degraded"),
    ("bronze", "data_quality", "bronze_data_quality", "avg", "above", 0.8, "unhealthy"),
    ("bronze", "dead_letter_queue", "bronze_dlq_count", "sum", "below", 100.0, "warning"),
    ("silver", "processing_latency", "silver_processing_latency", "avg", "below", 200.0, "degraded"),
    ("silver", "validation_rate", "silver_validation_rate", "avg", "above", 0.95, "warning"),
    ("silver", "enrichment_success", "silver_enrichment_success", "avg", "above", 0.98, "degraded"),
    ("gold", "aggregation_lag", "gold_aggregation_lag", "avg", "below", 60.0, "warning"),
    ("gold", "kpi_calculation", "gold_kpi_calculation_time", "avg", "below", 30.0, "degraded"),
]
KEY_METRICS = [
    ("throughput", "throughput_per_second", 5), ("latency", "processing_latency_ms", 5),
    ("error_rate", "error_rate", 5), ("fraud_detection", "fraud_detection_rate", 15),
    ("auto_approval", "auto_approval_rate", 15),
]
# (metric, window minutes, statistic, fires when, bound, advice)
COST_ADVICE = [
    ("throughput_per_second", 60, "avg", "below", 50.0,
     "Consider reducing Event Hub throughput units - current usage is below 50 events/sec"),
    ("processing_latency_ms", 60, "avg", "above", 500.0,
     "High processing latency detected - consider optimizing transformations or increasing compute"),
    ("partition_skew", 30, "max", "above", 2.0,
     "Data skew detected - consider repartitioning strategy for better load distribution"),
    ("storage_gb_used", 60, "latest", "above", 1000.0,
     "High storage usage - review data retention policies and archival strategy"),
]
COST_RATES = {"event_hub": 0.000001, "compute": 0.5, "storage": 0.02, "network": 0.01}


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def inline_table(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A constant table as an inline VALUES relation.

    The optimizer knows its exact size and rows, so it needs no job to build and is folded into
    the plan of whoever joins it. ``columns`` is a DDL list such as ``"area STRING, risk DOUBLE"``.
    """
    fields = [c.strip().rsplit(" ", 1) for c in columns.split(",")]
    names = ", ".join(f"`{name}`" for name, _ in fields)
    casts = ", ".join(f"CAST(`{name}` AS {kind}) AS `{name}`" for name, kind in fields)
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})")

# --- fixed values: texts of masked, audited and erased data -------------------------------------
REDACTED_TEXT = "[REDACTED - Contains sensitive PII]"
NO_MASKING = "No masking required"
AUDIT_ACCESS = "AUDIT_ACCESS"
ERASED_VALUES = {
    "customer_name": "ANONYMIZED", "customer_email": "deleted@anonymous.com", "customer_phone": "0000000000",
    "customer_address": "DELETED", "incident_description": "[REDACTED]", "claim_notes": "[REDACTED]",
}
