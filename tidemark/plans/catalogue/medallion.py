"""Registered queries of the bronze rules, silver and gold layers, with their checking SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import refdata
from tidemark.functions import distincts
from tidemark.operators import anomaly, bronze, gold, silver
from tidemark.operators import customers as x
from tidemark.plans.catalogue.common import register, src, ts, values_sql
from tidemark.plans.claims import anomaly_frame, as_of, scored_bronze, silver_frame, stored_silver
from tidemark.plans import inputs
from tidemark.session import cut

AS_OF = f"TIMESTAMP '{inputs.CLAIMS_AS_OF}'"

BRONZE_CTE = f"""bronze0 AS (SELECT *, {ts('claim_s')} AS claim_date, {ts('incident_s')} AS incident_date,
  {ts('ingestion_s')} AS ingested, {ts('silver_s')} AS silvered FROM ({src('bronze')})),
bronze AS (SELECT *, claim_id IS NOT NULL AS f1, policy_number IS NOT NULL AS f2, customer_id IS NOT NULL AS f3,
  claim_amount IS NOT NULL AS f4, coalesce(claim_amount > 0, false) AS f5, coalesce(claim_amount < 1000000, false) AS f6,
  coalesce(claim_date >= incident_date, false) AS f7,
  coalesce(regexp_matches(incident_postcode, '^[A-Z]{{1,2}}[0-9]'), false) AS f8 FROM bronze0),
scored AS (SELECT *, (f1::INT + f2::INT + f3::INT + f4::INT + f5::INT + f6::INT + f7::INT + f8::INT) / 8e0 AS dq_score
  FROM bronze)"""

SILVER_CTE = BRONZE_CTE + f""",
s1 AS (SELECT *, regexp_extract(incident_postcode, '^([A-Z]{{1,2}}[0-9]{{1,2}})', 1) AS postcode_district,
  regexp_extract(incident_postcode, '^([A-Z]{{1,2}})', 1) AS postcode_area,
  date_diff('day', incident_date, claim_date) AS days_to_claim, dayofweek(claim_date) IN (0, 6) AS is_weekend_claim,
  hour(claim_date) AS claim_hour, claim_amount AS claim_amount_gbp,
  CASE WHEN claim_amount < 1000 THEN 'small' WHEN claim_amount < 10000 THEN 'medium'
    WHEN claim_amount < 50000 THEN 'large' ELSE 'exceptional' END AS claim_amount_category
  FROM scored WHERE dq_score > 0.5),
s2 AS (SELECT s1.*, claim_hour BETWEEN 9 AND 17 AND NOT is_weekend_claim AS is_business_hours, r.region,
  h.d IS NOT NULL AS is_bank_holiday, coalesce(m.mult, 1e0) AS postcode_fraud_risk
  FROM s1 LEFT JOIN {values_sql(refdata.AREA_REGIONS)} AS r(area, region) ON s1.postcode_area = r.area
  LEFT JOIN {values_sql(refdata.BANK_HOLIDAYS)} AS h(d, n) ON CAST(s1.claim_date AS DATE) = CAST(h.d AS DATE)
  LEFT JOIN {values_sql(refdata.DISTRICT_MULTIPLIERS)} AS m(district, mult) ON s1.postcode_district = m.district),
s3 AS (SELECT *, list_filter([CASE WHEN days_to_claim < 30 THEN 'QUICK_CLAIM' END,
  CASE WHEN claim_amount > 50000 THEN 'HIGH_VALUE' END,
  CASE WHEN is_weekend_claim OR is_bank_holiday THEN 'SUSPICIOUS_TIMING' END,
  CASE WHEN claim_hour IN (0, 1, 2, 3, 4, 5, 23) THEN 'ODD_HOURS' END,
  CASE WHEN postcode_fraud_risk > 2 THEN 'HIGH_RISK_LOCATION' END,
  CASE WHEN claim_type = 'motor' AND claim_amount BETWEEN 3000 AND 6000 THEN 'WHIPLASH_PATTERN' END,
  CASE WHEN claim_type = 'home' AND days_to_claim < 2 THEN 'STORM_CHASER' END], lambda v: v IS NOT NULL)
  AS fraud_indicators FROM s2),
s4 AS (SELECT *, least(fraud_score * postcode_fraud_risk * (1 + len(fraud_indicators) * 1e-1), 1e0)
  AS adjusted_fraud_score FROM s3),
s5 AS (SELECT *, adjusted_fraud_score > 7e-1 AS is_high_risk,
  adjusted_fraud_score > 5e-1 OR claim_amount > 25000 OR len(fraud_indicators) > 3 AS requires_manual_review,
  (coalesce(CASE claim_type WHEN 'motor' THEN claim_amount <= 100000 WHEN 'home' THEN claim_amount <= 500000
     WHEN 'travel' THEN claim_amount <= 50000 ELSE true END, false)::INT
   + coalesce(days_to_claim >= 0, false)::INT + (policy_number IS NOT NULL)::INT + (customer_id IS NOT NULL)::INT
   + coalesce(regexp_matches(incident_postcode, '^[A-Z]{{1,2}}[0-9]{{1,2}}[A-Z]?\\s?[0-9][A-Z]{{2}}$'), false)::INT) / 5e0
  AS validation_score FROM s4),
silver AS (SELECT *, CASE WHEN validation_score < 6e-1 THEN 'REJECTED' WHEN requires_manual_review THEN 'MANUAL_REVIEW'
  WHEN is_high_risk THEN 'FRAUD_INVESTIGATION' ELSE 'AUTO_APPROVED' END AS processing_status,
  dq_score AS data_quality_score, silvered AS silver_ts, (silver_s - ingestion_s) * 1000 AS processing_ms FROM s5)"""


def gold_sql(body: str) -> str:
    return f"WITH {SILVER_CTE} {body}"


def on_silver(key, shape, operator, body):
    """A query that applies one operator to the silver frame."""
    register(key, shape, lambda spark, d: operator(silver_frame(spark, d)), gold_sql(body))


def on_bronze(key, shape, operator, body):
    register(key, shape, lambda spark, d: operator(scored_bronze(spark, d)), gold_sql(body))


# ---------------------------------------------------------------------------------- bronze rules
_FLAGS = ["has_claim_id", "has_policy_number", "has_customer_id", "has_amount", "positive_amount",
          "reasonable_amount", "valid_dates", "valid_uk_postcode"]
on_bronze("dq_checks", "claim_id:s " + " ".join(f"{f}:b" for f in _FLAGS),
          lambda df: bronze.dq_checks(df).select("claim_id", "dq_checks.*"),
          "SELECT claim_id, " + ", ".join(f"f{i + 1} AS {f}" for i, f in enumerate(_FLAGS)) + " FROM bronze")
on_bronze("dq_score", "claim_id:s dq_score:d", lambda df: df, "SELECT claim_id, dq_score FROM scored")
on_bronze("bronze_monitoring",
          "ingestion_date:D ingestion_hour:i claim_type:s claim_count:i avg_claim_amount:d max_claim_amount:d "
          "avg_fraud_score:d high_fraud_count:i avg_quality_score:d unique_customers:i",
          lambda df: bronze.bronze_monitoring(df, as_of("2024-06-01 00:00:00")),
          """SELECT CAST(ingested AS DATE) AS ingestion_date, hour(ingested) AS ingestion_hour, claim_type,
          count(*) AS claim_count, avg(claim_amount) AS avg_claim_amount, max(claim_amount) AS max_claim_amount,
          avg(fraud_score) AS avg_fraud_score, count(*) FILTER (fraud_score > 7e-1) AS high_fraud_count,
          avg(dq_score) AS avg_quality_score, count(DISTINCT customer_id) AS unique_customers FROM scored
          WHERE ingested >= TIMESTAMP '2024-05-31 00:00:00' GROUP BY ALL""")

# ---------------------------------------------------------------------------------- silver steps
on_bronze("quality_gate", "claim_id:s dq_score:d", silver.quality_gate, "SELECT claim_id, dq_score FROM s1")
on_bronze("postcode_parts", "claim_id:s postcode_district:s postcode_area:s",
          lambda df: df.transform(silver.quality_gate).transform(silver.postcode_parts),
          "SELECT claim_id, postcode_district, postcode_area FROM s1")
_derived = lambda df: df.transform(silver.quality_gate).transform(silver.postcode_parts).transform(silver.claim_derivations)
on_bronze("claim_derivations",
          "claim_id:s claim_amount_gbp:d days_to_claim:i claim_amount_category:s is_weekend_claim:b claim_hour:i is_business_hours:b",
          _derived, """SELECT claim_id, claim_amount_gbp, days_to_claim, claim_amount_category, is_weekend_claim,
          claim_hour, is_business_hours FROM s2""")
on_bronze("enrich_region", "claim_id:s region:s", lambda df: _derived(df).transform(silver.enrich_region),
          "SELECT claim_id, region FROM s2")
on_bronze("enrich_bank_holiday", "claim_id:s is_bank_holiday:b",
          lambda df: _derived(df).transform(silver.enrich_bank_holiday), "SELECT claim_id, is_bank_holiday FROM s2")
on_bronze("enrich_postcode_risk", "claim_id:s postcode_fraud_risk:d",
          lambda df: _derived(df).transform(silver.enrich_postcode_risk), "SELECT claim_id, postcode_fraud_risk FROM s2")
_enriched = lambda df: (_derived(df).transform(silver.enrich_region).transform(silver.enrich_bank_holiday)
                        .transform(silver.enrich_postcode_risk))
_indicated = lambda df: _enriched(df).transform(silver.fraud_indicators)
on_bronze("fraud_indicators", "claim_id:s fraud_indicators:a", _indicated, "SELECT claim_id, fraud_indicators FROM s3")
on_bronze("adjusted_fraud_score", "claim_id:s adjusted_fraud_score:d",
          lambda df: _indicated(df).transform(silver.adjusted_fraud_score), "SELECT claim_id, adjusted_fraud_score FROM s4")
on_bronze("review_flags", "claim_id:s is_high_risk:b requires_manual_review:b",
          lambda df: _indicated(df).transform(silver.adjusted_fraud_score).transform(silver.review_flags),
          "SELECT claim_id, is_high_risk, requires_manual_review FROM s5")
on_bronze("validate_business_rules", "claim_id:s validation_score:d",
          lambda df: _derived(df).transform(silver.validate_business_rules), "SELECT claim_id, validation_score FROM s5")
on_silver("processing_status", "claim_id:s processing_status:s", lambda df: df, "SELECT claim_id, processing_status FROM silver")
on_bronze("silver_pii_columns",
          "claim_id:s customer_id_hash:s gdpr_consent:b gdpr_consent_date:D data_retention_date:D",
          lambda df: silver.silver_pii_columns(silver.quality_gate(df), as_of()),
          f"""SELECT claim_id, sha256(customer_id) AS customer_id_hash, true AS gdpr_consent,
          CAST({AS_OF} AS DATE) AS gdpr_consent_date, CAST({AS_OF} AS DATE) + 2555 AS data_retention_date FROM s1""")
on_silver("silver_output",
          "claim_id:s policy_number:s customer_id:s claim_amount:d claim_amount_gbp:d claim_date:t incident_date:t "
          "incident_location:s incident_postcode:s postcode_district:s postcode_area:s region:s claim_type:s "
          "claim_status:s fraud_score:d adjusted_fraud_score:d fraud_indicators:a is_high_risk:b "
          "requires_manual_review:b days_to_claim:i claim_amount_category:s is_weekend_claim:b is_bank_holiday:b "
          "is_business_hours:b processing_status:s validation_score:d data_quality_score:d silver_timestamp:t "
          "processing_time_ms:i",
          lambda df: df.withColumnsRenamed({"_silver_timestamp": "silver_timestamp", "_processing_time_ms": "processing_time_ms"}),
          "SELECT *, silver_ts AS silver_timestamp, processing_ms AS processing_time_ms FROM silver")
on_bronze("silver_lite",
          "claim_id:s postcode_district:s days_to_claim:i is_high_risk:b requires_manual_review:b processing_status:s "
          "fraud_indicators:a data_quality_score:d",
          lambda df: silver.silver_lite(df, F.col("_silver_timestamp")),
          """SELECT claim_id, regexp_extract(incident_postcode, '^([A-Z]{1,2}[0-9]{1,2})', 1) AS postcode_district,
          date_diff('day', incident_date, claim_date) AS days_to_claim, fraud_score > 7e-1 AS is_high_risk,
          fraud_score > 5e-1 OR claim_amount > 10000 AS requires_manual_review,
          CASE WHEN fraud_score > 7e-1 THEN 'FRAUD_INVESTIGATION' WHEN claim_amount > 25000 THEN 'MANUAL_REVIEW'
            ELSE 'AUTO_APPROVED' END AS processing_status,
          list_filter([CASE WHEN date_diff('day', incident_date, claim_date) < 30 THEN 'QUICK_CLAIM' END,
            CASE WHEN claim_amount > 50000 THEN 'HIGH_VALUE' END], lambda v: v IS NOT NULL) AS fraud_indicators,
          95e-2 AS data_quality_score FROM scored""")
on_silver("silver_monitoring",
          "processing_date:D processing_hour:i processing_status:s claim_type:s claim_count:i avg_amount:d max_amount:d "
          "avg_fraud_score:d high_risk_count:i manual_review_count:i avg_processing_time_ms:d p95_processing_time_ms:i",
          lambda df: silver.silver_monitoring(df, as_of("2024-06-01 00:00:00")),
          """SELECT CAST(silver_ts AS DATE) AS processing_date, hour(silver_ts) AS processing_hour, processing_status,
          claim_type, count(*) AS claim_count, avg(claim_amount_gbp) AS avg_amount, max(claim_amount_gbp) AS max_amount,
          avg(adjusted_fraud_score) AS avg_fraud_score, count(*) FILTER (is_high_risk) AS high_risk_count,
          count(*) FILTER (requires_manual_review) AS manual_review_count, avg(processing_ms) AS avg_processing_time_ms,
          quantile_disc(processing_ms, 0.95) AS p95_processing_time_ms FROM silver
          WHERE silver_ts >= TIMESTAMP '2024-05-31 00:00:00' GROUP BY ALL""")
on_silver("status_summary", "processing_status:s claim_count:i avg_amount:d avg_fraud_score:d", silver.status_summary,
          """SELECT processing_status, count(*) AS claim_count, avg(claim_amount_gbp) AS avg_amount,
          avg(adjusted_fraud_score) AS avg_fraud_score FROM silver GROUP BY ALL""")
on_silver("fraud_pattern_analysis",
          "fraud_indicator:s occurrence_count:i avg_claim_amount:d avg_fraud_score:d affected_postcodes:a",
          lambda df: silver.fraud_pattern_analysis(df, as_of("2024-12-01 00:00:00")),
          """SELECT fraud_indicator, count(*) AS occurrence_count, avg(claim_amount_gbp) AS avg_claim_amount,
          avg(adjusted_fraud_score) AS avg_fraud_score,
          list_sort(list(DISTINCT postcode_district) FILTER (postcode_district IS NOT NULL)) AS affected_postcodes
          FROM (SELECT *, unnest(fraud_indicators) AS fraud_indicator FROM silver
                WHERE silver_ts >= TIMESTAMP '2024-11-24 00:00:00') GROUP BY fraud_indicator""")
on_silver("high_risk_alerts",
          "claim_id:s claim_date:t customer_id:s claim_amount_gbp:d adjusted_fraud_score:d fraud_indicators:a processing_status:s",
          silver.high_risk_alerts,
          "SELECT * FROM silver WHERE is_high_risk OR claim_amount_gbp > 50000 OR len(fraud_indicators) > 4")

PERSONAL_CTE = f"""personal AS (SELECT *, {ts('claim_s')} AS submitted_at FROM ({src('personal')})),
derived AS (SELECT *, CASE WHEN postcode LIKE 'SW%' THEN 'London' WHEN postcode LIKE 'E%' THEN 'London'
  WHEN postcode LIKE 'M%' THEN 'Manchester' WHEN postcode LIKE 'B%' THEN 'Birmingham' WHEN postcode LIKE 'L%' THEN 'Liverpool'
  WHEN postcode LIKE 'G%' THEN 'Glasgow' ELSE 'Other' END AS uk_region, claim_amount > 10000 AS high_value_claim,
  hour(submitted_at) BETWEEN 0 AND 6 AS suspicious_timing, fraud_score > 7e-1 AS is_suspicious,
  CASE WHEN fraud_score > 8e-1 THEN 'HIGH' WHEN fraud_score > 5e-1 THEN 'MEDIUM' WHEN fraud_score > 3e-1 THEN 'LOW'
    ELSE 'NONE' END AS risk_level FROM personal)"""


def personal_derived(spark, d):
    return silver.pii_silver_derive(inputs.personal_claims(spark, d), "submitted_at")


register("pii_silver_derive",
         "claim_id:s uk_region:s high_value_claim:b suspicious_timing:b is_suspicious:b risk_level:s",
         personal_derived, f"WITH {PERSONAL_CTE} SELECT * FROM derived")
register("pii_silver_totals",
         "total_claims:i unique_customers:i avg_claim_amount:d suspicious_claims:i high_value_claims:i",
         lambda s, d: silver.pii_silver_totals(personal_derived(s, d)),
         f"""WITH {PERSONAL_CTE} SELECT count(*) AS total_claims, count(DISTINCT customer_id) AS unique_customers,
         avg(claim_amount) AS avg_claim_amount, count(*) FILTER (is_suspicious) AS suspicious_claims,
         count(*) FILTER (high_value_claim) AS high_value_claims FROM derived""")
register("pii_silver_checks", "uk_region:s claim_type:s risk_level:s claim_count:i",
         lambda s, d: silver.pii_silver_checks(personal_derived(s, d)),
         f"""WITH {PERSONAL_CTE} SELECT uk_region, claim_type, risk_level, count(*) AS claim_count FROM derived
         GROUP BY ALL ORDER BY claim_count DESC, uk_region, claim_type, risk_level LIMIT 20""")

# ---------------------------------------------------------------------------------- gold
_DAILY_SQL = """SELECT CAST(claim_date AS DATE) AS summary_date, claim_type, count(*) AS total_claims,
  sum(claim_amount_gbp) AS total_amount, avg(claim_amount_gbp) AS average_amount,
  quantile_disc(claim_amount_gbp, 0.5) AS median_amount, min(claim_amount_gbp) AS min_amount,
  max(claim_amount_gbp) AS max_amount, stddev(claim_amount_gbp) AS stddev_amount,
  count(*) FILTER (is_high_risk) AS fraud_detected_count,
  coalesce(sum(claim_amount_gbp) FILTER (is_high_risk), 0) AS fraud_detected_amount,
  avg(adjusted_fraud_score) AS avg_fraud_score, count(*) FILTER (requires_manual_review) AS manual_review_count,
  count(*) FILTER (processing_status = 'AUTO_APPROVED') AS auto_approved_count,
  count(*) FILTER (processing_status = 'REJECTED') AS rejected_count, avg(processing_ms) AS processing_time_avg_ms,
  quantile_disc(processing_ms, 0.95) AS processing_time_p95_ms,
  quantile_disc(processing_ms, 0.99) AS processing_time_p99_ms, avg(data_quality_score) AS avg_data_quality,
  avg(validation_score) AS avg_validation_score,
  count(*) FILTER (is_high_risk) / count(*) AS fraud_rate,
  count(*) FILTER (processing_status = 'AUTO_APPROVED') / count(*) AS auto_approval_rate FROM silver GROUP BY ALL"""
on_silver("daily_claims_summary",
          "summary_date:D claim_type:s total_claims:i total_amount:m average_amount:d median_amount:d min_amount:d "
          "max_amount:d stddev_amount:d fraud_detected_count:i fraud_detected_amount:m avg_fraud_score:d "
          "manual_review_count:i auto_approved_count:i rejected_count:i processing_time_avg_ms:d "
          "processing_time_p95_ms:i processing_time_p99_ms:i avg_data_quality:d avg_validation_score:d fraud_rate:d "
          "auto_approval_rate:d", gold.daily_claims_summary, _DAILY_SQL)
on_silver("fraud_metrics",
          "metric_date:D metric_hour:i total_claims_evaluated:i fraud_alerts_generated:i high_risk_flagged:i "
          "sent_to_investigation:i avg_original_fraud_score:d avg_adjusted_fraud_score:d max_fraud_score:d "
          "p90_fraud_score:d total_fraud_prevented_gbp:m avg_fraud_amount_gbp:d top_fraud_patterns:a "
          "high_risk_postcodes:a avg_detection_time_ms:d fraud_detection_rate:d alert_to_investigation_rate:d",
          gold.fraud_metrics,
          """SELECT *, high_risk_flagged / total_claims_evaluated AS fraud_detection_rate,
          CASE WHEN fraud_alerts_generated > 0 THEN sent_to_investigation / fraud_alerts_generated ELSE 0 END
            AS alert_to_investigation_rate FROM (
          SELECT CAST(claim_date AS DATE) AS metric_date, hour(claim_date) AS metric_hour, count(*) AS total_claims_evaluated,
          count(*) FILTER (adjusted_fraud_score > 5e-1) AS fraud_alerts_generated,
          count(*) FILTER (is_high_risk) AS high_risk_flagged,
          count(*) FILTER (processing_status = 'FRAUD_INVESTIGATION') AS sent_to_investigation,
          avg(fraud_score) AS avg_original_fraud_score, avg(adjusted_fraud_score) AS avg_adjusted_fraud_score,
          max(adjusted_fraud_score) AS max_fraud_score, quantile_disc(adjusted_fraud_score, 0.9) AS p90_fraud_score,
          coalesce(sum(claim_amount_gbp) FILTER (is_high_risk), 0) AS total_fraud_prevented_gbp,
          avg(claim_amount_gbp) FILTER (is_high_risk) AS avg_fraud_amount_gbp,
          coalesce(list_sort(list(DISTINCT fraud_indicators[1]) FILTER (fraud_indicators[1] IS NOT NULL)), []) AS top_fraud_patterns,
          coalesce(list_sort(list(DISTINCT postcode_district) FILTER (is_high_risk AND postcode_district IS NOT NULL)), [])
            AS high_risk_postcodes,
          avg(processing_ms) FILTER (is_high_risk) AS avg_detection_time_ms FROM silver GROUP BY ALL)""")
_WIDE_SQL = """SELECT CAST(claim_date AS DATE) AS kpi_date, avg(processing_ms) AS avg_processing_time_ms,
  quantile_disc(processing_ms, 0.95) AS p95_processing_time_ms,
  count(*) FILTER (processing_status = 'AUTO_APPROVED') / count(*) AS auto_approval_rate,
  count(*) FILTER (requires_manual_review) / count(*) AS manual_review_rate,
  count(*) FILTER (is_high_risk) / count(*) AS fraud_detection_rate, avg(adjusted_fraud_score) AS avg_fraud_confidence,
  avg(data_quality_score) AS data_quality_score, avg(validation_score) AS validation_score,
  count(*) AS total_claims_processed, count(*) / 24e0 AS claims_per_hour, sum(claim_amount_gbp) AS total_claim_value,
  avg(claim_amount_gbp) AS avg_claim_value FROM silver GROUP BY ALL"""
on_silver("operational_kpis_wide",
          "kpi_date:D avg_processing_time_ms:d p95_processing_time_ms:i auto_approval_rate:d manual_review_rate:d "
          "fraud_detection_rate:d avg_fraud_confidence:d data_quality_score:d validation_score:d "
          "total_claims_processed:i claims_per_hour:d total_claim_value:m avg_claim_value:d",
          gold.operational_kpis_wide, _WIDE_SQL)
_KPI_SQL = f"""SELECT k.*, t.kpi_target, (kpi_value - kpi_target) / kpi_target * 100 AS variance_from_target,
  CASE WHEN kpi_value IS NULL THEN 'NO_TARGET'
    WHEN k.kpi_name = 'avg_processing_time_ms' THEN CASE WHEN kpi_value <= kpi_target THEN 'GREEN'
      WHEN kpi_value <= kpi_target * 12e-1 THEN 'AMBER' ELSE 'RED' END
    WHEN kpi_value >= kpi_target THEN 'GREEN' WHEN kpi_value >= kpi_target * 9e-1 THEN 'AMBER' ELSE 'RED' END AS kpi_status
  FROM (SELECT kpi_date, unnest(['avg_processing_time_ms', 'auto_approval_rate', 'fraud_detection_rate',
    'data_quality_score', 'claims_per_hour']) AS kpi_name, unnest([avg_processing_time_ms, auto_approval_rate,
    fraud_detection_rate, data_quality_score, claims_per_hour]) AS kpi_value FROM ({_WIDE_SQL})) k
  JOIN {values_sql(refdata.KPI_TARGETS)} AS t(kpi_name, kpi_target) ON k.kpi_name = t.kpi_name"""
on_silver("operational_kpis",
          "kpi_date:D kpi_name:s kpi_value:d kpi_target:d variance_from_target:d kpi_status:s",
          gold.operational_kpis, _KPI_SQL)
_RUN_SQL = """SELECT *, count(*) OVER w AS claims_count, sum(claim_amount_gbp) OVER w AS total_claimed,
  avg(claim_amount_gbp) OVER w AS avg_claim_amount, max(adjusted_fraud_score) OVER w AS max_fraud_score,
  sum(is_high_risk::INT) OVER w AS fraud_flags_count FROM silver
  WINDOW w AS (PARTITION BY customer_id ORDER BY claim_date, claim_id ROWS UNBOUNDED PRECEDING)"""
on_silver("customer_running_history",
          "claim_id:s customer_id:s claims_count:i total_claimed:m avg_claim_amount:d max_fraud_score:d fraud_flags_count:i",
          gold.customer_running_history, _RUN_SQL)
_PROFILE_SQL = f"""SELECT *, total_claims / 3e0 AS claims_frequency_score,
  CASE risk_segment WHEN 'HIGH_RISK' THEN 'DECLINE' WHEN 'MEDIUM_RISK' THEN 'REVIEW' ELSE 'ACCEPT' END AS overall_risk_rating,
  CASE risk_segment WHEN 'HIGH_RISK' THEN 15e-1 WHEN 'MEDIUM_RISK' THEN 12e-1 ELSE 1e0 END AS recommended_premium_adjustment
  FROM (SELECT *, CASE WHEN fraud_risk_score > 7e-1 OR fraud_incidents > 2 THEN 'HIGH_RISK'
    WHEN fraud_risk_score > 4e-1 OR total_claims / 3e0 > 5 THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END AS risk_segment
  FROM (SELECT customer_id, max(claims_count) AS total_claims, max(total_claimed) AS total_claimed_amount,
    max(avg_claim_amount) AS avg_claim_amount, avg(claim_amount_gbp) AS final_avg, max(max_fraud_score) AS fraud_risk_score,
    max(fraud_flags_count) AS fraud_incidents, max(claim_date) AS last_claim_date FROM ({_RUN_SQL}) GROUP BY customer_id))"""
on_silver("customer_risk_profiles",
          "customer_id:s total_claims:i total_claimed_amount:m avg_claim_amount:d final_avg:d fraud_risk_score:d "
          "fraud_incidents:i claims_frequency_score:d last_claim_date:t risk_segment:s overall_risk_rating:s "
          "recommended_premium_adjustment:d", gold.customer_risk_profiles, _PROFILE_SQL)
on_silver("realtime_dashboard",
          "claims_today:i total_value_today:m avg_fraud_score_today:d avg_processing_time_1h:d fraud_detected_today:i "
          "manual_review_queue:i fraud_investigation_queue:i",
          lambda df: gold.realtime_dashboard(df, as_of("2024-06-15 12:00:00")),
          """SELECT count(*) FILTER (CAST(claim_date AS DATE) = DATE '2024-06-15') AS claims_today,
          sum(claim_amount_gbp) FILTER (CAST(claim_date AS DATE) = DATE '2024-06-15') AS total_value_today,
          avg(adjusted_fraud_score) FILTER (CAST(claim_date AS DATE) = DATE '2024-06-15') AS avg_fraud_score_today,
          avg(processing_ms) FILTER (silver_ts >= TIMESTAMP '2024-06-15 11:00:00') AS avg_processing_time_1h,
          count(*) FILTER (is_high_risk AND CAST(claim_date AS DATE) = DATE '2024-06-15') AS fraud_detected_today,
          count(*) FILTER (requires_manual_review AND processing_status = 'MANUAL_REVIEW') AS manual_review_queue,
          count(*) FILTER (processing_status = 'FRAUD_INVESTIGATION') AS fraud_investigation_queue FROM silver""")
on_silver("top_claims_attention",
          "category:s claim_id:s customer_id:s claim_date:t claim_type:s claim_amount_gbp:d adjusted_fraud_score:d processing_status:s",
          lambda df: gold.top_claims_attention(df, as_of("2024-12-01 00:00:00")),
          """, recent AS (SELECT *, row_number() OVER (ORDER BY claim_amount_gbp DESC, claim_id) AS ra,
            row_number() OVER (ORDER BY adjusted_fraud_score DESC, claim_id) AS rf FROM silver
            WHERE claim_date >= TIMESTAMP '2024-11-24 00:00:00')
          SELECT 'HIGH_VALUE' AS category, * FROM recent WHERE ra <= 10
          UNION ALL SELECT 'HIGH_FRAUD_RISK' AS category, * FROM recent WHERE rf <= 10""")
on_silver("regional_metrics",
          "region:s claim_count:i total_claimed:m avg_claim_amount:d avg_fraud_score:d fraud_cases:i "
          "fraud_rate_percent:d avg_processing_time:d unique_customers:i",
          lambda df: gold.regional_metrics(df, as_of("2024-12-01 00:00:00")),
          """SELECT region, count(*) AS claim_count, sum(claim_amount_gbp) AS total_claimed,
          avg(claim_amount_gbp) AS avg_claim_amount, avg(adjusted_fraud_score) AS avg_fraud_score,
          count(*) FILTER (is_high_risk) AS fraud_cases, count(*) FILTER (is_high_risk) * 1e2 / count(*) AS fraud_rate_percent,
          avg(processing_ms) AS avg_processing_time, count(DISTINCT customer_id) AS unique_customers FROM silver
          WHERE claim_date >= TIMESTAMP '2024-11-01 00:00:00' AND region IS NOT NULL GROUP BY region""")
on_silver("regional_performance", "region:s claim_count:i avg_amount:d avg_fraud_score:d",
          lambda df: gold.regional_performance(df, as_of("2024-12-01 00:00:00")),
          """SELECT region, count(*) AS claim_count, avg(claim_amount_gbp) AS avg_amount, avg(fraud_score) AS avg_fraud_score
          FROM silver WHERE claim_date >= TIMESTAMP '2024-11-01 00:00:00' GROUP BY region""")
on_silver("executive_dashboard",
          "claims_per_hour:d auto_approval_percent:d fraud_detection_percent:d avg_processing_time_ms:d "
          "total_claims_today:i total_amount_today:m fraud_prevented_today:m fraud_rate_percent:d",
          lambda df: gold.executive_dashboard(gold.operational_kpis(df), gold.daily_claims_summary(df), as_of("2024-06-15 12:00:00")),
          f"""SELECT k.claims_per_hour, k.auto_approval_rate * 100 AS auto_approval_percent,
          k.fraud_detection_rate * 100 AS fraud_detection_percent, k.avg_processing_time_ms, s.* FROM
          (SELECT * FROM ({_WIDE_SQL}) WHERE kpi_date = DATE '2024-06-15') k,
          (SELECT sum(total_claims) AS total_claims_today, sum(total_amount) AS total_amount_today,
            sum(fraud_detected_amount) AS fraud_prevented_today, avg(fraud_rate) * 100 AS fraud_rate_percent
          FROM ({_DAILY_SQL}) WHERE summary_date = DATE '2024-06-15') s""")
on_silver("daily_summary_lite",
          "summary_date:D claim_type:s total_claims:i total_amount:m average_amount:d fraud_detected_count:i "
          "fraud_detected_amount:m auto_approved_count:i manual_review_count:i", gold.daily_summary_lite, _DAILY_SQL)
on_silver("weekly_kpis", "summary_date:D total_claims:i total_value:m avg_claim:d fraud_cases:i auto_approval_rate:d",
          lambda df: gold.weekly_kpis(gold.daily_summary_lite(df), as_of("2024-12-01 00:00:00")),
          f"""SELECT summary_date, sum(total_claims) AS total_claims, sum(total_amount) AS total_value,
          avg(average_amount) AS avg_claim, sum(fraud_detected_count) AS fraud_cases,
          sum(auto_approved_count) * 1e2 / sum(total_claims) AS auto_approval_rate FROM ({_DAILY_SQL})
          WHERE summary_date >= DATE '2024-11-24' GROUP BY summary_date""")
on_silver("claims_dashboard_metrics",
          "metric_group:s item:s claims:i total_amount:m avg_fraud_score:d fraud_cases:i high_risk_claims:i",
          gold.claims_dashboard_metrics,
          " UNION ALL ".join(
              f"""SELECT '{name}' AS metric_group, {item} AS item, count(*) AS claims, sum(claim_amount) AS total_amount,
              avg(fraud_score) AS avg_fraud_score, count(*) FILTER (fraud_score > 7e-1) AS fraud_cases,
              count(*) FILTER (fraud_score > 8e-1) AS high_risk_claims FROM silver GROUP BY 2"""
              for name, item in [("total", "'all'"), ("claim_type", "claim_type"), ("status", "claim_status"),
                                 ("city", "incident_location"), ("hour", "strftime(claim_date, '%Y-%m-%d %H:00')")]))
on_silver("recent_claims_topn",
          "claim_id:s claim_type:s claim_amount:d fraud_score:d claim_status:s incident_location:s claim_date:t traffic_light:s",
          gold.recent_claims_topn,
          """SELECT *, CASE WHEN fraud_score > 7e-1 THEN 'RED' WHEN fraud_score > 4e-1 THEN 'AMBER' ELSE 'GREEN' END
          AS traffic_light FROM silver ORDER BY claim_date DESC, claim_id LIMIT 10""")
on_silver("top_cities", "city:s claims:i", gold.top_cities,
          "SELECT incident_location AS city, count(*) AS claims FROM silver GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")

# ---------------------------------------------------------------- tables promised by schema only
_HISTORY_SQL = """SELECT postcode_district, count(*) AS claim_count, count(DISTINCT policy_number) AS policies,
  count(*) / nullif(count(DISTINCT policy_number), 0) AS historical_claim_frequency,
  avg(claim_amount_gbp) AS historical_claim_severity, avg(adjusted_fraud_score) AS risk_score
  FROM silver WHERE postcode_district <> '' GROUP BY postcode_district"""
on_silver("postcode_history",
          "postcode_district:s claim_count:i policies:i historical_claim_frequency:d historical_claim_severity:d risk_score:d",
          x.postcode_history, _HISTORY_SQL)
on_silver("fraud_investigation_queue",
          "claim_id:s claim_date:t customer_id:s claim_amount_gbp:d fraud_score:d fraud_indicators:a incident_postcode:s "
          "postcode_risk_score:d",
          lambda df: gold.fraud_investigation_queue(df, x.postcode_history(df)),
          f"""SELECT s.*, h.risk_score AS postcode_risk_score FROM silver s LEFT JOIN ({_HISTORY_SQL}) h
          ON s.postcode_district = h.postcode_district WHERE requires_manual_review OR fraud_score > 7e-1""")
_TREND = lambda n: (
    f"CASE WHEN count(kpi_value) OVER w{n} = 0 OR kpi_value IS NULL THEN NULL "
    f"WHEN kpi_value > (avg(kpi_value) OVER w{n}) * 105e-2 THEN 'UP' "
    f"WHEN kpi_value < (avg(kpi_value) OVER w{n}) * 95e-2 THEN 'DOWN' ELSE 'STABLE' END")
on_silver("kpi_trend", "kpi_date:D kpi_name:s kpi_value:d trend_7_day:s trend_30_day:s",
          lambda df: x.kpi_trend(gold.operational_kpis(df)),
          f"""SELECT *, {_TREND(7)} AS trend_7_day, {_TREND(30)} AS trend_30_day FROM ({_KPI_SQL})
          WINDOW w7 AS (PARTITION BY kpi_name ORDER BY kpi_date RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING),
          w30 AS (PARTITION BY kpi_name ORDER BY kpi_date RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING)""")

POLICY_CTE = (f"policy AS (SELECT *, {ts('start_s')} AS start_date, {ts('end_s')} AS end_date FROM ({src('policies')})), "
              f"holder AS (SELECT *, {ts('dob_s')} AS date_of_birth FROM ({src('holders')}))")
_ENRICH_SQL = f"""SELECT p.*, date_diff('day', start_date, end_date) AS policy_duration_days,
  premium_amount / 12e0 AS premium_monthly, {AS_OF} >= start_date AND {AS_OF} < end_date AS is_active,
  date_diff('day', {AS_OF}, end_date) AS days_until_renewal, coalesce(c.n, 0) AS claims_count,
  coalesce(c.total, 0) AS total_claims_amount, coalesce(c.total, 0) / nullif(premium_amount, 0) AS loss_ratio
  FROM policy p LEFT JOIN (SELECT policy_number, count(*) AS n, sum(claim_amount_gbp) AS total FROM silver
    GROUP BY policy_number) c ON p.policy_number = c.policy_number"""
register("policy_enrichment",
         "policy_number:s policy_duration_days:i premium_monthly:d is_active:b days_until_renewal:i claims_count:i "
         "total_claims_amount:m loss_ratio:d",
         lambda s, d: x.policy_enrichment(inputs.policies(s, d), silver_frame(s, d), as_of()),
         gold_sql(f", {POLICY_CTE} {_ENRICH_SQL}"))
_CUSTOMER_SQL = f"""SELECT h.policyholder_id AS customer_id, sha256(h.policyholder_id) AS customer_hash,
  CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 50 THEN '35-49' WHEN age < 65 THEN '50-64' ELSE '65+' END AS age_band,
  coalesce(p.total_policies, 0) AS total_policies, coalesce(p.active_policies, 0) AS active_policies,
  coalesce(p.lifetime_value, 0) AS lifetime_value, CASE WHEN coalesce(p.lifetime_value, 0) < 1000 THEN 'LOW'
    WHEN p.lifetime_value < 3000 THEN 'MEDIUM' ELSE 'HIGH' END AS lifetime_value_band,
  coalesce(c.n, 0) AS total_claims, coalesce(c.total, 0) AS total_claims_amount, c.mean AS average_claim_amount,
  c.score AS fraud_risk_score, CASE WHEN c.score > 7e-1 THEN 'WATCH' WHEN coalesce(p.lifetime_value, 0) >= 3000 THEN 'PREMIUM'
    ELSE 'STANDARD' END AS customer_segment
  FROM (SELECT *, date_diff('year', date_of_birth, {AS_OF}) - (strftime({AS_OF}, '%m%d') < strftime(date_of_birth, '%m%d'))::INT AS age
        FROM holder) h
  LEFT JOIN (SELECT policyholder_id, count(*) AS total_policies, count(*) FILTER ({AS_OF} >= start_date AND {AS_OF} < end_date) AS active_policies,
    sum(premium_amount) AS lifetime_value FROM policy GROUP BY 1) p ON h.policyholder_id = p.policyholder_id
  LEFT JOIN (SELECT customer_id, count(*) AS n, sum(claim_amount_gbp) AS total, avg(claim_amount_gbp) AS mean,
    max(adjusted_fraud_score) AS score FROM silver GROUP BY 1) c ON h.policyholder_id = c.customer_id"""


def customer_frame(s, d):
    return x.customer_360(inputs.holders(s, d), inputs.policies(s, d), silver_frame(s, d), as_of())


register("customer_360",
         "customer_id:s customer_hash:s age_band:s total_policies:i active_policies:i lifetime_value:m "
         "lifetime_value_band:s total_claims:i total_claims_amount:m average_claim_amount:d fraud_risk_score:d customer_segment:s",
         customer_frame, gold_sql(f", {POLICY_CTE} {_CUSTOMER_SQL}"))
register("recent_high_value_claims",
         "claim_id:s claim_date:t customer_id:s claim_amount_gbp:d claim_type:s fraud_score:d fraud_indicators:a "
         "customer_segment:s lifetime_value:m",
         lambda s, d: gold.recent_high_value_claims(silver_frame(s, d), customer_frame(s, d), as_of("2024-12-01 00:00:00")),
         gold_sql(f""", {POLICY_CTE} SELECT s.*, c.customer_segment, c.lifetime_value FROM silver s
         JOIN ({_CUSTOMER_SQL}) c ON s.customer_id = c.customer_id
         WHERE claim_date >= TIMESTAMP '2024-11-24 00:00:00' AND claim_amount_gbp > 10000"""))
register("claim_to_premium_ratio", "claim_id:s claim_to_premium_ratio:d customer_age_at_claim:i",
         lambda s, d: x.claim_to_premium_ratio(silver_frame(s, d), inputs.policies(s, d), inputs.holders(s, d)),
         gold_sql(f""", {POLICY_CTE} SELECT s.claim_id, s.claim_amount_gbp / nullif(p.premium_amount, 0) AS claim_to_premium_ratio,
         date_diff('year', date_of_birth, claim_date)
           - (strftime(claim_date, '%m%d') < strftime(date_of_birth, '%m%d'))::INT AS customer_age_at_claim
         FROM silver s LEFT JOIN policy p ON s.policy_number = p.policy_number
         LEFT JOIN holder h ON s.customer_id = h.policyholder_id"""))

def policy_versions(s, d):
    orders = inputs.read(s, d, "orders")
    return orders.selectExpr("'POL_' || lpad(cast(o_custkey AS STRING), 12, '0') AS policy_number",
                             "300e0 + o_orderkey % 3 AS premium_amount", "o_orderkey AS version_key",
                             "CAST(o_orderdate AS TIMESTAMP) AS changed_at")


register("policy_scd2",
         "policy_number:s premium_amount:d scd_start_date:t scd_end_date:t scd_is_current:b",
         lambda s, d: x.policy_scd2(policy_versions(s, d), "policy_number", "changed_at", ["premium_amount"], ["version_key"])
         .withColumnsRenamed({"_scd_start_date": "scd_start_date", "_scd_end_date": "scd_end_date", "_scd_is_current": "scd_is_current"}),
         """SELECT policy_number, premium_amount, changed_at AS scd_start_date, lead(changed_at) OVER w AS scd_end_date,
         lead(changed_at) OVER w IS NULL AS scd_is_current FROM (
           SELECT *, lag(premium_amount) OVER (PARTITION BY policy_number ORDER BY changed_at, version_key) AS before FROM (
             SELECT 'POL_' || lpad(cast(o_custkey AS STRING), 12, '0') AS policy_number, 300e0 + o_orderkey % 3 AS premium_amount,
             o_orderkey AS version_key, CAST(o_orderdate AS TIMESTAMP) AS changed_at FROM orders))
         WHERE before IS DISTINCT FROM premium_amount WINDOW w AS (PARTITION BY policy_number ORDER BY changed_at, version_key)""")
register("fraud_model_quality",
         "evaluated:i confirmed_fraud_cases:i false_positive_count:i false_negative_count:i precision_score:d recall_score:d f1_score:d",
         lambda s, d: x.fraud_model_quality(inputs.read(s, d, "labels"), F.col("quality") == 0, F.col("toxic") == 1),
         """SELECT *, tp / nullif(tp + false_positive_count, 0) AS precision_score, tp / nullif(tp + false_negative_count, 0) AS recall_score,
         2e0 * tp / nullif(2 * tp + false_positive_count + false_negative_count, 0) AS f1_score, tp AS confirmed_fraud_cases FROM (
         SELECT count(*) AS evaluated, count(*) FILTER (quality = 0 AND toxic = 1) AS tp,
         count(*) FILTER (quality = 0 AND toxic <> 1) AS false_positive_count,
         count(*) FILTER (quality <> 0 AND toxic = 1) AS false_negative_count FROM labels)""")

# ---------------------------------------------------------------------------------- anomalies
BASE_CTE = SILVER_CTE + f""",
base0 AS (SELECT claim_type, avg(claim_amount_gbp) AS mean_amount, stddev(claim_amount_gbp) AS stddev_amount,
  quantile_disc(claim_amount_gbp, 0.25) AS q1_amount, quantile_disc(claim_amount_gbp, 0.5) AS median_amount,
  quantile_disc(claim_amount_gbp, 0.75) AS q3_amount, avg(days_to_claim) AS mean_days_to_claim,
  stddev(days_to_claim) AS stddev_days_to_claim, avg(fraud_score) AS mean_fraud_score, stddev(fraud_score) AS stddev_fraud_score,
  count(*) / 90e0 AS daily_avg_count FROM silver WHERE claim_date >= CAST({AS_OF} AS DATE) - 90 GROUP BY claim_type),
base AS (SELECT *, q3_amount - q1_amount AS iqr_amount, q1_amount - 15e-1 * (q3_amount - q1_amount) AS lower_fence,
  q3_amount + 15e-1 * (q3_amount - q1_amount) AS upper_fence FROM base0)"""
A2_CTE = BASE_CTE + """,
a1 AS (SELECT s.*, b.* EXCLUDE (claim_type),
  CASE WHEN stddev_amount > 0 THEN abs(claim_amount_gbp - mean_amount) / stddev_amount ELSE 0 END AS z_score_amount,
  CASE WHEN stddev_days_to_claim > 0 THEN abs(days_to_claim - mean_days_to_claim) / stddev_days_to_claim ELSE 0 END AS z_score_days,
  CASE WHEN stddev_fraud_score > 0 THEN abs(fraud_score - mean_fraud_score) / stddev_fraud_score ELSE 0 END AS z_score_fraud,
  claim_amount_gbp < lower_fence OR claim_amount_gbp > upper_fence AS is_iqr_outlier
  FROM silver s LEFT JOIN base b ON s.claim_type = b.claim_type),
a2 AS (SELECT *, least(greatest(z_score_amount / 3e0, z_score_days / 3e0, z_score_fraud / 3e0,
  CASE WHEN is_iqr_outlier THEN 1e0 ELSE 0e0 END), 1e0) AS statistical_anomaly_score,
  z_score_amount > 3 AS amount_anomaly, z_score_days > 3 AS timing_anomaly, z_score_fraud > 3 AS fraud_score_anomaly FROM a1)"""
A3_CTE = A2_CTE + """,
a3w AS (SELECT *, count(*) OVER h AS hourly_count, avg(claim_amount_gbp) OVER h AS hourly_avg_amount,
  count(*) OVER d AS daily_count, avg(claim_amount_gbp) OVER d AS daily_avg_amount FROM a2
  WINDOW h AS (PARTITION BY claim_type ORDER BY claim_s RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW),
  d AS (PARTITION BY claim_type ORDER BY claim_s RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW)),
a3v AS (SELECT *, CASE WHEN hourly_count > 10 THEN 1e0 WHEN hourly_count > 5 THEN 5e-1 ELSE 0e0 END AS velocity_anomaly,
  CASE WHEN daily_count > daily_avg_count * 3 THEN 1e0 WHEN daily_count > daily_avg_count * 2 THEN 5e-1 ELSE 0e0 END AS volume_spike,
  CASE WHEN hourly_avg_amount > 0 THEN abs(claim_amount_gbp - hourly_avg_amount) / hourly_avg_amount ELSE 0e0 END AS amount_deviation
  FROM a3w),
a3 AS (SELECT *, greatest(velocity_anomaly, volume_spike, amount_spike_anomaly) AS time_series_anomaly_score FROM (
  SELECT *, CASE WHEN amount_deviation > 2 THEN 1e0 WHEN amount_deviation > 1 THEN 5e-1 ELSE 0e0 END AS amount_spike_anomaly FROM a3v))"""
A4_CTE = A3_CTE + """,
a4w AS (SELECT *, count(*) OVER g AS geo_claim_count, count(DISTINCT customer_id) OVER g AS geo_unique_customers,
  avg(claim_amount_gbp) OVER g AS geo_avg_amount FROM a3
  WINDOW g AS (PARTITION BY postcode_district, claim_type ORDER BY claim_s RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW)),
a4 AS (SELECT *, greatest(geo_anomaly, geo_amount_anomaly) AS geographic_anomaly_score FROM (SELECT *,
  CASE WHEN geo_concentration_ratio > 3 THEN 1e0 WHEN geo_concentration_ratio > 2 THEN 5e-1 ELSE 0e0 END AS geo_anomaly,
  CASE WHEN geo_avg_amount > mean_amount * 2 THEN 1e0 WHEN geo_avg_amount > mean_amount * 15e-1 THEN 5e-1 ELSE 0e0 END AS geo_amount_anomaly
  FROM (SELECT *, CASE WHEN geo_unique_customers > 0 THEN geo_claim_count / geo_unique_customers ELSE 1e0 END
    AS geo_concentration_ratio FROM a4w)))"""
A5_CTE = A4_CTE + """,
a5w AS (SELECT *, count(*) OVER c AS customer_claim_count, avg(claim_amount_gbp) OVER c AS customer_avg_amount,
  max(claim_amount_gbp) OVER c AS customer_max_amount, avg(days_to_claim) OVER c AS customer_avg_days_between FROM a4
  WINDOW c AS (PARTITION BY customer_id ORDER BY claim_s RANGE BETWEEN 7776000 PRECEDING AND 1 PRECEDING)),
a5 AS (SELECT *, greatest(customer_amount_anomaly, customer_frequency_anomaly, first_time_high_value) AS customer_anomaly_score FROM (
  SELECT *, CASE WHEN amount_vs_history > 5 THEN 1e0 WHEN amount_vs_history > 3 THEN 7e-1 WHEN amount_vs_history > 2 THEN 3e-1 ELSE 0e0 END
    AS customer_amount_anomaly,
  CASE WHEN customer_claim_count > 5 THEN 1e0 WHEN customer_claim_count > 3 THEN 5e-1 ELSE 0e0 END AS customer_frequency_anomaly,
  CASE WHEN customer_claim_count = 0 AND claim_amount_gbp > 10000 THEN 1e0 ELSE 0e0 END AS first_time_high_value
  FROM (SELECT *, CASE WHEN customer_avg_amount > 0 THEN claim_amount_gbp / customer_avg_amount ELSE 1e0 END AS amount_vs_history FROM a5w)))"""
A6_CTE = A5_CTE + """,
a6w AS (SELECT *, count(*) OVER n AS same_location_claims, count(DISTINCT customer_id) OVER n AS unique_customers_location FROM a5
  WINDOW n AS (PARTITION BY incident_postcode ORDER BY claim_s RANGE BETWEEN 259200 PRECEDING AND 259200 FOLLOWING)),
a6 AS (SELECT *, CASE WHEN location_concentration > 5e-1 AND similar_amounts > 5e-1 THEN 1e0
  WHEN location_concentration > 5e-1 OR similar_amounts > 5e-1 THEN 5e-1 ELSE 0e0 END AS network_anomaly_score FROM (
  SELECT *, CASE WHEN same_location_claims > 3 THEN 1e0 WHEN same_location_claims > 2 THEN 5e-1 ELSE 0e0 END AS location_concentration,
  CASE WHEN abs(claim_amount_gbp - hourly_avg_amount) < 100 THEN 1e0 ELSE 0e0 END AS similar_amounts FROM a6w))"""
A7_CTE = A6_CTE + """,
a7s AS (SELECT *, CASE WHEN composite_anomaly_score > 8e-1 THEN 'CRITICAL' WHEN composite_anomaly_score > 6e-1 THEN 'HIGH'
  WHEN composite_anomaly_score > 4e-1 THEN 'MEDIUM' WHEN composite_anomaly_score > 2e-1 THEN 'LOW' ELSE 'NONE' END AS anomaly_severity,
  list_filter([CASE WHEN statistical_anomaly_score > 5e-1 THEN 'STATISTICAL_OUTLIER' END,
    CASE WHEN time_series_anomaly_score > 5e-1 THEN 'TIME_PATTERN' END,
    CASE WHEN geographic_anomaly_score > 5e-1 THEN 'GEOGRAPHIC_CLUSTER' END,
    CASE WHEN customer_anomaly_score > 5e-1 THEN 'CUSTOMER_BEHAVIOR' END,
    CASE WHEN network_anomaly_score > 5e-1 THEN 'NETWORK_PATTERN' END], lambda v: v IS NOT NULL) AS anomaly_reasons FROM (
  SELECT *, statistical_anomaly_score * 25e-2 + time_series_anomaly_score * 2e-1 + geographic_anomaly_score * 2e-1
    + customer_anomaly_score * 2e-1 + network_anomaly_score * 15e-2 AS composite_anomaly_score FROM a6)),
a7 AS (SELECT *, CASE WHEN anomaly_severity = 'CRITICAL' AND claim_amount_gbp > 10000 THEN 1 WHEN anomaly_severity = 'CRITICAL' THEN 2
  WHEN anomaly_severity = 'HIGH' AND claim_amount_gbp > 5000 THEN 3 WHEN anomaly_severity = 'HIGH' THEN 4 ELSE 5 END
  AS investigation_priority FROM a7s)"""


def _baselines(df):
    return anomaly.statistical_baselines(df, as_of())


def _upto(df, *steps):
    """The silver frame through the first detectors, as the later ones need their columns."""
    facts = df.select(*anomaly.INPUT_COLUMNS)
    out = anomaly.statistical_anomaly(facts, _baselines(df))
    for step in steps:
        out = step(out, facts=facts)
    return out


register_sql = lambda cte, name: f"WITH {cte} SELECT * FROM {name}"
register("statistical_baselines",
         "claim_type:s mean_amount:d stddev_amount:d q1_amount:d median_amount:d q3_amount:d mean_days_to_claim:d "
         "stddev_days_to_claim:d mean_fraud_score:d stddev_fraud_score:d daily_avg_count:d iqr_amount:d lower_fence:d upper_fence:d",
         lambda s, d: _baselines(silver_frame(s, d)), register_sql(BASE_CTE, "base"))


def on_scores(key, shape, steps, cte, name):
    register(key, shape, lambda s, d: _upto(stored_silver(s, d), *steps), register_sql(cte, name))


on_scores("statistical_anomaly",
          "claim_id:s z_score_amount:d z_score_days:d z_score_fraud:d is_iqr_outlier:b statistical_anomaly_score:d "
          "amount_anomaly:b timing_anomaly:b fraud_score_anomaly:b", [], A2_CTE, "a2")
on_scores("time_series_anomaly",
          "claim_id:s hourly_count:i hourly_avg_amount:d daily_count:i daily_avg_amount:d velocity_anomaly:d volume_spike:d "
          "amount_deviation:d amount_spike_anomaly:d time_series_anomaly_score:d", [anomaly.time_series_anomaly], A3_CTE, "a3")
on_scores("geographic_anomaly",
          "claim_id:s geo_claim_count:i geo_unique_customers:i geo_avg_amount:d geo_concentration_ratio:d geo_anomaly:d "
          "geo_amount_anomaly:d geographic_anomaly_score:d", [anomaly.geographic_anomaly], A4_CTE, "a4")
on_scores("customer_behavior_anomaly",
          "claim_id:s customer_claim_count:i customer_avg_amount:d customer_max_amount:d customer_avg_days_between:d "
          "amount_vs_history:d customer_amount_anomaly:d customer_frequency_anomaly:d first_time_high_value:d customer_anomaly_score:d",
          [anomaly.customer_behavior_anomaly], A5_CTE, "a5")
on_scores("network_anomaly",
          "claim_id:s same_location_claims:i unique_customers_location:i location_concentration:d similar_amounts:d network_anomaly_score:d",
          [anomaly.time_series_anomaly, anomaly.network_anomaly], A6_CTE, "a6")
_ALL = [anomaly.time_series_anomaly, anomaly.geographic_anomaly, anomaly.customer_behavior_anomaly,
        anomaly.network_anomaly, lambda df, facts: anomaly.composite_anomaly(df)]
on_scores("composite_anomaly",
          "claim_id:s composite_anomaly_score:d anomaly_severity:s anomaly_reasons:a investigation_priority:i", _ALL, A7_CTE, "a7")
register("anomaly_output",
         "claim_id:s claim_date:t customer_id:s claim_type:s claim_amount_gbp:d incident_postcode:s statistical_anomaly_score:d "
         "time_series_anomaly_score:d geographic_anomaly_score:d customer_anomaly_score:d network_anomaly_score:d "
         "composite_anomaly_score:d anomaly_severity:s anomaly_reasons:a investigation_priority:i amount_anomaly:b "
         "timing_anomaly:b fraud_score_anomaly:b velocity_anomaly:d geo_concentration_ratio:d customer_frequency_anomaly:d",
         anomaly_frame, register_sql(A7_CTE, "a7"))
register("anomaly_alerts",
         "claim_id:s customer_id:s claim_amount_gbp:d composite_anomaly_score:d anomaly_severity:s anomaly_reasons:a investigation_priority:i",
         lambda s, d: anomaly.anomaly_alerts(anomaly_frame(s, d)),
         register_sql(A7_CTE, "a7 WHERE anomaly_severity IN ('CRITICAL', 'HIGH') AND investigation_priority <= 3"))
register("anomaly_patterns", "anomaly_severity:s anomaly_type:s anomaly_count:i avg_score:d avg_amount:d",
         lambda s, d: anomaly.anomaly_patterns(anomaly_frame(s, d), as_of()),
         f"""WITH {A7_CTE} SELECT anomaly_severity, anomaly_type, count(*) AS anomaly_count, avg(composite_anomaly_score) AS avg_score,
         avg(claim_amount_gbp) AS avg_amount FROM (SELECT *, unnest(anomaly_reasons) AS anomaly_type FROM a7) GROUP BY ALL""")
register("detection_metrics",
         "total_claims_analyzed:i anomalies_detected:i avg_anomaly_score:d max_anomaly_score:d critical_anomalies:i "
         "high_anomalies:i detection_rate:d",
         lambda s, d: anomaly.detection_metrics(anomaly_frame(s, d), as_of()),
         f"""WITH {A7_CTE} SELECT count(*) AS total_claims_analyzed, count(*) FILTER (anomaly_severity <> 'NONE') AS anomalies_detected,
         avg(composite_anomaly_score) AS avg_anomaly_score, max(composite_anomaly_score) AS max_anomaly_score,
         count(DISTINCT claim_id) FILTER (anomaly_severity = 'CRITICAL') AS critical_anomalies,
         count(DISTINCT claim_id) FILTER (anomaly_severity = 'HIGH') AS high_anomalies,
         count(*) FILTER (anomaly_severity <> 'NONE') / count(*) * 100 AS detection_rate FROM a7""")

# ---------------------------------------------------------------------------------- distinct customers over periods
_DAY_END_S = 1717200000  # 2024-06-01


def _customer_sets(s, d):
    """Hourly sets of the customers by region and type, in two loads with one dictionary."""
    claims = silver_frame(s, d).select("customer_id", "claim_date", "region", "claim_type", "claim_id")
    loads = [claims.where(F.pmod(F.xxhash64("claim_id"), F.lit(2)) == n) for n in (0, 1)]
    keys = {"region": F.col("region"), "claim_type": F.col("claim_type")}
    held = cut(distincts.coded(loads[0].select(F.col("customer_id").alias("id"))))
    held = cut(held.union(distincts.coded(loads[1].select(F.col("customer_id").alias("id")), held)))
    first, second = (distincts.hourly_sets(load, F.col("claim_date"), "customer_id", held, keys) for load in loads)
    return cut(first.union(second))


register("distinct_customers_24h", "region:s claim_type:s distinct_ids:i",
         lambda s, d: distincts.distinct_between(_customer_sets(s, d), _DAY_END_S - 86400, _DAY_END_S, "region", "claim_type"),
         gold_sql(f"""SELECT region, claim_type, count(DISTINCT customer_id) AS distinct_ids FROM silver
         WHERE epoch(claim_date) >= {_DAY_END_S - 86400} AND epoch(claim_date) < {_DAY_END_S} GROUP BY ALL"""))
register("distinct_customers_30d", "period_end:D claim_type:s distinct_ids:i",
         lambda s, d: distincts.moving_distinct(_customer_sets(s, d), 30, "claim_type"),
         gold_sql("""SELECT e.day AS period_end, e.claim_type, count(DISTINCT customer_id) AS distinct_ids
         FROM (SELECT DISTINCT CAST(claim_date AS DATE) AS day, claim_type FROM silver) e JOIN silver c
           ON c.claim_type = e.claim_type AND CAST(c.claim_date AS DATE) BETWEEN e.day - 29 AND e.day GROUP BY ALL"""))
