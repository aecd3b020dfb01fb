"""Declared schemas of events, envelopes and stored tables."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DateType, DecimalType, DoubleType, IntegerType,
                               LongType, MapType, StringType, StructField, StructType, TimestampType)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


S, D, I, L, B = StringType(), DoubleType(), IntegerType(), LongType(), BooleanType()
TS, DATE, TEXTS = TimestampType(), DateType(), ArrayType(StringType())
MONEY, BIG_MONEY = DecimalType(10, 2), DecimalType(12, 2)

CLAIM_EVENT = _struct(
    claim_id=S, policy_number=S, customer_id=S, claim_amount=D, claim_date=S, incident_date=S,
    incident_location=S, incident_postcode=S, claim_type=S, claim_status=S, fraud_score=D,
    fraud_indicators=TEXTS, description=S, metadata=MapType(S, S),
)
DEAD_LETTER = _struct(
    raw_data=S, error_message=S, error_timestamp=TS, event_hub_offset=L, event_hub_partition=I,
)
BRONZE_CLAIM = _struct(
    claim_id=S, policy_number=S, customer_id=S, claim_amount=MONEY, claim_date=TS, incident_date=TS,
    incident_location=S, incident_postcode=S, claim_type=S, claim_status=S, fraud_score=D,
    description=S, _raw_data=S, _ingestion_timestamp=TS, _event_hub_offset=L,
    _event_hub_partition=I, _event_hub_sequence=L, _data_source=S, dq_score=D, ingestion_date=DATE,
)
SILVER_CLAIM = _struct(
    claim_id=S, policy_number=S, customer_id=S, claim_amount=D, claim_amount_gbp=D, claim_date=TS,
    incident_date=TS, incident_location=S, incident_postcode=S, postcode_district=S, postcode_area=S,
    region=S, claim_type=S, claim_status=S, fraud_score=D, adjusted_fraud_score=D,
    fraud_indicators=TEXTS, is_high_risk=B, requires_manual_review=B, days_to_claim=I,
    claim_amount_category=S, is_weekend_claim=B, is_bank_holiday=B, is_business_hours=B,
    processing_status=S, validation_score=D, data_quality_score=D, _silver_timestamp=TS,
    _processing_time_ms=L,
)
ADDRESS = _struct(line1=S, line2=S, city=S, county=S, postcode=S, country=S)
POLICYHOLDER = _struct(
    id=S, first_name=S, last_name=S, email=S, phone=S, date_of_birth=S, address=ADDRESS,
    risk_score=D, is_corporate=B, company_name=S, company_registration=S, created_at=S,
)
POLICY = _struct(
    id=S, policy_number=S, policyholder_id=S, policy_type=S, start_date=S, end_date=S,
    premium_amount=D, sum_insured=D, deductible=D, is_active=B, risk_profile=S, underwriter=S,
    broker=S, created_at=S, updated_at=S,
)
ENVELOPE_CLAIM = _struct(
    id=S, claim_number=S, policy_id=S, policyholder_id=S, claim_type=S, status=S, incident_date=S,
    reported_date=S, claim_amount=D, approved_amount=D, description=S, location=ADDRESS,
    fraud_score=D, fraud_indicators=TEXTS, is_flagged=B,
)
FRAUD_ANALYSIS = _struct(
    fraud_score=D, risk_level=S, fraud_indicators=TEXTS, is_flagged=B, confidence=D,
    recommended_action=S,
)
ENVELOPE = _struct(
    event_id=S, event_type=S, partition_key=S,
    data=_struct(policy=POLICY, policyholder=POLICYHOLDER, claim=ENVELOPE_CLAIM,
                 fraud_analysis=FRAUD_ANALYSIS, id=S, fraud_score=D, claim_amount=D, claim_type=S),
    metadata=MapType(S, S), timestamp=S,
)
PERSONAL_CLAIM = _struct(
    claim_id=S, policy_number=S, customer_id=S, customer_name=S, customer_email=S, customer_phone=S,
    customer_address=S, postcode=S, claim_amount=D, claim_date=TS, claim_type=S, claim_status=S,
    fraud_score=D, incident_location=S, incident_description=S, claim_notes=S, uk_region=S,
    high_value_claim=B, suspicious_timing=B, is_suspicious=B, risk_level=S, processed_time=TS,
    processing_date=DATE,
)
AUDIT_EVENT = _struct(
    audit_id=S, event_timestamp=TS, event_type=S, user_id=S, user_role=S, resource_type=S,
    resource_id=S, action=S, sensitivity_level=S, data_categories=TEXTS, access_reason=S,
    ip_address=S, session_id=S, success=B, error_message=S, gdpr_article=S, retention_days=I,
    processing_date=DATE,
)
METRIC_POINT = _struct(name=S, value=D, metric_type=S, ts=TS, tags=MapType(S, S), unit=S)

# Tables the catalogue set-up creates: layer -> table -> (schema, partition columns).
TABLES = {
    "bronze": {
        "claims_raw": (BRONZE_CLAIM, ["ingestion_date"]),
        "policies_raw": (POLICY, []),
        "customers_raw": (POLICYHOLDER, []),
        "dead_letter_queue": (DEAD_LETTER, []),
    },
    "silver": {
        "claims": (StructType(SILVER_CLAIM.fields + [StructField("claim_day", DATE)]), ["claim_day"]),
        "claims_processed": (PERSONAL_CLAIM, ["processing_date"]),
        "policies": (_struct(
            policy_number=S, customer_id=S, policy_type=S, start_date=DATE, end_date=DATE,
            policy_duration_days=I, premium_amount=MONEY, premium_monthly=MONEY,
            coverage_limit=BIG_MONEY, deductible=MONEY, risk_score=D, risk_category=S, underwriter=S,
            is_active=B, days_until_renewal=I, claims_count=I, total_claims_amount=BIG_MONEY,
            loss_ratio=D, profitability_score=D, _silver_timestamp=TS, _scd_start_date=TS,
            _scd_end_date=TS, _scd_is_current=B), ["policy_type"]),
        "customers": (_struct(
            customer_id=S, customer_hash=S, age_band=S, postcode_district=S, city=S, country=S,
            registration_year=I, customer_segment=S, lifetime_value=BIG_MONEY, lifetime_value_band=S,
            total_policies=I, active_policies=I, total_claims=I, total_claims_amount=BIG_MONEY,
            average_claim_amount=MONEY, fraud_risk_score=D, churn_risk_score=D,
            is_vulnerable_customer=B, gdpr_consent=B, gdpr_consent_date=DATE,
            data_retention_date=DATE, _silver_timestamp=TS), []),
        "dim_postcode_risk": (_struct(
            postcode_district=S, region=S, flood_risk_level=S, crime_risk_level=S,
            average_property_value=BIG_MONEY, population_density=S, urban_rural_classification=S,
            historical_claim_frequency=D, historical_claim_severity=D, risk_score=D,
            last_updated=DATE), []),
        "dim_insurance_products": (_struct(
            product_code=S, product_name=S, product_type=S, product_category=S, min_coverage=MONEY,
            max_coverage=BIG_MONEY, base_premium=MONEY, risk_factors=TEXTS, excluded_conditions=TEXTS,
            regulatory_requirements=TEXTS, is_active=B, launch_date=DATE, discontinue_date=DATE), []),
    },
    "gold": {
        "daily_claims_summary": (_struct(
            claim_type=S, total_claims=L, total_amount=D, average_amount=D, median_amount=D,
            min_amount=D, max_amount=D, stddev_amount=D, fraud_detected_count=L,
            fraud_detected_amount=D, avg_fraud_score=D, manual_review_count=L, auto_approved_count=L,
            rejected_count=L, processing_time_avg_ms=D, processing_time_p95_ms=L,
            processing_time_p99_ms=L, avg_data_quality=D, avg_validation_score=D, fraud_rate=D,
            auto_approval_rate=D, summary_date=DATE), ["summary_date"]),
        "fraud_metrics": (_struct(
            metric_hour=I, total_claims_evaluated=L, fraud_alerts_generated=L, high_risk_flagged=L,
            sent_to_investigation=L, avg_original_fraud_score=D, avg_adjusted_fraud_score=D,
            max_fraud_score=D, p90_fraud_score=D, total_fraud_prevented_gbp=D,
            avg_fraud_amount_gbp=D, top_fraud_patterns=TEXTS, high_risk_postcodes=TEXTS,
            avg_detection_time_ms=D, fraud_detection_rate=D, alert_to_investigation_rate=D,
            metric_date=DATE), ["metric_date"]),
        "operational_kpis": (_struct(
            kpi_name=S, kpi_value=D, kpi_target=D, kpi_status=S, variance_from_target=D,
            trend_7_day=S, trend_30_day=S, kpi_date=DATE), ["kpi_date"]),
        "customer_risk_profiles": (_struct(
            customer_id=S, total_claims=L, total_claimed_amount=D, avg_claim_amount=D,
            fraud_risk_score=D, fraud_incidents=L, claims_frequency_score=D,
            claims_severity_score=D, last_claim_date=TS, risk_segment=S, overall_risk_rating=S,
            recommended_premium_adjustment=D), []),
        "anomaly_scores": (_struct(
            claim_id=S, claim_date=TS, customer_id=S, claim_type=S, claim_amount_gbp=D,
            incident_postcode=S, statistical_anomaly_score=D, time_series_anomaly_score=D,
            geographic_anomaly_score=D, customer_anomaly_score=D, network_anomaly_score=D,
            composite_anomaly_score=D, anomaly_severity=S, anomaly_reasons=TEXTS,
            investigation_priority=I, amount_anomaly=B, timing_anomaly=B, fraud_score_anomaly=B,
            velocity_anomaly=D, geo_concentration_ratio=D, customer_frequency_anomaly=D,
            anomaly_detection_timestamp=TS), []),
    },
    "gdpr": {
        "audit_log": (AUDIT_EVENT, ["processing_date"]),
        "pii_classified_claims": (_struct(
            claim_id=S, customer_id=S, scan_timestamp=TS, claim_notes_pii=S,
            incident_description_pii=S, customer_address_pii=S, overall_sensitivity=S,
            contains_pii=B, gdpr_risk_score=D, processing_date=DATE), ["processing_date"]),
    },
}
