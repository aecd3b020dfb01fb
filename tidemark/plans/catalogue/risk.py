"""Registered queries of the rule engine, geography, rating and fraud scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import refdata
from tidemark.config import FraudConfig
from tidemark.functions import rules
from tidemark.operators import business_rules as br
from tidemark.operators import fraud, geo, scenarios
from tidemark.plans import inputs
from tidemark.plans.catalogue.common import in_list, register, src, ts, values_sql
from tidemark.plans.catalogue.medallion import AS_OF, POLICY_CTE
from tidemark.plans.claims import as_of

# ---------------------------------------------------------------------------------- rules
RULE_CTE = f"""rin AS (SELECT a.*, {ts('a.claim_s')} AS claim_date, {ts('a.incident_s')} AS incident_date,
  {ts('a.consent_s')} AS consent_date, {ts('p.end_s')} AS policy_end_date,
  CAST(floor((a.claim_s - a.incident_s) / 86400e0) AS BIGINT) AS delay, CAST(floor((p.end_s - a.claim_s) / 86400e0) AS BIGINT) AS remaining,
  CAST(floor((epoch({AS_OF}) - a.consent_s) / 86400e0) AS BIGINT) AS consent_age,
  CASE product WHEN 'motor' THEN 5000e0 WHEN 'home' THEN 15000e0 WHEN 'travel' THEN 2000e0 WHEN 'pet' THEN 1000e0
    WHEN 'life' THEN 100000e0 END AS typical,
  list_filter([CASE WHEN regexp_matches(coalesce(incident_location, ''), '^(B1|B2|B3|M1|M2|M3|L1|L2|L3)') AND fault_percentage = 100
      AND witness_count = 0 THEN 'POSSIBLE_STAGED_ACCIDENT' END,
    CASE WHEN accident_type = 'rear_end' AND medical_report_delay_days > 14 THEN 'DELAYED_WHIPLASH_CLAIM' END,
    CASE WHEN fault_percentage = 0 AND witness_count > 3 THEN 'EXCESSIVE_WITNESSES' END], lambda v: v IS NOT NULL) AS motor_found,
  list_filter([CASE WHEN customer_age > 80 THEN 'elderly customer' END, CASE WHEN has_disability THEN 'disability' END,
    CASE WHEN financial_difficulty THEN 'financial difficulty' END, CASE WHEN recent_bereavement THEN 'recent bereavement' END],
    lambda v: v IS NOT NULL) AS fca_found,
  CASE a.underwriter WHEN 'Hiscox' THEN '33' WHEN 'Beazley' THEN '2623' WHEN 'Catlin' THEN '2003' WHEN 'Amlin' THEN '2001' END AS syndicate
  FROM ({src('rule_attributes')}) a LEFT JOIN ({src('policies')}) p ON a.policy_number = p.policy_number),
r1 AS (SELECT claim_id, CASE WHEN claim_amount > policy_limit THEN 'CLAIM_001' WHEN claim_amount > policy_limit * 95e-2 THEN 'CLAIM_002'
    WHEN claim_amount > typical * 3 THEN 'CLAIM_003' ELSE 'CLAIM_001' END AS rule_id,
  NOT coalesce(claim_amount > policy_limit OR claim_amount > policy_limit * 95e-2 OR claim_amount > typical * 3, false) AS passed,
  CASE WHEN claim_amount > policy_limit THEN 'CRITICAL' WHEN claim_amount > policy_limit * 95e-2 THEN 'HIGH'
    WHEN claim_amount > typical * 3 THEN 'MEDIUM' ELSE 'INFO' END AS severity,
  CASE WHEN claim_amount > policy_limit THEN 'AUTO_REJECT' WHEN claim_amount > policy_limit * 95e-2 OR claim_amount > typical * 3
    THEN 'MANUAL_REVIEW' ELSE 'CONTINUE' END AS action,
  CASE WHEN claim_amount > policy_limit THEN 'Claim Exceeds Policy Limit' WHEN claim_amount > policy_limit * 95e-2 THEN 'Suspicious Amount Near Limit'
    WHEN claim_amount > typical * 3 THEN 'Unusually High Claim' ELSE 'Claim Amount Valid' END AS rule_name FROM rin),
r2 AS (SELECT claim_id, claim_type <> 'motor' OR len(motor_found) = 0 AS passed,
  CASE WHEN claim_type <> 'motor' THEN 'MOTOR_001' ELSE 'MOTOR_002' END AS rule_id,
  CASE WHEN claim_type = 'motor' AND len(motor_found) > 0 THEN 'HIGH' ELSE 'INFO' END AS severity,
  CASE WHEN claim_type = 'motor' AND len(motor_found) > 0 THEN 'FRAUD_INVESTIGATION' ELSE 'CONTINUE' END AS action,
  CASE WHEN claim_type <> 'motor' THEN 'Rule applies only to motor claims' WHEN len(motor_found) > 0
    THEN 'Fraud patterns detected: ' || array_to_string(motor_found, ', ') ELSE 'No motor fraud patterns detected' END AS message FROM rin),
r3 AS (SELECT claim_id, action = 'CONTINUE' AS passed, CASE action WHEN 'CONTINUE' THEN 'WEATHER_001' ELSE rid END AS rule_id,
  CASE action WHEN 'CONTINUE' THEN 'INFO' ELSE 'MEDIUM' END AS severity, action, message FROM (SELECT claim_id,
  CASE WHEN claim_type NOT IN ('storm_damage', 'flood', 'wind_damage', 'weather') THEN 'CONTINUE'
    WHEN claim_type = 'flood' AND left(coalesce(incident_location, ''), 2) NOT IN {in_list(refdata.FLOOD_AREAS)} THEN 'MANUAL_REVIEW'
    WHEN weather_event IS NOT NULL THEN 'MANUAL_REVIEW' ELSE 'CONTINUE' END AS action,
  CASE WHEN claim_type = 'flood' AND left(coalesce(incident_location, ''), 2) NOT IN {in_list(refdata.FLOOD_AREAS)} THEN 'WEATHER_002'
    ELSE 'WEATHER_003' END AS rid,
  CASE WHEN claim_type NOT IN ('storm_damage', 'flood', 'wind_damage', 'weather') THEN 'Not a weather-related claim'
    WHEN claim_type = 'flood' AND left(coalesce(incident_location, ''), 2) NOT IN {in_list(refdata.FLOOD_AREAS)}
      THEN 'Flood claim in area ' || left(coalesce(incident_location, ''), 2) || ' not typically at flood risk'
    WHEN weather_event IS NOT NULL THEN 'Claim filed immediately after weather event' ELSE 'Weather claim appears legitimate' END AS message FROM rin)),
r4 AS (SELECT claim_id, true AS passed, 'FCA_001' AS rule_id, CASE WHEN len(fca_found) > 0 THEN 'HIGH' ELSE 'INFO' END AS severity,
  CASE WHEN len(fca_found) > 0 THEN 'ESCALATE' ELSE 'CONTINUE' END AS action,
  CASE WHEN len(fca_found) > 0 THEN 'FCA vulnerable customer: ' || array_to_string(fca_found, ', ') ELSE 'No vulnerability indicators' END AS message FROM rin),
r5 AS (SELECT claim_id, gdpr_consent AND NOT coalesce(consent_age > 365, false) AND data_retention_years <= 7 AS passed,
  CASE WHEN NOT gdpr_consent THEN 'GDPR_001' WHEN consent_age > 365 THEN 'GDPR_002' WHEN data_retention_years > 7 THEN 'GDPR_003'
    ELSE 'GDPR_001' END AS rule_id,
  CASE WHEN NOT gdpr_consent THEN 'CRITICAL' WHEN consent_age > 365 THEN 'HIGH' WHEN data_retention_years > 7 THEN 'MEDIUM' ELSE 'INFO' END AS severity,
  CASE WHEN NOT gdpr_consent THEN 'AUTO_REJECT' WHEN consent_age > 365 OR data_retention_years > 7 THEN 'MANUAL_REVIEW' ELSE 'CONTINUE' END AS action,
  CASE WHEN NOT gdpr_consent THEN 'Cannot process claim without GDPR consent'
    WHEN consent_age > 365 THEN 'GDPR consent expired (' || consent_age || ' days old)'
    WHEN data_retention_years > 7 THEN 'Data retention period (' || data_retention_years || ' years) exceeds guidelines'
    ELSE 'GDPR requirements satisfied' END AS message FROM rin),
r6 AS (SELECT claim_id, syndicate IS NULL OR NOT (claim_amount < 50000 AND NOT is_reinsurance) AS passed,
  CASE WHEN syndicate IS NOT NULL AND claim_amount < 50000 AND NOT is_reinsurance THEN 'LLOYDS_002' ELSE 'LLOYDS_001' END AS rule_id,
  CASE WHEN syndicate IS NOT NULL AND claim_amount < 50000 AND NOT is_reinsurance THEN 'MEDIUM' ELSE 'INFO' END AS severity,
  CASE WHEN syndicate IS NOT NULL AND claim_amount < 50000 AND NOT is_reinsurance THEN 'MANUAL_REVIEW' ELSE 'CONTINUE' END AS action,
  CASE WHEN syndicate IS NULL THEN 'Not Lloyd''s Claim' WHEN claim_amount < 50000 AND NOT is_reinsurance THEN 'Unusual Lloyd''s Small Claim'
    ELSE 'Valid Lloyd''s Claim' END AS rule_name FROM rin),
r7 AS (SELECT claim_id, CASE WHEN delay > 90 THEN 'TIMING_001' WHEN remaining BETWEEN 0 AND 30 THEN 'TIMING_002' WHEN delay < 0 THEN 'TIMING_003'
    ELSE 'TIMING_001' END AS rule_id, NOT (delay > 90 OR remaining BETWEEN 0 AND 30 OR delay < 0) AS passed,
  CASE WHEN delay > 90 THEN 'HIGH' WHEN remaining BETWEEN 0 AND 30 THEN 'MEDIUM' WHEN delay < 0 THEN 'CRITICAL' ELSE 'INFO' END AS severity,
  CASE WHEN delay > 90 OR remaining BETWEEN 0 AND 30 THEN 'MANUAL_REVIEW' WHEN delay < 0 THEN 'FRAUD_INVESTIGATION' ELSE 'CONTINUE' END AS action,
  CASE WHEN delay > 90 THEN 'Claim filed ' || delay || ' days after incident' WHEN remaining BETWEEN 0 AND 30 THEN 'Claim filed ' || remaining
    || ' days before policy expires' WHEN delay < 0 THEN 'Claim date is before incident date' ELSE 'Claim filed ' || delay || ' days after incident' END
  AS message FROM rin),
applied AS (
  SELECT r1.claim_id, passed, rule_id, severity, action, 1 AS o FROM r1 JOIN rin USING (claim_id) WHERE policy_limit IS NOT NULL
  UNION ALL SELECT r2.claim_id, passed, rule_id, severity, action, 2 FROM r2 JOIN rin USING (claim_id) WHERE claim_type = 'motor'
  UNION ALL SELECT r3.claim_id, passed, rule_id, severity, action, 3 FROM r3 JOIN rin USING (claim_id)
    WHERE claim_type IN ('storm_damage', 'flood', 'wind_damage')
  UNION ALL SELECT r4.claim_id, passed, rule_id, severity, action, 4 FROM r4 JOIN rin USING (claim_id) WHERE customer_age IS NOT NULL
  UNION ALL SELECT claim_id, passed, rule_id, severity, action, 5 FROM r5
  UNION ALL SELECT r7.claim_id, passed, rule_id, severity, action, 6 FROM r7 JOIN rin USING (claim_id) WHERE policy_end_date IS NOT NULL)"""


def on_rules(key, shape, make, body):
    register(key, shape, lambda s, d: make(inputs.rule_input(s, d)), f"WITH {RULE_CTE} {body}")


def one_rule(key, rule, cte, extra):
    shape = f"claim_id:s passed:b rule_id:s severity:s action:s {extra}:s"
    on_rules(key, shape, lambda df: br.apply_rule(df, rule()), f"SELECT * FROM {cte}")


one_rule("rule_amount_limit", rules.amount_limit, "r1", "rule_name")
one_rule("rule_motor_fraud", rules.motor_fraud, "r2", "message")
one_rule("rule_weather", rules.weather, "r3", "message")
one_rule("rule_fca_vulnerable", rules.fca_vulnerable, "r4", "message")
one_rule("rule_gdpr", lambda: rules.gdpr(as_of()), "r5", "message")
one_rule("rule_lloyds", rules.lloyds_market, "r6", "rule_name")
one_rule("rule_timing", rules.claim_timing, "r7", "message")
on_rules("evaluate_all_rules", "claim_id:s passed:b rule_id:s severity:s action:s",
         lambda df: br.rule_results_long(br.evaluate_all_rules(df, as_of())), "SELECT * FROM applied")
on_rules("determine_claim_action", "claim_id:s claim_action:s failed_rules:a escalations:a",
         lambda df: br.determine_claim_action(br.evaluate_all_rules(df, as_of())),
         """SELECT claim_id, coalesce(list(rule_id ORDER BY o) FILTER (NOT passed), []) AS failed_rules,
         coalesce(list(rule_id) FILTER (passed AND action = 'ESCALATE'), []) AS escalations,
         CASE min(CASE action WHEN 'AUTO_REJECT' THEN 1 WHEN 'FRAUD_INVESTIGATION' THEN 2 WHEN 'ESCALATE' THEN 3 WHEN 'MANUAL_REVIEW' THEN 4
           ELSE 6 END) FILTER (NOT passed) WHEN 1 THEN 'AUTO_REJECT' WHEN 2 THEN 'FRAUD_INVESTIGATION' WHEN 4 THEN 'MANUAL_REVIEW'
           ELSE 'AUTO_APPROVE' END AS claim_action FROM applied GROUP BY claim_id""")
on_rules("rule_summary", "rule_id:s severity:s action:s failures:i",
         lambda df: br.rule_summary(br.evaluate_all_rules(df, as_of())),
         "SELECT rule_id, severity, action, count(*) AS failures FROM applied WHERE NOT passed GROUP BY ALL")

# ---------------------------------------------------------------------------------- geography
_PARTS = refdata.POSTCODE_PARTS
PROFILE_ROWS = f"""{values_sql(refdata.AREA_PROFILES)} AS p(area, profile_region, risk_zone, base_risk_score, crime_rate, flood_risk,
  average_income, population_density, motor_theft_rate, burglary_rate, latitude, longitude, major_city)"""
CASE_CTE = f"""{POLICY_CTE},
claim AS (SELECT *, {ts('incident_s')} AS incident_date, {ts('reported_s')} AS reported_date FROM ({src('claims')})),
pc AS (SELECT *, CASE WHEN regexp_matches(clean, '{_PARTS}') THEN regexp_extract(clean, '{_PARTS}', 1) END AS pc_area FROM
  (SELECT *, replace(upper(incident_postcode), ' ', '') AS clean FROM claim)),
hp AS (SELECT *, CASE WHEN regexp_matches(clean, '{_PARTS}') THEN regexp_extract(clean, '{_PARTS}', 1) END AS pc_area FROM
  (SELECT *, replace(upper(holder_postcode), ' ', '') AS clean FROM holder)),
cases AS (SELECT c.*, p.policy_type, p.start_date, p.end_date, p.start_s, p.end_s, p.sum_insured, p.deductible, h.email, h.company_registration,
  h.holder_postcode, h.risk_score AS holder_risk_score, h.pc_area AS holder_area,
  date_diff('year', date_of_birth, {AS_OF}) - (strftime({AS_OF}, '%m%d') < strftime(date_of_birth, '%m%d'))::INT AS holder_age,
  CAST(floor((c.incident_s - p.start_s) / 86400e0) AS BIGINT) AS since_start, CAST(floor((c.reported_s - c.incident_s) / 86400e0) AS BIGINT) AS delay,
  CAST(floor((p.end_s - c.incident_s) / 86400e0) AS BIGINT) AS to_end
  FROM pc c LEFT JOIN policy p ON c.policy_number = p.policy_number LEFT JOIN hp h ON c.policyholder_id = h.policyholder_id)"""


def on_claims(key, shape, make, body):
    register(key, shape, lambda s, d: make(inputs.normal_claims(s, d)), f"WITH {CASE_CTE} {body}")


def on_holders(key, shape, make, body):
    register(key, shape, lambda s, d: make(inputs.holders(s, d)), f"WITH {CASE_CTE} {body}")


def case_frame(s, d):
    return fraud.case_file(inputs.normal_claims(s, d), inputs.policies(s, d), inputs.holders(s, d), as_of())


def on_cases(key, shape, make, body):
    register(key, shape, lambda s, d: make(case_frame(s, d)), f"WITH {CASE_CTE} {body}")


on_holders("parse_postcode", "policyholder_id:s full_postcode:s area:s district:s sector:s unit:s outward:s inward:s",
           lambda df: geo.parse_postcode(df, "holder_postcode").select("policyholder_id", "postcode_parts.*").withColumnRenamed("full", "full_postcode"),
           f"""SELECT policyholder_id, CASE WHEN ok THEN upper(holder_postcode) END AS full_postcode, pc_area AS area,
           CASE WHEN ok THEN a || n END AS district, CASE WHEN ok THEN a || n || ' ' || s END AS sector, CASE WHEN ok THEN u END AS unit,
           CASE WHEN ok THEN a || n END AS outward, CASE WHEN ok THEN s || u END AS inward FROM (SELECT *, pc_area IS NOT NULL AS ok,
           regexp_extract(clean, '{_PARTS}', 1) AS a, regexp_extract(clean, '{_PARTS}', 2) AS n, regexp_extract(clean, '{_PARTS}', 3) AS s,
           regexp_extract(clean, '{_PARTS}', 4) AS u FROM hp)""")
on_claims("postcode_profile",
          "claim_id:s region:s risk_zone:s base_risk_score:d crime_rate:d flood_risk:d average_income:d population_density:d "
          "motor_theft_rate:d burglary_rate:d latitude:d longitude:d major_city:s",
          lambda df: geo.postcode_profile(df, "incident_postcode"),
          f"SELECT *, profile_region AS region FROM pc LEFT JOIN {PROFILE_ROWS} ON pc_area = area")
on_claims("postcode_risk_score", "claim_id:s postcode_risk:d",
          lambda df: geo.postcode_risk_score(df, "incident_postcode", {
              "crime_weight": 1.0, "flood_weight": 0.8, "income_weight": 0.5, "density_weight": 0.5}),
          f"""SELECT claim_id, CASE WHEN base_risk_score IS NULL THEN 5e-1 ELSE greatest(0e0, least(1e0, base_risk_score
          + crime_rate / 100e0 * 1e0 * 2e-1 + flood_risk * 8e-1 * 15e-2 + (1 - average_income / 75000e0) * 5e-1 * 1e-1
          + least(population_density / 10000e0, 1e0) * 5e-1 * 1e-1)) END AS postcode_risk FROM pc LEFT JOIN {PROFILE_ROWS} ON pc_area = area""")
_F = "(1 / 298257223563e-9)"
register("postcode_distance", "claim_id:s distance_km:d",
         lambda s, d: geo.postcode_distance(case_frame(s, d), "incident_postcode", "holder_postcode"),
         f"""WITH {CASE_CTE}, prof AS (SELECT area, latitude, longitude FROM {PROFILE_ROWS}),
         g AS (SELECT claim_id, atan((1 - {_F}) * tan(radians(a.latitude))) AS b1, atan((1 - {_F}) * tan(radians(b.latitude))) AS b2,
           radians(b.longitude - a.longitude) AS l FROM cases LEFT JOIN prof a ON pc_area = a.area LEFT JOIN prof b ON holder_area = b.area),
         h AS (SELECT *, 2 * asin(sqrt(least(1e0, pow(sin((b2 - b1) / 2), 2) + cos(b1) * cos(b2) * pow(sin(l / 2), 2)))) AS g,
           (b1 + b2) / 2 AS p, (b2 - b1) / 2 AS q FROM g)
         SELECT claim_id, CASE WHEN g = 0 THEN 0e0 ELSE 6378137e-3 * (g - {_F} / 2 * (
           (g - sin(g)) * pow(sin(p), 2) * pow(cos(q), 2) / nullif(pow(cos(g / 2), 2), 0)
           + (g + sin(g)) * pow(cos(p), 2) * pow(sin(q), 2) / nullif(pow(sin(g / 2), 2), 0))) END AS distance_km FROM h""")
for _group in ("high", "low"):
    on_claims(f"claims_by_{_group}_zone", "area:s risk_zone:s claims:i",
              lambda df, g=_group: geo.claims_by_zone(df, "incident_postcode", g),
              f"""SELECT area, risk_zone, count(claim_id) AS claims FROM {PROFILE_ROWS} LEFT JOIN pc ON pc_area = area
              WHERE risk_zone IN ('{_group}', 'very_{_group}') GROUP BY ALL""")
on_claims("geographic_concentration",
          "city:s total_postcodes:i unique_areas:i most_common_area:s concentration_ratio:d average_risk_score:d clusters:s "
          "high_concentration:b suspicious_clustering:b",
          lambda df: geo.geographic_concentration(df, "city", "incident_postcode").withColumn(
              "clusters", F.array_join(F.transform(F.array_sort(F.map_entries("clusters")),
                                                   lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), "|")),
          f"""SELECT *, ratio AS concentration_ratio, ratio > 3e-1 AS high_concentration, ratio > 5e-1 AND average_risk_score > 6e-1
            AS suspicious_clustering FROM (
          SELECT city, sum(n) AS total_postcodes, count(pc_area) AS unique_areas,
            arg_min(pc_area, {{'m': -n, 'a': pc_area}}) FILTER (pc_area IS NOT NULL) AS most_common_area,
            coalesce(max(n) FILTER (pc_area IS NOT NULL), 0) / sum(n) AS ratio,
            coalesce(sum(n * base_risk_score) / sum(n) FILTER (base_risk_score IS NOT NULL), 0) AS average_risk_score,
            coalesce(string_agg(pc_area || '=' || n, '|' ORDER BY pc_area) FILTER (pc_area IS NOT NULL AND n >= greatest(3e0, total * 1e-1)), '')
              AS clusters
          FROM (SELECT c.city, c.pc_area, base_risk_score, count(*) AS n, any_value(total) AS total FROM pc c
                JOIN (SELECT city, count(*) AS total FROM pc GROUP BY city) t ON t.city = c.city
                LEFT JOIN {PROFILE_ROWS} ON c.pc_area = area GROUP BY ALL) GROUP BY city)""")
on_holders("policyholder_risk_score", "policyholder_id:s holder_risk:d",
           lambda df: geo.policyholder_risk_score(df, as_of()),
           f"""SELECT policyholder_id, greatest(0e0, least(1e0, coalesce(base, 5e-1) + CASE WHEN age < 25 THEN 3e-1 WHEN age < 30 THEN 2e-1
           WHEN age < 60 THEN 0e0 ELSE 1e-1 END + CASE WHEN is_corporate THEN -1e-1 ELSE 0e0 END)) AS holder_risk FROM (
           SELECT *, floor(floor((epoch({AS_OF}) - dob_s) / 86400e0) / 365e0) AS age,
             CASE WHEN split_part(holder_postcode, ' ', 1) <> '' THEN left(split_part(holder_postcode, ' ', 1), length(split_part(holder_postcode, ' ', 1)) - 1) END AS zone
           FROM holder) LEFT JOIN {values_sql(refdata.UNDERWRITING_RISK)} AS u(z, base) ON zone = z""")
on_holders("risk_profile_band", "policyholder_id:s risk_profile:s",
           lambda df: df.withColumn("risk_profile", geo.risk_profile_band(F.col("risk_score"))),
           """SELECT policyholder_id, CASE WHEN risk_score < 3e-1 THEN 'low' WHEN risk_score < 6e-1 THEN 'medium' WHEN risk_score < 8e-1
           THEN 'high' ELSE 'very_high' END AS risk_profile FROM holder""")
register("base_premium_rating",
         "policy_number:s base_premium:d sum_insured_in_band:b deductible_in_band:b",
         lambda s, d: geo.base_premium_rating(inputs.policies(s, d).join(
             inputs.holders(s, d).select("policyholder_id", "risk_score"), "policyholder_id")),
         f"""WITH {CASE_CTE} SELECT policy_number, pmin + (pmax - pmin) * risk_score AS base_premium,
         sum_insured BETWEEN premium_amount * imin AND premium_amount * imax AS sum_insured_in_band,
         deductible BETWEEN sum_insured * dmin AND sum_insured * dmax AS deductible_in_band
         FROM policy JOIN holder USING (policyholder_id) LEFT JOIN {values_sql(refdata.RATING)}
           AS r(kind, pmin, pmax, imin, imax, dmin, dmax) ON policy_type = kind""")
register("renewals_due", "policy_number:s policyholder_id:s start_date:t end_date:t premium_amount:d sum_insured:d deductible:d",
         lambda s, d: geo.renewals_due(inputs.policies(s, d), as_of("2025-01-01 00:00:00"), as_of("2025-03-01 00:00:00"), 2025, 1.05, 1.02),
         f"""WITH {POLICY_CTE} SELECT policy_number || '-R2025' AS policy_number, policyholder_id, end_date AS start_date,
         end_date + INTERVAL 365 DAYS AS end_date, round(premium_amount * 105e-2, 2) AS premium_amount, sum_insured * 102e-2 AS sum_insured, deductible
         FROM policy WHERE end_date >= TIMESTAMP '2025-01-01' AND end_date < TIMESTAMP '2025-03-01'""")
on_cases("claim_severity_vs_band", "claim_id:s severity:d band_low:d band_high:d out_of_band:b", geo.claim_severity_vs_band,
         f"""SELECT claim_id, claim_amount / sum_insured AS severity, coalesce(lo, 1e-1) AS band_low, coalesce(hi, 5e-1) AS band_high,
         claim_amount / sum_insured < coalesce(lo, 1e-1) OR claim_amount / sum_insured > coalesce(hi, 5e-1) AS out_of_band
         FROM cases LEFT JOIN {values_sql(refdata.SEVERITY_BANDS)} AS b(kind, lo, hi) ON claim_type = kind""")


def _violations(*checks):
    return ("list_filter([" + ", ".join(f"CASE WHEN NOT coalesce({test}, false) THEN '{name}' END" for name, test in checks)
            + "], lambda v: v IS NOT NULL)")


_allowed_rows = [(p, c) for p, kinds in refdata.ALLOWED_CLAIM_TYPES.items() for c in kinds]
register("entity_validation", "entity_type:s entity_id:s violations:a is_valid:b",
         lambda s, d: geo.entity_validation(inputs.policies(s, d), inputs.holders(s, d), inputs.normal_claims(s, d)),
         f"""WITH {CASE_CTE} SELECT *, len(violations) = 0 AS is_valid FROM (
         SELECT 'policy' AS entity_type, policy_number AS entity_id, {_violations(
             ("policy_type", f"policy_type IN {in_list(refdata.POLICY_TYPES)}"), ("end_after_start", "end_date > start_date"),
             ("premium_positive", "premium_amount > 0"), ("sum_insured_positive", "sum_insured > 0"),
             ("deductible_not_negative", "deductible >= 0"), ("risk_profile", f"risk_profile IN {in_list(refdata.RISK_PROFILES)}"))}
           AS violations FROM policy
         UNION ALL SELECT 'policyholder', policyholder_id, {_violations(
             ("postcode", f"regexp_matches(replace(upper(holder_postcode), ' ', ''), '{refdata.ENTITY_POSTCODE}')"),
             ("risk_score_range", "risk_score BETWEEN 0 AND 1"))} FROM holder
         UNION ALL SELECT 'claim', claim_id, {_violations(
             ("claim_type", f"claim_type IN {in_list(refdata.CLAIM_TYPES)}"), ("claim_status", f"claim_state IN {in_list(refdata.CLAIM_STATUSES)}"),
             ("amount_positive", "claim_amount > 0"), ("fraud_score_range", "fraud_score BETWEEN 0 AND 1"),
             ("reported_after_incident", "reported_date >= incident_date"), ("allowed_for_policy", "w.p IS NOT NULL"))}
           FROM cases LEFT JOIN {values_sql(_allowed_rows)} AS w(p, c) ON w.p = policy_type AND w.c = claim_type)""")
register("entity_derivations", "claim_id:s age:i reporting_delay_days:i",
         lambda s, d: geo.entity_derivations(inputs.normal_claims(s, d), inputs.holders(s, d), as_of()),
         f"WITH {CASE_CTE} SELECT claim_id, holder_age AS age, delay AS reporting_delay_days FROM cases")

# ---------------------------------------------------------------------------------- fraud signals
NETWORK = FraudConfig(neighbour_score=0.4)
_AMOUNT_SHARE = "CASE WHEN sum_insured > 0 THEN claim_amount / sum_insured ELSE 0e0 END"
_TEXT = " + ".join(f"contains(lower(coalesce({{0}}, '')), '{p}')::INT" for p in refdata.SUSPICIOUS_PHRASES)
SIGNAL_CTE = CASE_CTE + f""",
edge0 AS ({src('edges')}),
edge AS (SELECT src, dst FROM edge0 WHERE src <> dst UNION SELECT dst, src FROM edge0 WHERE src <> dst),
listed AS (SELECT DISTINCT entity FROM (SELECT policyholder_id AS entity FROM holder WHERE right(policyholder_id, 2) = '13'
  UNION ALL SELECT email FROM holder WHERE right(policyholder_id, 2) = '29' UNION ALL SELECT 'REG7')),
sig0 AS (SELECT c.*, least(1e0, CASE WHEN since_start < 30 THEN 6e-1 WHEN since_start < 60 THEN 3e-1 ELSE 0e0 END
    + CASE WHEN delay > 30 THEN 3e-1 WHEN delay > 14 THEN 1e-1 ELSE 0e0 END + CASE WHEN to_end < 30 THEN 2e-1 ELSE 0e0 END
    + CASE WHEN dayofweek(incident_date) IN (0, 6) THEN 1e-1 ELSE 0e0 END) AS timing,
  coalesce(since_start < 30 OR delay > 30, false) AS suspicious_timing, {_AMOUNT_SHARE} > 8e-1 AS inflated,
  least(1e0, CASE WHEN {_AMOUNT_SHARE} > 8e-1 THEN 5e-1 WHEN {_AMOUNT_SHARE} > 6e-1 THEN 3e-1 WHEN {_AMOUNT_SHARE} > 4e-1 THEN 1e-1 ELSE 0e0 END
    + CASE WHEN claim_amount < deductible * 11e-1 THEN 2e-1 ELSE 0e0 END
    + CASE WHEN claim_amount % 1000 = 0 THEN 1e-1 WHEN claim_amount % 500 = 0 THEN 5e-2 ELSE 0e0 END) AS amount,
  count(*) OVER y AS prior_claims_365d, count(*) OVER w AS alike, min(incident_s) OVER (PARTITION BY policyholder_id) < incident_s AS has_history,
  CASE WHEN left(coalesce(incident_postcode, ''), 3) <> '' AND left(coalesce(holder_postcode, ''), 3) <> ''
    AND left(incident_postcode, 3) <> left(holder_postcode, 3) THEN 3e-1 ELSE 0e0 END
    + CASE WHEN regexp_matches(coalesce(incident_postcode, ''), '^(E|SE|EC|WC|B|M|L)') THEN 2e-1 ELSE 0e0 END AS geographic,
  least(1e0, ({_TEXT.format('description')}) * 2e-1) AS text_analysis,
  coalesce(holder_risk_score, 0e0) + CASE WHEN holder_age < 25 THEN 1e-1 WHEN holder_age > 75 THEN 5e-2 ELSE 0e0 END AS own_risk,
  EXISTS (SELECT 1 FROM listed l WHERE l.entity IN (c.policyholder_id, c.email, c.company_registration)) AS blacklisted
  FROM cases c WINDOW y AS (PARTITION BY policyholder_id ORDER BY incident_s RANGE BETWEEN 31536000 PRECEDING AND 1 PRECEDING),
  w AS (PARTITION BY policyholder_id, claim_type ORDER BY incident_s RANGE BETWEEN 518400 PRECEDING AND 1 PRECEDING)),
sig AS (SELECT *, least(1e0, CASE WHEN prior_claims_365d > 5 THEN 6e-1 WHEN prior_claims_365d > 3 THEN 3e-1 WHEN prior_claims_365d > 2 THEN 1e-1
    ELSE 0e0 END + CASE WHEN alike > 0 THEN 5e-1 ELSE 0e0 END) AS frequency FROM sig0),
base AS (SELECT *, timing * 25e-2 + amount * 2e-1 + CASE WHEN has_history THEN frequency * 15e-2 ELSE 0e0 END + geographic * 1e-1
  + text_analysis * 5e-2 + CASE WHEN blacklisted THEN 5e-1 ELSE 0e0 END AS score_base,
  row_number() OVER (PARTITION BY policyholder_id ORDER BY incident_s, claim_id) AS rn FROM sig)"""


def sequence_sql(name, source, base):
    return f"""{name} AS (
  SELECT claim_id, policyholder_id, rn, least(own_risk, 1e0) AS policyholder_risk, least({base} + 15e-2 * least(own_risk, 1e0), 1e0) AS score,
    least({base} + 15e-2 * least(own_risk, 1e0), 1e0) AS total FROM {source} WHERE rn = 1
  UNION ALL SELECT n.claim_id, n.policyholder_id, n.rn, least((own_risk + p.total / p.rn) / 2, 1e0),
    least({base} + 15e-2 * least((own_risk + p.total / p.rn) / 2, 1e0), 1e0),
    p.total + least({base} + 15e-2 * least((own_risk + p.total / p.rn) / 2, 1e0), 1e0)
  FROM {name} p JOIN {source} n ON n.policyholder_id = p.policyholder_id AND n.rn = p.rn + 1)"""


def blacklist_frame(s, d):
    holders = inputs.holders(s, d)
    ids = holders.where("right(policyholder_id, 2) = '13'").select(F.col("policyholder_id").alias("entity"))
    mails = holders.where("right(policyholder_id, 2) = '29'").select(F.col("email").alias("entity"))
    return ids.union(mails).union(s.sql("SELECT 'REG7' AS entity"))


def on_signals(key, shape, make, body):
    register(key, shape, lambda s, d: make(case_frame(s, d)), f"WITH RECURSIVE {SIGNAL_CTE} {body}")


on_signals("signal_timing", "claim_id:s timing:d", fraud.signal_timing, "SELECT claim_id, timing FROM sig")
on_signals("signal_amount", "claim_id:s amount:d", fraud.signal_amount, "SELECT claim_id, amount FROM sig")
register("signal_frequency", "claim_id:s prior_claims_365d:i frequency:d has_history:b",
         lambda s, d: fraud.signal_frequency(case_frame(s, d), inputs.normal_claims(s, d)),
         f"WITH {SIGNAL_CTE} SELECT * FROM sig")
on_signals("signal_geographic", "claim_id:s geographic:d", fraud.signal_geographic, "SELECT claim_id, geographic FROM sig")
register("signal_text", "doc_id:i text_analysis:d",
         lambda s, d: fraud.signal_text(inputs.read(s, d, "documents"), "text"),
         f"SELECT doc_id, least(1e0, ({_TEXT.format('text')}) * 2e-1) AS text_analysis FROM documents")
on_signals("signal_text_claims", "claim_id:s text_analysis:d", fraud.signal_text, "SELECT claim_id, text_analysis FROM sig")
register("signal_network", "policyholder_id:s fraud_connections:i network:d",
         lambda s, d: fraud.signal_network(inputs.derived(s, d, "edges"), fraud.mean_scores(inputs.normal_claims(s, d)), NETWORK),
         f"""WITH {SIGNAL_CTE}, m AS (SELECT policyholder_id, avg(fraud_score) AS mean_score FROM claim GROUP BY 1)
         SELECT *, CASE WHEN fraud_connections > 2 THEN 8e-1 WHEN fraud_connections > 0 THEN 4e-1 ELSE 0e0 END AS network FROM (
         SELECT src AS policyholder_id, count(*) FILTER (mean_score > 4e-1) AS fraud_connections FROM edge LEFT JOIN m ON dst = policyholder_id GROUP BY src)""")
register("blacklist_check", "policyholder_id:s blacklisted:b",
         lambda s, d: fraud.blacklist_check(inputs.holders(s, d), blacklist_frame(s, d)),
         f"""WITH {SIGNAL_CTE} SELECT policyholder_id, EXISTS (SELECT 1 FROM listed l
         WHERE l.entity IN (h.policyholder_id, h.email, h.company_registration)) AS blacklisted FROM holder h""")
register("signal_policyholder_risk", "claim_id:s claim_number:i policyholder_risk:d running_score:d",
         lambda s, d: fraud.signal_policyholder_risk(case_frame(s, d).withColumn("score_base", F.col("fraud_score"))),
         f"""WITH RECURSIVE {SIGNAL_CTE}, {sequence_sql('seq', 'base', 'fraud_score')}
         SELECT claim_id, rn AS claim_number, policyholder_risk, score AS running_score FROM seq""")


def analysis_frame(s, d):
    return fraud.fraud_score(inputs.normal_claims(s, d), inputs.policies(s, d), inputs.holders(s, d),
                             inputs.derived(s, d, "edges"), blacklist_frame(s, d), as_of(), NETWORK)


_ANALYSIS_SQL = f"""WITH RECURSIVE {SIGNAL_CTE}, {sequence_sql('first', 'base', 'score_base')},
means AS (SELECT policyholder_id, avg(score) AS mean_score FROM first GROUP BY 1),
net AS (SELECT src AS policyholder_id, CASE WHEN n > 2 THEN 8e-1 WHEN n > 0 THEN 4e-1 ELSE 0e0 END AS network FROM (
  SELECT src, count(*) FILTER (mean_score > 4e-1) AS n FROM edge LEFT JOIN means ON dst = policyholder_id GROUP BY src)),
linked AS (SELECT b.* EXCLUDE (score_base), coalesce(n.network, 0e0) AS network, score_base + coalesce(n.network, 0e0) * 1e-1 AS score_base
  FROM base b LEFT JOIN net n ON b.policyholder_id = n.policyholder_id),
{sequence_sql('second', 'linked', 'score_base')},
analysed AS (SELECT l.*, s.score AS analysis_score, s.policyholder_risk, list_filter([timing, amount, CASE WHEN has_history THEN frequency END,
    geographic, s.policyholder_risk, network, text_analysis, CASE WHEN blacklisted THEN 1e0 END], lambda v: v IS NOT NULL) AS signals
  FROM linked l JOIN second s ON l.claim_id = s.claim_id)
SELECT *, CASE WHEN analysis_score >= 9e-1 THEN 'CRITICAL' WHEN analysis_score >= 8e-1 THEN 'HIGH' WHEN analysis_score >= 6e-1 THEN 'MEDIUM'
    WHEN analysis_score >= 3e-1 THEN 'LOW' ELSE 'MINIMAL' END AS risk_level,
  CASE WHEN analysis_score >= 9e-1 THEN 'IMMEDIATE_INVESTIGATION_REQUIRED' WHEN analysis_score >= 8e-1 THEN 'MANUAL_REVIEW_REQUIRED'
    WHEN analysis_score >= 6e-1 THEN 'ADDITIONAL_DOCUMENTATION_REQUIRED' WHEN analysis_score >= 3e-1 THEN 'STANDARD_PROCESSING_WITH_MONITORING'
    ELSE 'STANDARD_PROCESSING' END AS recommended_action, analysis_score > 6e-1 AS is_flagged,
  list_sort(list_filter([CASE WHEN suspicious_timing THEN 'suspicious_timing' END, CASE WHEN inflated THEN 'inflated_amount' END,
    CASE WHEN has_history AND prior_claims_365d > 5 THEN 'unusual_frequency' END, CASE WHEN has_history AND alike > 0 THEN 'duplicate_claim' END,
    CASE WHEN blacklisted THEN 'blacklisted_entity' END], lambda v: v IS NOT NULL)) AS analysis_indicators,
  least(len(list_filter(signals, lambda v: v > 3e-1)) * 2e-1, 1e0) * (1 - list_stddev_pop(signals)) AS confidence FROM analysed"""
register("fraud_score",
         "claim_id:s timing:d amount:d frequency:d geographic:d policyholder_risk:d network:d text_analysis:d blacklisted:b "
         "analysis_score:d risk_level:s recommended_action:s is_flagged:b analysis_indicators:a",
         analysis_frame, _ANALYSIS_SQL)
register("fraud_confidence", "claim_id:s confidence:d", analysis_frame, _ANALYSIS_SQL)
_TRACK_SQL = """SELECT *, CASE WHEN claim_number >= 3 THEN m END AS recent_mean, coalesce(claim_number >= 3 AND m > 8e-1, false) AS blacklists_holder
  FROM (SELECT *, row_number() OVER (PARTITION BY policyholder_id ORDER BY incident_s, claim_id) AS claim_number,
  avg(fraud_score) OVER (PARTITION BY policyholder_id ORDER BY incident_s, claim_id ROWS 2 PRECEDING) AS m FROM claim)"""
on_claims("fraud_tracking", "policyholder_id:s claim_id:s claim_number:i recent_mean:d blacklists_holder:b",
          fraud.fraud_tracking, _TRACK_SQL)
register("fraud_statistics",
         "total_claims_analyzed:i unique_policyholders:i high_risk_policyholders:i average_fraud_score:d blacklisted_entities:i network_connections:i",
         lambda s, d: fraud.fraud_statistics(inputs.normal_claims(s, d), blacklist_frame(s, d), inputs.derived(s, d, "edges"),
                                             cfg=FraudConfig(high=0.5)),
         f"""WITH {SIGNAL_CTE}, h AS (SELECT policyholder_id, avg(fraud_score) AS m FROM claim GROUP BY 1)
         SELECT (SELECT count(*) FROM claim) AS total_claims_analyzed, (SELECT count(*) FROM h) AS unique_policyholders,
         (SELECT count(*) FROM h WHERE m > 5e-1) AS high_risk_policyholders, (SELECT avg(fraud_score) FROM claim) AS average_fraud_score,
         (SELECT count(*) FROM listed) AS blacklisted_entities, (SELECT count(*) FROM edge) AS network_connections""")
on_cases("fraud_patterns_rule_score", "claim_id:s pattern_score:d pattern_flagged:b", fraud.pattern_rule_score,
         """SELECT claim_id, least(1e0, s) AS pattern_score, s > 6e-1 AS pattern_flagged FROM (SELECT claim_id,
         CASE WHEN since_start < 30 THEN 3e-1 ELSE 0e0 END + CASE WHEN claim_amount > sum_insured * 5e-1 THEN 25e-2 ELSE 0e0 END
         + CASE WHEN delay > 30 THEN 2e-1 ELSE 0e0 END + CASE WHEN holder_risk_score > 7e-1 THEN 15e-2 ELSE 0e0 END AS s FROM cases)""")

# ---------------------------------------------------------------------------------- scenarios
SCENARIO_CTE = CASE_CTE + """,
early AS (SELECT * FROM cases WHERE since_start < 30 AND fraud_score >= 7e-1),
inflated AS (SELECT * FROM cases WHERE claim_amount / nullif(sum_insured, 0) >= 8e-1),
alike AS (SELECT *, regexp_extract(incident_postcode, '^([A-Z]{1,2})[0-9]', 1) AS postcode_area FROM claim WHERE claim_amount BETWEEN 5000 AND 60000),
linked AS (SELECT *, lag(incident_s) OVER (PARTITION BY postcode_area, claim_type ORDER BY incident_s, claim_id) AS before
  FROM alike WHERE postcode_area <> ''),
chained AS (SELECT *, max(CASE WHEN before IS NULL OR incident_s - before > 172800 THEN incident_s END) OVER (
  PARTITION BY postcode_area, claim_type ORDER BY incident_s, claim_id ROWS UNBOUNDED PRECEDING) AS ring_start_s FROM linked),
rings AS (SELECT postcode_area, claim_type, ring_start_s, count(*) AS claims, count(DISTINCT policyholder_id) AS holders,
  sum(claim_amount) AS total_amount, min(incident_s) AS first_s, max(incident_s) AS last_s, avg(fraud_score) AS avg_score
  FROM chained GROUP BY ALL HAVING count(DISTINCT policyholder_id) >= 3),
members AS (SELECT c.* FROM chained c JOIN rings r USING (postcode_area, claim_type, ring_start_s)),
flagged AS (SELECT *, count(*) OVER w AS flagged_claims, count(DISTINCT policy_type) OVER w AS flagged_types FROM cases WHERE fraud_score > 6e-1
  WINDOW w AS (PARTITION BY policyholder_id ORDER BY incident_s RANGE BETWEEN 10368000 PRECEDING AND CURRENT ROW)),
repeats AS (SELECT * FROM flagged WHERE flagged_claims >= 3),
phantom AS (SELECT * FROM cases WHERE claim_type = 'theft' AND delay >= 30 AND claim_amount BETWEEN 10000 AND 25000
  AND contains(lower(description), 'no witnesses')),
opportunistic AS (SELECT *, claim_amount / nullif(approved_amount, 0) AS inflation_factor, claim_amount - approved_amount AS excess_amount FROM cases
  WHERE claim_type = 'collision' AND claim_amount / nullif(approved_amount, 0) >= 2)"""


# The generated amounts are spread widely; the ring band is widened so that rings occur.
_RING_AMOUNTS = (5000, 60000)


def _ring_members(df):
    return scenarios.ring_members(df, amounts=_RING_AMOUNTS)


def on_scenarios(key, shape, make, body):
    register(key, shape, lambda s, d: make(case_frame(s, d)), f"WITH {SCENARIO_CTE} {body}")


on_scenarios("detect_early_claims", "claim_id:s policy_age_days:i fraud_score:d", scenarios.detect_early_claims,
             "SELECT *, since_start AS policy_age_days FROM early")
on_scenarios("detect_inflated_claims", "claim_id:s insured_share:d", scenarios.detect_inflated_claims,
             "SELECT *, claim_amount / sum_insured AS insured_share FROM inflated")
on_scenarios("detect_fraud_rings",
             "postcode_area:s claim_type:s ring_start_s:i claims:i holders:i total_amount:m first_s:i last_s:i avg_score:d",
             lambda df: scenarios.detect_fraud_rings(_ring_members(df)), "SELECT * FROM rings")
on_scenarios("ring_members", "claim_id:s postcode_area:s claim_type:s ring_start_s:i policyholder_id:s",
             _ring_members, "SELECT * FROM members")
on_scenarios("ring_edges", "src:s dst:s", lambda df: scenarios.ring_edges(_ring_members(df)),
             """, hub AS (SELECT postcode_area, claim_type, ring_start_s, min(policyholder_id) AS src FROM members GROUP BY ALL)
             SELECT DISTINCT src, policyholder_id AS dst FROM members JOIN hub USING (postcode_area, claim_type, ring_start_s)
             WHERE src <> policyholder_id""")
on_scenarios("detect_repeat_offenders", "claim_id:s policyholder_id:s flagged_claims:i flagged_types:i",
             scenarios.detect_repeat_offenders, "SELECT * FROM repeats")
# The holder's policies by claim: with one policy a holder, several policy types could not occur.
_TYPED = "CASE CAST(right(claim_id, 3) AS INT) % 3 WHEN 0 THEN 'motor' WHEN 1 THEN 'property' ELSE 'marine' END"
on_scenarios("detect_repeat_offenders_types", "claim_id:s policyholder_id:s policy_type:s flagged_claims:i flagged_types:i",
             lambda df: scenarios.detect_repeat_offenders(df.withColumn("policy_type", F.expr(_TYPED)), claims=2, policy_types=2, score=0.3),
             f""", typed AS (SELECT * EXCLUDE (policy_type), {_TYPED} AS policy_type FROM cases WHERE fraud_score > 3e-1)
             SELECT * FROM (SELECT *, count(*) OVER w AS flagged_claims, count(DISTINCT policy_type) OVER w AS flagged_types FROM typed
             WINDOW w AS (PARTITION BY policyholder_id ORDER BY incident_s RANGE BETWEEN 10368000 PRECEDING AND CURRENT ROW))
             WHERE flagged_claims >= 2 AND flagged_types >= 2""")
on_scenarios("detect_phantom_claims", "claim_id:s reporting_delay_days:i claim_amount:d", scenarios.detect_phantom_claims,
             "SELECT *, delay AS reporting_delay_days FROM phantom")
on_scenarios("detect_opportunistic", "claim_id:s inflation_factor:d excess_amount:d", scenarios.detect_opportunistic,
             "SELECT * FROM opportunistic")
on_scenarios("scenario_summary", "scenario:s claims:i total_amount:m max_score:d avg_score:d detection_rate:d",
             lambda df: scenarios.scenario_summary(df, ring_amounts=_RING_AMOUNTS),
             " UNION ALL ".join(
                 f"""SELECT '{name}' AS scenario, count(*) AS claims, sum(claim_amount) AS total_amount, max(fraud_score) AS max_score,
                 avg(fraud_score) AS avg_score, count(*) FILTER (fraud_score > 7e-1) / count(*) AS detection_rate FROM {table} HAVING count(*) > 0"""
                 for name, table in [("early_claim_fraud", "early"), ("inflated_claim_fraud", "inflated"), ("fraud_ring", "members"),
                                     ("repeat_offender", "repeats"), ("phantom_claim", "phantom"), ("opportunistic_fraud", "opportunistic")]))
register("ring_components", "node:s component:s",
         lambda s, d: scenarios.ring_components(scenarios.ring_edges(_ring_members(case_frame(s, d)))),
         f"""WITH RECURSIVE {SCENARIO_CTE}, hub AS (SELECT postcode_area, claim_type, ring_start_s, min(policyholder_id) AS src FROM members GROUP BY ALL),
         pair AS (SELECT DISTINCT src, policyholder_id AS dst FROM members JOIN hub USING (postcode_area, claim_type, ring_start_s)
           WHERE src <> policyholder_id),
         both_ways AS (SELECT src, dst FROM pair UNION SELECT dst, src FROM pair),
         reached(node, origin) AS (SELECT src, src FROM both_ways UNION SELECT b.dst, r.origin FROM reached r JOIN both_ways b ON b.src = r.node)
         SELECT node, min(origin) AS component FROM reached GROUP BY node""")
