"""Registered queries of data protection, audit, retention and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import refdata
from tidemark.functions import masking
from tidemark.operators import audit, monitoring, privacy, retention
from tidemark.plans import inputs
from tidemark.plans.catalogue.common import register, register_twin, src, values_sql
from tidemark.plans.catalogue.medallion import PERSONAL_CTE, personal_derived
from tidemark.plans.claims import as_of
from tidemark.session import work_path
from tidemark.sources import keyed

# ---------------------------------------------------------------------------------- detection
_LEVEL = {"NONE": 0, "LOW": 1, "MEDIUM": 2, "HIGH": 3}


def _count(column, kind, pattern):
    return f"len(regexp_extract_all(coalesce({column}, ''), '(?i){pattern}')) AS n_{kind}"


def _counts(column):
    return ", ".join(_count(column, kind, pattern) for kind, pattern, _, _ in refdata.PII_PATTERNS)


def _sensitivity(prefix=""):
    by_level = {level: " OR ".join(f"{prefix}n_{k} > 0" for k, _, s, _ in refdata.PII_PATTERNS if s == level)
                for level in ("HIGH", "MEDIUM", "LOW")}
    return ("CASE " + " ".join(f"WHEN {test} THEN '{level}'" for level, test in by_level.items()) + " ELSE 'NONE' END")


_TOTAL = "(" + " + ".join(f"n_{k}" for k, _, _, _ in refdata.PII_PATTERNS) + ")"
_CATEGORIES = ("list_sort(list_distinct(list_filter([" + ", ".join(
    f"CASE WHEN n_{k} > 0 THEN '{c}' END" for k, _, _, c in refdata.PII_PATTERNS) + "], lambda v: v IS NOT NULL)))")
_FINDINGS = "list_filter([" + ", ".join(
    f"CASE WHEN n_{k} > 0 THEN '{k}:' || n_{k} END" for k, _, _, _ in refdata.PII_PATTERNS) + "], lambda v: v IS NOT NULL)"
_FOUND = f"SELECT *, {_sensitivity()} AS sensitivity, {_CATEGORIES} AS categories, {_FINDINGS} AS kinds, {_TOTAL} AS pii_count"


def _findings(df, ids, column):
    return privacy.pii.with_findings(df.select(*ids, column), {"p": column}).select(
        *ids, "p.sensitivity", "p.categories", "p.pii_count",
        F.transform("p.findings", lambda f: F.concat_ws(":", f["type"], f["n"])).alias("kinds"))


for _key, _column in [("detect_pii", "incident_description"), ("detect_pii_notes", "claim_notes")]:
    register(_key, "claim_id:s sensitivity:s categories:a pii_count:i kinds:a",
             lambda s, d, c=_column: _findings(inputs.personal_claims(s, d), ["claim_id"], c),
             f"{_FOUND} FROM (SELECT claim_id, {_counts(_column)} FROM ({src('personal')}))")
for _table, _ids in [("documents", ("doc_id",)), ("conversations", ("conv_id", "turn"))]:
    register(f"detect_pii_{_table}", " ".join(f"{i}:i" for i in _ids) + " sensitivity:s categories:a pii_count:i kinds:a",
             lambda s, d, t=_table, ids=_ids: _findings(inputs.read(s, d, t), ids, "text"),
             f"{_FOUND} FROM (SELECT *, {_counts('text')} FROM {_table})")

_SCAN = {label: f"t_{label}" for label in privacy.SCANNED}
_SCAN_CTES = ", ".join(
    f"t_{label} AS (SELECT claim_id, {_sensitivity()} AS {label}_sensitivity FROM (SELECT claim_id, {_counts(column)} FROM derived))"
    for label, column in privacy.SCANNED.items())
_SENS = [f"{label}_sensitivity" for label in privacy.SCANNED]
CLASSIFIED_CTE = f"""{PERSONAL_CTE}, {_SCAN_CTES},
scan AS (SELECT * FROM derived {' '.join(f'JOIN {t} USING (claim_id)' for t in _SCAN.values())}),
classified AS (SELECT *, overall_sensitivity <> 'NONE' AS contains_pii, CASE overall_sensitivity WHEN 'HIGH' THEN 1e0 WHEN 'MEDIUM' THEN 5e-1
  WHEN 'LOW' THEN 2e-1 ELSE 0e0 END AS gdpr_risk_score FROM (SELECT *, CASE WHEN 'HIGH' IN ({', '.join(_SENS)}) THEN 'HIGH'
  WHEN 'MEDIUM' IN ({', '.join(_SENS)}) THEN 'MEDIUM' WHEN 'LOW' IN ({', '.join(_SENS)}) THEN 'LOW' ELSE 'NONE' END AS overall_sensitivity FROM scan))"""


def classified(s, d):
    return privacy.classify_claims(personal_derived(s, d))


def on_classified(key, shape, make, body):
    register(key, shape, lambda s, d: make(classified(s, d)), f"WITH {CLASSIFIED_CTE} {body}")


register("pii_scan_columns", "claim_id:s " + " ".join(f"{c}:s" for c in _SENS),
         lambda s, d: privacy.pii_scan_columns(personal_derived(s, d)), f"WITH {CLASSIFIED_CTE} SELECT * FROM scan")
on_classified("overall_sensitivity", "claim_id:s overall_sensitivity:s contains_pii:b gdpr_risk_score:d", lambda df: df,
              "SELECT * FROM classified")
register("sample_scan", "claim_id:s overall_sensitivity:s",
         lambda s, d: privacy.classify_claims(privacy.sample_scan(personal_derived(s, d), 0.1, key="claim_id")),
         f"""WITH {CLASSIFIED_CTE} SELECT * FROM classified
         WHERE CAST('0x' || left(md5(claim_id), 8) AS BIGINT) % 10000 < 1000""")
on_classified("pii_totals",
              "total_records:i records_with_pii:i high_sensitivity:i medium_sensitivity:i low_sensitivity:i avg_risk_score:d",
              privacy.pii_totals,
              """SELECT count(*) AS total_records, count(*) FILTER (contains_pii) AS records_with_pii,
              count(*) FILTER (overall_sensitivity = 'HIGH') AS high_sensitivity, count(*) FILTER (overall_sensitivity = 'MEDIUM') AS medium_sensitivity,
              count(*) FILTER (overall_sensitivity = 'LOW') AS low_sensitivity, avg(gdpr_risk_score) AS avg_risk_score FROM classified""")
on_classified("pii_summary", "overall_sensitivity:s records:i percentage:d", privacy.pii_summary,
              """SELECT overall_sensitivity, count(*) AS records, round(count(*) * 1e2 / sum(count(*)) OVER (), 2) AS percentage
              FROM classified GROUP BY overall_sensitivity""")

# ---------------------------------------------------------------------------------- masking
_WORDS = "string_split_regex(trim(regexp_replace({0}, '\\s+', ' ', 'g')), ' ')"
_MASKS = {
    "mask_email": ("customer_email", masking.mask_email,
                   """CASE WHEN {0} IS NULL OR {0} = '' OR NOT contains({0}, '@') THEN {0} ELSE CASE WHEN length(split_part({0}, '@', 1)) > 2
                   THEN left({0}, 1) || repeat('*', length(split_part({0}, '@', 1)) - 2) || right(split_part({0}, '@', 1), 1) ELSE '***' END
                   || '@' || split_part({0}, '@', 2) END"""),
    "mask_phone": ("customer_phone", masking.mask_phone,
                   """CASE WHEN {0} IS NULL OR {0} = '' THEN {0} WHEN length(regexp_replace({0}, '[ -]', '', 'g')) >= 10 THEN
                   left(regexp_replace({0}, '[ -]', '', 'g'), 4) || repeat('*', length(regexp_replace({0}, '[ -]', '', 'g')) - 6)
                   || right(regexp_replace({0}, '[ -]', '', 'g'), 2) ELSE repeat('*', length(regexp_replace({0}, '[ -]', '', 'g'))) END"""),
    "mask_name": ("customer_name", masking.mask_name,
                  "CASE WHEN {0} IS NULL OR {0} = '' THEN {0} WHEN len(" + _WORDS + ") >= 2 THEN left(" + _WORDS + "[1], 1) || '*** ' || left("
                  + _WORDS + "[-1], 1) || '***' ELSE left({0}, 1) || '***' END"),
    "mask_address": ("customer_address", masking.mask_address,
                     "CASE WHEN {0} IS NULL OR {0} = '' THEN {0} WHEN len(" + _WORDS + ") > 1 AND regexp_extract({0}, '" + refdata.MASK_POSTCODE.replace("{", "{{").replace("}", "}}")
                     + "') <> '' THEN " + _WORDS + "[1] || ' ***, ' || left(regexp_extract({0}, '" + refdata.MASK_POSTCODE.replace("{", "{{").replace("}", "}}")
                     + "'), 2) || '** ***' ELSE " + _WORDS + "[1] || ' ***' END"),
    "hash_id": ("customer_id", masking.hash_id, "left(sha256({0} || '" + refdata.ID_SALT + "'), 16)"),
}
for _key, (_column, _mask, _sql) in _MASKS.items():
    register(_key, "claim_id:s masked:s",
             lambda s, d, c=_column, m=_mask: inputs.personal_claims(s, d).select("claim_id", m(F.col(c)).alias("masked")),
             f"WITH {PERSONAL_CTE} SELECT claim_id, {_sql.format(_column)} AS masked FROM personal")

_M = {name: sql.format(column) for name, (column, _, sql) in _MASKS.items()}
_RED = "'[REDACTED - Contains sensitive PII]'"
MASKED_CTE = CLASSIFIED_CTE + f""",
masked AS (SELECT *, overall_sensitivity AS sensitivity, gdpr_risk_score AS risk_score,
  CASE WHEN overall_sensitivity = 'HIGH' THEN {_M['mask_name']} ELSE customer_name END AS customer_name_masked,
  CASE WHEN overall_sensitivity IN ('HIGH', 'MEDIUM') THEN {_M['mask_email']} ELSE customer_email END AS customer_email_masked,
  CASE WHEN overall_sensitivity IN ('HIGH', 'MEDIUM') THEN {_M['mask_phone']} ELSE customer_phone END AS customer_phone_masked,
  CASE WHEN overall_sensitivity = 'HIGH' THEN {_M['mask_address']} ELSE customer_address END AS customer_address_masked,
  CASE WHEN overall_sensitivity = 'HIGH' THEN {_M['hash_id']} ELSE customer_id END AS customer_id_masked,
  CASE overall_sensitivity WHEN 'HIGH' THEN {_RED} WHEN 'MEDIUM' THEN regexp_replace(incident_description, '{refdata.MASK_DIGITS}', 'XXX', 'g')
    ELSE incident_description END AS incident_description_masked,
  CASE overall_sensitivity WHEN 'HIGH' THEN {_RED} WHEN 'MEDIUM' THEN regexp_replace(claim_notes, '{refdata.MASK_EMAIL}', '[EMAIL]', 'g')
    ELSE claim_notes END AS claim_notes_masked,
  overall_sensitivity <> 'NONE' AS masking_applied, CASE overall_sensitivity WHEN 'HIGH' THEN 'GDPR Article 9 - Special Category Data'
    WHEN 'MEDIUM' THEN 'GDPR Article 6 - Personal Data' WHEN 'LOW' THEN 'GDPR - Minimal Risk Data' ELSE 'No masking required' END AS masking_reason
  FROM classified)"""


def with_levels(s, d):
    """The claims classified in place: nothing has to be joined back."""
    return privacy.overall_sensitivity(privacy.pii_scan_columns(personal_derived(s, d)))


def masked(s, d):
    return privacy.dynamic_masking(with_levels(s, d), masked_at=as_of())


def on_masked(key, shape, make, body):
    register(key, shape, lambda s, d: make(masked(s, d)), f"WITH {MASKED_CTE} {body}")


on_masked("dynamic_masking",
          "claim_id:s sensitivity:s risk_score:d customer_name_masked:s customer_email_masked:s customer_phone_masked:s "
          "customer_address_masked:s customer_id_masked:s incident_description_masked:s claim_notes_masked:s masking_applied:b masking_reason:s",
          lambda df: df, "SELECT * FROM masked")
on_masked("analyst_view",
          "claim_id:s policy_number:s customer_id:s customer_name:s customer_email:s customer_phone:s customer_address:s claim_amount:d "
          "claim_date:D claim_type:s claim_status:s incident_location:s incident_description:s fraud_score:d risk_level:s uk_region:s",
          privacy.analyst_view,
          """SELECT claim_id, policy_number, customer_id_masked AS customer_id, customer_name_masked AS customer_name,
          customer_email_masked AS customer_email, customer_phone_masked AS customer_phone, customer_address_masked AS customer_address,
          claim_amount, claim_date, claim_type, claim_status, incident_location, incident_description_masked AS incident_description,
          fraud_score, risk_level, uk_region FROM masked""")
on_masked("partner_view",
          "claim_ref:s claim_amount:d claim_month:D claim_type:s claim_status:s uk_region:s risk_level:s fraud_indicator:d",
          privacy.partner_view,
          f"""SELECT left(sha256(claim_id || '{refdata.ID_SALT}'), 16) AS claim_ref, claim_amount, date_trunc('month', claim_date) AS claim_month,
          claim_type, claim_status, uk_region, risk_level, round(fraud_score, 1) AS fraud_indicator FROM masked""")
on_masked("audit_view", "claim_id:s sensitivity:s customer_name:s access_reason:s named:b",
          lambda df: privacy.audit_view(df).withColumn("named", F.length("accessed_by") > 0),
          "SELECT *, 'AUDIT_ACCESS' AS access_reason, true AS named FROM masked")
on_masked("masking_stats", "sensitivity:s record_count:i masked_count:i avg_risk_score:d unique_masked_ids:i unique_masked_emails:i",
          privacy.masking_stats,
          """SELECT sensitivity, count(*) AS record_count, count(*) FILTER (masking_applied) AS masked_count, avg(risk_score) AS avg_risk_score,
          count(DISTINCT customer_id_masked) AS unique_masked_ids, count(DISTINCT customer_email_masked) AS unique_masked_emails
          FROM masked GROUP BY sensitivity""")
on_classified("masking_policies", "overall_sensitivity:s policy_name:s mask_action:s records:i", privacy.effective_masking,
              f"""SELECT overall_sensitivity, policy_name, CASE overall_sensitivity WHEN 'HIGH' THEN h WHEN 'MEDIUM' THEN m WHEN 'LOW' THEN l ELSE n END
              AS mask_action, count(*) AS records FROM classified, {values_sql(refdata.MASKING_POLICIES)} AS p(policy_name, h, m, l, n) GROUP BY ALL""")

# ---------------------------------------------------------------------------------- audit
AUDIT_AS_OF = f"TIMESTAMP '{inputs.AUDIT_AS_OF}'"
LOG_CTE = f"""log AS (SELECT e.*, coalesce(a.article, '{refdata.DEFAULT_ARTICLE}') AS gdpr_article,
  coalesce(p.days, {refdata.DEFAULT_AUDIT_RETENTION}) AS retention_days, CAST(event_timestamp AS DATE) AS processing_date FROM ({src('audit_log')}) e
  LEFT JOIN {values_sql(refdata.GDPR_ARTICLES)} AS a(act, article) ON e.action = a.act
  LEFT JOIN {values_sql(refdata.AUDIT_RETENTION_DAYS)} AS p(kind, days) ON e.event_type = p.kind)"""


def log_frame(s, d):
    return audit.audit_events(inputs.audit_log(s, d), with_ids=False)


def on_log(key, shape, make, body):
    register(key, shape, lambda s, d: make(log_frame(s, d)), f"WITH {LOG_CTE} {body}")


audit_now = lambda: as_of(inputs.AUDIT_AS_OF)
on_log("audit_events", "audit_id:s event_type:s action:s gdpr_article:s retention_days:i processing_date:D", lambda df: df, "SELECT * FROM log")
on_log("high_risk_access",
       "user_id:s access_count:i unique_resources:i high_sensitivity_access:i failed_attempts:i last_access:t",
       lambda df: audit.high_risk_access(df, audit_now(), hours=24 * 14),
       f"""SELECT * FROM (SELECT user_id, count(*) AS access_count, count(DISTINCT resource_id) AS unique_resources,
       count(*) FILTER (sensitivity_level = 'HIGH') AS high_sensitivity_access, count(*) FILTER (NOT success) AS failed_attempts,
       max(event_timestamp) AS last_access FROM log WHERE event_timestamp >= {AUDIT_AS_OF} - INTERVAL 336 HOURS GROUP BY user_id)
       WHERE high_sensitivity_access > 5 OR failed_attempts > 3""")
on_log("article_compliance", "gdpr_article:s action:s event_count:i unique_users:i success_rate:d active_days:i",
       lambda df: audit.article_compliance(df, audit_now()),
       f"""SELECT gdpr_article, action, count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
       avg(success::INT) * 100 AS success_rate, count(DISTINCT CAST(event_timestamp AS DATE)) AS active_days FROM log
       WHERE event_timestamp >= {AUDIT_AS_OF} - INTERVAL 30 DAYS GROUP BY ALL""")
on_log("access_anomalies", "user_id:s accesses_today:i high_sensitivity_today:i anomaly_score:d",
       lambda df: audit.access_anomalies(df, audit_now()),
       """SELECT * FROM (SELECT r.user_id, accesses_today, high_sensitivity_today, CASE WHEN high_sensitivity_today > rate * 10 THEN 1e0
         WHEN accesses_today > total * 5e-1 THEN 8e-1 WHEN types_today > types * 2 THEN 6e-1 ELSE 0e0 END AS anomaly_score FROM
         (SELECT user_id, count(*) FILTER (sensitivity_level = 'HIGH') AS high_sensitivity_today, count(*) AS accesses_today,
           count(DISTINCT resource_type) AS types_today FROM log WHERE event_timestamp >= TIMESTAMP '2024-01-30' GROUP BY 1) r
         LEFT JOIN (SELECT user_id, avg((sensitivity_level = 'HIGH')::INT) AS rate, count(*) AS total, count(DISTINCT resource_type) AS types
           FROM log WHERE event_timestamp >= TIMESTAMP '2024-01-01' GROUP BY 1) b ON r.user_id = b.user_id) WHERE anomaly_score > 5e-1""")
on_log("audit_totals", "total_events:i unique_users:i high_sensitivity_accesses:i failed_accesses:i success_rate:d", audit.audit_totals,
       """SELECT count(*) AS total_events, count(DISTINCT user_id) AS unique_users, count(*) FILTER (sensitivity_level = 'HIGH')
       AS high_sensitivity_accesses, count(*) FILTER (NOT success) AS failed_accesses, avg(success::INT) AS success_rate FROM log""")
on_log("audit_dashboard", "sensitivity_level:s action:s event_count:i success_rate:d", audit.audit_dashboard,
       "SELECT sensitivity_level, action, count(*) AS event_count, avg(success::INT) * 100 AS success_rate FROM log GROUP BY ALL")
on_log("audit_retention", "audit_id:s days_old:i retention_days:i",
       lambda df: audit.audit_retention(df, as_of("2026-01-15 00:00:00"))[0],
       """SELECT *, date_diff('day', processing_date, DATE '2026-01-15') AS days_old FROM log
       WHERE date_diff('day', processing_date, DATE '2026-01-15') > retention_days""")
on_log("audit_retained", "audit_id:s retention_days:i", lambda df: audit.audit_retention(df, as_of("2026-01-15 00:00:00"))[1],
       "SELECT * FROM log WHERE date_diff('day', processing_date, DATE '2026-01-15') <= retention_days")
on_log("regulatory_report",
       "gdpr_article:s sensitivity_level:s total_operations:i unique_users:i unique_resources:i failed_operations:i first_access:t last_access:t",
       lambda df: audit.regulatory_report(df, audit_now()),
       """SELECT gdpr_article, sensitivity_level, count(*) AS total_operations, count(DISTINCT user_id) AS unique_users,
       count(DISTINCT resource_id) AS unique_resources, count(*) FILTER (NOT success) AS failed_operations, min(event_timestamp) AS first_access,
       max(event_timestamp) AS last_access FROM log WHERE event_timestamp >= TIMESTAMP '2024-01-01' GROUP BY ALL""")

# ---------------------------------------------------------------------------------- retention
RETAIN_CTE = CLASSIFIED_CTE + f""",
kept AS (SELECT *, retention_days - days_since_claim AS days_until_deletion, days_since_claim > retention_days AS past_retention,
  claim_date + CAST(retention_days AS INT) AS retention_end_date FROM (SELECT *, CASE retention_category WHEN 'fraud' THEN 3650 WHEN 'declined' THEN 1095
    ELSE 2555 END AS retention_days FROM (SELECT *, date_diff('day', claim_date, DATE '{inputs.RETENTION_AS_OF}') AS days_since_claim,
    CASE WHEN fraud_score > 8e-1 THEN 'fraud' WHEN claim_status = 'REJECTED' THEN 'declined' ELSE 'standard' END AS retention_category FROM classified)))"""


def retained(s, d):
    return retention.claims_retention(with_levels(s, d), as_of(inputs.RETENTION_AS_OF))


def on_retained(key, shape, make, body):
    register(key, shape, lambda s, d: make(retained(s, d)), f"WITH {RETAIN_CTE} {body}")


on_retained("claims_retention",
            "claim_id:s days_since_claim:i retention_category:s retention_days:i retention_end_date:D past_retention:b days_until_deletion:i "
            "overall_sensitivity:s", lambda df: df, "SELECT * FROM kept")
on_retained("retention_policies", "category:s policy_type:s retention_days:i description:s active:b claims_held:i", retention.policies_in_force,
            f"""SELECT category, policy_type, days AS retention_days, description, true AS active, count(claim_id) AS claims_held
            FROM {values_sql(refdata.RETENTION_POLICIES)} AS r(category, policy_type, days, description)
            LEFT JOIN kept ON category = 'claims' AND policy_type = retention_category GROUP BY ALL""")
on_retained("retention_counts", "retention_category:s past_retention:b records:i", retention.retention_counts,
            "SELECT retention_category, past_retention, count(*) AS records FROM kept GROUP BY ALL")
on_retained("retention_summary",
            "retention_category:s total_records:i overdue_records:i due_soon:i avg_age_days:d oldest_claim:D newest_claim:D overdue_percentage:d",
            retention.retention_summary,
            """SELECT retention_category, count(*) AS total_records, count(*) FILTER (past_retention) AS overdue_records,
            count(*) FILTER (days_until_deletion BETWEEN 0 AND 30) AS due_soon, round(avg(days_since_claim), 0) AS avg_age_days,
            min(claim_date) AS oldest_claim, max(claim_date) AS newest_claim,
            round(count(*) FILTER (past_retention) * 1e2 / count(*), 2) AS overdue_percentage FROM kept GROUP BY retention_category""")
on_retained("deletion_candidates",
            "claim_id:s customer_id:s claim_date:D retention_category:s retention_days:i days_since_claim:i",
            retention.deletion_candidates, "SELECT * FROM kept WHERE past_retention")
on_retained("deletion_schedule", "deletion_date:D records_to_delete:i categories:a high_sensitivity_records:i",
            lambda df: retention.deletion_schedule(df, as_of(inputs.RETENTION_AS_OF)),
            f"""SELECT DATE '{inputs.RETENTION_AS_OF}' + CAST(days_until_deletion AS INT) AS deletion_date, count(*) AS records_to_delete,
            list_sort(list(DISTINCT retention_category)) AS categories, count(*) FILTER (overall_sensitivity = 'HIGH') AS high_sensitivity_records
            FROM kept WHERE days_until_deletion BETWEEN 0 AND 30 GROUP BY 1""")
on_retained("retention_compliance", "retention_category:s status:s record_count:i min_days:i max_days:i", retention.retention_compliance,
            """SELECT retention_category, CASE WHEN days_until_deletion < 0 THEN 'OVERDUE' WHEN days_until_deletion < 30 THEN 'DUE_SOON'
            WHEN days_until_deletion < 180 THEN 'UPCOMING' ELSE 'COMPLIANT' END AS status, count(*) AS record_count,
            min(days_until_deletion) AS min_days, max(days_until_deletion) AS max_days FROM kept GROUP BY ALL""")
ERASE_CTE = PERSONAL_CTE + f""", asked AS ({src('requests')}),
holds AS (SELECT customer_id, count(*) AS hold_count FROM derived WHERE (fraud_score > 8e-1 OR claim_status = 'DISPUTED')
  AND customer_id IN (SELECT customer_id FROM asked) GROUP BY 1),
granted AS (SELECT * FROM asked WHERE customer_id NOT IN (SELECT customer_id FROM holds)),
hit AS (SELECT * FROM derived WHERE customer_id IN (SELECT customer_id FROM granted))"""


def _erasure(part):
    return lambda s, d: retention.erasure(personal_derived(s, d), inputs.derived(s, d, "requests"), as_of())[part]


register("erasure",
         "claim_id:s customer_id:s customer_name:s customer_email:s customer_phone:s customer_address:s claim_amount:d claim_date:D "
         "claim_type:s claim_status:s incident_description:s claim_notes:s", _erasure(0),
         f"""WITH {ERASE_CTE} SELECT claim_id, 'DELETED_' || claim_id AS customer_id, 'ANONYMIZED' AS customer_name,
         'deleted@anonymous.com' AS customer_email, '0000000000' AS customer_phone, 'DELETED' AS customer_address, claim_amount, claim_date,
         claim_type, claim_status, '[REDACTED]' AS incident_description, '[REDACTED]' AS claim_notes FROM hit""")
register("erasure_log", "customer_id:s reason:s records_affected:i hold_count:i deletion_type:s retention_override:b", _erasure(1),
         f"""WITH {ERASE_CTE} SELECT a.customer_id, a.reason, coalesce(n, 0) AS records_affected, coalesce(hold_count, 0) AS hold_count,
         CASE WHEN hold_count > 0 THEN 'REFUSED_LEGAL_HOLD' ELSE 'ANONYMIZATION' END AS deletion_type, false AS retention_override
         FROM asked a LEFT JOIN holds USING (customer_id) LEFT JOIN (SELECT customer_id, count(*) AS n FROM hit GROUP BY 1) USING (customer_id)""")
register("export_customer_data",
         "claim_id:s policy_number:s customer_id:s customer_name:s customer_email:s customer_phone:s customer_address:s claim_amount:d claim_date:D "
         "claim_type:s claim_status:s incident_location:s incident_description:s overall_sensitivity:s gdpr_risk_score:d",
         lambda s, d: retention.export_customer_data(with_levels(s, d), inputs.derived(s, d, "requests")),
         f"WITH {CLASSIFIED_CTE}, asked AS ({src('requests')}) SELECT * FROM classified WHERE customer_id IN (SELECT customer_id FROM asked)")


def _looked_up(s, table, asked):
    """The rows of the asked customers out of a table that is clustered by customer."""
    path = work_path(s, "by-customer")
    keyed.write_keyed(table, path, "customer_id", ["claim_id"])
    return keyed.rows_of_keys(s.read.parquet(path), "customer_id", asked)


def _erasure_keyed(part):
    def run(s, d):
        asked = inputs.derived(s, d, "requests")
        return retention.erasure(_looked_up(s, personal_derived(s, d), asked), asked, as_of())[part]
    return run


def _export_keyed(s, d):
    asked = inputs.derived(s, d, "requests")
    return retention.export_customer_data(_looked_up(s, with_levels(s, d), asked), asked)


register_twin("erasure_keyed", "erasure", _erasure_keyed(0))
register_twin("erasure_log_keyed", "erasure_log", _erasure_keyed(1))
register_twin("export_keyed", "export_customer_data", _export_keyed)


def _export_log(s, d):
    path = work_path(s, "export")
    retention.write_export(retention.export_customer_data(with_levels(s, d), inputs.derived(s, d, "requests")), path)
    return retention.export_log(s, path).withColumn("folder", F.substring_index("export_path", "/", -1))


register("export_log", "customer_id:s records_exported:i format:s folder:s gdpr_article:s", _export_log,
         f"""WITH {PERSONAL_CTE}, asked AS ({src('requests')}) SELECT customer_id, count(*) AS records_exported, 'json' AS format,
         'export_part=' || left(sha256(customer_id), 2) AS folder, 'Article 20 - Data Portability' AS gdpr_article FROM derived
         WHERE customer_id IN (SELECT customer_id FROM asked) GROUP BY customer_id""")

# ---------------------------------------------------------------------------------- monitoring
DAY_MIN = 1440
SLA_CTE = f"""points AS ({src('metrics')}),
breaches AS (SELECT p.name AS metric_name, severity, value AS current_value, target AS threshold, ts, point_id, 'SLA breach: ' || p.name || ' is '
  || printf('%.2f', value) || ' (target: ' || comparison || ' ' || CASE WHEN target = floor(target) THEN CAST(CAST(target AS BIGINT) AS VARCHAR)
  ELSE CAST(target AS VARCHAR) END || ')' AS message FROM points p
  JOIN {values_sql(refdata.SLA_TARGETS)} AS t(name, target, comparison, minutes, severity) ON p.name = t.name
  WHERE CASE comparison WHEN 'less_than' THEN value >= target WHEN 'greater_than' THEN value <= target ELSE abs(value - target) > target * 1e-1 END)"""
_AGG = """count(*) AS "count", sum(value) AS "sum", avg(value) AS "avg", min(value) AS "min", max(value) AS "max"
  , arg_max(value, {'t': ts, 'p': point_id}) AS latest"""
register("metric_aggregates", "name:s points:i total:m mean:d lowest:d highest:d latest:d",
         lambda s, d: monitoring.metric_aggregates(inputs.metrics(s, d), audit_now(), DAY_MIN, "point_id").withColumnsRenamed(
             {"count": "points", "sum": "total", "avg": "mean", "min": "lowest", "max": "highest"}),
         f"""WITH {SLA_CTE} SELECT name, count(*) AS points, sum(value) AS total, avg(value) AS mean, min(value) AS lowest, max(value) AS highest,
         arg_max(value, {{'t': ts, 'p': point_id}}) AS latest FROM points WHERE ts >= {AUDIT_AS_OF} - INTERVAL 1 DAY GROUP BY name""")
register("sla_breaches", "point_id:i metric_name:s severity:s message:s current_value:d threshold:d",
         lambda s, d: monitoring.sla_breaches(inputs.metrics(s, d)), f"WITH {SLA_CTE} SELECT * FROM breaches")
register("active_alerts", "severity:s alerts:i",
         lambda s, d: monitoring.alert_counts(monitoring.sla_breaches(inputs.metrics(s, d)), audit_now(), DAY_MIN),
         f"WITH {SLA_CTE} SELECT severity, count(*) AS alerts FROM breaches WHERE ts >= {AUDIT_AS_OF} - INTERVAL 1 DAY GROUP BY severity")
HEALTH_CTE = f"""lpoints AS ({src('layer_metrics')}),
agg AS (SELECT name, avg(value) AS a, sum(value) AS s FROM lpoints WHERE ts >= {AUDIT_AS_OF} - INTERVAL 1 DAY GROUP BY name),
checks AS (SELECT layer, check_name, value, CASE WHEN CASE healthy_when WHEN 'above' THEN value > bound ELSE value < bound END THEN 'healthy'
  ELSE worse END AS status FROM (SELECT c.*, CASE stat WHEN 'avg' THEN a ELSE s END AS value
  FROM {values_sql(refdata.HEALTH_CHECKS)} AS c(layer, check_name, metric, stat, healthy_when, bound, worse) JOIN agg ON agg.name = c.metric)),
layers AS (SELECT l.layer, count(check_name) AS checks, CASE WHEN bool_or(status = 'unhealthy') THEN 'unhealthy'
  WHEN bool_or(status IN ('degraded', 'warning')) THEN 'degraded' ELSE 'healthy' END AS status
  FROM (VALUES ('bronze'), ('silver'), ('gold')) AS l(layer) LEFT JOIN checks ON checks.layer = l.layer GROUP BY l.layer)"""
register("health_checks", "layer:s check_name:s value:d status:s",
         lambda s, d: monitoring.health_checks(inputs.metrics(s, d, "layer_metrics"), audit_now(), DAY_MIN),
         f"WITH {HEALTH_CTE} SELECT * FROM checks")
register("layer_health", "layer:s checks:i status:s",
         lambda s, d: monitoring.layer_health(monitoring.health_checks(inputs.metrics(s, d, "layer_metrics"), audit_now(), DAY_MIN)),
         f"WITH {HEALTH_CTE} SELECT * FROM layers")
register("overall_health",
         "overall_status:s bronze_status:s silver_status:s gold_status:s critical_alerts:i error_alerts:i warning_alerts:i "
         "throughput_avg:d latency_avg:d error_rate_avg:d fraud_detection_avg:d auto_approval_avg:d",
         lambda s, d: monitoring.overall_health(
             inputs.metrics(s, d).unionByName(inputs.metrics(s, d, "layer_metrics")), audit_now(), DAY_MIN, DAY_MIN, 288),
         f"""WITH {SLA_CTE}, {HEALTH_CTE.replace(f"lpoints AS ({src('layer_metrics')})", f"lpoints AS (SELECT * FROM points UNION ALL {src('layer_metrics')})")}
         SELECT CASE WHEN bool_or(status = 'unhealthy') THEN 'unhealthy' WHEN bool_or(status = 'degraded') THEN 'degraded' ELSE 'healthy' END AS overall_status,
         max(status) FILTER (layer = 'bronze') AS bronze_status, max(status) FILTER (layer = 'silver') AS silver_status,
         max(status) FILTER (layer = 'gold') AS gold_status,
         (SELECT count(*) FROM breaches WHERE severity = 'CRITICAL' AND ts >= {AUDIT_AS_OF} - INTERVAL 1 DAY) AS critical_alerts,
         (SELECT count(*) FROM breaches WHERE severity = 'ERROR' AND ts >= {AUDIT_AS_OF} - INTERVAL 1 DAY) AS error_alerts,
         (SELECT count(*) FROM breaches WHERE severity = 'WARNING' AND ts >= {AUDIT_AS_OF} - INTERVAL 1 DAY) AS warning_alerts,
         (SELECT avg(value) FROM points WHERE name = 'throughput_per_second' AND ts >= {AUDIT_AS_OF} - INTERVAL 1 DAY) AS throughput_avg,
         (SELECT avg(value) FROM points WHERE name = 'processing_latency_ms' AND ts >= {AUDIT_AS_OF} - INTERVAL 1 DAY) AS latency_avg,
         (SELECT avg(value) FROM points WHERE name = 'error_rate' AND ts >= {AUDIT_AS_OF} - INTERVAL 1 DAY) AS error_rate_avg,
         (SELECT avg(value) FROM points WHERE name = 'fraud_detection_rate' AND ts >= {AUDIT_AS_OF} - INTERVAL 3 DAY) AS fraud_detection_avg,
         (SELECT avg(value) FROM points WHERE name = 'auto_approval_rate') AS auto_approval_avg FROM layers""")


def _daily_usage(s, d):
    return inputs.metrics(s, d).groupBy(F.to_date("ts").alias("day")).agg(
        F.count("*").alias("events_processed"), F.lit(24.0).alias("compute_hours"),
        (F.count("*") / 1e3).alias("storage_gb"), (F.count("*") / 2e3).alias("network_gb"))


register("streaming_cost", "day:D event_hub_cost:d compute_cost:d storage_cost:d network_cost:d total_cost:d",
         lambda s, d: monitoring.streaming_cost(_daily_usage(s, d)),
         f"""SELECT *, event_hub_cost + compute_cost + storage_cost + network_cost AS total_cost FROM (SELECT CAST(ts AS DATE) AS day,
         count(*) * 1e-6 AS event_hub_cost, 24e0 * 5e-1 AS compute_cost, count(*) / 1e3 * 2e-2 AS storage_cost, count(*) / 2e3 * 1e-2 AS network_cost
         FROM ({src('metrics')}) GROUP BY 1)""")
register("optimization_recommendations", "name:s value:d recommendation:s",
         lambda s, d: monitoring.optimization_recommendations(
             inputs.metrics(s, d).withColumn("value", F.when(F.col("name") == "processing_latency_ms", F.col("value") * 20).otherwise(F.col("value"))),
             audit_now(), "point_id", 24),
         f"""SELECT name, value, recommendation FROM (SELECT name, 'avg' AS s, avg(CASE name WHEN 'processing_latency_ms' THEN value * 20 ELSE value END) AS value
           FROM ({src('metrics')}) WHERE ts >= {AUDIT_AS_OF} - INTERVAL 1 DAY GROUP BY name) p
         JOIN {values_sql(refdata.COST_ADVICE)} AS a(metric, minutes, stat, fires, bound, recommendation) ON metric = name AND stat = 'avg'
         WHERE CASE fires WHEN 'above' THEN value > bound ELSE value < bound END""")
USAGE_AS_OF = "2000-06-20"
usage_now = lambda: as_of(USAGE_AS_OF)
USAGE_CTE = (f"usage AS ({src('usage')}), mtd AS (SELECT * FROM usage WHERE usage_date BETWEEN DATE '2000-06-01' AND DATE '{USAGE_AS_OF}')")
register("usage_by_service", "service:s cost:d", lambda s, d: monitoring.usage_by_service(inputs.derived(s, d, "usage"), usage_now()),
         f"WITH {USAGE_CTE} SELECT service, sum(cost) AS cost FROM mtd GROUP BY service")
register("usage_top_services", "service:s cost:d", lambda s, d: monitoring.usage_by_service(inputs.derived(s, d, "usage"), usage_now(), 3),
         f"WITH {USAGE_CTE} SELECT service, sum(cost) AS cost FROM mtd GROUP BY service ORDER BY cost DESC, service LIMIT 3")
register("usage_daily_series", "usage_date:D cost:d",
         lambda s, d: monitoring.usage_daily_series(inputs.derived(s, d, "usage"), usage_now()),
         f"""WITH {USAGE_CTE} SELECT day AS usage_date, coalesce(sum(cost), 0) AS cost FROM (SELECT DATE '{USAGE_AS_OF}' - CAST(i AS INT) AS day
         FROM range(7) r(i)) LEFT JOIN usage ON usage_date = day GROUP BY day""")
register("usage_cost_rollup",
         "total_cost:d budget_limit:d over_budget:b remaining:d daily_average:d projected_monthly:d",
         lambda s, d: monitoring.usage_month_summary(inputs.derived(s, d, "usage"), usage_now(), 500),
         f"""WITH {USAGE_CTE} SELECT t AS total_cost, 500e0 AS budget_limit, t > 500 AS over_budget, 500 - t AS remaining, t / 20 AS daily_average,
         t * 30 / 20 AS projected_monthly FROM (SELECT coalesce(sum(cost), 0) AS t FROM mtd)""")
