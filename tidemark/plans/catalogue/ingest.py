"""Registered queries of sources, parsing, sinks and the streaming layers.

Streaming queries replay the derived events from files in the shared folder with ``availableNow`` and
return what reached their tables.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tidemark.operators import anomaly, bronze, fraud, scenarios
from tidemark.plans import inputs
from tidemark.plans.catalogue.common import register, register_twin, src, ts
from tidemark.plans.catalogue.medallion import SILVER_CTE
from tidemark.plans.catalogue.risk import CASE_CTE, SIGNAL_CTE, _TRACK_SQL, case_frame, _ring_members
from tidemark.plans.claims import as_of, scored_bronze, silver_frame
from tidemark.schemas import SILVER_CLAIM
from tidemark.session import cut, work_path
from tidemark.sources import catalog, events, sinks
from tidemark.streaming import cases, medallion, rings, tracking, windows

_LINES = src("event_lines")


def event_frame(s, d):
    """The messy feed in the columns of an event broker."""
    return inputs.derived(s, d, "event_lines").select(
        "body", F.timestamp_seconds("enqueued_s").alias("enqueuedTime"), F.col("stream_offset").alias("offset"),
        F.col("partition_id").alias("partition"), F.col("seq").alias("sequenceNumber"),
        F.create_map(F.lit("hub"), F.lit("claims")).alias("systemProperties"),
        F.lit(None).cast("map<string,string>").alias("properties"))


def event_folder(s, d):
    """The feed as JSON event files."""
    path = work_path(s, "events")
    event_frame(s, d).write.json(path)
    return path


def metadata(s, d):
    return bronze.event_metadata(event_frame(s, d))


PARSE_CTE = f"""lines AS (SELECT *, {ts('enqueued_s')} AS event_time FROM ({_LINES})),
opened AS (SELECT *, CASE WHEN json_valid(body) THEN body END AS j FROM lines),
parsed AS (SELECT *, j ->> '$.claim_id' AS claim_id, j ->> '$.policy_number' AS policy_number, j ->> '$.customer_id' AS customer_id,
  TRY_CAST(j ->> '$.claim_amount' AS DECIMAL(10, 2)) AS claim_amount, TRY_CAST(j ->> '$.claim_date' AS TIMESTAMP) AS claim_date,
  TRY_CAST(j ->> '$.incident_date' AS TIMESTAMP) AS incident_date, j ->> '$.incident_location' AS incident_location,
  j ->> '$.incident_postcode' AS incident_postcode, j ->> '$.claim_type' AS claim_type, j ->> '$.claim_status' AS claim_status,
  TRY_CAST(j ->> '$.fraud_score' AS DOUBLE) AS fraud_score, j ->> '$.description' AS description FROM opened),
valid AS (SELECT * FROM parsed WHERE claim_id IS NOT NULL), invalid AS (SELECT * FROM parsed WHERE claim_id IS NULL)"""
_CLAIM = ("claim_id:s policy_number:s customer_id:s claim_amount:d claim_date:t incident_date:t incident_location:s "
          "incident_postcode:s claim_type:s claim_status:s fraud_score:d description:s event_hub_sequence:i")


def _plain(df):
    return df.withColumnRenamed("_event_hub_sequence", "event_hub_sequence")


def on_lines(key, shape, run, body):
    register(key, shape, run, f"WITH {PARSE_CTE} {body}")


_META = "raw_body:s event_time:t event_hub_offset:i event_hub_partition:i event_hub_sequence:i"
_META_SQL = """SELECT body AS raw_body, event_time, stream_offset AS event_hub_offset, partition_id AS event_hub_partition,
  seq AS event_hub_sequence FROM lines"""
on_lines("event_metadata", _META, metadata, _META_SQL)


def _replayed(s, d):
    source = events.stream_source(s, event_folder(s, d), "files")
    table, checkpoint = work_path(s, "raw"), work_path(s, "checkpoint")
    sinks.write_stream_table(bronze.event_metadata(source), table, checkpoint).awaitTermination()
    return s.read.parquet(table)


on_lines("stream_source", _META, _replayed, _META_SQL)
_VALID_SQL = "SELECT *, seq AS event_hub_sequence FROM valid"
on_lines("parse_claim_event", _CLAIM, lambda s, d: _plain(bronze.parse_claim_event(metadata(s, d), F.col("event_time"))[0]), _VALID_SQL)
on_lines("parse_claim_json_path", _CLAIM, lambda s, d: _plain(bronze.parse_claim_json_path(metadata(s, d), F.col("event_time"))),
         "SELECT *, seq AS event_hub_sequence FROM parsed")
_DEAD = "raw_data:s error_message:s error_timestamp:t event_hub_offset:i event_hub_partition:i"
_DEAD_SQL = """SELECT body AS raw_data, 'Failed JSON parsing' AS error_message, event_time AS error_timestamp, stream_offset AS event_hub_offset,
  partition_id AS event_hub_partition FROM invalid"""
on_lines("dead_letter", _DEAD, lambda s, d: bronze.dead_letter(
    bronze.parse_claim_event(metadata(s, d))[1], F.col("event_time")), _DEAD_SQL)
on_lines("dedup_claims", _CLAIM, lambda s, d: _plain(bronze.dedup_claims(bronze.parse_claim_event(
    metadata(s, d), F.col("event_time"))[0], order_by=("_event_hub_sequence",))),
         "SELECT *, seq AS event_hub_sequence FROM valid QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY event_time, seq) = 1")


PARTS = 3


def arriving(frame, parts, folder, run):
    """Write the parts of a frame one after another and run the stream over what is there after each."""
    for n in range(PARTS):
        frame.where(parts == n).write.mode("append").parquet(folder)
        run()


def _arriving_events(s, d, start):
    """The feed in three loads: times and bad lines are mixed over them, repeated claim ids come in the last."""
    folder = work_path(s, "events")
    frame = event_frame(s, d)
    part = F.when(F.col("sequenceNumber") % 20 == 7, 2).otherwise(F.pmod(F.xxhash64("sequenceNumber"), F.lit(3)).cast("int") % 2)
    for n in range(PARTS):
        frame.where(part == n).write.mode("append").json(folder)
        start(events.stream_source(s, folder, "files")).awaitTermination()


def _bronze_table(s, d):
    table, checkpoint = work_path(s, "bronze"), work_path(s, "checkpoint")
    _arriving_events(s, d, lambda source: medallion.bronze_stream(source, table, checkpoint))
    return s.read.parquet(table)


def _dead_letters(s, d):
    table, checkpoint = work_path(s, "dead"), work_path(s, "checkpoint")
    _arriving_events(s, d, lambda source: medallion.dead_letter_stream(source, table, checkpoint, F.col("event_time")))
    return s.read.parquet(table)


on_lines("bronze_stream", _CLAIM, lambda s, d: _plain(_bronze_table(s, d)),
         "SELECT *, seq AS event_hub_sequence FROM valid QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY seq % 20 = 7, seq) = 1")
on_lines("dead_letter_stream", _DEAD, _dead_letters, _DEAD_SQL)


def stored(df, name):
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def _load_of(column):
    return F.pmod(F.xxhash64(column), F.lit(PARTS))


def silver_tables(s, d, after=lambda silver: None):
    """Silver claims and alerts as the stream writes them from three loads; ``after`` runs on the table after each."""
    claims = scored_bronze(s, d)
    folder, table, alerts, checkpoint = (work_path(s, n) for n in ("bronze", "silver", "alerts", "checkpoint"))

    def run():
        source = medallion.table_stream(s, folder, claims.schema)
        medallion.silver_stream(source, table, alerts, checkpoint, F.col("_silver_timestamp")).awaitTermination()
        after(table)

    arriving(claims, _load_of("claim_id"), folder, run)
    return table, alerts


register_twin("silver_stream", "silver_output", lambda s, d: s.read.parquet(silver_tables(s, d)[0]).withColumnsRenamed(
    {"_silver_timestamp": "silver_timestamp", "_processing_time_ms": "processing_time_ms"}))
register("alert_stream", "claim_id:s adjusted_fraud_score:d processing_status:s",
         lambda s, d: s.read.parquet(silver_tables(s, d)[1]),
         f"WITH {SILVER_CTE} SELECT * FROM silver WHERE is_high_risk OR claim_amount_gbp > 50000 OR len(fraud_indicators) > 4")


def _gold(name):
    def run(s, d):
        table, checkpoint = work_path(s, "gold"), work_path(s, "checkpoint")
        silver_tables(s, d, lambda silver: medallion.gold_stream(
            medallion.table_stream(s, silver, SILVER_CLAIM), silver, name, table, checkpoint).awaitTermination())
        return medallion.gold_table(s, table, name)
    return run


register_twin("gold_stream", "daily_claims_summary", _gold("daily_claims_summary"))
register_twin("fraud_metrics_stream", "fraud_metrics", _gold("fraud_metrics"))
register_twin("operational_kpis_stream", "operational_kpis", _gold("operational_kpis"))


def _profiles(s, d):
    table, checkpoint = work_path(s, "profiles"), work_path(s, "checkpoint")
    silver_tables(s, d, lambda silver: medallion.profile_stream(
        medallion.table_stream(s, silver, SILVER_CLAIM), silver, table, checkpoint).awaitTermination())
    return medallion.latest_rows(s, table, "customer_id")


register_twin("customer_risk_profiles_stream", "customer_risk_profiles", _profiles)


def _anomaly_scores(s, d):
    """The baselines are those of all claims; the claims arrive in three loads, each of which also affects earlier ones."""
    baselines, scores, checkpoint = (work_path(s, n) for n in ("baselines", "scores", "checkpoint"))
    anomaly.statistical_baselines(silver_frame(s, d), as_of()).write.parquet(baselines)
    silver_tables(s, d, lambda silver: medallion.anomaly_stream(
        medallion.table_stream(s, silver, SILVER_CLAIM), silver, baselines, scores, checkpoint, as_of()).awaitTermination())
    return medallion.latest_scores(s, scores)


register_twin("anomaly_stream", "anomaly_output", _anomaly_scores)


def _tracked(s, d):
    claims = inputs.normal_claims(s, d).select("policyholder_id", "claim_id", "incident_date", "fraud_score")
    folder, table, checkpoint = (work_path(s, n) for n in ("claims", "tracking", "checkpoint"))
    # Tracking goes by arrival: the three loads are thirds of the incident time.
    low, high = claims.agg(F.min(F.unix_timestamp("incident_date")), F.max(F.unix_timestamp("incident_date"))).first()
    third = F.expr(f"least(2, (unix_timestamp(incident_date) - {low}) * 3 div {high - low + 1})")
    arriving(claims, third, folder, lambda: sinks.write_stream_table(
        tracking.track_scores(medallion.table_stream(s, folder, claims.schema)), table, checkpoint).awaitTermination())
    return s.read.parquet(table)


register("fraud_tracking_stream", "policyholder_id:s claim_id:s claim_number:i recent_mean:d blacklists_holder:b", _tracked,
         f"WITH {CASE_CTE} {_TRACK_SQL}")
register("tracked_blacklist", "entity:s",
         lambda s, d: fraud.tracked_blacklist(fraud.fraud_tracking(inputs.normal_claims(s, d), cfg=fraud.FraudConfig(high=0.6))),
         f"""WITH {CASE_CTE} SELECT DISTINCT policyholder_id AS entity FROM ({_TRACK_SQL}) WHERE claim_number >= 3 AND m > 6e-1""")

# ---------------------------------------------------------------------------------- windows with a watermark
# Claims come in three loads by time; one in twenty comes with the last one, most of them after their window is over.
_FIRST_S, _THIRD_S, _DELAY = 1704067200 - 2 * 86400, 155 * 86400, "7 days"
_LOADED_CTE = f"""{SILVER_CTE},
loaded AS (SELECT *, CASE WHEN CAST(right(claim_id, 12) AS BIGINT) % 20 = 7 THEN 2
  ELSE least(2, CAST(floor((epoch(claim_date) - {_FIRST_S}) / {_THIRD_S}) AS BIGINT)) END AS load FROM silver),
marks AS (SELECT n.load, (SELECT max(claim_date) FROM loaded WHERE loaded.load < n.load) - INTERVAL {_DELAY} AS mark
  FROM (SELECT DISTINCT load FROM loaded) n),
ended AS (SELECT max(claim_date) - INTERVAL {_DELAY} AS last_mark FROM loaded),
judged AS (SELECT l.*, last_mark, date_trunc('day', claim_date) AS d0, date_trunc('day', claim_date) + INTERVAL 1 DAY AS d1,
  date_trunc('hour', claim_date) AS h0, date_trunc('hour', claim_date) + INTERVAL 1 HOUR AS h1, mark
  FROM loaded l JOIN marks m ON l.load = m.load CROSS JOIN ended)"""
_IN_TIME = "(mark IS NULL OR {0} > mark)"


def _windowed(table, start):
    """The three loads through one of the windows' streams; gives the folder that it writes."""
    def run(s, d):
        claims = silver_frame(s, d)
        folder, path, checkpoint = (work_path(s, n) for n in ("silver", "windows", "checkpoint"))
        late = F.substring("claim_id", -12, 12).cast("long") % 20 == 7
        load = F.when(late, 2).otherwise(F.least(F.lit(2), F.floor((F.unix_timestamp("claim_date") - _FIRST_S) / _THIRD_S)))
        arriving(claims, load, folder, lambda: start(medallion.table_stream(s, folder, claims.schema), table, path, checkpoint, _DELAY).awaitTermination())
        return path
    return run


def _closed(table):
    run = _windowed(table, windows.closed_windows_stream)
    return lambda s, d: s.read.parquet(run(s, d))


def _open(table):
    run = _windowed(table, windows.open_windows_stream)
    return lambda s, d: windows.newest_windows(s, run(s, d), table)


_SUMMARY_SQL = """SELECT d0 AS window_start, d1 AS window_end, claim_type, count(*) AS total_claims, sum(claim_amount_gbp) AS total_amount,
  avg(claim_amount_gbp) AS average_amount, min(claim_amount_gbp) AS min_amount, max(claim_amount_gbp) AS max_amount,
  stddev(claim_amount_gbp) AS stddev_amount, count(*) FILTER (is_high_risk) AS fraud_detected_count,
  coalesce(sum(claim_amount_gbp) FILTER (is_high_risk), 0) AS fraud_detected_amount, avg(adjusted_fraud_score) AS avg_fraud_score,
  count(*) FILTER (requires_manual_review) AS manual_review_count, count(*) FILTER (processing_status = 'AUTO_APPROVED') AS auto_approved_count,
  count(*) FILTER (processing_status = 'REJECTED') AS rejected_count, avg(processing_ms) AS processing_time_avg_ms,
  avg(data_quality_score) AS avg_data_quality, avg(validation_score) AS avg_validation_score FROM judged WHERE {0} GROUP BY ALL"""
_SUMMARY = ("window_start:t window_end:t claim_type:s total_claims:i total_amount:m average_amount:d min_amount:d max_amount:d stddev_amount:d "
            "fraud_detected_count:i fraud_detected_amount:m avg_fraud_score:d manual_review_count:i auto_approved_count:i rejected_count:i "
            "processing_time_avg_ms:d avg_data_quality:d avg_validation_score:d")
register("windowed_summary_append", _SUMMARY, _closed("daily_claims_summary"),
         f"WITH {_LOADED_CTE} {_SUMMARY_SQL.format(_IN_TIME.format('d1') + ' AND d1 <= last_mark')}")
register("windowed_summary_update", _SUMMARY, _open("daily_claims_summary"), f"WITH {_LOADED_CTE} {_SUMMARY_SQL.format(_IN_TIME.format('d1'))}")
register("windowed_fraud_update",
         "window_start:t total_claims_evaluated:i fraud_alerts_generated:i high_risk_flagged:i sent_to_investigation:i avg_adjusted_fraud_score:d "
         "max_fraud_score:d total_fraud_prevented_gbp:m top_fraud_patterns:a high_risk_postcodes:a", _open("fraud_metrics"),
         f"""WITH {_LOADED_CTE} SELECT h0 AS window_start, count(*) AS total_claims_evaluated,
         count(*) FILTER (adjusted_fraud_score > 5e-1) AS fraud_alerts_generated, count(*) FILTER (is_high_risk) AS high_risk_flagged,
         count(*) FILTER (processing_status = 'FRAUD_INVESTIGATION') AS sent_to_investigation,
         avg(adjusted_fraud_score) AS avg_adjusted_fraud_score, max(adjusted_fraud_score) AS max_fraud_score,
         coalesce(sum(claim_amount_gbp) FILTER (is_high_risk), 0) AS total_fraud_prevented_gbp,
         coalesce(list_sort(list(DISTINCT fraud_indicators[1]) FILTER (fraud_indicators[1] IS NOT NULL)), []) AS top_fraud_patterns,
         coalesce(list_sort(list(DISTINCT postcode_district) FILTER (is_high_risk AND postcode_district IS NOT NULL)), []) AS high_risk_postcodes
         FROM judged WHERE {_IN_TIME.format('h1')} GROUP BY ALL""")
register("windowed_kpis_append",
         "window_start:t avg_processing_time_ms:d auto_approval_rate:d manual_review_rate:d fraud_detection_rate:d avg_fraud_confidence:d "
         "total_claims_processed:i claims_per_hour:d total_claim_value:m", _closed("operational_kpis"),
         f"""WITH {_LOADED_CTE} SELECT d0 AS window_start, avg(processing_ms) AS avg_processing_time_ms,
         count(*) FILTER (processing_status = 'AUTO_APPROVED') / count(*) AS auto_approval_rate,
         count(*) FILTER (requires_manual_review) / count(*) AS manual_review_rate, count(*) FILTER (is_high_risk) / count(*) AS fraud_detection_rate,
         avg(adjusted_fraud_score) AS avg_fraud_confidence, count(*) AS total_claims_processed, count(*) / 24e0 AS claims_per_hour,
         sum(claim_amount_gbp) AS total_claim_value FROM judged WHERE {_IN_TIME.format('d1')} AND d1 <= last_mark GROUP BY ALL""")
register("windowed_lite_update", "window_start:t claim_type:s total_claims:i total_amount:m fraud_detected_count:i auto_approved_count:i",
         _open("daily_summary_lite"),
         f"""WITH {_LOADED_CTE} SELECT d0 AS window_start, claim_type, count(*) AS total_claims, sum(claim_amount_gbp) AS total_amount,
         count(*) FILTER (is_high_risk) AS fraud_detected_count, count(*) FILTER (processing_status = 'AUTO_APPROVED') AS auto_approved_count
         FROM judged WHERE {_IN_TIME.format('d1')} GROUP BY ALL""")
_late = _windowed("daily_claims_summary", windows.late_claims_stream)
register("windowed_late_claims", "window_start:t window_end:t claim_type:s late_claims:i",
         lambda s, d: windows.late_claims(s, _late(s, d), "daily_claims_summary"),
         f"""WITH {_LOADED_CTE} SELECT d0 AS window_start, d1 AS window_end, claim_type, count(*) AS late_claims
         FROM judged WHERE d1 <= mark GROUP BY ALL""")

# ---------------------------------------------------------------------------------- claims and policies both arriving


def _signals(s, d):
    """Thirds of the claims by incident and of the policies by start, so that many policies come after their claims."""
    claims, terms = inputs.normal_claims(s, d), inputs.policies(s, d)
    folders = [work_path(s, n) for n in ("claims", "policies")]
    table, checkpoint = work_path(s, "signals"), work_path(s, "checkpoint")
    third = lambda c, first: F.least(F.lit(2), F.floor((F.unix_timestamp(c) - first) / (122 * 86400)))
    for n in range(PARTS):
        claims.where(third("incident_date", 1704067200) == n).write.mode("append").parquet(folders[0])
        terms.where(third("start_date", 1688169600) == n).write.mode("append").parquet(folders[1])
        both = cases.policy_cases(medallion.table_stream(s, folders[0], claims.schema), medallion.table_stream(s, folders[1], terms.schema))
        sinks.write_stream_table(cases.policy_signals(both, inputs.holders(s, d)), table, checkpoint).awaitTermination()
    return s.read.parquet(table)


register("policy_signals_stream", "claim_id:s timing:d amount:d geographic:d", _signals, f"WITH RECURSIVE {SIGNAL_CTE} SELECT * FROM sig")



def _growing_rings(s, d):
    """The links of rings in three loads by a hash, so that components of one load are joined by the next."""
    edges = cut(scenarios.ring_edges(_ring_members(case_frame(s, d))))
    folder, table, checkpoint = (work_path(s, n) for n in ("edges", "rings", "checkpoint"))
    arriving(edges, F.pmod(F.xxhash64("src", "dst"), F.lit(PARTS)), folder, lambda: rings.component_stream(
        medallion.table_stream(s, folder, edges.schema), table, checkpoint).awaitTermination())
    return rings.components(s, table)


register_twin("ring_components_stream", "ring_components", _growing_rings)

# ---------------------------------------------------------------------------------- envelopes


def envelope_lines(s, d):
    """Envelopes of policies and claims as JSON lines, some unreadable and some without a type."""
    policy = inputs.derived(s, d, "policies")
    holder = inputs.derived(s, d, "holders")
    stamp = lambda c: F.date_format(F.timestamp_seconds(c), "yyyy-MM-dd HH:mm:ss")
    created = policy.join(holder, "policyholder_id").select(F.to_json(F.struct(
        F.concat(F.lit("E-"), "policy_number").alias("event_id"), F.lit("policy_created").alias("event_type"),
        F.col("policyholder_id").alias("partition_key"),
        F.struct(
            F.struct(F.col("policy_number").alias("id"), "policy_number", "policyholder_id", "policy_type", stamp("start_s").alias("start_date"),
                     stamp("end_s").alias("end_date"), "premium_amount", "sum_insured", "deductible").alias("policy"),
            F.struct(F.col("policyholder_id").alias("id"), "email", stamp("dob_s").alias("date_of_birth"), "is_corporate",
                     F.struct(F.lit("Leeds").alias("city"), F.col("holder_postcode").alias("postcode")).alias("address")).alias("policyholder"),
        ).alias("data"),
        F.create_map(F.lit("region"), F.lit("Leeds")).alias("metadata"), stamp("start_s").alias("timestamp"))).alias("value"))
    claims = inputs.derived(s, d, "claims")
    submitted = claims.select(F.when(F.col("claim_key") % 71 == 0, F.lit("{\"event_id\": ")).otherwise(F.to_json(F.struct(
        F.concat(F.lit("E-"), "claim_id").alias("event_id"),
        F.when(F.col("claim_key") % 73 != 0, "claim_submitted").alias("event_type"), F.col("policyholder_id").alias("partition_key"),
        F.struct(
            F.struct(F.col("claim_id").alias("id"), "claim_type", "claim_amount", "fraud_score", stamp("incident_s").alias("incident_date"),
                     stamp("reported_s").alias("reported_date"),
                     F.struct("city", F.col("incident_postcode").alias("postcode")).alias("location")).alias("claim"),
            F.struct(F.lit("MANUAL_REVIEW_REQUIRED").alias("recommended_action")).alias("fraud_analysis")).alias("data"),
        stamp("reported_s").alias("timestamp")))).alias("value"))
    return created.unionByName(submitted)


register("event_router", "event_type:s received:i processed:i errors:i fraud_detected:i",
         lambda s, d: bronze.event_router(envelope_lines(s, d)),
         f"""WITH {CASE_CTE} SELECT kind AS event_type, count(*) AS received, count(*) FILTER (kind <> '(unreadable)') AS processed,
         count(*) FILTER (kind = '(unreadable)') AS errors, count(*) FILTER (alarm) AS fraud_detected FROM (
         SELECT 'policy_created' AS kind, false AS alarm FROM policy UNION ALL
         SELECT CASE WHEN claim_key % 71 = 0 THEN '(unreadable)' WHEN claim_key % 73 = 0 THEN 'unknown' ELSE 'claim_submitted' END,
           fraud_score > 7e-1 AND claim_key % 71 <> 0 AND claim_key % 73 <> 0 FROM claim) GROUP BY kind""")


def _routed(s, d):
    """Envelopes in three loads, handed to a handler per event type and one for all, and counted in their folders."""
    lines = envelope_lines(s, d)
    folder, table, checkpoint = (work_path(s, n) for n in ("envelopes", "routed", "checkpoint"))
    handlers = {"policy_created": bronze.policy_rows, "claim_submitted": bronze.claim_rows,
                "*": lambda rows: rows.select("event_id", "event_type")}
    arriving(lines, _load_of("value"), folder, lambda: medallion.routed_stream(
        medallion.table_stream(s, folder, lines.schema), handlers, table, checkpoint).awaitTermination())
    counts = [s.read.parquet(f"{table}/{kind}").agg(F.lit(kind).alias("handler"), F.count("*").alias("events"))
              for kind in ("policy_created", "claim_submitted", "all")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


register("event_fan_out", "handler:s events:i", _routed,
         f"""WITH {CASE_CTE} SELECT 'policy_created' AS handler, count(*) AS events FROM policy UNION ALL
         SELECT 'claim_submitted', count(*) FROM claim WHERE claim_key % 71 <> 0 AND claim_key % 73 <> 0 UNION ALL
         SELECT 'all', (SELECT count(*) FROM policy) + (SELECT count(*) FROM claim WHERE claim_key % 71 <> 0)""")
register("envelope_flatten",
         "policy_number:s policyholder_id:s policy_type:s start_date:t end_date:t premium_amount:d sum_insured:d deductible:d email:s "
         "is_corporate:b date_of_birth:t city:s postcode:s region:s",
         lambda s, d: bronze.policy_rows(bronze.route(envelope_lines(s, d), "*")),
         f"""WITH {CASE_CTE} SELECT p.*, h.email, h.is_corporate, h.date_of_birth, 'Leeds' AS city, h.holder_postcode AS postcode, 'Leeds' AS region
         FROM policy p JOIN holder h ON p.policyholder_id = h.policyholder_id""")
register("envelope_flatten_claims",
         "claim_id:s claim_type:s claim_amount:d fraud_score:d incident_date:t reported_date:t city:s postcode:s recommended_action:s",
         lambda s, d: bronze.claim_rows(bronze.route(envelope_lines(s, d), "claim_submitted")),
         f"""WITH {CASE_CTE} SELECT *, incident_postcode AS postcode, 'MANUAL_REVIEW_REQUIRED' AS recommended_action FROM claim
         WHERE claim_key % 71 <> 0 AND claim_key % 73 <> 0""")
register("audit_projection", "event_type:s entity_type:s entity_id:s action:s subject:s",
         lambda s, d: bronze.audit_projection(inputs.policies(s, d), inputs.normal_claims(s, d)).withColumn(
             "subject", F.try_element_at("details", F.lit("policyholder_id"))),
         f"""WITH {CASE_CTE} SELECT 'policy_created' AS event_type, 'policy' AS entity_type, policy_number AS entity_id, 'CREATE' AS action,
         policyholder_id AS subject FROM policy UNION ALL
         SELECT 'high_risk_claim_detected', 'claim', claim_id, 'FLAG', NULL FROM claim WHERE fraud_score > 7e-1""")

# ---------------------------------------------------------------------------------- sinks
_EXPORTED = "claim_id string, customer_id string, claim_type string, claim_status string, fraud_score double"


def _exported(s, d, file_format):
    columns = [c.split()[0] for c in _EXPORTED.split(", ")]
    path = sinks.export_files(inputs.bronze_claims(s, d).select(*columns), work_path(s, "export"), file_format)
    return sinks.read_export(s, path, file_format, _EXPORTED)


for _format in ("json", "csv", "parquet"):
    register("export_files" if _format == "json" else f"export_files_{_format}",
             "claim_id:s customer_id:s claim_type:s claim_status:s fraud_score:d",
             lambda s, d, f=_format: _exported(s, d, f), f"SELECT * FROM ({src('bronze')})")


def _partitioned(s, d):
    path = work_path(s, "partitioned")
    sinks.partitioned_table_write(inputs.bronze_claims(s, d), path,
                                  {"claim_month": F.date_format("claim_date", "yyyy-MM"), "kind": F.col("claim_type")})
    return s.read.parquet(path).groupBy("claim_month", "kind").agg(F.count("*").alias("claims"))


register("partitioned_table_write", "claim_month:s kind:s claims:i", _partitioned,
         f"SELECT strftime({ts('claim_s')}, '%Y-%m') AS claim_month, claim_type AS kind, count(*) AS claims FROM ({src('bronze')}) GROUP BY ALL")


def _stream_table(s, d):
    claims = inputs.bronze_claims(s, d).select("claim_id", "claim_type", "claim_amount")
    source = medallion.table_stream(s, stored(claims, "claims"), claims.schema)
    table = work_path(s, "table")
    sinks.write_stream_table(source, table, work_path(s, "checkpoint"), partition_by=["claim_type"]).awaitTermination()
    return s.read.parquet(table)


register("write_stream_table", "claim_id:s claim_type:s claim_amount:d", _stream_table, f"SELECT * FROM ({src('bronze')})")


def _loaded_catalogue(s, d):
    """Set the catalogue up, load the silver claims through it and count them by type."""
    location = work_path(s, "catalog")
    prefix = "tm_" + os.path.basename(location).split("-")[-1][:12]
    catalog.catalog_setup(s, prefix, location)
    rows = silver_frame(s, d).withColumn("claim_day", F.to_date("claim_date"))
    rows.hint("rebalance", F.col("claim_day")).write.mode("append").insertInto(f"{prefix}_silver.claims")
    listed = catalog.list_tables(s, prefix).where("table_name = 'claims'").select("layer", "table_name", "columns")
    return s.table(f"{prefix}_silver.claims").groupBy("claim_type").agg(F.count("*").alias("rows_loaded")).withColumn(
        "layer", F.lit("silver")).join(listed, "layer")


register("catalog_setup", "layer:s table_name:s columns:i claim_type:s rows_loaded:i", _loaded_catalogue,
         f"WITH {SILVER_CTE} SELECT 'silver' AS layer, 'claims' AS table_name, 30 AS columns, claim_type, count(*) AS rows_loaded FROM silver GROUP BY claim_type")
