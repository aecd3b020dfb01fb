"""Bronze layer: turning raw event bodies into checked, de-duplicated claims."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark import schemas
from tidemark.config import QualityConfig

_BROKEN = "_broken"
_TEXT_FIELDS = ["policy_number", "customer_id"]
_LATER_TEXT_FIELDS = ["incident_location", "incident_postcode", "claim_type", "claim_status"]


def event_metadata(df: DataFrame) -> DataFrame:
    """Event body as text, with the broker's time, offset, partition, sequence and properties."""
    renamed = {
        "enqueuedTime": "event_time", "offset": "event_hub_offset",
        "partition": "event_hub_partition", "sequenceNumber": "event_hub_sequence",
    }
    carried = [c for c in ("systemProperties", "properties") if c in df.columns]
    return df.select(
        F.col("body").cast("string").alias("raw_body"),
        *[F.col(old).alias(new) for old, new in renamed.items()],
        *carried,
    )


def _lineage(ingested_at: Column | None) -> list[Column]:
    return [
        F.col("raw_body").alias("_raw_data"),
        (ingested_at if ingested_at is not None else F.current_timestamp()).alias("_ingestion_timestamp"),
        F.col("event_hub_offset").alias("_event_hub_offset"),
        F.col("event_hub_partition").alias("_event_hub_partition"),
        F.col("event_hub_sequence").alias("_event_hub_sequence"),
        F.lit("event_hub").alias("_data_source"),
    ]


def decode_events(df: DataFrame) -> DataFrame:
    """Add ``event`` (typed struct) and ``is_valid`` to metadata rows.

    A body is valid when it parses completely and carries a claim id; a body that does not parse
    gives a struct of nulls, so validity is read from the corrupt-record field instead.
    """
    wanted = T.StructType([*schemas.CLAIM_EVENT.fields, T.StructField(_BROKEN, T.StringType())])
    event = F.from_json("raw_body", wanted, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})
    sound = F.col(f"event.{_BROKEN}").isNull() & F.col("event.claim_id").isNotNull()
    return df.withColumn("event", event).withColumn("is_valid", F.coalesce(sound, F.lit(False)))


def typed_claims(decoded: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """The valid half of ``decode_events`` as typed claim rows with lineage."""
    field = lambda name: F.col(f"event.{name}")
    return decoded.where("is_valid").select(
        field("claim_id").alias("claim_id"),
        *[field(name).alias(name) for name in _TEXT_FIELDS],
        field("claim_amount").try_cast("decimal(10,2)").alias("claim_amount"),
        *[F.try_to_timestamp(field(name)).alias(name) for name in ("claim_date", "incident_date")],
        *[field(name).alias(name) for name in _LATER_TEXT_FIELDS],
        field("fraud_score").alias("fraud_score"),
        field("description").alias("description"),
        *_lineage(ingested_at),
    )


def parse_claim_event(df: DataFrame, ingested_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Split metadata rows into (typed claims, undecodable rows)."""
    decoded = decode_events(df)
    return typed_claims(decoded, ingested_at), decoded.where("NOT is_valid").drop("event", "is_valid")


def parse_claim_json_path(df: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """The lighter parse: one JSON path per column, every row kept."""
    at = lambda name: F.get_json_object("raw_body", f"$.{name}")
    casts = {"claim_amount": "decimal(10,2)", "claim_date": "timestamp", "incident_date": "timestamp",
             "fraud_score": "double"}
    names = ["claim_id", *_TEXT_FIELDS, "claim_amount", "claim_date", "incident_date",
             *_LATER_TEXT_FIELDS, "fraud_score", "description"]
    parsed = [(at(n).try_cast(casts[n]) if n in casts else at(n)).alias(n) for n in names]
    return df.select(*parsed, *[c for c in _lineage(ingested_at)])


def dead_letter(invalid: DataFrame, failed_at: Column | None = None) -> DataFrame:
    """Undecodable rows in dead-letter form."""
    return invalid.select(
        F.col("raw_body").alias("raw_data"),
        F.lit("Failed JSON parsing").alias("error_message"),
        (failed_at if failed_at is not None else F.current_timestamp()).alias("error_timestamp"),
        "event_hub_offset", "event_hub_partition",
    )


def quality_flags(cfg: QualityConfig = QualityConfig()) -> dict[str, Column]:
    amount = F.col("claim_amount")
    flags = {f"has_{label}": F.col(name).isNotNull() for label, name in
             [("claim_id", "claim_id"), ("policy_number", "policy_number"),
              ("customer_id", "customer_id"), ("amount", "claim_amount")]}
    flags["positive_amount"] = amount > 0
    flags["reasonable_amount"] = amount < cfg.amount_ceiling
    flags["valid_dates"] = F.col("claim_date") >= F.col("incident_date")
    flags["valid_uk_postcode"] = F.col("incident_postcode").rlike("^[A-Z]{1,2}[0-9]")
    return {name: F.coalesce(flag, F.lit(False)) for name, flag in flags.items()}


def dq_checks(df: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """Add ``dq_checks``, a struct of eight never-null flags."""
    return df.withColumn("dq_checks", F.struct(*[f.alias(n) for n, f in quality_flags(cfg).items()]))


def dq_score(df: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """Add ``dq_score``, the share of quality flags that hold."""
    flags = [flag.cast("int") for flag in quality_flags(cfg).values()]
    return df.withColumn("dq_score", reduce(lambda a, b: a + b, flags) / F.lit(float(len(flags))))


def dedup_claims(df: DataFrame, delay: str = "10 minutes", order_by: tuple = ("_event_hub_sequence",)) -> DataFrame:
    """One row per claim id.

    A stream keeps the ids seen within the watermark on ingestion time; a batch keeps the earliest
    row, found with a map-side combined minimum, so that a claim id repeated any number of times
    never gathers in one task.
    """
    if df.isStreaming:
        return df.withWatermark("_ingestion_timestamp", delay).dropDuplicatesWithinWatermark(["claim_id"])
    rest = [c for c in df.columns if c != "claim_id"]
    first = F.min_by(F.struct(*rest), F.struct("_ingestion_timestamp", *order_by)).alias("row")
    return df.groupBy("claim_id").agg(first).select("claim_id", "row.*").select(*df.columns)


def bronze_monitoring(df: DataFrame, as_of: Column, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """Hourly ingestion figures of the 24 hours before ``as_of``."""
    stamp = F.col("_ingestion_timestamp")
    return (
        df.where(stamp >= as_of - F.expr("INTERVAL 24 HOURS"))
        .groupBy(F.to_date(stamp).alias("ingestion_date"), F.hour(stamp).alias("ingestion_hour"), "claim_type")
        .agg(
            F.count("*").alias("claim_count"),
            F.avg("claim_amount").alias("avg_claim_amount"),
            F.max("claim_amount").alias("max_claim_amount"),
            F.avg("fraud_score").alias("avg_fraud_score"),
            F.count_if(F.col("fraud_score") > cfg.high_fraud).alias("high_fraud_count"),
            F.avg("dq_score").alias("avg_quality_score"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
    )


# ------------------------------------------------------------------------------- envelopes

def open_envelopes(lines: DataFrame, column: str = "value") -> DataFrame:
    """Parse envelope lines; rows that do not parse keep a null ``envelope`` and ``parsed`` false."""
    wanted = T.StructType([*schemas.ENVELOPE.fields, T.StructField(_BROKEN, T.StringType())])
    envelope = F.from_json(column, wanted, {"columnNameOfCorruptRecord": _BROKEN})
    return (
        lines.withColumn("envelope", envelope)
        .withColumn("parsed", F.coalesce(F.col(f"envelope.{_BROKEN}").isNull() & F.col("envelope").isNotNull(),
                                         F.lit(False)))
    )


def event_router(lines: DataFrame, column: str = "value", cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """Per event type: received, processed, errors, and high-fraud claims among them.

    Envelopes without a type count as ``unknown``; lines that are not JSON count as errors under
    ``(unreadable)``.
    """
    opened = open_envelopes(lines, column)
    kind = F.when(F.col("parsed"), F.coalesce("envelope.event_type", F.lit("unknown"))).otherwise("(unreadable)")
    score = F.coalesce("envelope.data.fraud_score", "envelope.data.claim.fraud_score", F.lit(0.0))
    is_claim = kind.isin("claim", "claim_submitted")
    return (
        opened.select(kind.alias("event_type"), "parsed", (is_claim & (score > cfg.high_fraud)).alias("alarming"))
        .groupBy("event_type")
        .agg(
            F.count("*").alias("received"),
            F.count_if("parsed").alias("processed"),
            F.count_if(~F.col("parsed")).alias("errors"),
            F.count_if("alarming").alias("fraud_detected"),
        )
    )


def route(lines: DataFrame, event_type: str, column: str = "value") -> DataFrame:
    """The envelopes one handler subscribes to; ``*`` subscribes to all that parse."""
    opened = open_envelopes(lines, column).where("parsed").select("envelope.*")
    return opened if event_type == "*" else opened.where(F.col("event_type") == event_type)


def policy_rows(envelopes: DataFrame) -> DataFrame:
    """``policy_created`` envelopes as one typed row of policy and policyholder."""
    picked = envelopes.where((F.col("event_type") == "policy_created") & F.col("data.policy").isNotNull())
    times = {"start_date", "end_date"}
    policy = [
        (F.try_to_timestamp(F.col(f"data.policy.{f.name}")) if f.name in times
         else F.col(f"data.policy.{f.name}")).alias("policy_id" if f.name == "id" else f.name)
        for f in schemas.POLICY.fields if f.name not in ("created_at", "updated_at")
    ]
    holder = [F.col(f"data.policyholder.{n}").alias(n) for n in
              ("first_name", "last_name", "email", "phone", "risk_score", "is_corporate", "company_registration")]
    return picked.select(
        "event_id", "partition_key", F.try_to_timestamp(F.col("timestamp")).alias("event_time"),
        *policy, *holder,
        F.try_to_timestamp(F.col("data.policyholder.date_of_birth")).alias("date_of_birth"),
        F.col("data.policyholder.address.city").alias("city"),
        F.col("data.policyholder.address.postcode").alias("postcode"),
        F.col("metadata")["region"].alias("region"),
    )


def claim_rows(envelopes: DataFrame) -> DataFrame:
    """``claim_submitted`` envelopes as typed claim rows with the attached fraud analysis."""
    picked = envelopes.where((F.col("event_type") == "claim_submitted") & F.col("data.claim").isNotNull())
    times = {"incident_date", "reported_date"}
    claim = [
        (F.try_to_timestamp(F.col(f"data.claim.{f.name}")) if f.name in times
         else F.col(f"data.claim.{f.name}")).alias("claim_id" if f.name == "id" else f.name)
        for f in schemas.ENVELOPE_CLAIM.fields if f.name != "location"
    ]
    return picked.select(
        "event_id", "partition_key", F.try_to_timestamp(F.col("timestamp")).alias("event_time"), *claim,
        F.col("data.claim.location.city").alias("city"),
        F.col("data.claim.location.postcode").alias("postcode"),
        F.col("data.fraud_analysis.recommended_action").alias("recommended_action"),
        F.col("data.fraud_analysis.risk_level").alias("analysis_risk_level"),
    )


def audit_projection(policies: DataFrame, claims: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """Audit events: one CREATE per policy, one FLAG per claim scored above the fraud limit.

    ``policies`` needs policy_number, policy_type, premium_amount, policyholder_id; ``claims`` needs
    claim_id, fraud_score, claim_amount and may have fraud_indicators and recommended_action.
    """
    def events(df, kind, entity, key, action, details):
        pairs = [part for name, value in details.items() for part in (F.lit(name), value)]
        return df.select(
            F.lit(kind).alias("event_type"), F.lit(entity).alias("entity_type"),
            F.col(key).alias("entity_id"), F.lit(action).alias("action"),
            F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()).alias("details"),
        )

    text = lambda name: F.col(name).cast("string")
    created = events(policies, "policy_created", "policy", "policy_number", "CREATE", {
        "policy_type": text("policy_type"), "premium": text("premium_amount"),
        "policyholder_id": text("policyholder_id")})
    optional = {}
    if "fraud_indicators" in claims.columns:
        optional["fraud_indicators"] = F.array_join("fraud_indicators", ",")
    if "recommended_action" in claims.columns:
        optional["recommended_action"] = text("recommended_action")
    flagged = events(claims.where(F.col("fraud_score") > cfg.high_fraud), "high_risk_claim_detected",
                     "claim", "claim_id", "FLAG",
                     {"fraud_score": text("fraud_score"), "claim_amount": text("claim_amount"), **optional})
    return created.unionByName(flagged)
