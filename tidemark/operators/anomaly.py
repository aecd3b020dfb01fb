"""Anomaly scoring of silver claims: five detectors, a weighted score, alerts and reports.

The detectors look back (and around) in time per claim type, district, customer and postcode. They
use the block-wise helpers of ``functions.windows``, so their cost does not depend on how unevenly
claims are spread over those keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import AnomalyConfig
from tidemark.functions.ranks import Ranked, with_percentiles
from tidemark.functions.windows import null_safe_join, sliding_extremes, sliding_stats
from tidemark.operators.silver import labels_of

_AT = "_claim_s"


def _tiers(value: Column, *steps: tuple[object, float]) -> Column:
    """First score whose bound the value exceeds, else 0."""
    chain = F
    for bound, score in steps:
        chain = chain.when(value > bound, score)
    return chain.otherwise(0.0)


def _clocked(df: DataFrame) -> DataFrame:
    return df.withColumn(_AT, F.unix_timestamp("claim_date"))


def _facts(df: DataFrame, facts: DataFrame | None, only: DataFrame | None, keys: list[str], *columns: str) -> DataFrame:
    """The columns a look-back needs. ``facts`` are the plain claims (``df`` itself by default).

    Chained detectors pass the same plain claims to each, so that every look-back is one pruned scan
    instead of a repetition of the detectors before it. With ``only`` the keys that occur in those
    rows are kept; it pays when they are a small part of the claims.
    """
    source = _clocked(df if facts is None else facts).select(_AT, *keys, *columns)
    return source if only is None else null_safe_join(source, only.select(*keys).distinct(), keys, "left_semi")


def statistical_baselines(history: DataFrame, as_of: Column | None = None, cfg: AnomalyConfig = AnomalyConfig()) -> DataFrame:
    """Mean, spread and quartiles per claim type over the last ``history_days``."""
    if as_of is not None:
        history = history.where(F.col("claim_date") >= F.date_sub(F.to_date(as_of), cfg.history_days))
    amount = F.col("claim_amount_gbp")
    spread = lambda name, label: [F.avg(name).alias(f"mean_{label}"), F.stddev(name).alias(f"stddev_{label}")]
    stats = history.groupBy("claim_type").agg(
        *spread("claim_amount_gbp", "amount"),
        *spread("days_to_claim", "days_to_claim"), *spread("fraud_score", "fraud_score"),
        (F.count("*") / F.lit(float(cfg.history_days))).alias("daily_avg_count"),
    )
    quartiles = Ranked(amount, {"q1_amount": 0.25, "median_amount": 0.5, "q3_amount": 0.75})
    iqr = F.col("q3_amount") - F.col("q1_amount")
    return with_percentiles(stats, history, {"claim_type": F.col("claim_type")}, quartiles).withColumns({
        "iqr_amount": iqr,
        "lower_fence": F.col("q1_amount") - cfg.iqr_factor * iqr,
        "upper_fence": F.col("q3_amount") + cfg.iqr_factor * iqr,
    })


def statistical_anomaly(df: DataFrame, baselines: DataFrame, cfg: AnomalyConfig = AnomalyConfig()) -> DataFrame:
    """Distance of each claim from its type's baseline. ``baselines`` has one row per claim type."""
    joined = df.join(baselines, "claim_type", "left")

    def z_score(value, label):
        spread = F.col(f"stddev_{label}")
        return F.when(spread > 0, F.abs(F.col(value) - F.col(f"mean_{label}")) / spread).otherwise(0.0)

    amount = F.col("claim_amount_gbp")
    outlier = (amount < F.col("lower_fence")) | (amount > F.col("upper_fence"))
    scored = joined.withColumns({
        "z_score_amount": z_score("claim_amount_gbp", "amount"),
        "z_score_days": z_score("days_to_claim", "days_to_claim"),
        "z_score_fraud": z_score("fraud_score", "fraud_score"),
        "is_iqr_outlier": outlier,
    })
    scores = ["z_score_amount", "z_score_days", "z_score_fraud"]
    worst = F.greatest(*[F.col(z) / cfg.z_limit for z in scores], F.when(F.col("is_iqr_outlier"), 1.0).otherwise(0.0))
    flags = dict(zip(["amount_anomaly", "timing_anomaly", "fraud_score_anomaly"], scores))
    return scored.withColumns({
        "statistical_anomaly_score": F.least(worst, F.lit(1.0)),
        **{flag: F.col(z) > cfg.z_limit for flag, z in flags.items()},
    })


def time_series_anomaly(df: DataFrame, cfg: AnomalyConfig = AnomalyConfig(), facts: DataFrame | None = None,
                        only: DataFrame | None = None) -> DataFrame:
    """Bursts and jumps per claim type over the last hour and day. Needs ``daily_avg_count``."""
    clocked = _clocked(df)
    source = _facts(df, facts, only, ["claim_type"], "claim_amount_gbp")
    windows = None
    for label, seconds in (("hourly", cfg.hour), ("daily", cfg.day)):
        stats = sliding_stats(source, ["claim_type"], _AT, seconds, count=f"{label}_count",
                              sums={f"{label}_sum": "claim_amount_gbp"})
        stats = stats.withColumn(f"{label}_avg_amount", F.try_divide(f"{label}_sum", f"{label}_sum_n")).drop(
            f"{label}_sum", f"{label}_sum_n")
        windows = stats if windows is None else null_safe_join(windows, stats, ["claim_type", _AT], "inner")
    joined = null_safe_join(clocked, windows, ["claim_type", _AT]).drop(_AT)
    per_hour, daily = F.col("hourly_avg_amount"), F.col("daily_avg_count")
    deviation = F.when(per_hour > 0, F.abs(F.col("claim_amount_gbp") - per_hour) / per_hour).otherwise(0.0)
    return joined.withColumns({
        "velocity_anomaly": _tiers(F.col("hourly_count"), (10, 1.0), (5, 0.5)),
        "volume_spike": _tiers(F.col("daily_count"), (daily * 3, 1.0), (daily * 2, 0.5)),
        "amount_deviation": deviation,
        "amount_spike_anomaly": _tiers(deviation, (2.0, 1.0), (1.0, 0.5)),
    }).withColumn("time_series_anomaly_score",
                  F.greatest("velocity_anomaly", "volume_spike", "amount_spike_anomaly"))


def geographic_anomaly(df: DataFrame, cfg: AnomalyConfig = AnomalyConfig(), facts: DataFrame | None = None,
                       only: DataFrame | None = None) -> DataFrame:
    """Concentration per district and type over the last week. Needs ``mean_amount``."""
    clocked, keys = _clocked(df), ["postcode_district", "claim_type"]
    stats = sliding_stats(_facts(df, facts, only, keys, "claim_amount_gbp", "customer_id"), keys, _AT,
                          cfg.geo_days * cfg.day, count="geo_claim_count", sums={"_sum": "claim_amount_gbp"},
                          distinct=("geo_unique_customers", "customer_id"))
    joined = null_safe_join(clocked, stats, [*keys, _AT]).drop(_AT)
    people, mean = F.col("geo_unique_customers"), F.col("mean_amount")
    return joined.withColumns({
        "geo_avg_amount": F.try_divide("_sum", "_sum_n"),
        "geo_concentration_ratio": F.when(people > 0, F.col("geo_claim_count") / people).otherwise(1.0),
    }).drop("_sum", "_sum_n").withColumns({
        "geo_anomaly": _tiers(F.col("geo_concentration_ratio"), (3, 1.0), (2, 0.5)),
        "geo_amount_anomaly": _tiers(F.col("geo_avg_amount"), (mean * 2, 1.0), (mean * 1.5, 0.5)),
    }).withColumn("geographic_anomaly_score", F.greatest("geo_anomaly", "geo_amount_anomaly"))


def customer_behavior_anomaly(df: DataFrame, cfg: AnomalyConfig = AnomalyConfig(), facts: DataFrame | None = None,
                              only: DataFrame | None = None) -> DataFrame:
    """Each claim against the same customer's previous 90 days (the current second excluded)."""
    clocked = _clocked(df)
    stats = sliding_extremes(
        _facts(df, facts, only, ["customer_id"], "claim_amount_gbp", "days_to_claim"), ["customer_id"], _AT,
        cfg.customer_days * cfg.day, -1, {
            "customer_claim_count": ("count", None),
            "_sum": ("sum", "claim_amount_gbp"), "_n": ("count", "claim_amount_gbp"),
            "customer_max_amount": ("max", "claim_amount_gbp"),
            "_days": ("sum", "days_to_claim"), "_days_n": ("count", "days_to_claim"),
        })
    joined = null_safe_join(clocked, stats, ["customer_id", _AT]).drop(_AT)
    amount, usual = F.col("claim_amount_gbp"), F.col("customer_avg_amount")
    return joined.withColumns({
        "customer_claim_count": F.coalesce("customer_claim_count", F.lit(0)),
        "customer_avg_amount": F.try_divide("_sum", "_n"),
        "customer_avg_days_between": F.try_divide("_days", "_days_n"),
    }).drop("_sum", "_n", "_days", "_days_n").withColumn(
        "amount_vs_history", F.when(usual > 0, amount / usual).otherwise(1.0)
    ).withColumns({
        "customer_amount_anomaly": _tiers(F.col("amount_vs_history"), (5, 1.0), (3, 0.7), (2, 0.3)),
        "customer_frequency_anomaly": _tiers(F.col("customer_claim_count"), (5, 1.0), (3, 0.5)),
        "first_time_high_value": F.when(
            (F.col("customer_claim_count") == 0) & (amount > cfg.first_claim_amount), 1.0).otherwise(0.0),
    }).withColumn("customer_anomaly_score", F.greatest(
        "customer_amount_anomaly", "customer_frequency_anomaly", "first_time_high_value"))


def network_anomaly(df: DataFrame, cfg: AnomalyConfig = AnomalyConfig(), facts: DataFrame | None = None,
                    only: DataFrame | None = None) -> DataFrame:
    """Claims around the same postcode within three days. Needs ``hourly_avg_amount``."""
    clocked = _clocked(df)
    reach = cfg.network_days * cfg.day
    stats = sliding_stats(_facts(df, facts, only, ["incident_postcode"], "customer_id"), ["incident_postcode"], _AT,
                          reach, reach, count="same_location_claims",
                          distinct=("unique_customers_location", "customer_id"))
    joined = null_safe_join(clocked, stats, ["incident_postcode", _AT]).drop(_AT)
    alike = F.abs(F.col("claim_amount_gbp") - F.col("hourly_avg_amount")) < cfg.similar_amount
    crowded, similar = F.col("location_concentration") > 0.5, F.col("similar_amounts") > 0.5
    return joined.withColumns({
        "location_concentration": _tiers(F.col("same_location_claims"), (3, 1.0), (2, 0.5)),
        "similar_amounts": F.when(alike, 1.0).otherwise(0.0),
    }).withColumn("network_anomaly_score",
                  F.when(crowded & similar, 1.0).when(crowded | similar, 0.5).otherwise(0.0))


_PARTS = [
    ("statistical_anomaly_score", "STATISTICAL_OUTLIER"), ("time_series_anomaly_score", "TIME_PATTERN"),
    ("geographic_anomaly_score", "GEOGRAPHIC_CLUSTER"), ("customer_anomaly_score", "CUSTOMER_BEHAVIOR"),
    ("network_anomaly_score", "NETWORK_PATTERN"),
]


def composite_anomaly(df: DataFrame, cfg: AnomalyConfig = AnomalyConfig()) -> DataFrame:
    """Weighted score, severity, reasons and investigation priority."""
    terms = [F.col(name) * weight for (name, _), weight in zip(_PARTS, cfg.weights)]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    score, severity, amount = F.col("composite_anomaly_score"), F.col("anomaly_severity"), F.col("claim_amount_gbp")
    return (
        df.withColumn("composite_anomaly_score", total)
        .withColumn("anomaly_severity", F.when(score > 0.8, "CRITICAL").when(score > 0.6, "HIGH")
                    .when(score > 0.4, "MEDIUM").when(score > 0.2, "LOW").otherwise("NONE"))
        .withColumn("anomaly_reasons", labels_of([(reason, F.col(name) > cfg.reason_above) for name, reason in _PARTS]))
        .withColumn("investigation_priority",
                    F.when((severity == "CRITICAL") & (amount > 10000), 1).when(severity == "CRITICAL", 2)
                    .when((severity == "HIGH") & (amount > 5000), 3).when(severity == "HIGH", 4).otherwise(5))
    )


OUTPUT_COLUMNS = [
    "claim_id", "claim_date", "customer_id", "claim_type", "claim_amount_gbp", "incident_postcode",
    *[name for name, _ in _PARTS], "composite_anomaly_score", "anomaly_severity", "anomaly_reasons",
    "investigation_priority", "amount_anomaly", "timing_anomaly", "fraud_score_anomaly", "velocity_anomaly",
    "geo_concentration_ratio", "customer_frequency_anomaly",
]
INPUT_COLUMNS = [
    "claim_id", "claim_date", "customer_id", "claim_type", "claim_amount_gbp", "incident_postcode",
    "postcode_district", "days_to_claim", "fraud_score",
]


def score_claims(df: DataFrame, baselines: DataFrame, cfg: AnomalyConfig = AnomalyConfig(),
                 facts: DataFrame | None = None, restrict: bool = False,
                 store: Callable[[DataFrame], DataFrame] = lambda scored: scored) -> DataFrame:
    """All detectors and the composite score over the columns they need.

    ``facts`` are the claims the look-backs read when only some rows are scored; ``restrict`` limits
    them to the keys of those rows. ``store`` may store what each detector gives, so that each is a query of its own.
    """
    narrow = df.select(*INPUT_COLUMNS)
    source = narrow if facts is None else facts
    scored = statistical_anomaly(narrow, baselines, cfg)
    for detector in (time_series_anomaly, geographic_anomaly, customer_behavior_anomaly, network_anomaly):
        scored = store(detector(scored, cfg, source, narrow if restrict else None))
    return composite_anomaly(scored, cfg)


def anomaly_output(df: DataFrame, as_of: Column | None = None, detected_at: Column | None = None,
                   cfg: AnomalyConfig = AnomalyConfig()) -> DataFrame:
    """Scores of all claims against the baselines of the last 90 days."""
    baselines = statistical_baselines(df, as_of, cfg)
    stamp = detected_at if detected_at is not None else F.current_timestamp()
    return score_claims(df, baselines, cfg).select(*OUTPUT_COLUMNS, stamp.alias("anomaly_detection_timestamp"))


def anomaly_alerts(scored: DataFrame) -> DataFrame:
    """Critical and high anomalies worth more than the lower amounts."""
    urgent = F.col("anomaly_severity").isin("CRITICAL", "HIGH") & (F.col("investigation_priority") <= 3)
    return scored.where(urgent).select("claim_id", "customer_id", "claim_amount_gbp", "composite_anomaly_score",
                                       "anomaly_severity", "anomaly_reasons", "investigation_priority")


def _recent(scored: DataFrame, as_of: Column | None, hours: int) -> DataFrame:
    if as_of is None:
        return scored
    return scored.where(F.col("anomaly_detection_timestamp") >= as_of - F.make_interval(hours=F.lit(hours)))


def anomaly_patterns(scored: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Count and means per severity and reason over the last 24 hours of detection."""
    return (
        _recent(scored, as_of, 24)
        .select("anomaly_severity", F.explode("anomaly_reasons").alias("anomaly_type"),
                "composite_anomaly_score", "claim_amount_gbp")
        .groupBy("anomaly_severity", "anomaly_type")
        .agg(F.count("*").alias("anomaly_count"), F.avg("composite_anomaly_score").alias("avg_score"),
             F.avg("claim_amount_gbp").alias("avg_amount"))
    )


def detection_metrics(scored: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Totals and rates of one hour of detection."""
    ids = lambda level: F.count_distinct(F.when(F.col("anomaly_severity") == level, F.col("claim_id")))
    return _recent(scored, as_of, 1).agg(
        F.count("*").alias("total_claims_analyzed"),
        F.count_if(F.col("anomaly_severity") != "NONE").alias("anomalies_detected"),
        F.avg("composite_anomaly_score").alias("avg_anomaly_score"),
        F.max("composite_anomaly_score").alias("max_anomaly_score"),
        ids("CRITICAL").alias("critical_anomalies"),
        ids("HIGH").alias("high_anomalies"),
    ).withColumn("detection_rate", F.try_divide("anomalies_detected", "total_claims_analyzed") * 100)
