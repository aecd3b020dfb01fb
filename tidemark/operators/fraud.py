"""Fraud scoring of claims with their policy and policyholder: signals, score, tracking."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import refdata
from tidemark.config import FraudConfig
from tidemark.functions.folds import sequential_scores
from tidemark.functions.timing import days_24h
from tidemark.functions.windows import null_safe_join, numbered_rows, sliding_stats, with_previous
from tidemark.operators.customers import age_on
from tidemark.operators.silver import labels_of
from tidemark.session import cut, stores

DAY = 86400


def case_file(claims: DataFrame, policies: DataFrame, holders: DataFrame, as_of: Column) -> DataFrame:
    """Claims with the policy and policyholder columns the signals read (every claim is kept)."""
    terms = policies.select("policy_number", "policy_type", "start_date", "end_date", "sum_insured", "deductible")
    extra = [c for c in ("blacklisted",) if c in holders.columns]
    people = holders.select("policyholder_id", "email", "company_registration", "holder_postcode",
                            F.col("risk_score").alias("holder_risk_score"),
                            age_on(F.col("date_of_birth"), as_of).alias("holder_age"), *extra)
    return claims.join(terms, "policy_number", "left").join(people, "policyholder_id", "left")


def _step(*cases: tuple[Column, float]) -> Column:
    chain = F
    for condition, score in cases:
        chain = chain.when(condition, score)
    return chain.otherwise(0.0)


def signal_timing(cases: DataFrame) -> DataFrame:
    """Early and late claims, late reports and weekend incidents."""
    since_start = days_24h(F.col("incident_date"), F.col("start_date"))
    delay = days_24h(F.col("reported_date"), F.col("incident_date"))
    to_end = days_24h(F.col("end_date"), F.col("incident_date"))
    score = (_step((since_start < 30, 0.6), (since_start < 60, 0.3)) + _step((delay > 30, 0.3), (delay > 14, 0.1))
             + _step((to_end < 30, 0.2)) + _step((F.dayofweek("incident_date").isin(1, 7), 0.1)))
    suspicious = F.coalesce((since_start < 30) | (delay > 30), F.lit(False))
    return cases.withColumns({"timing": F.least(score, F.lit(1.0)), "_suspicious_timing": suspicious})


def signal_amount(cases: DataFrame) -> DataFrame:
    """Share of the sum insured, closeness to the deductible and round amounts."""
    amount = F.col("claim_amount")
    share = F.when(F.col("sum_insured") > 0, amount / F.col("sum_insured")).otherwise(0.0)
    score = (_step((share > 0.8, 0.5), (share > 0.6, 0.3), (share > 0.4, 0.1))
             + _step((amount < F.col("deductible") * 1.1, 0.2))
             + _step((amount % 1000 == 0, 0.1), (amount % 500 == 0, 0.05)))
    return cases.withColumns({"amount": F.least(score, F.lit(1.0)), "_inflated": share > 0.8})


def signal_frequency(cases: DataFrame, claims: DataFrame | None = None,
                     store: Callable[[DataFrame], DataFrame] = lambda counts: counts) -> DataFrame:
    """Earlier claims of the holder within a year, and an earlier one of the same type within a week.

    ``claims`` is the plain claims table the history is read from (``cases`` by default) and has the keys of all cases.
    Both counts are block-wise look-backs, so a holder with a large share of all claims is no bottleneck. They are put
    together first, so the cases are joined once; ``store`` may store each of the two tables.
    """
    at = "_incident_s"
    clocked = cases.withColumn(at, F.unix_timestamp("incident_date"))
    source = (cases if claims is None else claims).select(
        "policyholder_id", "claim_type", F.unix_timestamp("incident_date").alias(at))
    yearly = sliding_stats(source, ["policyholder_id"], at, 365 * DAY, -1, count="_recent")
    weekly = sliding_stats(source, ["policyholder_id", "claim_type"], at, 6 * DAY, -1, count="_alike")
    first = source.groupBy("policyholder_id").agg(F.min(at).alias("_first"))
    history = store(null_safe_join(yearly, first, ["policyholder_id"]))
    history = store(null_safe_join(weekly, history, ["policyholder_id", at]))
    joined = null_safe_join(clocked, history, ["policyholder_id", "claim_type", at])
    recent = F.col("_recent")
    score = _step((recent > 5, 0.6), (recent > 3, 0.3), (recent > 2, 0.1)) + _step((F.col("_alike") > 0, 0.5))
    return joined.withColumns({
        "prior_claims_365d": recent,
        "frequency": F.least(score, F.lit(1.0)),
        "has_history": F.col("_first") < F.col(at),
        "_unusual": recent > 5,
        "_duplicate": F.col("_alike") > 0,
    }).drop(at, "_recent", "_alike", "_first")


def signal_geographic(cases: DataFrame) -> DataFrame:
    """Incident away from home, and incidents in the high-risk areas."""
    place, home = (F.coalesce(c, F.lit("")) for c in ("incident_postcode", "holder_postcode"))
    here, there = F.left(place, F.lit(3)), F.left(home, F.lit(3))
    away = (here != "") & (there != "") & (here != there)
    risky = place.rlike("^(" + "|".join(refdata.HIGH_RISK_AREAS) + ")")
    return cases.withColumn("geographic", F.least(_step((away, 0.3)) + _step((risky, 0.2)), F.lit(1.0)))


def signal_text(df: DataFrame, column: str = "description") -> DataFrame:
    """Suspicious phrases in a text: 0.2 each, at most 1."""
    text = F.lower(F.coalesce(F.col(column), F.lit("")))
    hits = sum((text.contains(phrase).cast("int") for phrase in refdata.SUSPICIOUS_PHRASES), F.lit(0))
    return df.withColumn("text_analysis", F.least(hits * F.lit(0.2), F.lit(1.0)))


HOLDER_RISK_COLUMNS = ["holder_age", "holder_risk_score"]


def holder_base_risk() -> Column:
    """The policyholder's own risk with the age adjustment."""
    age = F.col("holder_age")
    return F.coalesce("holder_risk_score", F.lit(0.0)) + F.when(age < 25, 0.1).when(age > 75, 0.05).otherwise(0.0)


def blacklist_check(holders: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Add ``blacklisted``: id, email or company registration is on the list (column ``entity``)."""
    names = holders.select("policyholder_id", F.explode(F.array_distinct(F.array_compact(F.array(
        "policyholder_id", "email", "company_registration")))).alias("entity"))
    hit = names.join(blacklist.select("entity").distinct(), "entity", "left_semi").select("policyholder_id").distinct()
    return (holders.join(hit.withColumn("_hit", F.lit(True)), "policyholder_id", "left")
            .withColumn("blacklisted", F.coalesce("_hit", F.lit(False))).drop("_hit"))


def symmetric_edges(edges: DataFrame) -> DataFrame:
    """Every edge in both directions, once; self-loops dropped."""
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return edges.select("src", "dst").unionByName(back).where("src <> dst").distinct()


def mean_scores(scores: DataFrame, score: str = "fraud_score") -> DataFrame:
    return scores.groupBy("policyholder_id").agg(F.avg(score).alias("mean_score"))


def signal_network(edges: DataFrame, means: DataFrame, cfg: FraudConfig = FraudConfig()) -> DataFrame:
    """Per holder with connections: neighbours whose mean score is high, and the network signal.

    Only the neighbours above the limit are joined to the edges, so the aggregation is over the few
    suspicious links instead of the whole graph.
    """
    links = symmetric_edges(edges)
    bad = means.where(F.col("mean_score") > cfg.neighbour_score).select(F.col("policyholder_id").alias("dst"))
    counted = links.join(bad, "dst", "left_semi").groupBy("src").agg(F.count("*").alias("fraud_connections"))
    everyone = links.select("src").distinct().join(counted, "src", "left")
    n = F.coalesce("fraud_connections", F.lit(0))
    return everyone.select(F.col("src").alias("policyholder_id"), n.alias("fraud_connections"),
                           _step((n > 2, 0.8), (n > 0, 0.4)).alias("network"))


def number_claims(cases: DataFrame) -> DataFrame:
    """Add ``claim_number``: position among the holder's claims by incident date and claim id."""
    clocked = cases.withColumn("_at", F.unix_timestamp("incident_date"))
    return numbered_rows(clocked, ["policyholder_id"], "_at", ["claim_id"], DAY, "claim_number").drop("_at")


def signal_policyholder_risk(cases: DataFrame, score_base: str = "score_base", weight: float = FraudConfig.weight_holder,
                             chunk: int = 50_000) -> DataFrame:
    """The holder's risk averaged with the mean of the holder's earlier scores, claim by claim.

    ``score_base`` is everything else that enters the score. Numbered cases get policyholder_risk and
    running_score, the score that follows; cases without ``claim_number`` are numbered and stored
    first, with the columns needed only.
    """
    prepared = cases.withColumn("_hr", holder_base_risk())
    if "claim_number" not in cases.columns:
        prepared = cut(number_claims(prepared.select("policyholder_id", "claim_id", "incident_date", score_base, "_hr")))
    return sequential_scores(prepared, "policyholder_id", "claim_number", score_base, "_hr", weight,
                             "policyholder_risk", "running_score", chunk).drop("_hr")


def risk_level(score: Column, cfg: FraudConfig = FraudConfig()) -> Column:
    return (F.when(score >= cfg.critical, "CRITICAL").when(score >= cfg.high, "HIGH")
            .when(score >= cfg.medium, "MEDIUM").when(score >= cfg.low, "LOW").otherwise("MINIMAL"))


def recommended_action(level: Column) -> Column:
    return (F.when(level == "CRITICAL", "IMMEDIATE_INVESTIGATION_REQUIRED").when(level == "HIGH", "MANUAL_REVIEW_REQUIRED")
            .when(level == "MEDIUM", "ADDITIONAL_DOCUMENTATION_REQUIRED")
            .when(level == "LOW", "STANDARD_PROCESSING_WITH_MONITORING").otherwise("STANDARD_PROCESSING"))


def fraud_confidence(df: DataFrame, cfg: FraudConfig = FraudConfig()) -> DataFrame:
    """Add ``confidence`` from how many signals are active and how much they agree.

    Frequency counts only for holders with history, a blacklist hit counts as 1.0 and is absent
    otherwise.
    """
    signals = F.array_compact(F.array(
        "timing", "amount", F.when(F.col("has_history"), F.col("frequency")), "geographic", "policyholder_risk",
        "network", "text_analysis", F.when(F.col("blacklisted"), F.lit(1.0))))
    size = F.size(signals)
    active = F.size(F.filter(signals, lambda v: v > cfg.active_signal))
    mean = F.aggregate(signals, F.lit(0.0), lambda a, v: a + v) / size
    squares = F.aggregate(signals, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean))
    return df.withColumn("confidence", F.least(active * F.lit(0.2), F.lit(1.0)) * (1 - F.sqrt(squares / size)))


# Columns the signals have read and the analysis does not carry on.
_CASE_ONLY = {"description", "email", "company_registration", "start_date", "end_date", "deductible", "city", "claim_state"}


def fraud_score(claims: DataFrame, policies: DataFrame, holders: DataFrame, edges: DataFrame, blacklist: DataFrame,
                as_of: Column, cfg: FraudConfig = FraudConfig()) -> DataFrame:
    """The full analysis of every claim.

    The network signal needs other holders' scores, so scores are taken twice: once without it to
    get mean scores per holder, then again with the network signal those means give. Every step that shuffles the
    claims is stored before the next, so that the disk holds the shuffle files of one step and not of all.
    """
    with stores() as store:
        cases = case_file(signal_text(claims), policies, blacklist_check(holders, blacklist), as_of).withColumn(
            "blacklisted", F.coalesce("blacklisted", F.lit(False)))
        rowwise = cases.transform(signal_timing).transform(signal_amount).transform(signal_geographic)
        rowwise = store(rowwise.drop(*_CASE_ONLY))
        signals = store(signal_frequency(rowwise, claims, store), rowwise)
        own = (F.col("timing") * cfg.weight_timing + F.col("amount") * cfg.weight_amount
               + F.when(F.col("has_history"), F.col("frequency") * cfg.weight_frequency).otherwise(0.0)
               + F.col("geographic") * cfg.weight_geographic + F.col("text_analysis") * cfg.weight_text
               + F.when(F.col("blacklisted"), cfg.blacklist_bonus).otherwise(0.0))
        based = store(number_claims(signals.withColumn("score_base", own)), signals)
        facts = ["policyholder_id", "claim_number", "score_base", *HOLDER_RISK_COLUMNS]
        means = mean_scores(signal_policyholder_risk(based.select(*facts), weight=cfg.weight_holder), "running_score")
        network = store(signal_network(edges, means, cfg).select("policyholder_id", "network"))
        linked = based.join(network, "policyholder_id", "left")
        linked = cut(linked.withColumn("network", F.coalesce("network", F.lit(0.0))).withColumn(
            "score_base", F.col("score_base") + F.col("network") * cfg.weight_network))
    second = signal_policyholder_risk(linked, weight=cfg.weight_holder)
    score, level = F.col("analysis_score"), F.col("risk_level")
    return (
        second.withColumn("analysis_score", F.col("running_score"))
        .withColumn("risk_level", risk_level(score, cfg))
        .withColumns({
            "is_flagged": score > cfg.medium,
            "recommended_action": recommended_action(level),
            "analysis_indicators": F.sort_array(labels_of([
                ("suspicious_timing", F.col("_suspicious_timing")), ("inflated_amount", F.col("_inflated")),
                ("unusual_frequency", F.col("has_history") & F.col("_unusual")),
                ("duplicate_claim", F.col("has_history") & F.col("_duplicate")),
                ("blacklisted_entity", F.col("blacklisted"))])),
        })
        .transform(fraud_confidence, cfg)
        .drop("score_base", "running_score", "_suspicious_timing", "_inflated", "_unusual", "_duplicate")
    )


def fraud_tracking(scores: DataFrame, score: str = "fraud_score", cfg: FraudConfig = FraudConfig(),
                   chunk: int = 100_000) -> DataFrame:
    """Mean of each holder's last three scores at every claim; above the limit blacklists the holder."""
    steps = cfg.recent_scores - 1
    facts = scores.select("policyholder_id", "claim_id", F.unix_timestamp("incident_date").alias("_at"), score)
    numbered = numbered_rows(facts, ["policyholder_id"], "_at", ["claim_id"], DAY, "claim_number")
    recent = with_previous(numbered, ["policyholder_id"], "claim_number", steps, {"_recent": score}, chunk)
    total = F.aggregate("_recent", F.lit(0.0), lambda a, v: a + v)
    mean = F.when(F.size("_recent") > steps, total / F.size("_recent"))
    return recent.select("policyholder_id", "claim_id", "claim_number", score, mean.alias("recent_mean"),
                         F.coalesce(mean > cfg.high, F.lit(False)).alias("blacklists_holder"))


def tracked_blacklist(tracking: DataFrame) -> DataFrame:
    """Holders put on the blacklist by their scores."""
    return tracking.where("blacklists_holder").select(F.col("policyholder_id").alias("entity")).distinct()


def fraud_statistics(scores: DataFrame, blacklist: DataFrame, edges: DataFrame, score: str = "fraud_score",
                     cfg: FraudConfig = FraudConfig()) -> DataFrame:
    """Totals over analysed claims, holders, blacklist and connections in one row."""
    per_holder = scores.groupBy("policyholder_id").agg(
        F.count(score).alias("n"), F.sum(score).alias("total"), F.avg(score).alias("mean"))
    people = per_holder.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_claims_analyzed"),
        F.count("*").alias("unique_policyholders"),
        F.count_if(F.col("mean") > cfg.high).alias("high_risk_policyholders"),
        F.coalesce(F.try_divide(F.sum("total"), F.sum("n")), F.lit(0.0)).alias("average_fraud_score"))
    listed = blacklist.agg(F.count_distinct("entity").alias("blacklisted_entities"))
    links = symmetric_edges(edges).agg(F.count("*").alias("network_connections"))
    one = F.lit(1)
    return (people.withColumn("_one", one).join(listed.withColumn("_one", one), "_one")
            .join(links.withColumn("_one", one), "_one").drop("_one"))


def pattern_rule_score(cases: DataFrame) -> DataFrame:
    """The deterministic pattern score: early, inflated, late reported, risky holder."""
    early = days_24h(F.col("incident_date"), F.col("start_date")) < 30
    late = days_24h(F.col("reported_date"), F.col("incident_date")) > 30
    score = (_step((early, 0.3)) + _step((F.col("claim_amount") > F.col("sum_insured") * 0.5, 0.25))
             + _step((late, 0.2)) + _step((F.col("holder_risk_score") > 0.7, 0.15)))
    return cases.withColumns({"pattern_score": F.least(score, F.lit(1.0)), "pattern_flagged": score > 0.6})
