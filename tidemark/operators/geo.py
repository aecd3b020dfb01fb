"""Postcode profiles, geographic risk, rating and entity checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import refdata
from tidemark.functions.postcodes import area_of, geodesic_km, parsed_postcode
from tidemark.functions.timing import days_24h
from tidemark.operators.customers import age_on


def profiles(spark) -> DataFrame:
    """The postcode area profiles as a constant table."""
    return refdata.inline_table(spark, refdata.PROFILE_COLUMNS, refdata.AREA_PROFILES)


def parse_postcode(df: DataFrame, column: str) -> DataFrame:
    """Add ``postcode``, a struct of the parts of ``column`` (null where it does not parse)."""
    return df.withColumn("postcode_parts", parsed_postcode(F.col(column)))


def postcode_profile(df: DataFrame, column: str, *fields: str) -> DataFrame:
    """Add profile columns (all, or the named ones) of the area of ``column``."""
    wanted = fields or tuple(c for c in profiles(df.sparkSession).columns if c != "area")
    table = profiles(df.sparkSession).select(F.col("area").alias("_area"), *wanted)
    return (df.withColumn("_of", area_of(F.col(column)))
            .join(F.broadcast(table), F.col("_of") == F.col("_area"), "left").drop("_of", "_area"))


def postcode_risk_score(df: DataFrame, column: str, weights: dict[str, float] | None = None,
                        known_only: bool = False) -> DataFrame:
    """Add ``postcode_risk``: base risk plus the weighted crime, flood, income and density factors."""
    weights = weights or {}
    needed = ["base_risk_score", "crime_rate", "flood_risk", "average_income", "population_density"]
    profiled = postcode_profile(df, column, *needed)
    score = F.col("base_risk_score")
    if "crime_weight" in weights:
        score = score + F.col("crime_rate") / 100 * weights["crime_weight"] * 0.2
    if "flood_weight" in weights:
        score = score + F.col("flood_risk") * weights["flood_weight"] * 0.15
    if "income_weight" in weights:
        score = score + (1 - F.col("average_income") / 75000) * weights["income_weight"] * 0.1
    if "density_weight" in weights:
        score = score + F.least(F.col("population_density") / 10000, F.lit(1.0)) * weights["density_weight"] * 0.1
    bounded = F.greatest(F.least(score, F.lit(1.0)), F.lit(0.0))
    unknown = F.lit(None).cast("double") if known_only else F.lit(refdata.DEFAULT_RISK)
    return profiled.withColumn(
        "postcode_risk", F.when(F.col("base_risk_score").isNull(), unknown).otherwise(bounded)).drop(*needed)


def postcode_distance(df: DataFrame, first: str, second: str) -> DataFrame:
    """Add ``distance_km`` between the centres of two postcodes' areas, null if one is unknown."""
    place = {"latitude": "{}_lat", "longitude": "{}_lon"}
    for side, column in (("a", first), ("b", second)):
        df = postcode_profile(df, column, "latitude", "longitude").withColumnsRenamed(
            {old: "_" + new.format(side) for old, new in place.items()})
    distance = geodesic_km(*[F.col(c) for c in ("_a_lat", "_a_lon", "_b_lat", "_b_lon")])
    return df.withColumn("distance_km", distance).drop("_a_lat", "_a_lon", "_b_lat", "_b_lon")


def areas_by_zone(spark, group: str) -> DataFrame:
    """Areas of the ``high`` (and very high) or ``low`` (and very low) zones."""
    return profiles(spark).where(F.col("risk_zone").isin(group, f"very_{group}")).select("area", "risk_zone")


def claims_by_zone(df: DataFrame, column: str, group: str) -> DataFrame:
    """Claims per area of a zone group; the areas without claims appear with 0."""
    counted = (df.select(area_of(F.col(column)).alias("area")).where("area IS NOT NULL")
               .groupBy("area").agg(F.count("*").alias("claims")))
    zones = areas_by_zone(df.sparkSession, group)
    return zones.join(counted, "area", "left").withColumn("claims", F.coalesce("claims", F.lit(0)))


def geographic_concentration(df: DataFrame, group: str, column: str) -> DataFrame:
    """How a group's postcodes spread over areas.

    Rows are counted per (group, area) first, so what comes together per group is at most one entry
    per postcode area (an area is one or two letters).
    """
    risk = profiles(df.sparkSession).select("area", "base_risk_score")
    per_area = df.groupBy(group, area_of(F.col(column)).alias("area")).agg(F.count("*").alias("n"))
    per_area = per_area.join(F.broadcast(risk), "area", "left")
    parsed, profiled = F.col("area").isNotNull(), F.col("base_risk_score").isNotNull()
    n = F.col("n")
    spread = per_area.groupBy(group).agg(
        F.sum(n).alias("total_postcodes"),
        F.count_if(parsed).alias("unique_areas"),
        F.min_by(F.when(parsed, F.col("area")), F.when(parsed, F.struct(-n, F.col("area")))).alias("most_common_area"),
        F.coalesce(F.max(F.when(parsed, n)), F.lit(0)).alias("_top"),
        F.sum(F.when(profiled, n * F.col("base_risk_score"))).alias("_risk"),
        F.sum(F.when(profiled, n)).alias("_known"),
        F.sort_array(F.collect_list(F.when(parsed, F.struct("area", "n")))).alias("_areas"),
    )
    least = F.greatest(F.lit(3.0), F.col("total_postcodes") * 0.1)
    ratio = F.col("_top") / F.col("total_postcodes")
    average = F.coalesce(F.try_divide("_risk", "_known"), F.lit(0.0))
    return spread.select(
        group, "total_postcodes", "unique_areas", "most_common_area", ratio.alias("concentration_ratio"),
        average.alias("average_risk_score"),
        F.map_from_entries(F.filter("_areas", lambda e: e["n"] >= least)).alias("clusters"),
        (ratio > 0.3).alias("high_concentration"), ((ratio > 0.5) & (average > 0.6)).alias("suspicious_clustering"))


# ------------------------------------------------------------------------------- rating

def policyholder_risk_score(holders: DataFrame, as_of: Column, column: str = "holder_postcode") -> DataFrame:
    """Add ``holder_risk``: risk of the area plus an age and a corporate adjustment."""
    outward = F.get(F.split(column, " "), F.lit(0))
    area = F.expr(f"substring(split(`{column}`, ' ')[0], 1, greatest(length(split(`{column}`, ' ')[0]) - 1, 0))")
    table = refdata.inline_table(holders.sparkSession, "_zone STRING, _base DOUBLE", refdata.UNDERWRITING_RISK)
    joined = holders.withColumn("_of", F.when(outward != "", area)).join(
        F.broadcast(table), F.col("_of") == F.col("_zone"), "left")
    age = F.floor(days_24h(as_of, F.col("date_of_birth")) / 365)
    by_age = F.when(age < 25, 0.3).when(age < 30, 0.2).when(age < 60, 0.0).otherwise(0.1)
    corporate = F.when(F.col("is_corporate"), -0.1).otherwise(0.0)
    score = F.coalesce("_base", F.lit(refdata.DEFAULT_RISK)) + by_age + corporate
    return joined.withColumn("holder_risk", F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))).drop("_of", "_zone", "_base")


def risk_profile_band(score: Column) -> Column:
    return F.when(score < 0.3, "low").when(score < 0.6, "medium").when(score < 0.8, "high").otherwise("very_high")


def base_premium_rating(policies: DataFrame, risk: str = "risk_score") -> DataFrame:
    """Add the technical premium and whether sum insured and deductible lie in their bands."""
    rating = refdata.inline_table(
        policies.sparkSession,
        "policy_type STRING, _pmin DOUBLE, _pmax DOUBLE, _imin DOUBLE, _imax DOUBLE, _dmin DOUBLE, _dmax DOUBLE",
        refdata.RATING)
    premium, insured = F.col("premium_amount"), F.col("sum_insured")
    return policies.join(F.broadcast(rating), "policy_type", "left").withColumns({
        "base_premium": F.col("_pmin") + (F.col("_pmax") - F.col("_pmin")) * F.col(risk),
        "sum_insured_in_band": insured.between(premium * F.col("_imin"), premium * F.col("_imax")),
        "deductible_in_band": F.col("deductible").between(insured * F.col("_dmin"), insured * F.col("_dmax")),
    }).drop("_pmin", "_pmax", "_imin", "_imax", "_dmin", "_dmax")


def renewals_due(policies: DataFrame, start: Column, end: Column, year: int, premium_factor: float = 1.0,
                 insured_factor: float = 1.0) -> DataFrame:
    """The next term of the policies that end in [start, end)."""
    due = policies.where((F.col("end_date") >= start) & (F.col("end_date") < end))
    return due.withColumns({
        "policy_number": F.concat("policy_number", F.lit(f"-R{year}")),
        "start_date": F.col("end_date"),
        "end_date": F.col("end_date") + F.expr("INTERVAL 365 DAYS"),
        "premium_amount": F.round(F.col("premium_amount") * premium_factor, 2),
        "sum_insured": F.col("sum_insured") * insured_factor,
        "is_active": F.lit(True),
    })


def claim_severity_vs_band(cases: DataFrame) -> DataFrame:
    """Claimed share of the sum insured against the band of the claim type."""
    bands = refdata.inline_table(cases.sparkSession, "claim_type STRING, _low DOUBLE, _high DOUBLE", refdata.SEVERITY_BANDS)
    low, high = refdata.DEFAULT_SEVERITY_BAND
    share = F.try_divide("claim_amount", "sum_insured")
    return cases.join(F.broadcast(bands), "claim_type", "left").withColumns({
        "severity": share,
        "band_low": F.coalesce("_low", F.lit(low)),
        "band_high": F.coalesce("_high", F.lit(high)),
    }).drop("_low", "_high").withColumn(
        "out_of_band", (F.col("severity") < F.col("band_low")) | (F.col("severity") > F.col("band_high")))


# ------------------------------------------------------------------------------- entities

def _report(df: DataFrame, key: str, checks: dict[str, Column]) -> DataFrame:
    """Ids with the names of the checks they fail."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))
    return df.select(F.col(key).alias("entity_id"), failed.alias("violations"), (F.size(failed) == 0).alias("is_valid"))


def validate_policies(policies: DataFrame) -> DataFrame:
    return _report(policies, "policy_number", {
        "policy_type": F.col("policy_type").isin(refdata.POLICY_TYPES),
        "end_after_start": F.col("end_date") > F.col("start_date"),
        "premium_positive": F.col("premium_amount") > 0,
        "sum_insured_positive": F.col("sum_insured") > 0,
        "deductible_not_negative": F.col("deductible") >= 0,
        "risk_profile": F.col("risk_profile").isin(refdata.RISK_PROFILES),
    })


def validate_holders(holders: DataFrame, column: str = "holder_postcode") -> DataFrame:
    clean = F.replace(F.upper(F.col(column)), F.lit(" "), F.lit(""))
    return _report(holders, "policyholder_id", {
        "postcode": clean.rlike(refdata.ENTITY_POSTCODE),
        "risk_score_range": F.col("risk_score").between(0, 1),
    })


def validate_claims(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Constraint report of claims, including whether the policy type may carry the claim type."""
    pairs = [(policy, claim) for policy, kinds in refdata.ALLOWED_CLAIM_TYPES.items() for claim in kinds]
    allowed = refdata.inline_table(claims.sparkSession, "policy_type STRING, claim_type STRING", pairs)
    typed = claims.join(policies.select("policy_number", "policy_type"), "policy_number", "left")
    marked = typed.join(F.broadcast(allowed.withColumn("_allowed", F.lit(True))), ["policy_type", "claim_type"], "left")
    return _report(marked, "claim_id", {
        "claim_type": F.col("claim_type").isin(refdata.CLAIM_TYPES),
        "claim_status": F.col("claim_state").isin(refdata.CLAIM_STATUSES),
        "amount_positive": F.col("claim_amount") > 0,
        "fraud_score_range": F.col("fraud_score").between(0, 1),
        "reported_after_incident": F.col("reported_date") >= F.col("incident_date"),
        "allowed_for_policy": F.col("_allowed"),
    })


def entity_validation(policies: DataFrame, holders: DataFrame, claims: DataFrame) -> DataFrame:
    """The three constraint reports in one table."""
    reports = {"policy": validate_policies(policies), "policyholder": validate_holders(holders),
               "claim": validate_claims(claims, policies)}
    tagged = [report.select(F.lit(kind).alias("entity_type"), "*") for kind, report in reports.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


def entity_derivations(claims: DataFrame, holders: DataFrame, as_of: Column) -> DataFrame:
    """Age of the policyholder and reporting delay of each claim."""
    ages = holders.select("policyholder_id", age_on(F.col("date_of_birth"), as_of).alias("age"))
    return claims.join(ages, "policyholder_id", "left").select(
        "claim_id", "age", days_24h(F.col("reported_date"), F.col("incident_date")).alias("reporting_delay_days"))
