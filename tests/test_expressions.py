"""Golden values of masks, patterns, postcodes, rules and silver thresholds, with nulls and edges."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import masking, pii
from tidemark.functions.postcodes import parsed_postcode
from tidemark.functions.timing import days_24h
from tidemark.operators import bronze, geo, silver


def _one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(make(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("mask,value,expected", [
    (masking.mask_email, "john.smith@example.com", "j********h@example.com"), (masking.mask_email, "ab@x.uk", "***@x.uk"),
    (masking.mask_email, "nothing", "nothing"), (masking.mask_email, None, None), (masking.mask_email, "", ""),
    (masking.mask_phone, "07123 456-789", "0712*****89"), (masking.mask_phone, "12345", "*****"), (masking.mask_phone, None, None),
    (masking.mask_name, "John Henry Smith", "J*** S***"), (masking.mask_name, "Cher", "C***"), (masking.mask_name, "", ""),
    (masking.mask_address, "10 Downing Street, London, SW1A 2AA", "10 ***, SW** ***"),
    (masking.mask_address, "Flat 2, Nowhere", "Flat ***"), (masking.mask_address, "Manor", "Manor ***"),
    (masking.mask_address, None, None), (masking.hash_id, None, None)])
def test_masks(spark, mask, value, expected):
    assert _one(spark, value, mask) == expected


@pytest.mark.parametrize("text,kind,level", [
    ("NI AB123456C.", "ni_number", "HIGH"), ("NHS 943 476 5919.", "nhs_number", "HIGH"), ("MORGA657054SM9!", "driving_license", "HIGH"),
    ("x@y.co", "email", "MEDIUM"), ("07123456789", "uk_phone", "MEDIUM"), ("12-34-56-12345678", "bank_account", "HIGH"),
    ("4111-1111-1111-1111", "credit_card", "HIGH"), ("sw1a1aa", "postcode", "LOW"), ("Mary Jones", "person_name", "MEDIUM")])
def test_each_pattern_is_found(spark, text, kind, level):
    found = _one(spark, text, pii.detect_pii)
    assert kind in {f["type"] for f in found["findings"]}
    assert pii.LEVELS.index(found["sensitivity"]) >= pii.LEVELS.index(level)


def test_all_findings_count(spark):
    text = " ".join(f"a{i}@b.com" for i in range(12)) + " 12-34-56-12345678"
    found = _one(spark, text, pii.detect_pii)
    counts = {f["type"]: f["n"] for f in found["findings"]}
    assert counts["email"] == 12 and counts["bank_account"] == 1 and found["pii_count"] == sum(counts.values())
    assert found["sensitivity"] == "HIGH" and "Financial" in found["categories"]
    accented = _one(spark, "é07123456789é", pii.detect_pii)
    assert {f["type"] for f in accented["findings"]} >= {"uk_phone"}
    for empty in (None, ""):
        found = _one(spark, empty, pii.detect_pii)
        assert (found["sensitivity"], found["pii_count"], found["categories"]) == ("NONE", 0, [])


@pytest.mark.parametrize("code,district,sector", [
    ("E1 6AN", "E1", "E1 6"), ("sw1a 1aa", "SW1A", "SW1A 1"), ("M1 1AE", "M1", "M1 1"), ("EC1A1BB", "EC1A", "EC1A 1"),
    ("B33 8TH", "B33", "B33 8"), ("XX99 9XX", "XX99", "XX99 9"), ("INVALID", None, None), ("", None, None), (None, None, None)])
def test_postcode_parts(spark, code, district, sector):
    parts = _one(spark, code, parsed_postcode)
    assert (parts["district"] if parts else None, parts["sector"] if parts else None) == (district, sector)


def test_distances(spark):
    df = spark.createDataFrame([("E1 6AN", "M1 1AE"), ("E1 6AN", "E2 1AA"), ("ZZ1 1AA", "E1 6AN")], "a string, b string")
    far, near, unknown = [r["distance_km"] for r in geo.postcode_distance(df, "a", "b").orderBy("a", F.desc("b")).collect()]
    assert 250 < far < 280 and near == 0.0 and unknown is None


def test_days_round_down(spark):
    rows = [(86400 * 3 + 5, 3), (-1, -1), (-86400, -1), (-86401, -2), (0, 0)]
    df = spark.createDataFrame(rows, "s long, expected int")
    got = df.select(days_24h(F.timestamp_seconds("s"), F.timestamp_seconds(F.lit(0))).alias("d"), "expected")
    assert all(r["d"] == r["expected"] for r in got.collect())


CLAIM = ("claim_id string, policy_number string, customer_id string, claim_amount double, claim_date timestamp, incident_date timestamp, "
         "incident_location string, incident_postcode string, claim_type string, claim_status string, fraud_score double, "
         "_ingestion_timestamp timestamp")


def _claims(spark, *rows):
    base = dict(claim_id="c", policy_number="p", customer_id="u", claim_amount=500.0, claim_date="2024-02-14 12:00:00",
                incident_date="2024-01-01 12:00:00", incident_location="x", incident_postcode="N1 1AA", claim_type="pet",
                claim_status="OPEN", fraud_score=0.1, _ingestion_timestamp="2024-02-14 12:00:01")
    names = list(base)
    filled = [tuple({**base, **r, "claim_id": f"c{i}"}[n] for n in names) for i, r in enumerate(rows)]
    text = CLAIM.replace("timestamp", "string").replace("_ingestion_string", "_ingestion_timestamp")
    df = spark.createDataFrame(filled, text)
    for c in ("claim_date", "incident_date", "_ingestion_timestamp"):
        df = df.withColumn(c, F.col(c).cast("timestamp"))
    return df


def _silver(spark, *rows):
    out = silver.silver_claims(bronze.dq_score(_claims(spark, *rows)), F.col("_ingestion_timestamp"))
    return [r.asDict() for r in out.orderBy("claim_id").collect()]


def test_thresholds_are_strict(spark):
    got = _silver(spark, {"claim_amount": 50000.0}, {"claim_amount": 50000.01}, {"claim_amount": 999.99}, {"claim_amount": 1000.0},
                  {"fraud_score": 0.7}, {"fraud_score": 0.71}, {"claim_amount": 25000.0}, {"claim_amount": 25000.01})
    assert ["HIGH_VALUE" in r["fraud_indicators"] for r in got[:2]] == [False, True]
    assert [r["claim_amount_category"] for r in got[:4]] == ["exceptional", "exceptional", "small", "medium"]
    assert [r["is_high_risk"] for r in got[4:6]] == [False, True]
    assert [r["requires_manual_review"] for r in got[6:]] == [False, True]


def test_nulls_lower_scores_instead_of_losing_rows(spark):
    got = _silver(spark, {"incident_postcode": None}, {"policy_number": None, "incident_postcode": "bad"}, {"incident_date": None})
    assert [r["data_quality_score"] for r in got] == [0.875, 0.75, 0.875]
    assert [r["validation_score"] for r in got] == [0.8, 0.6, 0.8]
    assert all(r["fraud_indicators"] is not None and r["adjusted_fraud_score"] is not None for r in got)


def test_bad_events_go_to_the_dead_letters(spark):
    bodies = ['{"claim_id":"a","claim_amount":12.5,"claim_date":"2024-01-02 03:04:05"}', '{"claim_id": "b', "null", "", '{"x":1}',
              '{"claim_id":"c","claim_amount":99999999999.0,"claim_date":"soon"}']
    df = spark.createDataFrame([(b, i) for i, b in enumerate(bodies)], "raw_body string, event_hub_offset long").withColumns({
        "event_hub_partition": F.lit(0), "event_hub_sequence": F.col("event_hub_offset")})
    good, bad = bronze.parse_claim_event(df)
    rows = {r["claim_id"]: r for r in good.collect()}
    assert set(rows) == {"a", "c"} and str(rows["a"]["claim_amount"]) == "12.50"
    assert rows["c"]["claim_amount"] is None and rows["c"]["claim_date"] is None
    assert {r["event_hub_offset"] for r in bad.collect()} == {1, 2, 3, 4}
