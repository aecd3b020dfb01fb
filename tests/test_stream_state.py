"""State of the windows and of the join of two streams ends; what comes too late or never is still accounted for."""

from pyspark.sql import functions as F

from tidemark.session import work_path
from tidemark.sources import sinks
from tidemark.streaming import cases, windows
from tidemark.streaming.medallion import table_stream

CLAIMS = "claim_id string, policy_number string, incident_date timestamp"
POLICIES = "policy_number string, policy_type string, start_date timestamp, end_date timestamp, sum_insured double, deductible double"


def rows_of(spark, schema, *rows):
    return spark.createDataFrame(rows, schema.replace("timestamp", "string")).select(
        *[F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", ")])


def policy(number, start):
    return (number, "motor", start, "2030-01-01", 1000.0, 10.0)


def test_claims_wait_for_their_policies_and_no_longer(spark):
    folders = [work_path(spark, n) for n in ("claims", "policies")]
    table, checkpoint = work_path(spark, "cases"), work_path(spark, "checkpoint")
    held = []
    for claims, policies in (
            ([("c1", "p1", "2024-01-10"), ("c2", "p2", "2024-01-11"), ("c3", None, "2024-01-11")], [policy("p0", "2023-12-01")]),
            ([("c4", "p0", "2024-02-01")], [policy("p1", "2024-03-01")]),  # p1 starts after c1 and comes after it
            ([("c9", "p9", "2027-01-01")], [policy("p9", "2027-01-01")]),  # both watermarks pass all partners
    ):
        rows_of(spark, CLAIMS, *claims).write.mode("append").parquet(folders[0])
        rows_of(spark, POLICIES, *policies).write.mode("append").parquet(folders[1])
        joined = cases.policy_cases(table_stream(spark, folders[0], CLAIMS), table_stream(spark, folders[1], POLICIES))
        query = sinks.write_stream_table(joined, table, checkpoint)
        query.awaitTermination()
        held.append(sum(o["numRowsTotal"] for o in query.lastProgress["stateOperators"]))
    found = {r.claim_id: r.start_date and str(r.start_date.date()) for r in spark.read.parquet(table).collect()}
    assert found == {"c1": "2024-03-01", "c4": "2023-12-01", "c9": "2027-01-01", "c2": None, "c3": None}
    assert held[0] == 4 and held[2] == 2  # at last only the two of 2027


SILVER = ("claim_type string, claim_date timestamp, claim_amount_gbp double, is_high_risk boolean, requires_manual_review boolean, "
          "processing_status string")


def test_windows_leave_the_state_and_late_claims_are_counted(spark):
    def claim(day):
        return ("motor", day, 10.0, False, False, "REJECTED")

    folder = work_path(spark, "silver")
    paths = {n: (work_path(spark, n), work_path(spark, f"{n}-checkpoint")) for n in ("closed", "open", "late")}
    held = []
    for days in (["2024-01-01", "2024-01-02", "2024-01-03"], ["2024-02-01 12:00:00"], ["2024-01-02", None, "2024-02-01 13:00:00", "2024-01-31"]):
        rows_of(spark, SILVER, *map(claim, days)).write.mode("append").parquet(folder)
        source = lambda: table_stream(spark, folder, SILVER)
        query = windows.closed_windows_stream(source(), "daily_summary_lite", *paths["closed"], "1 day")
        query.awaitTermination()
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        windows.open_windows_stream(source(), "daily_summary_lite", *paths["open"], "1 day").awaitTermination()
        windows.late_claims_stream(source(), "daily_summary_lite", *paths["late"], "1 day").awaitTermination()
    counts = lambda df: {r.window_start and str(r.window_start.date()): r.n for r in df.collect()}
    closed = counts(spark.read.parquet(paths["closed"][0]).withColumnRenamed("total_claims", "n"))
    newest = counts(windows.newest_windows(spark, paths["open"][0], "daily_summary_lite").withColumnRenamed("total_claims", "n"))
    late = counts(windows.late_claims(spark, paths["late"][0], "daily_summary_lite").withColumnRenamed("late_claims", "n"))
    assert closed == {"2024-01-01": 1, "2024-01-02": 1, "2024-01-03": 1}
    assert newest == closed | {"2024-01-31": 1, "2024-02-01": 2}
    assert late == {"2024-01-02": 1, None: 1}
    assert held == [2, 1, 2]
