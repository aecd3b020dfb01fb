"""The block-wise window helpers against brute force, with one key holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.windows import neighbour, running_stats, sliding_extremes, sliding_stats, with_previous


def _rows(seed, n=160):
    rng = random.Random(seed)
    return [(rng.choice(["hot"] * 6 + ["cold", None]), rng.randrange(-60, 90), rng.choice("abcd"),
             rng.choice([None, 1.5, 2.25, 10.0, 99.99]), i) for i in range(n)]


@pytest.mark.parametrize("before,after", [(10, 0), (7, 7), (30, -1), (3, 0)])
def test_sliding_stats_equal_brute_force(spark, before, after):
    rows = _rows(before * 10 + after)
    df = spark.createDataFrame(rows, "k string, t long, who string, amount double, id long")
    got = {(r["k"], r["t"]): r for r in sliding_stats(
        df, ["k"], "t", before, after, count="n", sums={"total": "amount"}, distinct=("people", "who")).collect()}
    assert set(got) == {(k, t) for k, t, *_ in rows}
    for (k, t), r in got.items():
        inside = [x for x in rows if x[0] == k and t - before <= x[1] <= t + after]
        amounts = [x[3] for x in inside if x[3] is not None]
        assert r["n"] == len(inside)
        assert r["people"] == len({x[2] for x in inside})
        assert r["total_n"] == len(amounts)
        assert r["total"] == pytest.approx(sum(amounts))


@pytest.mark.parametrize("before,after", [(10, 0), (30, -1), (7, 7)])
def test_sliding_extremes_equal_brute_force(spark, before, after):
    rows = _rows(before + after + 99)
    df = spark.createDataFrame(rows, "k string, t long, who string, amount double, id long")
    got = {(r["k"], r["t"]): r for r in sliding_extremes(
        df, ["k"], "t", before, after, {"n": ("count", None), "top": ("max", "amount"), "low": ("min", "amount")}).collect()}
    for k, t in {(k, t) for k, t, *_ in rows}:
        amounts = [x[3] for x in rows if x[0] == k and t - before <= x[1] <= t + after]
        present = [a for a in amounts if a is not None]
        r = got.get((k, t))
        assert (r["n"] if r else 0) == len(amounts)
        assert (r["top"] if r else None) == (max(present) if present else None)
        assert (r["low"] if r else None) == (min(present) if present else None)


def test_running_stats_and_neighbours_do_not_depend_on_buckets(spark):
    rows = _rows(5)
    df = spark.createDataFrame(rows, "k string, t long, who string, amount double, id long")
    ordered = {}
    for row in sorted(rows, key=lambda x: (x[1], x[4])):
        ordered.setdefault(row[0], []).append(row)
    for bucket in (1, 13, 10_000):
        run = running_stats(df, ["k"], "t", ["id"], bucket, {"n": ("count", None), "top": ("max", F.col("amount")),
                                                            "total": ("sum", F.col("amount"))})
        back = {r["id"]: r for r in neighbour(df, ["k"], "t", ["id"], bucket, {"prev": "id"}).collect()}
        ahead = {r["id"]: r for r in neighbour(df, ["k"], "t", ["id"], bucket, {"next": "id"}, forward=True).collect()}
        recent = {r["id"]: r["last"] for r in with_previous(run, ["k"], "n", 2, {"last": "id"}, chunk=4).collect()}
        got = {r["id"]: r for r in run.collect()}
        for group in ordered.values():
            for i, row in enumerate(group):
                seen = [x[3] for x in group[:i + 1] if x[3] is not None]
                assert got[row[4]]["n"] == i + 1
                assert got[row[4]]["top"] == (max(seen) if seen else None)
                assert got[row[4]]["total"] == (pytest.approx(sum(seen)) if seen else None)
                assert back[row[4]]["prev"] == (group[i - 1][4] if i else None)
                assert ahead[row[4]]["next"] == (group[i + 1][4] if i + 1 < len(group) else None)
                assert recent[row[4]] == [x[4] for x in group[max(0, i - 2):i + 1]]


def test_a_busy_key_enters_the_window_once_per_second(spark):
    """200,000 holders on one key in 600 seconds: a few rows per second, however many entries leave and enter."""
    df = spark.range(200_000).selectExpr("'hot' AS k", "1000000 + id % 600 AS at", "id AS person")
    entered = []
    out = sliding_stats(df, ["k"], "at", 3600, 3600, count="n", distinct=("people", "person"), entered=entered)
    assert entered[0].count() <= 7 * 600
    assert {(r.n, r.people) for r in out.collect()} == {(200_000, 200_000)}


def test_entries_of_a_window_come_from_one_pass(spark):
    """One exchange to combine seconds and one to total them, however many kinds of entries a second makes."""
    df = spark.createDataFrame(_rows(1), "k string, t long, who string, amount double, id long")
    for frame in (sliding_stats(df, ["k"], "t", 10, 0, count="n", sums={"total": "amount"}), sliding_stats(df, ["k"], "t", 7, 7, count="n"),
                  sliding_extremes(df, ["k"], "t", 10, -1, {"n": ("count", None)}).select("n")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(k") <= 3 and plan.count("Scan") == 1
