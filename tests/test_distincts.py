"""Distinct counts from hourly sets against plain sets."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from tidemark.functions import distincts
from tidemark.session import cut

START = 1_704_067_200  # 2024-01-01


def table(spark, rows):
    return spark.createDataFrame(rows, "id string, s long, k string").withColumn("at", F.timestamp_seconds("s"))


def test_any_period_against_plain_sets(spark):
    rng = random.Random(8)
    rows = [(rng.choice([None, *(f"c{i}" for i in range(400))]), START + rng.randrange(40 * 86400), rng.choice(["a", "b", None])) for _ in range(6000)]
    rows += [("hot", START + i, "a") for i in range(3000)] + [("c1", None, "a")]
    first, second = table(spark, rows[:3000]), table(spark, rows[3000:])
    held = cut(distincts.coded(first.select("id").repartition(5)))
    held = cut(held.union(distincts.coded(second.select("id").repartition(3), held)))
    codes = {r.id: r.code for r in held.collect()}
    assert set(codes) == {i for i, _, _ in rows} - {None} and len(set(codes.values())) == len(codes)
    keys = {"k": F.col("k")}
    sets = cut(distincts.hourly_sets(first, F.col("at"), "id", held, keys).union(distincts.hourly_sets(second, F.col("at"), "id", held, keys)))

    def plain(low, high):
        found = {}
        for i, s, k in rows:
            if i is not None and s is not None and low <= s < high:
                found.setdefault(k, set()).add(i)
        return {k: len(v) for k, v in found.items()}

    for low, high in ((0, 86400), (5 * 3600, 29 * 3600), (0, 40 * 86400), (3600, 7200)):
        found = distincts.distinct_between(sets, START + low, START + high, "k")
        assert {r.k: r.distinct_ids for r in found.collect()} == plain(START + low, START + high)
    for row in distincts.moving_distinct(sets, 7, "k").collect():
        end = START + ((row.period_end - date(2024, 1, 1)) // timedelta(days=1) + 1) * 86400
        assert row.distinct_ids == plain(end - 7 * 86400, end)[row.k]
    assert distincts.moving_distinct(sets, 7, "k").count() == len({(s // 86400, k) for i, s, k in rows if i and s})
