"""Exact percentiles against a plain sort."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.ranks import Ranked, exact_percentiles

SHARES = {"least": 0.0, "tenth": 0.1, "middle": 0.5, "tail": 0.95, "far": 0.999, "most": 1.0}


def by_sort(values, share):
    ordered = sorted(values)
    return ordered[max(1, math.ceil(share * len(ordered))) - 1]


@pytest.mark.parametrize("partitions", [None, 1, 13])
def test_against_a_sort(spark, partitions):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, 1.5, rng.random() * 100, rng.randrange(5) * 1.0]), rng.randrange(40)) for _ in range(3000)]
    rows += [("single", 7.0, 3), ("none", None, None), ("ties", 2.0, 2)] + [("ties", 2.0, 2)] * 50
    df = spark.createDataFrame(rows, "k string, v double, n int")
    found = {r.k: r.asDict() for r in exact_percentiles(
        df, {"k": F.col("k")}, [Ranked(F.col("v"), SHARES), Ranked(F.col("n"), {"n_middle": 0.5, "n_tail": 0.99})], partitions).collect()}
    assert set(found) == {"a", "b", None, "single", "ties"}
    for key, row in found.items():
        values = [v for k, v, _ in rows if k == key and v is not None]
        numbers = [n for k, _, n in rows if k == key]
        assert {s: row[s] for s in SHARES} == {s: by_sort(values, q) for s, q in SHARES.items()}
        assert (row["n_middle"], row["n_tail"]) == (by_sort(numbers, 0.5), by_sort(numbers, 0.99))
        assert isinstance(row["n_middle"], int)


def test_a_group_of_a_million(spark):
    """All values differ; one group holds nearly all rows and spans many ranges."""
    n = 1_000_003
    df = spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 1000 == 0, "small").otherwise("large").alias("k"), (F.pmod(F.col("id") * 7919, F.lit(n)) / 3).alias("v"))
    found = {r.k: r for r in exact_percentiles(df, {"k": F.col("k")}, [Ranked(F.col("v"), SHARES)], 31).collect()}
    values = {"small": [], "large": []}
    for i in range(n):
        values["large" if i % 1000 else "small"].append(i * 7919 % n / 3)
    for key, own in values.items():
        assert {s: found[key][s] for s in SHARES} == {s: by_sort(own, q) for s, q in SHARES.items()}


def test_no_rows(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert exact_percentiles(df, {"k": F.col("k")}, [Ranked(F.col("v"), {"m": 0.5})]).collect() == []
