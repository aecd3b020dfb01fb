"""Looking up keys reads few row groups and finds the same rows."""

import pytest
from pyspark.sql import functions as F

from tidemark.session import work_path
from tidemark.sources import keyed


def rows_scanned(df):
    """Rows in the row groups that the scan opened."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.mark.parametrize("count", [3, 40])
def test_few_keys_read_few_row_groups(spark, count):
    n = 300_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("C000007")).otherwise(F.format_string("C%06d", F.pmod(F.col("id") * 7919, F.lit(20_000)) * 2)).alias("customer_id"),
        F.col("id").alias("claim_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    path = work_path(spark, "keyed")
    keyed.write_keyed(rows, path, "customer_id", ["claim_id"], row_group_bytes=256 << 10, keys_per_group=2000)
    table = spark.read.parquet(path)
    assert table.count() == n
    # Even numbers are there, odd ones lie inside the bounds of row groups and only the filters can tell.
    there = spark.range(count).select(F.format_string("C%06d", F.col("id") * 400 + 2000).alias("customer_id"))
    absent = spark.range(count).select(F.format_string("C%06d", F.col("id") * 400 + 2001).alias("customer_id"))
    found = keyed.rows_of_keys(table, "customer_id", there.union(there).union(spark.createDataFrame([(None,)], "customer_id string")))
    assert rows_scanned(found) < n // 3
    expected = rows.join(there, "customer_id", "left_semi")
    assert found.count() == expected.count() > 0 and found.exceptAll(expected.select(found.columns)).count() == 0
    missing = keyed.rows_of_keys(table, "customer_id", absent)
    assert missing.count() == 0 and rows_scanned(missing) < rows_scanned(found) / 2
    many = keyed.rows_of_keys(table, "customer_id", there, most=count - 1)
    assert many.exceptAll(found.select(many.columns)).count() == 0 and many.count() == found.count()


def test_a_key_with_very_many_rows_is_split(spark):
    rows = spark.range(50_000, numPartitions=8).select(F.lit("hot").alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("t"))
    path = work_path(spark, "keyed")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed.write_keyed(rows, path, "k", ["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    table = spark.read.parquet(path)
    assert len(table.inputFiles()) > 1
    assert keyed.rows_of_keys(table, "k", spark.createDataFrame([("hot",)], "k string")).count() == 50_000
    assert keyed.rows_of_keys(table, "k", spark.createDataFrame([], "k string")).count() == 0
