"""Stored tables: what stays on disk after a step and after a block."""

import os
import time

from pyspark.sql import functions as F

from tidemark.functions.windows import numbered_rows
from tidemark.session import cut, stores


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if "/shuffle_" in f}


def test_the_shuffle_files_of_a_stored_frame_are_deleted(spark):
    before, left = shuffle_files(spark), None
    rows = cut(spark.range(10_000).groupBy((F.col("id") % 97).alias("k")).agg(F.count("*").alias("n")).repartition(5, "n"))
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and rows.count() == 97 and rows.agg(F.sum("n")).first()[0] == 10_000


def test_stored_tables_of_a_block_go_when_they_are_replaced_and_at_its_end(spark):
    folder = lambda: {f for f in os.listdir(spark.conf.get("spark.checkpoint.dir")) if f.startswith("kept-")}
    cut(spark.range(1))
    before = folder()
    with stores() as store:
        first = store(spark.range(5))
        second = store(first.withColumn("b", F.col("id") + 1), first)
        assert len(folder() - before) == 1 and second.count() == 5
        store(spark.range(2))
        assert len(folder() - before) == 2
    assert folder() == before


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_rows_are_exchanged_once_for_their_number(spark):
    """One exchange for the window and the join after it; three for the totals of earlier buckets."""
    rows = cut(spark.range(50).selectExpr("concat('h', id % 7) AS k", "id * 3 AS t", "id"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = numbered_rows(rows, ["k"], "t", ["id"], 10, "n")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning") == 4
