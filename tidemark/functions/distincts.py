"""Exact distinct counts over any period from small mergeable sets.

An id gets a number once, from a stored dictionary. The ids of an hour are then bits: one bitmap of 4 KB for each 32,768
numbers that occur. Bitmaps of hours are united into those of any longer period without looking at the rows again, and
the number of bits is the exact count of distinct ids, which sums of hourly counts cannot give.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = 1 << 15
DAY_S, HOUR_S = 86400, 3600


def coded(ids: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """(id, code) of the ids (one column ``id``; nulls are left out) that ``dictionary`` does not hold yet.

    Numbers are dense within a task and begin behind the dictionary's, so tasks need no numbering in common. The result
    has to be stored before it is used: numbers depend on how the ids are dealt out.
    """
    new = ids.where(F.col("id").isNotNull()).distinct()
    first = F.lit(0)
    if dictionary is not None:
        new = new.join(dictionary.select("id"), "id", "left_anti")
        new = new.join(F.broadcast(dictionary.agg(F.coalesce(F.max("code") + 1, F.lit(0)).alias("_first"))))  # one row
        first = F.col("_first")
    return new.select("id", (first + F.monotonically_increasing_id()).alias("code"))


def hourly_sets(rows: DataFrame, at: Column, id_column: str, dictionary: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """The rollup: per hour (epoch seconds), keys and bucket of numbers the bitmap of the ids that occur.

    An id is counted once per hour and key before it becomes a bit, so a busy hour is combined where it is read. Rows
    without time or id are in no set.
    """
    narrow = rows.select(F.floor(F.unix_timestamp(at) / HOUR_S).cast("long").alias("_h"), F.col(id_column).alias("id"), *[c.alias(k) for k, c in keys.items()])
    once = narrow.where("_h IS NOT NULL AND id IS NOT NULL").distinct().join(dictionary, "id")
    return (once.groupBy((F.col("_h") * HOUR_S).alias("hour_s"), *keys, F.bitmap_bucket_number("code").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("ids")))


def united(sets: DataFrame, *keys: str) -> DataFrame:
    """``distinct_ids`` per key over all given sets: united by bucket, then the bits of the buckets are added."""
    merged = sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("ids")).alias("distinct_ids"))


def distinct_between(sets: DataFrame, first_s: int, end_s: int, *keys: str) -> DataFrame:
    """Distinct ids per key from ``first_s`` (a full hour) to before ``end_s``."""
    return united(sets.where((F.col("hour_s") >= first_s) & (F.col("hour_s") < end_s)), *keys)


def moving_distinct(sets: DataFrame, days: int, *keys: str) -> DataFrame:
    """Distinct ids per key over the ``days`` days up to each day that has rows.

    Hours become days first; each day's sets are then handed to the periods that they belong to.
    """
    day = F.floor(F.col("hour_s") / DAY_S).cast("int")
    daily = sets.groupBy(day.alias("_day"), *keys, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))
    ends = daily.select("_day", *keys).distinct()
    handed = daily.withColumn("_end", F.explode(F.sequence(F.col("_day"), F.col("_day") + (days - 1)))).drop("_day")
    counted = united(handed, "_end", *keys)
    named = ends.withColumnRenamed("_day", "_end")
    joined = counted.alias("c").join(named.alias("e"), F.expr(" AND ".join(f"c.{k} <=> e.{k}" for k in ("_end", *keys))), "left_semi")
    return joined.withColumn("period_end", F.date_from_unix_date("_end")).drop("_end")
