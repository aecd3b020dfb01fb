"""Exact percentiles of groups of any size by distributed rank selection.

``percentile`` and ``percentile_approx`` bring a whole group, or a sketch of it, into one task. Here values are counted
per (group, value), the counts are dealt into ranges of (group, value) and stored, and running totals over the ranges
tell which range holds a rank. Only the counts of those ranges are then put in order, each range on its own. So no task
sees more than one range, however large a group is, and results are values that occur, without any error.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.window import Window

from tidemark.functions.windows import null_safe_join
from tidemark.session import work_path


@dataclass(frozen=True)
class Ranked:
    """A value and, by the names of their columns, the shares of which percentiles are wanted."""

    value: Column
    shares: dict[str, float]


def _ranges(df: DataFrame, keys: dict[str, Column], measures: list[Ranked], partitions: int | None) -> DataFrame:
    """Counts per (keys, measure, value) with the range that they are in, stored by range.

    The bounds of the ranges come from a sample, so they are fixed by the stored table and not by the plan.
    """
    values = F.array(*[F.struct(F.lit(i).alias("_m"), m.value.cast("double").alias("_v")) for i, m in enumerate(measures)])
    rows = (df.select(*[c.alias(k) for k, c in keys.items()], F.explode(values).alias("_x"))
            .select(*keys, "_x._m", "_x._v").where(F.col("_v").isNotNull()))
    counts = rows.groupBy(*keys, "_m", "_v").agg(F.count("*").alias("_n"))
    by = [*keys, "_m", "_v"]
    ranged = counts.repartitionByRange(partitions, *by) if partitions else counts.repartitionByRange(*by)
    path = work_path(df.sparkSession, "ranges")
    ranged.withColumn("_range", F.spark_partition_id()).write.partitionBy("_range").parquet(path)
    schema = StructType([*counts.schema.fields, StructField("_range", IntegerType())])
    return df.sparkSession.read.schema(schema).parquet(path)


def exact_percentiles(df: DataFrame, keys: dict[str, Column], measures: list[Ranked], partitions: int | None = None) -> DataFrame:
    """One row per group with each wanted percentile: the value of rank ceil(share * count), at least 1, in its own type.

    Nulls do not count; a group without values has no row. NaN is larger than any number. Groups are compared null-safe.
    ``partitions`` is the number of ranges (by default the session's, joined where small).
    """
    held = _ranges(df, keys, measures, partitions)
    group = [*keys, "_m"]
    over = Window.partitionBy(*group)
    placed = (held.groupBy(*group, "_range").agg(F.sum("_n").alias("_own"))
              .withColumns({"_until": F.sum("_own").over(over.orderBy("_range")), "_all": F.sum("_own").over(over)}))
    wanted = reduce(lambda chain, item: chain.when(F.col("_m") == item[0], F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(share).alias("share")) for name, share in item[1].shares.items()])), enumerate(measures), F)
    targets = (placed.select(*group, "_range", "_own", "_until", "_all", F.explode(wanted).alias("_w"))
               .withColumn("_rank", F.greatest(F.ceil(F.col("_w.share") * F.col("_all")), F.lit(1)) - (F.col("_until") - F.col("_own")))
               .where(F.col("_rank").between(1, F.col("_own")))
               .select(*group, "_range", "_rank", F.col("_w.name").alias("_name")))
    inside = null_safe_join(held, targets, [*group, "_range"], "inner")
    running = F.sum("_n").over(Window.partitionBy(*group, "_range", "_name").orderBy("_v"))
    found = inside.withColumn("_reached", running).where((F.col("_reached") >= F.col("_rank")) & (F.col("_reached") - F.col("_n") < F.col("_rank")))
    kinds = df.select(*[m.value.alias(str(i)) for i, m in enumerate(measures)]).schema
    picked = lambda name, i: F.max(F.when(F.col("_name") == name, F.col("_v"))).cast(kinds[i].dataType).alias(name)
    return found.groupBy(*keys).agg(*[picked(name, i) for i, m in enumerate(measures) for name in m.shares])


def with_percentiles(groups: DataFrame, df: DataFrame, keys: dict[str, Column], *measures: Ranked) -> DataFrame:
    """The aggregated ``groups`` of ``df`` with their exact percentiles."""
    return null_safe_join(groups, exact_percentiles(df, keys, list(measures)), list(keys))
