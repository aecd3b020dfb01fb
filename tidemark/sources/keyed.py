"""Tables that a few keys can be looked up in without a full scan.

Rows are clustered by ranges of (key, further columns) and sorted, so that a key lies in few row groups; a Bloom filter
of each row group tells, beside its bounds, whether a key can be in it. A condition on the key then reads only the row
groups that may hold it. Further columns in the clustering split a key that has very many rows over several files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that are handed to the scan as a list; more of them are joined, as most row groups hold one of them anyway.
LISTED_KEYS = 5_000


def write_keyed(df: DataFrame, path: str, key: str, then: list[str], *, row_group_bytes: int = 8 << 20, keys_per_group: int = 100_000) -> None:
    """Write ``df`` clustered by ``key`` (and ``then``), with a Bloom filter on the key sized for ``keys_per_group`` keys."""
    clustered = df.repartitionByRange(key, *then).sortWithinPartitions(key, *then)
    (clustered.write.mode("overwrite").option("parquet.block.size", row_group_bytes)
     .option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.expected.ndv#{key}", keys_per_group)
     .parquet(path))


def rows_of_keys(table: DataFrame, key: str, asked: DataFrame, most: int = LISTED_KEYS) -> DataFrame:
    """The rows of ``table`` whose key is in ``asked``, which may name it more than once; null keys are not asked for.

    At most ``most`` keys reach the driver: fewer become a condition that the scan checks against bounds and Bloom
    filters of row groups; with more, the table is joined. The rows are the same.
    """
    wanted = asked.select(key).where(F.col(key).isNotNull()).distinct()
    listed = [r[0] for r in wanted.limit(most + 1).collect()]
    if len(listed) > most:
        return table.join(wanted, key, "left_semi")
    spark = table.sparkSession
    # Longer lists would only be pushed down as their least and largest key.
    if int(spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold")) < most:
        spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(most))
    return table.where(F.col(key).isin(listed))
