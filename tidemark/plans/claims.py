"""Plans that assemble operators into the standard frames other queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import anomaly, bronze, silver
from tidemark.plans import inputs
from tidemark.session import cut


def as_of(text: str = inputs.CLAIMS_AS_OF):
    return F.lit(text).cast("timestamp")


def scored_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze claims with their quality score."""
    return bronze.dq_score(inputs.bronze_claims(spark, sf_dir))


def silver_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver claims; processing times come from the input, so that runs repeat exactly."""
    return silver.silver_claims(scored_bronze(spark, sf_dir), F.col("_silver_timestamp"))


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver columns anomaly scoring reads, stored once: the detectors read them several times."""
    return cut(silver_frame(spark, sf_dir).select(*anomaly.INPUT_COLUMNS))


def anomaly_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.anomaly_output(stored_silver(spark, sf_dir), as_of(), detected_at=as_of())
