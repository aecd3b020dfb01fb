"""Event sources: streams and batches of raw event bodies with broker metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, MapType, StringType, StructField, StructType, TimestampType

EVENT_FILE = StructType([
    StructField("body", StringType()), StructField("enqueuedTime", TimestampType()),
    StructField("offset", LongType()), StructField("partition", LongType()),
    StructField("sequenceNumber", LongType()), StructField("systemProperties", MapType(StringType(), StringType())),
    StructField("properties", MapType(StringType(), StringType())),
])


def _from_kafka(df: DataFrame) -> DataFrame:
    """Kafka's columns under the event column names; headers become the properties."""
    headers = F.map_from_entries(F.transform(
        F.coalesce("headers", F.array().cast("array<struct<key:string,value:binary>>")),
        lambda h: F.struct(h["key"], h["value"].cast("string"))))
    return df.select(
        F.col("value").alias("body"), F.col("timestamp").alias("enqueuedTime"), "offset",
        F.col("partition").cast("long").alias("partition"), F.col("offset").alias("sequenceNumber"),
        F.create_map(F.lit("topic"), F.col("topic")).alias("systemProperties"), headers.alias("properties"))


def stream_source(spark: SparkSession, location: str, kind: str = "files", start: str = "earliest",
                  consumer_group: str | None = None, max_per_trigger: int | None = None,
                  options: dict[str, str] | None = None) -> DataFrame:
    """An unbounded event frame: body, enqueuedTime, offset, partition, sequenceNumber, properties.

    ``kind`` is ``files`` (a folder of JSON event lines in the ``EVENT_FILE`` schema), ``text`` (a
    folder of bare bodies, one per line) or ``kafka`` (``location`` is the topic and the servers are
    given in ``options``). ``max_per_trigger`` limits files or offsets per micro-batch. ``start`` is
    ``earliest`` or, for Kafka, ``latest`` or offsets as JSON; files start at ``earliest``, or with a time given in
    the option ``modifiedAfter``.

    A line of a text file has no number of its own: its offset is a hash of the file, the block and the body.
    """
    options = dict(options or {})
    if kind == "kafka":
        reader = spark.readStream.format("kafka").option("subscribe", location).option("startingOffsets", start)
        reader = reader.option("includeHeaders", "true")
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_per_trigger))
        if consumer_group:
            reader = reader.option("kafka.group.id", consumer_group)
        return _from_kafka(reader.options(**options).load())
    if max_per_trigger:
        options["maxFilesPerTrigger"] = str(max_per_trigger)
    if start != "earliest":
        raise ValueError("files are read from the earliest; give the option modifiedAfter to start later")
    if kind == "files":
        return spark.readStream.schema(EVENT_FILE).options(**options).json(location)
    if kind == "text":
        lines = spark.readStream.options(**options).text(location)
        empty = F.lit(None).cast("map<string,string>")
        return lines.select(
            F.col("value").alias("body"), F.col("_metadata.file_modification_time").alias("enqueuedTime"),
            F.xxhash64("_metadata.file_path", "_metadata.file_block_start", "value").alias("offset"), F.xxhash64("_metadata.file_path").alias("partition"),
            F.col("_metadata.file_block_start").alias("sequenceNumber"),
            F.create_map(F.lit("file"), F.col("_metadata.file_name")).alias("systemProperties"), empty.alias("properties"))
    raise ValueError(f"unknown source kind {kind!r}")


def event_batch(spark: SparkSession, location: str) -> DataFrame:
    """The same event files as a bounded frame."""
    return spark.read.schema(EVENT_FILE).json(location)
