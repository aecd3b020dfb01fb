"""Components of a graph whose edges keep coming, without reading old edges.

Each node has its label stored once, when it first comes. Components that a batch joins are rewritten in a table of
relabellings (old label, smallest label now), which holds one row for each label that has lost its component. A batch
looks up the labels of its own nodes, finds the components among these labels alone, and brings the table up to date;
its paths are kept one step long. Both tables are written per batch, so a repeated batch replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.scenarios import ring_components
from tidemark.session import cut
from tidemark.sources.sinks import write_batch_once, write_stream_batches

NODES = "node string, label string, batch int"
RELABELLED = "old string, label string, batch int"


def _nodes_before(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """Labels that nodes had when they came, without a half-written or repeated batch."""
    return spark.read.schema(NODES).parquet(f"{path}/nodes").where(F.col("batch") < batch_id).select("node", "label")


def _relabelled_before(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """The table of relabellings as the batch before left it; each batch writes it anew."""
    return spark.read.schema(RELABELLED).parquet(f"{path}/relabelled").where(F.col("batch") == batch_id - 1).select("old", "label")


def _now(labelled: DataFrame, relabelled: DataFrame) -> DataFrame:
    """Labels brought up to date."""
    changed = relabelled.select(F.col("old").alias("label"), F.col("label").alias("_new"))
    return labelled.join(changed, "label", "left").select("node", F.coalesce("_new", "label").alias("label"))


def add_edges(edges: DataFrame, batch_id: int, path: str) -> None:
    """Take the edges (src, dst) of one batch; edges of a node with itself and null ends are left out."""
    spark = edges.sparkSession
    links = cut(edges.select("src", "dst").where("src <> dst").distinct())
    ends = links.select(F.col("src").alias("node")).union(links.select("dst")).distinct()
    if batch_id:
        relabelled = _relabelled_before(spark, path, batch_id)
        known = _now(_nodes_before(spark, path, batch_id).join(ends, "node", "left_semi"), relabelled)
    else:
        relabelled, known = spark.createDataFrame([], "old string, label string"), spark.createDataFrame([], "node string, label string")
    labels = cut(ends.join(known.withColumnRenamed("label", "_known"), "node", "left").select(
        "node", F.coalesce("_known", "node").alias("label"), F.col("_known").isNull().alias("new")))
    of = lambda end: labels.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label"))
    between = links.join(of("src"), "src").join(of("dst"), "dst").select(F.col("src_label").alias("src"), F.col("dst_label").alias("dst"))
    merged = cut(ring_components(between).where("node <> component").select(F.col("node").alias("old"), F.col("component").alias("label")))
    write_batch_once(_now(labels.where("new").select("node", "label"), merged), batch_id, f"{path}/nodes")
    # Old relabellings point to the newest label again, and labels that have lost their component are added.
    moved = _now(relabelled.select(F.col("old").alias("node"), "label"), merged).select(F.col("node").alias("old"), "label")
    write_batch_once(moved.union(merged.join(labels.where("new").select(F.col("node").alias("old")), "old", "left_anti")), batch_id, f"{path}/relabelled")


def component_stream(edges: DataFrame, path: str, checkpoint: str, trigger: str | None = None, name: str | None = None) -> StreamingQuery:
    """Keep the components of a stream of edges; ``components`` reads them."""
    return write_stream_batches(edges, lambda batch, n: add_edges(batch, n, path), checkpoint, trigger=trigger, name=name)


def components(spark: SparkSession, path: str) -> DataFrame:
    """(node, component) of all nodes seen: their smallest node."""
    versions = spark.read.schema(RELABELLED).parquet(f"{path}/relabelled")
    batches = spark.read.schema(NODES).parquet(f"{path}/nodes").agg(F.max("batch")).first()[0]
    last = versions.agg(F.max("batch")).first()[0]
    end = max(-1 if batches is None else batches, -1 if last is None else last) + 1
    return _now(_nodes_before(spark, path, end), versions.where(F.col("batch") == F.lit(-1 if last is None else last)).select("old", "label")).withColumnRenamed("label", "component")
