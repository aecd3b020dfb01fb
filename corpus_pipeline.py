"""The text pipeline: each stage takes (spark, docs, sf_dir), and its result is written and read again by the next.

quality     documents that fail the quality rules go
line_dedup  repeated lines go, but for the last document that holds them
near_copies one document of each group of near copies stays (five-word shingles, similarity of 0.8 or more)
mixing      the documents in the order of the source schedule, file by file; none is dropped or repeated
bpe         each document's place in the mix (from 0, over all files), the token ids of its whole text, and the SHA-256
            of the text decoded from them
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import bpe, line_dedup, mixing, ngram_join, quality
from tidemark.llm.queries import tokenizer
from tidemark.llm.store import stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(docs)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def placed(docs: DataFrame) -> DataFrame:
    """The rows of a table in files with `place`, their number in the order of file names and of the rows in each file.

    A scan may take files in any order and several at once, so the order is read from the files, not from the scan. Only
    the row counts of the files are summed in one task.
    """
    at = docs.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    counts = at.groupBy("_file").agg(F.count("*").alias("_n"))
    before = counts.select("_file", (F.sum("_n").over(Window.orderBy("_file")) - F.col("_n")).alias("_before"))
    return at.join(F.broadcast(before), "_file").withColumn("place", F.col("_before") + F.col("_row")).drop("_file", "_row", "_before")


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = bpe.encoded(placed(docs.select("doc_id", "source", "text")), tokenizer("word_bpe_49k.json"), "decoded_sha256")
    return encoded.select("doc_id", "source", "place", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded_sha256")


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_copies", near_copies_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: SQL expresses neither robust covariances nor BPE; the stages are tested against plain Python versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
