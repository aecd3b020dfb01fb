"""The registered queries of this package and, where SQL can express them, their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import alignment, bpe, line_dedup, maxent_lm, mixing, neighbours, ngram_join, quality, token_files, toxicity, url_filter, warc, whitening

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_report(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_report(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.file_report(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op7_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.score_report(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(table(spark, sf_dir, "pages"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.component_report(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.alignment_report(docs, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op2_bpe": op2_bpe,
    "op3_url_filter": op3_url_filter,
    "op4_neighbours": op4_neighbours,
    "op5_token_files": op5_token_files,
    "op6_quality": op6_quality,
    "op7_maxent_lm": op7_maxent_lm,
    "op8_warc": op8_warc,
    "op9_line_dedup": op9_line_dedup,
    "op10_ngram_join": op10_ngram_join,
    "op11_alignment": op11_alignment,
    "op12_whitening": op12_whitening,
    "op13_toxicity": op13_toxicity,
}

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES: dict[str, str] = {
    "op9_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
        keyed AS (
            SELECT *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
            FROM lines),
        repeated AS (
            SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40
            GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
        marked AS (
            SELECT a.*, r.k IS NOT NULL AND a.doc_id <> r.last AS gone FROM keyed a LEFT JOIN repeated r ON a.k = r.k)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
}
