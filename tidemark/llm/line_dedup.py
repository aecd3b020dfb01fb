"""Repeated lines: range-partitioned line hashes, streamed in (hash, document, position) order, to keep bitmaps.

A line's key is the line without ASCII white space at its ends and with A-Z in lower case. Keys of at least
`min_chars` code points that at least `min_docs` documents hold lose all their lines, except in the largest
`doc_id` that holds them.

* A null or empty text is one empty line. Rows with a null `doc_id` neither count nor lose lines.
* Rows with the same `doc_id` are one document for counting; each row keeps its own bitmap.
* Further columns are ignored by `keep_bitmaps` and passed through by `drop_lines`.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.store import boxed, stored, unboxed

MIN_CHARS = 40
MIN_DOCS = 5
#: A key's rows are dealt to so many groups by document, so that one very common line never meets in one task.
SALTS = 64
WORD = 64
ALL_KEPT = -1
BLANKS = " \t\n\x0b\f\r"

KEY = ["_h1", "_h2"]
ROW = ["_doc", "_row"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def ascii_lower(value: Column) -> Column:
    """Lower-case A-Z only: the plain function where all characters are ASCII, a mapping elsewhere."""
    return F.when(F.length(value) == F.octet_length(value), F.lower(value)).otherwise(
        F.translate(value, string.ascii_uppercase, string.ascii_lowercase))


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line long enough to count: 128-bit key hash, document, row and position."""
    lines = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_row"), F.posexplode(lines_of(F.col("text"))).alias("_pos", "_line"))
    stripped = lines.withColumn("_line", F.btrim("_line", F.lit(BLANKS))).where(F.length("_line") >= min_chars)
    keyed = stripped.withColumn("_line", ascii_lower(F.col("_line")))
    return keyed.select(
        F.xxhash64("_line").alias("_h1"), F.xxhash64(F.lit(1), "_line").alias("_h2"),
        F.pmod(F.xxhash64("_doc"), F.lit(SALTS)).cast("int").alias("_salt"), *ROW, "_pos")


def dropped_lines(keys: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(document, row, position) of each line to drop.

    Hashes are range-partitioned together with a salt of the document and sorted by document (largest first) and
    position, so the first row of a hash group is its last holder and documents follow one after another.
    """
    order = [F.col("_doc").desc(), "_pos"]
    streamed = keys.repartitionByRange(*KEY, "_salt").sortWithinPartitions(*KEY, "_salt", *order)
    group = Window.partitionBy(*KEY, "_salt").orderBy(*order)
    before = F.lag("_doc").over(group)
    firsts = streamed.withColumn("_new", (before.isNull() | (before != F.col("_doc"))).cast("long"))
    salted = firsts.groupBy(*KEY, "_salt").agg(F.sum("_new").alias("_n"), F.max("_doc").alias("_last"))
    salted = stored(salted, "line-groups")
    repeated = (salted.groupBy(*KEY).agg(F.sum("_n").alias("_docs"), F.max("_last").alias("_keep"))
                .where(F.col("_docs") >= min_docs).drop("_docs"))
    groups = salted.select(*KEY, "_salt").join(repeated, KEY)
    return keys.join(groups, [*KEY, "_salt"]).where(F.col("_doc") != F.col("_keep")).select(*ROW, "_pos")


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per row that loses lines: `n_dropped` and `keep`, its compressed bitmap.

    `keep` lists (word, bits) for each run of 64 lines with a dropped one, by word; runs kept whole are left out.
    """
    keys = stored(line_keys(docs, min_chars), "line-keys")
    dropped = dropped_lines(keys, min_docs)
    bit = F.expr(f"shiftleft(1L, _pos % {WORD})")
    words = dropped.groupBy(*ROW, F.expr(f"_pos div {WORD}").cast("int").alias("_word")).agg(
        F.bit_or(bit).alias("_bits"))
    return words.groupBy(*ROW).agg(
        F.sum(F.bit_count("_bits").cast("long")).alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct(F.col("_word").alias("word"), F.bitwise_not("_bits").alias("bits")))).alias("keep"))


def unpacked(keep: Column) -> Column:
    """A bitmap as plain 64-bit words up to its last listed one."""
    gap = lambda w, i: w["word"] - F.when(i == 0, 0).otherwise(F.get(keep, i - 1)["word"] + 1)
    return F.flatten(F.transform(keep, lambda w, i: F.concat(
        F.array_repeat(F.lit(ALL_KEPT).cast("long"), gap(w, i)), F.array(w["bits"]))))


def kept_text(text: Column, words: Column) -> Column:
    """The lines whose bit is set, joined by newlines; beyond the given words all are kept."""
    word = lambda i: F.coalesce(F.get(words, F.shiftright(i, 6)), F.lit(ALL_KEPT).cast("long"))
    bit = lambda i: F.call_function("shiftrightunsigned", word(i), F.pmod(i, F.lit(WORD)))
    return F.array_join(F.filter(lines_of(text), lambda line, i: bit(i).bitwiseAND(F.lit(1).cast("long")) == 1), "\n")


def with_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Each input row with `_words` (unpacked bitmap, null: all kept) and `_dropped`."""
    bitmaps = keep_bitmaps(docs, min_chars, min_docs).select(
        *ROW, F.col("n_dropped").alias("_dropped"), unpacked(F.col("keep")).alias("_words"))
    return (docs.withColumns({"_doc": F.col("doc_id"), "_row": F.xxhash64("text")})
            .join(bitmaps, ROW, "left").drop(*ROW))


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The rows with repeated lines cut from `text`; a row without dropped lines keeps its text, null included."""
    used = ("doc_id", "text")
    marked = with_bitmaps(boxed(docs, *used), min_chars, min_docs)
    text = F.when(F.col("_words").isNull(), F.col("text")).otherwise(kept_text(F.col("text"), F.col("_words")))
    return unboxed(marked.withColumn("text", text), docs.columns, *used)


def line_report(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the kept text."""
    marked = with_bitmaps(docs.select("doc_id", "text"), min_chars, min_docs)
    text = F.when(F.col("_words").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept_text(F.col("text"), F.col("_words")))
    newlines = F.length(F.coalesce("text", F.lit(""))) - F.length(F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit("")))
    return marked.select(
        "doc_id", (newlines + 1).cast("long").alias("n_lines"), F.coalesce("_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(text, 256).alias("kept_sha256"))
