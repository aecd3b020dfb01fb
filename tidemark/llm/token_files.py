"""Token ids in compressed files: patched frame-of-reference blocks, written in document order and read back.

A file is a run of segments. A segment holds whole documents, at least `SEGMENT_IDS` ids unless it is a file's last:

    header   uint32 number of ids, uint32 number of blocks
    index    uint32 byte offset of each block's start in the body
    body     per block: uint32 minimum, uint8 width, uint8 number of exceptions,
             width bit planes of 16 bytes (lowest bit first, of id minus minimum),
             per exception uint8 position and uint32 high bits

A block has 128 ids (the last one of a segment is filled with its minimum). Its width is the number of bits that
90 of 100 differences need; the higher bits of the others are its exceptions. Segments are rows of Parquet files, so
that any store that Spark writes to can hold them, a lost task is redone and a file appears whole or not at all.

* A null text is an empty one; every document ends with the end id, so it has one id at least.
* Documents are in ascending `doc_id` order (null first, ties by text); further columns are ignored.
* A document longer than a segment makes its segment longer; it is never cut.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tidemark.llm.alignment import ByteVocabulary
from tidemark.llm.store import new_path, stored

END_ID = 0
BLOCK = 128
WIDE_SHARE = 0.9
SEGMENT_IDS = 1 << 16
#: Documents of one file, by the characters they hold.
FILE_CHARS = 32 << 20

BLOCK_HEAD = np.dtype([("low", "<u4"), ("width", "u1"), ("patches", "u1")])
PATCH = np.dtype([("at", "u1"), ("high", "<u4")])


# ---- blocks


def pack(ids: np.ndarray) -> bytes:
    """One segment's bytes."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not n:
        return np.array([0, 0], "<u4").tobytes()
    table = np.full(blocks * BLOCK, ids[-1], dtype=np.uint32)
    table[:n] = ids
    table = table.reshape(blocks, BLOCK)
    lows = table.min(axis=1)
    table[-1, n - (blocks - 1) * BLOCK:] = lows[-1]
    rest = table - lows[:, None]
    typical = np.partition(rest, int(BLOCK * WIDE_SHARE) - 1, axis=1)[:, int(BLOCK * WIDE_SHARE) - 1]
    widths = np.frexp(typical.astype(np.float64))[1].astype(np.int64)
    high = rest >> np.minimum(widths, 31)[:, None].astype(np.uint32)
    high[widths >= 32] = 0
    owner, at = np.nonzero(high)
    patches = np.zeros(len(owner), PATCH)
    patches["at"], patches["high"] = at, high[owner, at]
    counts = np.bincount(owner, minlength=blocks)
    heads = np.zeros(blocks, BLOCK_HEAD)
    heads["low"], heads["width"], heads["patches"] = lows, widths, counts
    sizes = BLOCK_HEAD.itemsize + widths * (BLOCK // 8) + counts * PATCH.itemsize
    starts = np.cumsum(sizes) - sizes
    body = np.zeros(int(sizes.sum()), np.uint8)
    _spread(body, starts, heads.view(np.uint8).reshape(blocks, BLOCK_HEAD.itemsize))
    for width in np.unique(widths):
        own = np.flatnonzero(widths == width)
        planes = np.empty((len(own), int(width), BLOCK // 8), np.uint8)
        for bit in range(int(width)):
            planes[:, bit] = np.packbits(((rest[own] >> np.uint32(bit)) & np.uint32(1)).astype(np.uint8), axis=1, bitorder="little")
        _spread(body, starts[own] + BLOCK_HEAD.itemsize, planes.reshape(len(own), int(width) * (BLOCK // 8)))
    first = np.cumsum(counts) - counts
    place = (starts + BLOCK_HEAD.itemsize + widths * (BLOCK // 8))[owner] + (np.arange(len(owner)) - first[owner]) * PATCH.itemsize
    _spread(body, place, patches.view(np.uint8).reshape(-1, PATCH.itemsize))
    return np.array([n, blocks], "<u4").tobytes() + starts.astype("<u4").tobytes() + body.tobytes()


def _spread(body: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> None:
    """Write each row's bytes at its own start."""
    if rows.size:
        body[starts[:, None] + np.arange(rows.shape[1])] = rows


def _fetch(body: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    return body[starts[:, None] + np.arange(size)]


def unpack(content: bytes) -> np.ndarray:
    """The ids of one segment."""
    n, blocks = (int(x) for x in np.frombuffer(content, "<u4", 2))
    if not blocks:
        return np.zeros(0, np.uint32)
    starts = np.frombuffer(content, "<u4", blocks, 8).astype(np.int64)
    body = np.frombuffer(content, np.uint8, offset=8 + 4 * blocks)
    heads = _fetch(body, starts, BLOCK_HEAD.itemsize).copy().view(BLOCK_HEAD).ravel()
    widths, counts = heads["width"].astype(np.int64), heads["patches"].astype(np.int64)
    out = np.zeros((blocks, BLOCK), np.uint32)
    for width in np.unique(widths):
        own = np.flatnonzero(widths == width)
        planes = _fetch(body, starts[own] + BLOCK_HEAD.itemsize, int(width) * (BLOCK // 8)).reshape(len(own), int(width), BLOCK // 8)
        values = np.zeros((len(own), BLOCK), np.uint32)
        for bit in range(int(width)):
            values |= np.unpackbits(planes[:, bit], axis=1, bitorder="little").astype(np.uint32) << np.uint32(bit)
        out[own] = values
    owner = np.repeat(np.arange(blocks), counts)
    first = np.cumsum(counts) - counts
    place = (starts + BLOCK_HEAD.itemsize + widths * (BLOCK // 8))[owner] + (np.arange(len(owner)) - first[owner]) * PATCH.itemsize
    patches = _fetch(body, place, PATCH.itemsize).copy().view(PATCH).ravel()
    out[owner, patches["at"]] |= patches["high"].astype(np.uint32) << widths[owner].astype(np.uint32)
    out += heads["low"].astype(np.uint32)[:, None]
    return out.ravel()[:n]


# ---- ids of a text


class TextIds:
    """Encodes as the library does: added tokens are found in the raw text first, the text between them goes to the
    byte-pair encoder of alignment, which has the ids of the same file.
    """

    def __init__(self, content: str):
        self.vocabulary = ByteVocabulary(content)
        self.added = {t.content: i for i, t in Tokenizer.from_str(content).get_added_tokens_decoder().items()}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")

    def numbers(self, text: str | None) -> list[int]:
        if not text:
            return []
        parts = self.special.split(text) if self.added else [text]
        if len(parts) == 1:
            return self.vocabulary.encode(parts)[0]
        # Text and added tokens take turns.
        return [i for n, part in enumerate(parts) if part for i in ([self.added[part]] if n % 2 else self.vocabulary.encode([part])[0])]

    def encode(self, text: str | None) -> bytes:
        return np.array(self.numbers(text), "<u4").tobytes()


_LOADED: dict[str, TextIds] = {}


def _text_ids(content: str) -> TextIds:
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = TextIds(content)
    return _LOADED[key]


def _narrow(ids: list[int]) -> bytes:
    """For the shuffle: two bytes an id where all fit, else four, after a byte that says which."""
    if max(ids) > 0xFFFF:
        return b"\x04" + np.array(ids, "<u4").tobytes()
    return b"\x02" + np.array(ids, "<u2").tobytes()


def _widened(content: bytes) -> np.ndarray:
    return np.frombuffer(content, "<u2" if content[0] == 2 else "<u4", offset=1).astype(np.uint32)


# ---- tables


@dataclass
class FilePlan:
    """Which file holds a doc_id: ids are binned evenly from `low`, and `files` names the file of each bin."""

    low: int
    step: int
    files: list[int]

    @property
    def count(self) -> int:
        return self.files[-1] + 1

    def file_of(self, doc_id: Column) -> Column:
        place = F.expr(f"cast((doc_id - {self.low}) div {self.step} as int)")
        return F.when(doc_id.isNull(), F.lit(0)).otherwise(F.get(F.lit(self.files), place))


def plan_files(docs: DataFrame, file_chars: int = FILE_CHARS) -> FilePlan:
    """Cut the range of doc_id so that files hold about as many characters; 16 bins for each file come to the driver."""
    low, high, chars = docs.agg(F.min("doc_id"), F.max("doc_id"), F.sum(F.length("text"))).first()
    files = int(-(-(chars or 0) // file_chars))
    if files < 2 or low is None or high == low:
        return FilePlan(low or 0, max(1, (high or 0) - (low or 0) + 1), [0])
    step = max(1, -(-(high - low + 1) // (files * 16)))
    bins = docs.where("doc_id is not null").groupBy(F.expr(f"(doc_id - {low}) div {step}").alias("bin")).agg(
        F.sum(F.coalesce(F.length("text"), F.lit(0)) + 1).alias("n"))
    held = {r["bin"]: r["n"] for r in bins.collect()}
    named, before = [], 0
    for place in range((high - low) // step + 1):
        named.append(before // file_chars)
        before += held.get(place, 0)
    return FilePlan(low, step, named)


def write_ids(docs: DataFrame, tokenizer_path: str, path: str) -> None:
    """Encode `doc_id`, `text` and write the files below `path`."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        content = spark.sparkContext.broadcast(file.read())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _text_ids(content.value)
        for batch in batches:
            ids = pa.array((_narrow([*encoder.numbers(t.as_py()), END_ID]) for t in batch.column("text")), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=["doc_id", "packed"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents: list = []
        parts: list[np.ndarray] = []
        segment = held = 0

        def out():
            lengths = [len(p) for p in parts]
            return pa.RecordBatch.from_arrays([
                pa.array([file_no], pa.int32()), pa.array([segment], pa.int32()), pa.array([documents], pa.list_(pa.int64())),
                pa.array([lengths], pa.list_(pa.int64())), pa.array([pack(np.concatenate(parts))], pa.binary())],
                names=["file", "segment", "doc_ids", "lengths", "content"])

        file_no = 0
        for batch in batches:
            for number, doc, packed in zip(batch.column("file"), batch.column("doc_id"), batch.column("packed"), strict=True):
                if parts and (held >= SEGMENT_IDS or number.as_py() != file_no):
                    yield out()
                    segment, held, documents, parts = segment + 1, 0, [], []
                file_no = number.as_py()
                parts.append(_widened(packed.as_py()))
                documents.append(doc.as_py())
                held += len(parts[-1])
        if parts:
            yield out()

    plan = plan_files(docs)
    encoded = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(encode, "doc_id bigint, packed binary")
    placed = encoded.withColumn("file", plan.file_of(F.col("doc_id")))
    ordered = placed.repartitionById(plan.count, F.col("file")).sortWithinPartitions("file", "doc_id", "packed")
    segments = ordered.select("file", "doc_id", "packed").mapInArrow(
        gather, "file int, segment int, doc_ids array<bigint>, lengths array<bigint>, content binary")
    segments.write.option("compression", "none").option("parquet.block.size", 16 << 20).parquet(path)


def read_ids(spark, path: str) -> DataFrame:
    """One row per document of the files: file, segment, place in it, doc_id, n_tokens, ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                lengths = np.array(batch.column("lengths")[row].as_py(), np.int64)
                ids = unpack(batch.column("content")[row].as_py())
                if lengths.sum() != len(ids):
                    raise ValueError("a segment holds other ids than its documents")
                ends = np.cumsum(lengths)
                n = len(lengths)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, batch.column("file")[row].as_py(), np.int32)), pa.array(np.full(n, batch.column("segment")[row].as_py(), np.int32)),
                    pa.array(np.arange(n, dtype=np.int32)), batch.column("doc_ids")[row].values, pa.array(ends - lengths), pa.array(lengths),
                    pa.array((x.astype("<u4").tobytes() for x in np.split(ids, ends[:-1])), pa.binary())],
                    names=["file", "segment", "place", "doc_id", "before", "n_tokens", "ids"])

    return spark.read.parquet(path).mapInArrow(
        read, "file int, segment int, place int, doc_id bigint, before bigint, n_tokens bigint, ids binary")


def segment_starts(spark, path: str) -> DataFrame:
    """(file, segment, start): ids before each segment; running totals within files, then over the file totals."""
    sizes = spark.read.parquet(path).select("file", "segment", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b).alias("n"))
    sizes = stored(sizes, "segment-sizes")
    files = sizes.groupBy("file").agg(F.sum("n").alias("n"))
    before = files.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("earlier"))
    within = F.sum("n").over(Window.partitionBy("file").orderBy("segment")) - F.col("n")
    return sizes.select("file", "segment", within.alias("within")).join(before, "file").select(
        "file", "segment", (F.col("within") + F.col("earlier")).alias("base"))


def file_report(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids, all from the files read back."""
    spark = docs.sparkSession
    path = new_path(spark, "token-files")
    write_ids(docs, tokenizer_path, path)
    rows = read_ids(spark, path)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = pa.array([zlib.crc32(x.as_py()) for x in batch.column("ids")], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("file", "segment", "doc_id", "before", "n_tokens")), crc],
                                             names=["file", "segment", "doc_id", "before", "n_tokens", "ids_crc32"])

    digests = rows.mapInArrow(digest, "file int, segment int, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint")
    return digests.join(segment_starts(spark, path), ["file", "segment"]).select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
