"""WARC archives: written from pages, read back, segmented records put together again.

Each page is one record. Of pages with equal payloads of at least `min_bytes`, the one with the largest `page_id` is a
`response`; the others are `revisit` records that name it and carry no payload. A response holds an HTTP message with
chunked transfer framing. One longer than `segment_bytes` is cut into segments: the first record has segment number 1,
the others are `continuation` records that name the first one as their origin, and the last one states the total length.
Segments may lie in any archives, so reading brings them together: records are grouped by origin, ordered by segment
number, their total length is verified, and the chunked framing is decoded.

* A null html is an empty payload; it is a payload like others. Further columns are ignored.
* Rows with a null page_id are left out: a record needs a name. Repeated page ids with equal payloads are one record;
  with different payloads the larger digest is kept.
* Archives are gzip files of plain WARC records, written by Spark's text writer with the record end as line end, so any
  store that Spark reaches can hold them. They are read as whole files of bounded size.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.store import new_path, stored

MIN_BYTES = 0
SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
#: Payload bytes that an archive holds, about.
ARCHIVE_BYTES = 16 << 20
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
BLANK = b"\r\n\r\n"

_RECORD = "page_id bigint, number int, record binary"
_PIECE = "page_id bigint, origin bigint, number int, total bigint, kind string, digest string, refers_to bigint, declared bigint, block binary"


def record_id(page_id: int) -> str:
    return f"<urn:page:{page_id}>"


def _page_of(name: str) -> int:
    return int(name.removeprefix("<urn:page:").removesuffix(">").split("/")[0])


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing of a payload."""
    parts = [b"%x\r\n%s\r\n" % (len(payload[i:i + size]), payload[i:i + size]) for i in range(0, len(payload), size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(framed: bytes) -> bytes:
    """The payload in chunked framing; anything but a whole message is an error."""
    parts, at = [], 0
    while True:
        line = framed.index(b"\r\n", at)
        size = int(framed[at:line].split(b";")[0], 16)
        at = line + 2 + size
        if framed[at:at + 2] != b"\r\n" and size:
            raise ValueError("a chunk does not end where it says")
        if not size:
            return b"".join(parts)
        parts.append(framed[line + 2:at])
        at += 2


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(fields: list[tuple[str, object]]) -> bytes:
    return ("WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def response_records(page_id: int, url: str, payload: bytes, segment_bytes: int = SEGMENT_BYTES) -> Iterator[tuple[int, bytes]]:
    """(segment number, record) of a response, without the blank lines that end a record."""
    message = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    cuts = list(range(0, len(message), segment_bytes))
    for number, cut in enumerate(cuts, 1):
        block = message[cut:cut + segment_bytes]
        kind = "response" if number == 1 else "continuation"
        name = record_id(page_id) if number == 1 else f"<urn:page:{page_id}/{number}>"
        fields: list[tuple[str, object]] = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", DATE), ("WARC-Target-URI", url)]
        if number == 1:
            fields += [("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"), ("Content-Type", "application/http; msgtype=response")]
        if len(cuts) > 1:
            fields.append(("WARC-Segment-Number", number))
            if number > 1:
                fields.append(("WARC-Segment-Origin-ID", record_id(page_id)))
            if number == len(cuts):
                fields.append(("WARC-Segment-Total-Length", len(message)))
        yield number, _header([*fields, ("Content-Length", len(block))]) + block


def revisit_record(page_id: int, url: str, digest: str, payload_bytes: int, refers_to: int) -> bytes:
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % payload_bytes
    return _header([
        ("WARC-Type", "revisit"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE), ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("WARC-Refers-To", record_id(refers_to)), ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block))]) + block


def records_of(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of an archive."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError("a record does not start where it should")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]):
            raise ValueError("an archive ends inside a record")
        yield fields, block


def _clean_url(url: Column) -> Column:
    return F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n\t ]+", "%20")


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write the records of `pages` (page_id, url, html) as archives below `path`."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html"), F.lit(""))
    named = pages.where("page_id is not null").select(F.col("page_id").cast("bigint").alias("page_id"), _clean_url(F.col("url")).alias("url"), payload.alias("html"))
    digests = named.select("page_id", "url", F.sha1("html").alias("sha"), F.octet_length("html").cast("long").alias("bytes"))
    # One row per page: of a repeated page id the larger digest.
    ids = stored(digests.groupBy("page_id").agg(F.max(F.struct("sha", "bytes", "url")).alias("x")).select("page_id", "x.*"), "page-digests")
    total = ids.agg(F.sum("bytes")).first()[0] or 0
    last = ids.groupBy("sha").agg(F.max("page_id").alias("last"))
    shared = ids.join(last, "sha").where((F.col("bytes") >= min_bytes) & (F.col("page_id") != F.col("last")))
    revisits = stored(shared.select("page_id", "url", "sha", "bytes", F.col("last").alias("refers_to")), "revisits")
    # Payloads meet the ids they are needed for by page id; those of revisits stay behind. Their one shuffle also
    # deals the records to archives, so the join is never turned into a broadcast, whatever the size.
    wanted = ids.join(revisits.select("page_id"), "page_id", "left_anti").select("page_id", F.col("sha").alias("own"))
    archives = max(1, -(-total // ARCHIVE_BYTES))
    joined = named.repartition(archives, "page_id").hint("merge").join(wanted, "page_id")
    if _repeats(named, ids):
        joined = joined.where(F.sha1("html") == F.col("own")).dropDuplicates(["page_id"])
    full = joined.select("page_id", "url", "html")

    def responses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(p.as_py(), number, record)
                     for p, url, html in zip(batch.column("page_id"), batch.column("url"), batch.column("html"), strict=True)
                     for number, record in response_records(p.as_py(), url.as_py(), html.as_py().encode(), segment_bytes)]
            yield _table(found)

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _table([(r["page_id"], 1, revisit_record(r["page_id"], r["url"], base64.b32encode(bytes.fromhex(r["sha"])).decode(), r["bytes"], r["refers_to"]))
                          for r in batch.to_pylist()])

    records = full.mapInArrow(responses, _RECORD).unionByName(revisits.mapInArrow(visits, _RECORD))
    lines = records.select(F.col("record").cast("string").alias("value"))
    lines.write.option("lineSep", END).option("compression", "gzip").text(path)


def _repeats(named: DataFrame, ids: DataFrame) -> bool:
    """Whether a page id occurs more than once, which needs a closer look at the payloads."""
    return named.count() > ids.count()


def _table(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    page, number, record = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(page, pa.int64()), pa.array(number, pa.int32()), pa.array(record, pa.binary())],
                                      names=["page_id", "number", "record"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives: page, origin and number of a segment, total length where stated, and block."""
    names = [part.split()[0] for part in _PIECE.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows: list[tuple] = []
                held = 0
                for fields, block in records_of(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())))):
                    segmented = "warc-segment-number" in fields
                    origin = fields.get("warc-segment-origin-id", fields["warc-record-id"])
                    refers = fields.get("warc-refers-to")
                    declared = None
                    if fields["warc-type"] == "revisit":
                        head = block.split(BLANK)[0].decode().lower()
                        declared = int(head.split("content-length:")[1].split("\r\n")[0])
                    total = fields.get("warc-segment-total-length")
                    rows.append((_page_of(fields["warc-record-id"]), _page_of(origin) if segmented else None, int(fields.get("warc-segment-number", 1)),
                                 int(total) if total else None, fields["warc-type"], fields.get("warc-payload-digest"),
                                 _page_of(refers) if refers else None, declared, None if declared is not None else block))
                    held += len(block)
                    if held > (4 << 20):
                        yield table(rows)
                        rows, held = [], 0
                if rows:
                    yield table(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(read, _PIECE)


def reassembled(pieces: DataFrame) -> DataFrame:
    """Whole records: segments of one origin in order, complete and of the stated total length."""
    whole = pieces.where("origin is null").select("page_id", "kind", "digest", "refers_to", "declared", "block")
    grouped = pieces.where("origin is not null").groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("s"), F.max("total").alias("total"), F.max("number").alias("n"),
        F.max(F.when(F.col("number") == 1, F.col("digest"))).alias("digest"))
    length = F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x["block"]))
    right = (F.size("s") == F.col("n")) & (length == F.col("total"))
    block = F.when(right, F.aggregate("s", F.lit(b""), lambda a, x: F.concat(a, x["block"]))).otherwise(
        F.raise_error(F.concat(F.lit("segments missing of record "), F.col("origin"))))
    joined = grouped.select(F.col("origin").alias("page_id"), F.lit("response").alias("kind"), "digest",
                            F.lit(None).cast("bigint").alias("refers_to"), F.lit(None).cast("bigint").alias("declared"), block.alias("block"))
    return whole.unionByName(joined)


def payloads(records: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to; responses are checked against their digest."""
    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page, kind, digest, refers, declared, block in zip(*(batch.column(c) for c in ("page_id", "kind", "digest", "refers_to", "declared", "block")), strict=True):
                stated = digest.as_py().removeprefix("sha1:")
                size = declared.as_py()
                if kind.as_py() == "response":
                    payload = dechunked(block.as_py().split(BLANK, 1)[1])
                    size = len(payload)
                    if digest_of(payload) != stated:
                        raise ValueError(f"the payload of page {page} has another digest than its record states")
                rows.append((page.as_py(), size, stated, kind.as_py(), refers.as_py()))
            columns = zip(*rows, strict=True) if rows else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return records.mapInArrow(read, schema)


def archive_report(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    path = new_path(spark, "archives")
    write_archives(pages, path)
    return payloads(reassembled(read_archives(spark, path)))
