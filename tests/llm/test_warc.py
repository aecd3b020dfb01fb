import base64
import gzip
import hashlib
import io
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc
from tidemark.llm.store import new_path

SCHEMA = "page_id bigint, url string, html string, record string, sha string"


def pages(spark):
    rng = random.Random(5)
    texts = ["", None, "a\r\n\r\nWARC/1.0\r\n\r\nb", "é" * 30000, "x" * 200000, "same", "same", "same", "\r\n", "<p>" + "ab\n" * 40000]
    texts += ["".join(rng.choice("abc\r\n é") for _ in range(rng.randrange(1, 3000))) for _ in range(40)]
    rows = [(i, [f"http://h/{i}", None, "odd url\r\nX: y"][i % 3], t, "r", "s") for i, t in enumerate(texts)]
    return rows, spark.createDataFrame([*rows, (None, "u", "t", "r", "s"), rows[3]], SCHEMA).repartition(4)


def expected(rows, least=0):
    groups = defaultdict(list)
    for page, _, html, *_ in rows:
        groups[html or ""].append(page)
    out = set()
    for page, _, html, *_ in rows:
        body, last = (html or "").encode(), max(groups[html or ""])
        again = last != page and len(body) >= least
        out.add((page, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", last if again else None))
    return out


@pytest.mark.parametrize("size", [200, 32 << 10])
def test_round_trip(spark, size):
    rows, frame = pages(spark)
    path = new_path(spark, "test-archives")
    warc.write_archives(frame, path, segment_bytes=size)
    pieces = warc.read_archives(spark, path)
    found = warc.payloads(warc.reassembled(pieces)).collect()
    assert len(found) == len(rows)
    assert {tuple(r) for r in found} == expected(rows)
    assert pieces.where("kind = 'continuation'").count() > 0
    shuffled = pieces.orderBy(F.rand(1))
    assert {tuple(r) for r in warc.payloads(warc.reassembled(shuffled)).collect()} == expected(rows)


def test_least_size_of_revisits(spark):
    rows, frame = pages(spark)
    path = new_path(spark, "test-archives")
    warc.write_archives(frame, path, min_bytes=10)
    assert {tuple(r) for r in warc.payloads(warc.reassembled(warc.read_archives(spark, path))).collect()} == expected(rows, 10)


def test_missing_segment_is_an_error(spark):
    _, frame = pages(spark)
    path = new_path(spark, "test-archives")
    warc.write_archives(frame, path, segment_bytes=5000)
    pieces = warc.read_archives(spark, path).where("not (page_id = 4 and number = 2)")
    with pytest.raises(Exception, match="segments missing"):
        warc.reassembled(pieces).collect()


def test_archives_are_plain_warc(spark):
    _, frame = pages(spark)
    path = new_path(spark, "test-archives")
    warc.write_archives(frame, path)
    for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect():
        content = gzip.decompress(bytes(r.content))
        found = list(warc.records_of(io.BytesIO(content)))
        assert content.count(b"WARC/1.0\r\nWARC-Type: ") == len(found)
        assert content.endswith(b"\r\n\r\n")


def test_chunked_framing():
    for size in (1, 7, 100):
        for payload in (b"", b"a", b"0\r\n\r\n" * 50):
            assert warc.dechunked(warc.chunked(payload, size)) == payload
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nabc")


def test_repeated_page_ids(spark):
    frame = spark.createDataFrame([(1, "u", "a"), (1, "u", "b"), (2, "u", "b"), (2, "u", "b")], "page_id bigint, url string, html string")
    rows = {r.page_id: r for r in warc.archive_report(frame).collect()}
    assert set(rows) == {1, 2} and rows[2].record_type == "response"


def test_empty_table(spark):
    assert warc.archive_report(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []
