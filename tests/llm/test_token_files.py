import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import token_files
from tidemark.llm.store import new_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 60000), st.integers(0, 2**32 - 1)), max_size=700))
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.uint32)
    assert (token_files.unpack(token_files.pack(ids)) == ids).all()


def test_outliers_become_exceptions():
    ids = np.full(1280, 7, np.uint32)
    ids[::100] = 50000
    assert len(token_files.pack(ids)) < 300


def expected(docs):
    made = Tokenizer.from_file(PATH)
    start, out = 0, []
    for doc, text in docs:
        ids = made.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("file_chars", [500, 1 << 25])
def test_report(spark, awkward_docs, monkeypatch, file_chars):
    monkeypatch.setattr(token_files, "FILE_CHARS", file_chars)
    monkeypatch.setattr(token_files.plan_files, "__defaults__", (file_chars,))
    docs = sorted(((r.doc_id, r.text) for r in awkward_docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    rows = sorted(map(tuple, token_files.file_report(awkward_docs, PATH).collect()), key=lambda r: r[1])
    assert rows == expected(docs)


def test_files_hold_several_segments(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 50)
    docs = spark.createDataFrame([(i, f"document {i} " * (i % 9)) for i in range(200)], "doc_id bigint, text string")
    path = new_path(spark, "test-files")
    token_files.write_ids(docs, PATH, path)
    assert spark.read.parquet(path).count() > 20
    made = Tokenizer.from_file(PATH)
    for r in token_files.read_ids(spark, path).collect():
        assert list(np.frombuffer(r.ids, "<u4")) == made.encode(f"document {r.doc_id} " * (r.doc_id % 9), add_special_tokens=False).ids + [0]


def test_empty_table(no_docs):
    assert token_files.file_report(no_docs, PATH).collect() == []


def test_random_text_against_the_library():
    made, ours = Tokenizer.from_file(PATH), token_files.TextIds(open(PATH, encoding="utf-8").read())
    rng = random.Random(4)
    letters = ["a", "b", "é", " ", "  ", "\n", "\n\n", "\t", "\x85", "\xa0", "'s", "'ll", "1", "²", "!", "?!", "漢", "😀", "<|endoftext|>", "   ", "\x1c"]
    for _ in range(2000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 25)))
        assert list(np.frombuffer(ours.encode(text), "<u4")) == made.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_that_never_repeat_cost_less_than_with_the_library():
    """Much of a large corpus is words seen once, for which remembered words are no help."""
    made, ours = Tokenizer.from_file(PATH), token_files.TextIds(open(PATH, encoding="utf-8").read())
    rng = random.Random(6)
    text = " ".join("".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(40000))
    assert ours.numbers("warm up") == made.encode("warm up", add_special_tokens=False).ids
    began = time.process_time()
    found = ours.numbers(text)
    between = time.process_time()
    want = made.encode(text, add_special_tokens=False).ids
    assert found == want and between - began < time.process_time() - between
