import hashlib
import random

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tests.llm import common
from tidemark.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


def library():
    made = Tokenizer.from_file(PATH)
    made.no_truncation()
    made.no_padding()
    return made


def test_digests_are_those_of_the_library(spark, awkward_docs):
    theirs = library()
    rows = bpe.digest_report(awkward_docs, PATH).collect()
    assert len(rows) == awkward_docs.count()
    texts = {r.doc_id: r.text for r in awkward_docs.collect()}
    for r in rows:
        ids = theirs.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_random_text_against_the_library():
    theirs, ours = library(), bpe.WordBpe(open(PATH, encoding="utf-8").read())
    rng = random.Random(1)
    letters = "abcdeé ñß'ßAÉ 12½²\n\t\x85\xa0!?-_.,😀漢Σςσ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 80))) for _ in range(500)]
    for text, ids in zip(texts, ours.encode_all(texts), strict=True):
        assert ids == theirs.encode(text, add_special_tokens=False).ids, repr(text)


def test_tables_of_trees_equal_single_trees():
    ours, rng = bpe.WordBpe(open(PATH, encoding="utf-8").read()), random.Random(2)
    words = ["".join(rng.choice("thenigaé") for _ in range(n)) for n in [*range(1, 60)] * 20]
    assert ours.merge_all(words) == [ours.merge(w) for w in words]


def test_long_word_and_decoding(spark):
    word = "".join(random.Random(3).choice("abcdefgh") for _ in range(20000))
    docs = spark.createDataFrame([(1, word, "x"), (2, None, "y"), (3, "", "z")], "doc_id bigint, text string, ids string")
    encoded = bpe.encoded(docs, PATH)
    found = {r.doc_id: r for r in encoded.collect()}
    assert found[1].ids == library().encode(word, add_special_tokens=False).ids
    assert found[2].ids == [] and found[3].ids == []
    assert {r.doc_id: r.text for r in bpe.decoded(encoded, PATH).collect()}[1] == library().decode(found[1].ids, skip_special_tokens=False)


def test_empty_table(no_docs):
    assert bpe.digest_report(no_docs, PATH).collect() == []


def test_nothing_is_forgotten_wrongly(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    ours, theirs = bpe.Digests(bpe.WordBpe(open(PATH, encoding="utf-8").read())), library()
    rng = random.Random(5)
    for _ in range(20):
        text = common.sentences(rng, 15, 60)
        assert next(ours.of([text]))[0] == len(theirs.encode(text, add_special_tokens=False).ids)


def test_ids_are_handed_on_by_small_slices(monkeypatch):
    """One batch of many texts never has all its ids in memory, and no row is lost or moved."""
    monkeypatch.setattr(bpe, "ENCODED_CHARS", 100)
    ours = bpe.WordBpe(open(PATH, encoding="utf-8").read())
    texts = [None, "", *(f"some words of text {i}" for i in range(50)), "x" * 500]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    out = list(bpe.encoded_slices(ours, batch, ["doc_id"], "digest"))
    assert len(out) > 10 and all(b.num_rows < 8 for b in out)
    rows = [r for b in out for r in b.to_pylist()]
    assert [r["doc_id"] for r in rows] == list(range(len(texts)))
    assert [r["ids"] for r in rows] == list(ours.encode_all(texts))
    assert all(r["digest"] == hashlib.sha256(ours.decode(r["ids"]).encode()).hexdigest() for r in rows)
