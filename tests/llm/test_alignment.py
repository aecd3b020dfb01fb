"""The alignment against the two libraries, token by token in plain Python."""

import hashlib
import json
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm import common
from tidemark.llm import alignment
from tidemark.llm.bpe import byte_characters

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a▁b", "  two  spaces ", "tail ", " ", "  x", "x   y", "　 z    q", "x   b", "nul\x00 x", "<s> </s> <unk> <0x41> a", "x" * 20000,
       " " * 5000, "\n" * 3000, "a \n b", "\x1c  a\x85  b", "e ́x", "it's we'll <|endoftext|> x"]


def by_hand(texts):
    """The report of each text and the digest, from the libraries' own ids."""
    a = Tokenizer.from_file(BYTE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    byte = {c: n for n, c in enumerate(byte_characters())}

    def piece(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    rows, counts = [], Counter()
    for text in texts:
        a_ids, b_ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        tokens = [[bytes(byte[c] for c in a.id_to_token(i)) for i in a_ids], [piece(i) for i in b_ids]]
        if not text or any(b"".join(t) != (" " + text).encode() for t in tokens):
            rows.append((0, 0, 0, [], ""))
            continue
        ends = []
        for own in tokens:
            place, at = {}, 0
            for n, token in enumerate(own):
                at += len(token)
                place[at] = n
            ends.append(place)
        groups, links, i, j = [], [], 0, 0
        for end in sorted(ends[0].keys() & ends[1].keys()):
            m, n = ends[0][end], ends[1][end]
            groups.append(",".join(map(str, a_ids[i:m + 1])) + "|" + ",".join(map(str, b_ids[j:n + 1])))
            links.append((a_ids[m], b_ids[n]))
            i, j = m + 1, n + 1
        counts.update(links)
        rows.append((len(a_ids), len(b_ids), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = {}
    for (_, n), count in counts.items():
        most[n] = max(most.get(n, 0), count)
    return [(n_a, n_b, g, len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), digest)
            for n_a, n_b, g, links, digest in rows]


def report(docs):
    return sorted(map(tuple, alignment.alignment_report(docs, BYTE, PIECE).collect()), key=str)


def test_against_the_libraries(spark):
    texts = common.awkward() + ODD + ["the same words"] * 300
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in enumerate(texts)], "doc_id long, text string, pair string, part int, at string")
    assert report(docs.repartition(7)) == sorted([(i, *r) for i, r in enumerate(by_hand(texts))], key=str)


def test_repeated_and_null_ids_and_empty_tables(awkward_docs, no_docs):
    rows = awkward_docs.select("doc_id", "text").collect()
    assert report(awkward_docs) == sorted([(r.doc_id, *f) for r, f in zip(rows, by_hand([r.text for r in rows]), strict=True)], key=str)
    assert report(no_docs) == []


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_remembered_words_do_not_change_results(limit, monkeypatch):
    with open(BYTE, encoding="utf-8") as a, open(PIECE, "rb") as b:
        monkeypatch.setattr(alignment, "REMEMBERED_BYTES", limit)
        aligner = alignment.Aligner(a.read(), b.read())
    import pyarrow as pa

    texts = common.awkward()
    found = []
    for part in alignment.slices(pa.array(texts), 20_000):
        row = aligner.aligned(part, pa.array(range(part.first, part.first + part.n), pa.int64()), 0)
        found += zip(row["n_a"].tolist(), row["n_b"].tolist(), row["n_groups"].tolist(), row["groups_sha256"], strict=True)
    assert found == [(r[0], r[1], r[2], r[6]) for r in by_hand(texts)]


def test_other_files_go_through_the_library():
    """A file whose ids do not follow its merges is encoded whole by its own library."""
    with open(BYTE, encoding="utf-8") as file:
        content = json.load(file)
    content["pre_tokenizer"]["add_prefix_space"] = True
    other = alignment.ByteVocabulary(json.dumps(content))
    assert not other.ranked
    assert other.encode([" a b", " <|endoftext|>"]) == alignment.ByteVocabulary(open(BYTE, encoding="utf-8").read()).encode([" a b", " <|endoftext|>"])
