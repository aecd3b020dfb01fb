"""Alignment of two tokenizers over the same texts: where their tokens end together, and which ids meet there.

Tokenizer A is a byte-level BPE that encodes a space and the text; tokenizer B is a piece model that puts that space
before the text itself. Where a token of A and one of B end at the same byte of a document, they are linked, and these
ends cut both token sequences into groups.

Work goes by slices of whole documents. Both id lists are flattened with their parent documents; running byte totals,
restarted at each document, give every token's end; an Acero hash join on (document, end) yields the links, and
`Table.group_by` counts them by document and by pair of ids. Spark adds the slices' counts of each pair, and each slice
gets back the corpus-wide figures of the pairs it holds. A pair has one row a slice, however common it is.

* A null or empty text has no tokens, nor has one whose joined token bytes are not the space and the text (a text
  with U+2581, for one): zeros, and an empty `groups_sha256`. Special tokens inside a text are plain text.
* Texts of any length are encoded whole; a slice grows to hold its longest document.
* Null and repeated `doc_id`s are documents of their own; further columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from tidemark.llm.bpe import byte_characters
from tidemark.llm.store import stored
from tidemark.llm.textbytes import Slice, slices

#: Fixed value: the split pattern of byte-level BPE files of this kind.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Second last and last bytes of the white space beyond ASCII, and some other characters.
_WIDE_BEFORE = np.isin(np.arange(256), [0x80, 0x81, 0x9A, 0xC2])
_WIDE_LAST = np.isin(np.arange(256), [*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF])

#: Bytes of distinct words (with their ids) that a worker remembers; beyond that, only those of the latest slice stay.
REMEMBERED_BYTES = 12 << 20

SLICES = ("part long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
          "groups_sha256 array<string>, doc_pairs array<int>, pair_at array<int>, pair_links array<int>, "
          "pair array<long>, links array<long>")
REPORT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])


class ByteVocabulary:
    """Tokenizer A from the content of its file."""

    def __init__(self, content: str):
        file = json.loads(content)
        vocabulary = file["model"]["vocab"]
        byte = {c: b for b, c in enumerate(byte_characters())}
        self.entries = {i: bytes(byte[c] for c in t) for t, i in vocabulary.items()}
        joined = ["".join(m if isinstance(m, list) else m.split(" ")) for m in file["model"]["merges"]]
        # Merges in the order of their ids, under the usual pattern: ids serve as ranks.
        self.ranked = (all(vocabulary[t] == 256 + n for n, t in enumerate(joined)) and not file.get("normalizer")
                       and file["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True})
        if self.ranked:
            self.encoder = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks={t: i for i, t in self.entries.items()}, special_tokens={})
        else:
            self.encoder = Tokenizer.from_str(content)
            self.encoder.encode_special_tokens = True
            self.encoder.no_padding()
            self.encoder.no_truncation()

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.ranked:
            return [self.encoder.encode_ordinary(t) for t in texts]
        return [e.ids for e in self.encoder.encode_batch(texts, add_special_tokens=False)]


class PieceVocabulary:
    """Tokenizer B from the content of its model file."""

    def __init__(self, content: bytes):
        self.encoder = sentencepiece.SentencePieceProcessor(model_proto=content)
        pieces = [self.encoder.id_to_piece(i) for i in range(self.encoder.get_piece_size())]
        self.entries = {i: bytes([int(p[3:5], 16)]) if self.encoder.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)}
        spec = sentencepiece_model_pb2.ModelProto.FromString(content)
        # No piece goes on over a space after another character, and texts are taken as they are.
        self.cuttable = (
            not any("▁" in p.lstrip("▁") for p in pieces)
            and spec.trainer_spec.model_type == spec.trainer_spec.BPE and spec.normalizer_spec.add_dummy_prefix
            and not spec.normalizer_spec.remove_extra_whitespaces and not spec.normalizer_spec.precompiled_charsmap)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.encoder.encode(texts, num_threads=1)


def spaced(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a slice with a space before each document, and the documents' offsets."""
    offsets = part.offsets + np.arange(part.n + 1)
    out = np.empty(int(offsets[-1]), np.uint8)
    own = np.ones(len(out), bool)
    own[offsets[:-1]] = False
    out[own], out[~own] = part.data, 0x20
    return out, offsets


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The documents' starts, and the spaces inside them that follow no white space and are not their last byte.

    No token of either vocabulary goes over such a place, so what lies between two of them is encoded on its own.
    """
    at = np.flatnonzero(data == 0x20)
    at = at[at > 0]
    before = data[at - 1]
    wide = _WIDE_LAST[before] & _WIDE_BEFORE[data[np.maximum(at - 2, 0)]]
    cut = np.zeros(len(data) + 1, bool)
    cut[at[(before > 0x20) & ~wide]] = True
    cut[offsets[1:] - 1] = False
    cut[offsets] = True
    return np.flatnonzero(cut[:-1])


def _lists(ids: list[list[int]]) -> pa.ListArray:
    sizes = np.fromiter(map(len, ids), np.int32, len(ids))
    flat = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat))


class Aligner:
    """Links and groups of one slice after another."""

    def __init__(self, byte_file: str, piece_file: bytes):
        self.a, self.b = ByteVocabulary(byte_file), PieceVocabulary(piece_file)
        self.bytes = [self._table(v.entries) for v in (self.a, self.b)]
        self.sizes = [pc.fill_null(pc.binary_length(t), 0) for t in self.bytes]
        # Decimal ids with what follows them: "," inside a group, "|" after its last id of A, ";" after its last of B.
        ids = [np.arange(len(t)) for t in self.bytes]
        self.shift = 2 * len(ids[0])
        words = [f"{i}{mark}" for own, end in zip(ids, "|;", strict=True) for i in own for mark in (",", end)]
        self.marked_ids = pa.array(words, pa.large_string())
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.known_ids = [_lists([]), _lists([])]
        self.known_good = np.ones(0, bool)

    @staticmethod
    def _table(entries: dict[int, bytes]) -> pa.Array:
        return pa.array([entries.get(i) for i in range(max(entries) + 1)], pa.large_binary())

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[pa.ListArray], np.ndarray]:
        """Both id lists of each document, and which documents are given back byte for byte."""
        starts = cuts(data, offsets) if self.b.cuttable and self.a.ranked else offsets[:-1]
        text = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data)])
        coded = text.dictionary_encode()
        self.learn(coded.dictionary)
        word = pc.index_in(coded.dictionary, value_set=self.known).take(coded.indices)
        first = np.searchsorted(starts, offsets)
        whole = np.minimum.reduceat(self.known_good[word.to_numpy()], first[:-1]) if len(first) > 1 else np.ones(0, bool)
        out = []
        for lists in self.known_ids:
            taken = lists.take(word)
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(taken).to_numpy())])
            out.append(pa.LargeListArray.from_arrays(pa.array(ends[first]), taken.flatten()))
        return out, whole

    def learn(self, words: pa.Array) -> None:
        """Encode the words that are not yet known."""
        if self.known.nbytes > REMEMBERED_BYTES:
            self._forget()
        words = words.filter(pc.invert(pc.is_in(words, value_set=self.known)))
        plain = words.to_pylist()
        ids = [_lists(self.a.encode(plain)), _lists(self.b.encode([t[1:] for t in plain]))]
        good = np.ones(len(plain), bool)
        for lists, entries in zip(ids, self.bytes, strict=True):
            good &= self._restored(lists, entries, words, plain)
        self.known = pa.concat_arrays([self.known, words])
        self.known_ids = [pa.concat_arrays(x) for x in zip(self.known_ids, ids, strict=True)]
        self.known_good = np.concatenate([self.known_good, good])

    @staticmethod
    def _restored(lists: pa.ListArray, entries: pa.Array, texts: pa.Array, plain: list[str]) -> np.ndarray:
        joined = entries.take(lists.flatten())
        data = memoryview(joined.buffers()[2] or b"").cast("B")
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(joined), 0).to_numpy())])[lists.offsets.to_numpy()]
        sizes = pc.binary_length(texts).to_numpy()
        if np.array_equal(np.diff(ends), sizes) and data[:ends[-1]] == memoryview(texts.buffers()[2] or b"").cast("B")[:ends[-1]]:
            return np.ones(len(plain), bool)
        return np.array([data[lo:hi] == t.encode() for lo, hi, t in zip(ends[:-1], ends[1:], plain, strict=True)])

    def aligned(self, part: Slice, doc_ids: pa.Array, number: int) -> dict:
        """One row of SLICES."""
        has = np.flatnonzero(np.diff(part.offsets) > 0)
        kept = Slice(0, part.data, np.append(part.offsets[has], part.offsets[-1]))
        data, offsets = spaced(kept)
        lists, whole = self.encode(data, offsets)
        good = np.flatnonzero(whole)
        sides = []
        for lists_of, sizes, name in zip(lists, self.sizes, "ab", strict=True):
            own = lists_of.take(pa.array(good))
            ids, doc = own.flatten(), pc.list_parent_indices(own).to_numpy()
            total = np.concatenate([[0], np.cumsum(sizes.take(ids).to_numpy())])
            starts = np.concatenate([[0], np.cumsum(pc.list_value_length(own).to_numpy())]).astype(np.int64)
            end = total[1:] - total[starts[:-1]][doc]
            sides.append((ids, doc, starts, pa.table({"doc_end": (doc.astype(np.int64) << 40) | end, name: np.arange(len(ids))})))
        (a_ids, a_doc, a_starts, a), (b_ids, _, b_starts, b) = sides
        links = a.join(b, keys="doc_end", join_type="inner", use_threads=False)
        a_at, b_at = links["a"].to_numpy(), links["b"].to_numpy()
        a_last, b_last = np.zeros(len(a_ids), bool), np.zeros(len(b_ids), bool)
        a_last[a_at], b_last[b_at] = True, True
        doc = a_doc[a_at]
        key = pa.array((a_ids.to_numpy()[a_at].astype(np.int64) << 32) | b_ids.to_numpy()[b_at]).dictionary_encode()
        counted = pa.table({"doc": doc, "at": key.indices}).group_by(["doc", "at"], use_threads=False).aggregate([([], "count_all")])
        pairs = counted.group_by("at", use_threads=False).aggregate([("count_all", "sum")]).sort_by("at")
        counted = counted.sort_by([("doc", "ascending"), ("at", "ascending")])

        n = part.n
        at = has[good]
        figures = {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links", "doc_pairs")}
        figures["n_a"][at], figures["n_b"][at] = np.diff(a_starts), np.diff(b_starts)
        running = np.concatenate([[0], np.cumsum(a_last)])
        figures["n_groups"][at] = running[a_starts[1:]] - running[a_starts[:-1]]
        figures["n_links"][at] = np.bincount(doc, minlength=len(good))
        figures["doc_pairs"][at] = np.bincount(counted["doc"].to_numpy(), minlength=len(good))
        digests = np.full(n, "", object)
        digests[at] = self.digests(a_ids, a_starts, a_last, b_ids, b_starts, b_last)
        return figures | {
            "part": number, "doc_id": doc_ids, "groups_sha256": digests, "pair_at": counted["at"], "pair_links": counted["count_all"],
            "pair": key.dictionary, "links": pairs["count_all_sum"]}

    def digests(self, a_ids, a_starts, a_last, b_ids, b_starts, b_last) -> list[str]:
        """SHA-256 of each document's groups: ids of A, then ids of B, group by group."""
        a_group = np.cumsum(a_last) - a_last  # of whole groups before each token
        b_group = np.cumsum(b_last) - b_last
        a_until, b_until = np.concatenate([[0], np.flatnonzero(a_last) + 1]), np.concatenate([[0], np.flatnonzero(b_last) + 1])
        codes = np.empty(len(a_ids) + len(b_ids), np.int64)
        codes[np.arange(len(a_ids)) + b_until[a_group]] = 2 * a_ids.to_numpy() + a_last
        codes[np.arange(len(b_ids)) + a_until[np.minimum(b_group + 1, len(a_until) - 1)]] = 2 * b_ids.to_numpy() + b_last + self.shift
        text = self.marked_ids.take(pa.array(codes))
        ends = np.frombuffer(text.buffers()[1], np.int64)[a_starts + b_starts] if len(codes) else np.zeros(len(a_starts), np.int64)
        data = memoryview(text.buffers()[2]) if len(codes) else memoryview(b"")
        return [hashlib.sha256(data[lo:hi - 1]).hexdigest() for lo, hi in zip(ends[:-1], ends[1:], strict=True)]


def _row(found: dict) -> pa.RecordBatch:
    """A slice's figures as one row of lists."""
    def listed(values, kind):
        flat = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values if isinstance(values, pa.Array) else pa.array(values)
        return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat.cast(kind))

    kinds = {"doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(),
             "doc_pairs": pa.int32(), "pair_at": pa.int32(), "pair_links": pa.int32(), "pair": pa.int64(), "links": pa.int64()}
    return pa.RecordBatch.from_pydict({"part": pa.array([found["part"]], pa.int64())} | {c: listed(found[c], kind) for c, kind in kinds.items()})


_LOADED: dict[str, Aligner] = {}


def _aligner(byte_file: str, piece_file: bytes) -> Aligner:
    """One aligner per worker process and pair of files, kept over tasks."""
    key = hashlib.sha256(byte_file.encode() + piece_file).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Aligner(byte_file, piece_file)
    return _LOADED[key]


def sliced(docs: DataFrame, byte_file: str, piece_file: bytes) -> DataFrame:
    """One row of SLICES for each slice of `doc_id`, `text`; the files (a few megabytes) are sent to the executors once."""
    files = docs.sparkSession.sparkContext.broadcast((byte_file, piece_file))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = _aligner(*files.value), TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch.column("text")):
                yield _row(aligner.aligned(part, batch.column("doc_id").slice(part.first, part.n), number))
                number += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(align, SLICES)


def pair_counts(parts: DataFrame) -> DataFrame:
    """`pair` (id of A times 2**32 plus id of B), `links` over all slices, and `best`: no pair of this id of B has more."""
    totals = stored(
        parts.select(F.explode(F.arrays_zip("pair", "links")).alias("p")).groupBy(F.col("p.pair").alias("pair"))
        .agg(F.sum("p.links").alias("links")).withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)), "pairs")
    highest = totals.groupBy("b").agg(F.max("links").alias("most"))
    return totals.join(highest, "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


def _summed(key, docs: pa.Table, answers: pa.Table) -> pa.Table:
    row = {c: docs[c].combine_chunks().flatten() for c in docs.column_names if c != "part"}
    at = answers["at"].to_numpy()
    links, best = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
    links[at], best[at] = answers["total"].to_numpy(), answers["best"].to_numpy()
    held, times = row["pair_at"].to_numpy(), row["pair_links"].to_numpy().astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(row["doc_pairs"].to_numpy())])
    running = [np.concatenate([[0], np.cumsum(x)]) for x in (times * best[held], times * links[held])]
    best_of, sum_of = (x[starts[1:]] - x[starts[:-1]] for x in running)
    return pa.table({**{c: row[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}, "n_best": best_of, "count_sum": sum_of,
                     "groups_sha256": row["groups_sha256"]}, schema=_ARROW)


def alignment_report(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Per document: token, group and link counts, links of the best pairs, summed pair counts and the groups' digest."""
    with open(byte_path, encoding="utf-8") as a, open(piece_path, "rb") as b:
        parts = stored(sliced(docs, a.read(), b.read()), "slices")
    held = parts.select(F.col("part").alias("slice"), F.posexplode("pair").alias("at", "pair"))
    answers = held.join(pair_counts(parts).withColumnRenamed("links", "total"), "pair").select("slice", "at", "total", "best")
    return parts.drop("pair", "links").groupBy("part").cogroup(answers.groupBy("slice")).applyInArrow(_summed, REPORT)
