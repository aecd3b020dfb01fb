"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax.

log P(token | context) = log P(class | context) + log P(token | class, context). The most frequent tokens are classes of
their own; the others share classes by bands of their count, whose width follows the largest count. Every factor is a
softmax of at most 16 branches over hashed features of the tokens before: the last one, the one before it (a skip), both
together, and the third last (a skip). A class is chosen by two of them, its group of about equal mass and its place in
the group; a token inside its class by the digits of its number there, each given the digits before and the context, on
the last token and the last two. One unknown token belongs to the class of the rarest, so the probabilities of all tokens
sum to one.

The texts are tokenised once into chunks of documents (a chunk's distinct tokens and the sequence of their places).
Features are hashed from the tokens' numbers in the vocabulary, so that a token found in held-out texts only is the
unknown one as context too.
Token counts come from the chunks' own counts, each distinct token once per chunk. Training is one pass over the learning
part, in three rounds of a third of the chunks each: a task starts from the model so far, makes minibatch updates over its
chunks, and hands on its changes, which are averaged row by row, weighted by how often each task saw the row.

* A null or empty text is one end token. A null doc_id counts as learning, not held out.
* Repeated rows count as often as they occur. Further columns are ignored. An empty table gives an empty result.
* If nothing is learned from (all held out), the unknown token is the only one, and its probability is one.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes
from tidemark.llm.store import remove, stored, written

FOLDS, HELD = 7, 2
#: Tokens of a chunk, about; a longer document makes a larger chunk.
CHUNK_TOKENS = 400_000
#: Classes: tokens of their own, and bands of counts for all others.
OWN_CLASSES, BANDS = 96, 32
#: Branches of every softmax.
CLASSES = 16
BUCKETS = 1 << 16
ROUNDS = 3
#: Rows of a minibatch; 2**16 at most.
BATCH = 16384
#: Tokens whose features are made at a time.
SLICE = 1 << 16
RATE = 0.4
PARTS = 16
FEATURES = 4
#: Features of the steps that choose a class, and of those inside it.
OF_CLASS, INSIDE = np.array([0, 1, 2, 3]), np.array([0, 2])
#: Entries of the chunks' token lists for each part of the vocabulary, about.
PART_TOKENS = 4_000_000
END, START = np.uint64(0x656E64), np.uint64(0x7374617274)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_SHIFT = np.uint64(64 - 16)


# ---- chunks


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in as few bytes as all of them need, compressed, after the width and the length."""
    kind = next(f"<u{w}" for w in (1, 2, 4, 8) if int(values.max(initial=0)) < 1 << (8 * w))
    return struct.pack("<BQ", int(kind[-1]), len(values)) + pa.compress(values.astype(kind).tobytes(), "zstd", asbytes=True)


def _unpacked(content: bytes) -> np.ndarray:
    width, n = struct.unpack_from("<BQ", content)
    return np.frombuffer(pa.decompress(memoryview(content)[9:], width * n, "zstd", asbytes=True), f"<u{width}").astype(np.int64)


def is_held(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD


_CHUNK = "chunk bigint, docs array<bigint>, lengths array<int>, held array<boolean>, tokens binary, counts binary, sequence binary"


def _token_stream(text: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first document, token hashes with an end after each document, tokens of each document) by slices."""
    for part in textbytes.slices(text):
        starts, ends, first = part.words()
        words = textbytes.word_hashes(part.data, starts, ends, lower=True)
        lengths = np.diff(first) + 1
        yield part.first, np.insert(words, first[1:], END), lengths


def chunks(docs: DataFrame) -> DataFrame:
    """Tokenised documents; `tokens` are in ascending order, `counts` are those of the learning documents of a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, number = TaskContext.get().partitionId(), 0
        ids: list = []
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def out() -> pa.RecordBatch:
            held = np.array([is_held(i) for i in ids])
            lengths = np.concatenate([p[1] for p in parts])
            coded = pa.array(np.concatenate([p[0] for p in parts])).dictionary_encode()
            tokens = coded.dictionary.to_numpy()
            order = np.argsort(tokens)
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            tokens, index = tokens[order], place[coded.indices.to_numpy()]
            learned = np.bincount(index[np.repeat(~held, lengths)], minlength=len(tokens))
            values = [(partition << 32) + number, ids, lengths, held, tokens.tobytes(), _packed(learned), _packed(index)]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)],
                                              names=[part.split()[0] for part in _CHUNK.split(", ")])

        for batch in batches:
            found = batch.column("doc_id")
            for first, tokens, lengths in _token_stream(batch.column("text")):
                ids += found.slice(first, len(lengths)).to_pylist()
                parts.append((tokens, lengths))
                size += len(tokens)
                if size >= CHUNK_TOKENS:
                    yield out()
                    ids, parts, size, number = [], [], 0, number + 1
        if ids:
            yield out()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, _CHUNK)


# ---- vocabulary


@dataclass(frozen=True)
class Vocabulary:
    """Figures over all learning tokens: total, distinct, and per class its smoothed total and the first number of its tokens.

    Tokens are numbered class by class; the unknown one is the last of the last class.
    """

    tokens: int
    distinct: int
    mass: np.ndarray
    first: np.ndarray

    def groups(self) -> list[list[int]]:
        """The classes that have tokens, in order, by at most 16 groups of at most 16, of about equal mass."""
        classes = np.flatnonzero(np.diff(self.first)).tolist()
        out: list[list[int]] = [[]]
        left = float(self.mass[classes].sum())
        held = 0.0
        for at, c in enumerate(classes):
            further = CLASSES - len(out)  # groups that may still be opened
            may = len(classes) - at <= CLASSES * further
            full = held + self.mass[c] / 2 > left / (further + 1) or len(classes) - at <= further
            if out[-1] and (len(out[-1]) == CLASSES or may and full):
                out.append([])
                left, held = left - held, 0.0
            out[-1].append(c)
            held += float(self.mass[c])
        return out


def pieces(raw: DataFrame, count: int) -> DataFrame:
    """(part, chunk, tokens, counts): the tokens of each chunk by `count` ranges of their hashes, in their order."""
    width = -(-(1 << 64) // count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                tokens, counts = np.frombuffer(batch.column("tokens")[row].as_py(), np.uint64), _unpacked(batch.column("counts")[row].as_py())
                edges = [0, *np.searchsorted(tokens, np.array([width * p for p in range(1, count)], np.uint64)).tolist(), len(tokens)]
                own = [p for p in range(count) if edges[p] < edges[p + 1]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(own, pa.int32()), pa.array([batch.column("chunk")[row].as_py()] * len(own), pa.int64()),
                    pa.array([tokens[edges[p]:edges[p + 1]].tobytes() for p in own], pa.binary()),
                    pa.array([_packed(counts[edges[p]:edges[p + 1]]) for p in own], pa.binary())], names=["part", "chunk", "tokens", "counts"])

    return raw.select("chunk", "tokens", "counts").mapInArrow(run, "part int, chunk bigint, tokens binary, counts binary")


def counted(split: DataFrame, count: int) -> DataFrame:
    """(part, tokens, counts): the distinct tokens of each part with their counts over all chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(part: int) -> tuple[np.ndarray, np.ndarray]:
            tokens, at = np.unique(np.concatenate([t for t, _ in held[part]]), return_inverse=True)
            sums = np.zeros(len(tokens), np.int64)
            np.add.at(sums, at, np.concatenate([c for _, c in held[part]]))
            return tokens, sums

        for batch in batches:
            for row in range(batch.num_rows):
                own = held.setdefault(batch.column("part")[row].as_py(), [])
                own.append((np.frombuffer(batch.column("tokens")[row].as_py(), np.uint64), _unpacked(batch.column("counts")[row].as_py())))
                if len(own) >= 64:
                    own[:] = [merged(batch.column("part")[row].as_py())]
        for part in held:
            tokens, sums = merged(part)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([tokens.tobytes()], pa.binary()), pa.array([_packed(sums)], pa.binary())],
                                             names=["part", "tokens", "counts"])

    return split.repartitionById(count, F.col("part")).mapInArrow(run, "part int, tokens binary, counts binary")


def _arrays(r) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(bytes(r["tokens"]), np.uint64), _unpacked(bytes(r["counts"]))


def _most(tables: DataFrame) -> list[tuple[int, int]]:
    """The most frequent tokens and their counts, one more than have a class of their own; so many of each part come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens, counts = _arrays(row)
                order = np.lexsort((tokens, -counts))[:OWN_CLASSES + 1]
                order = order[counts[order] > 0]
                yield pa.RecordBatch.from_arrays([pa.array(tokens[order].view(np.int64)), pa.array(counts[order])], names=["token", "c"])

    rows = tables.mapInArrow(run, "token bigint, c bigint").orderBy(F.desc("c"), "token").limit(OWN_CLASSES + 1).collect()
    return [(r["token"] & ((1 << 64) - 1), r["c"]) for r in rows]


def _classes(tokens: np.ndarray, counts: np.ndarray, most: list[tuple[int, int]]) -> np.ndarray:
    """The class of each token: its own, or the band of its count. Tokens without a count are in the last one."""
    largest = most[-1][1] if len(most) > OWN_CLASSES else 1
    band = np.minimum(BANDS - 1, (np.log(np.maximum(counts, 1)) * (BANDS / math.log(largest + 1))).astype(np.int64))
    out = OWN_CLASSES + BANDS - 1 - band
    for number, (token, _) in enumerate(most[:OWN_CLASSES]):
        at = int(np.searchsorted(tokens, np.uint64(token)))
        if at < len(tokens) and tokens[at] == token:
            out[at] = number
    return out


def vocabulary(tables: DataFrame, count: int) -> tuple[Vocabulary, list[tuple[int, int]], np.ndarray]:
    """The figures, the most frequent tokens, and the first number of each class in each part (parts x classes)."""
    most, n_classes = _most(tables), OWN_CLASSES + BANDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens, counts = _arrays(row)
                of, seen = _classes(tokens, counts, most), counts > 0
                sizes = np.bincount(of[seen], minlength=n_classes)
                sums = np.zeros(n_classes, np.int64)
                np.add.at(sums, of, counts)
                yield pa.RecordBatch.from_arrays([pa.array([row["part"]], pa.int32()), pa.array([sizes], pa.list_(pa.int64())), pa.array([sums], pa.list_(pa.int64()))],
                                                 names=["part", "sizes", "sums"])

    sizes, mass = np.zeros((count, n_classes), np.int64), np.zeros(n_classes)
    total = 0
    for r in tables.mapInArrow(run, "part int, sizes array<bigint>, sums array<bigint>").collect():
        sizes[r["part"]] = r["sizes"]
        mass += np.array(r["sizes"]) + np.array(r["sums"])
        total += sum(r["sums"])
    mass[-1] += 1  # the unknown token
    begin = (np.cumsum(sizes.T) - sizes.T.ravel()).reshape(n_classes, count).T
    distinct = int(sizes.sum())
    return Vocabulary(total, distinct, mass, np.append(begin[0], distinct + 1)), most, begin


def encoded(raw: DataFrame, split: DataFrame, tables: DataFrame, count: int, figures: Vocabulary, most: list[tuple[int, int]], begin: np.ndarray) -> DataFrame:
    """Chunks with number and count of each of their distinct tokens in place of `tokens`, in the same order."""
    starts = raw.sparkSession.sparkContext.broadcast(begin)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counts = members = np.zeros(0, np.int64)
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for row in rows:
                if row["chunk"] is None:  # the part's table, before its pieces
                    known, counts = _arrays(row)
                    of, seen = _classes(known, counts, most), np.flatnonzero(counts > 0)
                    members = np.full(len(known), figures.distinct)
                    order = seen[np.argsort(of[seen], kind="stable")]
                    ranked = of[order]
                    members[order] = starts.value[row["part"]][ranked] + np.arange(len(order)) - np.searchsorted(ranked, ranked)
                else:
                    at = np.searchsorted(known, np.frombuffer(row["tokens"], np.uint64))
                    out.append((row["chunk"], row["part"], _packed(members[at]), _packed(counts[at])))
            if out:
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)],
                                                 names=["chunk", "part", "members", "c"])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = None
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            members, counts = (np.concatenate(x) for x in zip(*found, strict=True))
            values = [chunk.column(name) for name in ("chunk", "docs", "lengths", "held", "sequence")]
            return pa.RecordBatch.from_arrays([*values, pa.array([_packed(members)], pa.binary()), pa.array([_packed(counts)], pa.binary())],
                                              names=["chunk", "docs", "lengths", "held", "sequence", "members", "c"])

        for batch in batches:
            for row in range(batch.num_rows):
                if batch.column("part")[row].as_py() is None:  # the chunk, before what was looked up for it
                    if found:
                        yield out()
                    chunk, found = batch.slice(row, 1), []
                else:
                    found.append((_unpacked(batch.column("members")[row].as_py()), _unpacked(batch.column("c")[row].as_py())))
        if found:
            yield out()

    none = lambda *named: [F.lit(None).cast(kind).alias(name) for name, kind in named]
    asked = split.select("part", "chunk", "tokens", *none(("counts", "binary"))).union(tables.select("part", *none(("chunk", "bigint")), "tokens", "counts"))
    looked = asked.repartitionById(count, F.col("part")).sortWithinPartitions("part", F.col("chunk").asc_nulls_first()).mapInArrow(
        look_up, "chunk bigint, part int, members binary, c binary")
    own = raw.select("chunk", *none(("part", "int"), ("members", "binary"), ("c", "binary")), "docs", "lengths", "held", "sequence")
    answers = looked.select("chunk", "part", "members", "c", *none(
        ("docs", "array<bigint>"), ("lengths", "array<int>"), ("held", "array<boolean>"), ("sequence", "binary")))
    return own.union(answers).repartition("chunk").sortWithinPartitions("chunk", F.col("part").asc_nulls_first()).mapInArrow(
        assemble, "chunk bigint, docs array<bigint>, lengths array<int>, held array<boolean>, sequence binary, members binary, c binary")


# ---- steps to a token


@dataclass(frozen=True)
class Step:
    """One softmax on the way to tokens: which of the given ones take it, its node, their branch, and the row of its prior."""

    taken: np.ndarray
    node: np.ndarray
    branch: np.ndarray
    prior: np.ndarray
    features: np.ndarray
    rows: dict[int, np.ndarray] = field(default_factory=dict)

    def row_of(self, count: int) -> np.ndarray:
        """For each of the given `count` tokens its place in `taken`, or -1; made once."""
        if count not in self.rows:
            self.rows[count] = np.full(count, -1, np.int32)
            self.rows[count][self.taken] = np.arange(len(self.taken))
        return self.rows[count]


class Steps:
    """The softmaxes that lead to a token, by its number."""

    def __init__(self, figures: Vocabulary):
        self.figures, groups = figures, figures.groups()
        n = len(figures.mass)
        self.group, self.place, self.single = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
        #: Log priors: of the groups, of the classes of each group, and of as many even branches as there are.
        self.priors = np.full((1 + 2 * CLASSES + 1, CLASSES), -np.inf)
        of_class = figures.mass
        for g, classes in enumerate(groups):
            self.group[classes], self.place[classes], self.single[classes] = g, np.arange(len(classes)), len(classes) == 1
            self.priors[0, g] = np.log(of_class[classes].sum() / of_class.sum())
            self.priors[1 + g, :len(classes)] = np.log(of_class[classes] / of_class[classes].sum())
        for even in range(1, CLASSES + 1):
            self.priors[1 + CLASSES + even, :even] = -math.log(even)
        self.priors = self.priors.astype(np.float32)
        self.several = len(groups) > 1

    def of(self, members: np.ndarray) -> Iterator[Step]:
        of = np.searchsorted(self.figures.first, members, "right") - 1
        size, number = np.diff(self.figures.first)[of], members - self.figures.first[of]
        node = lambda *keys: textbytes.mixed(sum((k.astype(np.uint64) * f for k, f in zip(keys, _FACTORS, strict=False)), np.uint64(1)))
        if self.several:
            zero = np.zeros(len(members), np.int64)
            yield Step(np.arange(len(members)), node(zero), self.group[of].astype(np.uint8), zero.astype(np.uint8), OF_CLASS)
        at = np.flatnonzero(~self.single[of])
        group = self.group[of[at]]
        yield Step(at, node(group + 1), self.place[of[at]].astype(np.uint8), (group + 1).astype(np.uint8), OF_CLASS)
        width = 1
        while True:
            before = number % width
            left = (size - before + width - 1) // width  # tokens with the same digits so far
            at = np.flatnonzero(left > 1)
            if not len(at):
                return
            yield Step(at, node(of[at] + CLASSES + 1, np.full(len(at), width), before[at]), (number[at] // width % CLASSES).astype(np.uint8),
                       (1 + CLASSES + np.minimum(left[at], CLASSES)).astype(np.uint8), INSIDE)
            width *= CLASSES


# ---- model


def features(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashed features (tokens x FEATURES) from the tokens before each position of its document."""
    before = []
    for distance in (1, 2, 3):
        moved = np.full(len(tokens), START)
        moved[distance:] = tokens[:-distance] if distance < len(tokens) else moved[distance:]
        for extra in range(distance):
            at = starts + extra
            moved[at[at < len(tokens)]] = START
        before.append(moved)
    one, two, three = before
    keys = [one * _FACTORS[0], two * _FACTORS[1], (one * _FACTORS[0] ^ (two * _FACTORS[2])) * _FACTORS[3], three * _FACTORS[2] + _FACTORS[0]]
    return np.stack([textbytes.mixed(k) for k in keys]).T


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def shares(weights: np.ndarray, prior: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unscaled probabilities of every branch for a batch of feature buckets, and their sums."""
    logits = weights.take(buckets[:, 0], axis=0)
    for f in range(1, buckets.shape[1]):
        logits += weights.take(buckets[:, f], axis=0)
    np.clip(logits, -30, 30, out=logits)  # before the prior, whose largest is at least -log 16
    logits += prior
    np.exp(logits, out=logits)
    return logits, logits @ np.ones(logits.shape[1], np.float32)


def log_softmax(weights: np.ndarray, prior: np.ndarray, buckets: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Log probability of the given branch of each row."""
    found, total = shares(weights, prior, buckets)
    own = found.take(np.arange(0, found.size, found.shape[1]) + classes)
    return np.log(np.maximum(own, np.float32(1e-37)) / total)


def bucket_sums(slope: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets found and, for each, the sum of its rows over the root of their number.

    Most buckets of a batch have one row, which is taken as it is, and most others two; only longer ones need sums of
    their own. Bucket and place have 16 bits each.
    """
    ranked = np.sort((buckets.astype(np.uint32) << np.uint32(16)) | np.arange(len(buckets), dtype=np.uint32))
    bucket, place = (ranked >> np.uint32(16)).astype(np.int64), (ranked & np.uint32(0xFFFF)).astype(np.int64)
    edge = np.ones(len(ranked) + 1, bool)
    np.not_equal(bucket[1:], bucket[:-1], out=edge[1:-1])
    begins, ends = edge[:-1], edge[1:]
    once, twice = begins & ends, begins[:-1] & ~ends[:-1] & ends[1:]
    longer = ~once
    longer[:-1] &= ~twice
    longer[1:] &= ~twice
    once, twice, longer = (np.flatnonzero(x) for x in (once, twice, longer))
    first = np.flatnonzero(begins[longer])
    sums = np.empty((len(once) + len(twice) + len(first), slope.shape[1]), np.float32)
    of_once, of_twice, of_longer = np.split(sums, [len(once), len(once) + len(twice)])
    slope.take(place[once], axis=0, out=of_once, mode="clip")
    np.add(slope.take(place[twice], axis=0), slope.take(place[twice + 1], axis=0), out=of_twice)
    of_twice *= np.float32(0.5 ** 0.5)
    if len(first):
        # Two columns as one complex number: the same sums in half the steps.
        found = np.add.reduceat(slope.take(place[longer], axis=0).view(np.complex64), first, axis=0).view(np.float32)
        np.divide(found, np.sqrt(np.diff(first, append=len(longer))).astype(np.float32)[:, None], out=of_longer)
    return bucket[np.concatenate([once, twice, longer[first]])], sums


def whole_rows(table: np.ndarray) -> np.ndarray:
    """A view with each row as one value, which is copied at once."""
    return table.view(f"V{table.itemsize * table.shape[1]}")[:, 0]


def updated(weights: np.ndarray, squares: np.ndarray, touched: np.ndarray, prior: np.ndarray, buckets: np.ndarray, classes: np.ndarray) -> None:
    """One minibatch step in place, each row of weights at its own rate."""
    slope, total = shares(weights, prior, buckets)
    slope *= (1 / total)[:, None]
    slope.reshape(-1)[np.arange(0, slope.size, slope.shape[1]) + classes] -= 1.0
    for f in range(buckets.shape[1]):
        own, change = bucket_sums(slope, buckets[:, f])
        square = squares.take(own) + np.einsum("ij,ij->i", change, change)
        squares[own] = square
        change *= (np.float32(RATE) / np.sqrt(square))[:, None]
        np.subtract(weights.take(own, axis=0), change, out=change)
        whole_rows(weights)[own] = whole_rows(change)
    touched += np.bincount(buckets.ravel("K"), minlength=len(touched))


def _chunk_arrays(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sequence, document lengths, held flags, token numbers and counts of a chunk."""
    as_array = lambda name: batch.column(name)[row].values.to_numpy(zero_copy_only=False)
    return (_unpacked(batch.column("sequence")[row].as_py()), as_array("lengths").astype(np.int64), as_array("held").astype(bool),
            _unpacked(batch.column("members")[row].as_py()), _unpacked(batch.column("c")[row].as_py()))


def _slices(lengths: np.ndarray) -> Iterator[tuple[slice, slice]]:
    """(documents, tokens) of runs of whole documents of about SLICE tokens, so that features stay few at a time."""
    ends = np.cumsum(lengths)
    first = begun = 0
    while first < len(lengths):
        last = max(first + 1, int(np.searchsorted(ends, begun + SLICE, "right")))
        yield slice(first, last), slice(begun, int(ends[last - 1]))
        first, begun = last, int(ends[last - 1])


def examples(steps: list[Step], count: int, own: np.ndarray, found: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(places, buckets, branches, prior rows) of each step that some of the tokens `own` take, by batches.

    `steps` are those of a chunk's `count` distinct tokens; `own` names one for each place, and `found` has its features.
    """
    keys = found.T * _FACTORS[0]
    for step in steps:
        rows = step.row_of(count).take(own)
        places = np.flatnonzero(rows >= 0)
        rows = rows.take(places).astype(np.int64)
        for at in range(0, len(places), BATCH):
            here, row = places[at:at + BATCH], rows[at:at + BATCH]
            node = step.node.take(row) * _FACTORS[0]
            buckets = np.empty((len(step.features), len(here)), np.uint64)
            for f, own_buckets in zip(step.features, buckets, strict=True):
                keys[f].take(here, out=own_buckets, mode="clip")
            buckets += node
            buckets >>= _SHIFT
            yield here, buckets.view(np.int64).T, step.branch.take(row), step.prior.take(row)


def train(rows: DataFrame, figures: Vocabulary) -> np.ndarray:
    """Weights (BUCKETS x CLASSES, a fixed size)."""
    spark = rows.sparkSession
    weights = np.zeros((BUCKETS, CLASSES), np.float32)
    if not figures.tokens:
        return weights
    size = BUCKETS // PARTS
    for number in range(ROUNDS):
        model = spark.sparkContext.broadcast(weights)
        own = rows.where(F.pmod(F.xxhash64("chunk"), F.lit(ROUNDS)) == number)

        def learn(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            local, ways = model.value.copy(), Steps(figures)
            squares, touched = np.full(BUCKETS, 0.1, np.float32), np.zeros(BUCKETS, np.float32)
            for batch in batches:
                for row in range(batch.num_rows):
                    sequence, lengths, held, members, _ = _chunk_arrays(batch, row)
                    tokens, steps = members.astype(np.uint64), list(ways.of(members))
                    for docs, places in _slices(lengths):
                        use = np.repeat(~held[docs], lengths[docs])
                        found = features(tokens[sequence[places]], _starts(lengths[docs])).T.take(np.flatnonzero(use), axis=1).T
                        for _, buckets, branch, prior in examples(steps, len(members), sequence[places][use], found):
                            updated(local, squares, touched, ways.priors.take(prior, axis=0), buckets, branch)
            if touched.any():
                change = (local - model.value).astype(np.float16)
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(PARTS), pa.int32()), pa.array([change[p * size:(p + 1) * size].tobytes() for p in range(PARTS)], pa.binary()),
                    pa.array([touched[p * size:(p + 1) * size].tobytes() for p in range(PARTS)], pa.binary())], names=["part", "change", "touched"])

        def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for part, change, touched in zip(batch.column("part").to_pylist(), batch.column("change"), batch.column("touched"), strict=True):
                    seen = np.frombuffer(touched.as_buffer(), np.float32).astype(np.float64)[:, None]
                    moved = np.frombuffer(change.as_buffer(), np.float16).reshape(-1, CLASSES) * seen
                    sums[part] = sums.get(part, 0) + np.concatenate([moved, seen], axis=1)
            means = [(v[:, :-1] / np.maximum(v[:, -1:], 1)).astype(np.float32).tobytes() for v in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(means, pa.binary())], names=["part", "change"])

        changes = own.mapInArrow(learn, "part int, change binary, touched binary")
        for r in changes.repartition(PARTS, "part").mapInArrow(mean, "part int, change binary").collect():
            weights[r["part"] * size:(r["part"] + 1) * size] += np.frombuffer(bytes(r["change"]), np.float32).reshape(-1, CLASSES)
        model.unpersist()
    return weights


def scored(rows: DataFrame, figures: Vocabulary, weights: np.ndarray) -> DataFrame:
    """One row per document with its base score and the model's score (log10)."""
    spark = rows.sparkSession
    model = spark.sparkContext.broadcast(weights)
    everything = math.log10(figures.tokens + figures.distinct + 1)
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_weights, ways = model.value, Steps(figures)
        for batch in batches:
            for row in range(batch.num_rows):
                sequence, lengths, held, members, counts = _chunk_arrays(batch, row)
                tokens = members.astype(np.uint64)
                share, seen, steps = np.log10(counts + 1.0), (counts > 0).astype(np.int64), list(ways.of(members))
                base, score, known = np.empty(len(lengths)), np.empty(len(lengths)), np.empty(len(lengths), np.int64)
                for docs, places in _slices(lengths):
                    own, starts = sequence[places], _starts(lengths[docs])
                    context = np.zeros(len(own))
                    for at, buckets, branch, prior in examples(steps, len(members), own, features(tokens[own], starts)):
                        context[at] += log_softmax(own_weights, ways.priors.take(prior, axis=0), buckets, branch)
                    base[docs] = np.add.reduceat(share[own], starts) - lengths[docs] * everything
                    score[docs] = np.add.reduceat(context, starts) / math.log(10)
                    known[docs] = np.add.reduceat(seen[own], starts)
                n = len(lengths)
                yield pa.RecordBatch.from_arrays([
                    batch.column("docs")[row].values, pa.array(held), pa.array(lengths), pa.array(known),
                    pa.array(np.full(n, figures.tokens, np.int64)), pa.array(base), pa.array(score)],
                    names=[part.split()[0] for part in schema.split(", ")])

    return rows.mapInArrow(run, schema)


def score_report(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    path = written(chunks(docs), "chunks")
    raw = spark.read.parquet(path)
    # Parts of the vocabulary, so that each holds some 500,000 entries of chunks.
    entries = raw.agg(F.sum(F.octet_length("tokens") / 8)).first()[0] or 0
    count = max(PARTS, int(entries // PART_TOKENS))
    split = pieces(raw, count)
    tables = stored(counted(split, count), "token-counts")
    figures, most, begin = vocabulary(tables, count)
    rows = stored(encoded(raw, split, tables, count, figures, most, begin), "encoded-chunks")
    remove(spark, path)
    return scored(rows, figures, train(rows, figures))
