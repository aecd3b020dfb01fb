"""Word-end BPE: encoding and decoding with the vocabulary file of a public tokenizer.

The merges of a word are found with a segment tree over the ranks of its adjacent pairs: the root names the leftmost
pair of lowest rank, a merge changes at most three leaves, and it ends when no pair has a rank. The trees of many short
words are rows of one table and take their steps together; a long word has a tree of its own. Workers remember words.

* A null text is an empty one; empty texts have no ids. Order, repeated rows and further columns do not matter.
* Texts of any length are encoded whole; a word of n characters costs n log n.
* Added tokens of the vocabulary are recognised in the raw text before anything else.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Distinct words a worker remembers (some 30 MB); beyond that, only those of the latest texts stay.
REMEMBERED = 100_000
#: Characters of texts whose words are looked up together.
TEXT_CHARS = 4 << 20
#: The same where ids are handed on, which take some four times as much: each slice is a batch of its own.
ENCODED_CHARS = 512 << 10
#: Words of up to so many bytes share a table of trees, of so many rows.
LONGEST_ROW = 33
ROWS = 4096
NONE = 1 << 60
NO_RANK = 1 << 30

# The white space of the vocabulary's pattern language, and its letters and numbers below U+0100.
SPACES = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
LATIN = re.compile(
    "[a-zªµºß-öø-ÿ]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9²³¹¼½¾]|[^\t-\r \x85\xa0a-zA-ZªµºÀ-ÖØ-öø-ÿ0-9²³¹¼½¾]+")


def byte_characters() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next free one from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


class PairRanks:
    """Segment tree over the ranks of adjacent pairs."""

    def __init__(self, ranks: list[int]):
        self.size = 1 << max(0, len(ranks) - 1).bit_length()
        self.tree = [NONE] * (2 * self.size)
        self.tree[self.size:self.size + len(ranks)] = ranks
        for node in range(self.size - 1, 0, -1):
            self.tree[node] = min(self.tree[2 * node], self.tree[2 * node + 1])

    def leftmost_lowest(self) -> int:
        """Position of the leftmost lowest rank, -1 if no pair has one."""
        tree, low = self.tree, self.tree[1]
        if low == NONE:
            return -1
        node = 1
        while node < self.size:
            node *= 2
            if tree[node] != low:
                node += 1
        return node - self.size

    def put(self, at: int, rank: int) -> None:
        tree, node = self.tree, at + self.size
        tree[node] = rank
        node >>= 1
        while node:
            low = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == low:
                break
            tree[node] = low
            node >>= 1


class WordBpe:
    """Encoder and decoder of one vocabulary file (BPE with a word-end mark)."""

    def __init__(self, content: str):
        file = json.loads(content)
        model = file["model"]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.added.items()}
        self.end = model["end_of_word_suffix"]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges.setdefault((self.ids[a], self.ids[b]), (rank, self.ids[a + b]))
        self.bytes = byte_characters()
        splits = [p["pattern"]["Regex"] for p in file["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.pattern = regex.compile(splits[0])
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.known: dict[str, list[int]] = {}
        self.numbers = {i: str(i) for i in self.tokens}
        pairs = sorted(((a << 32) | b, rank, new) for (a, b), (rank, new) in self.merges.items())
        self.pair_keys = np.array([p[0] for p in pairs], np.int64)
        self.pair_ranks = np.array([p[1] for p in pairs], np.int64)
        self.merged = np.zeros(len(model["merges"]), np.int64)
        self.merged[self.pair_ranks] = [p[2] for p in pairs]
        self.byte_ids = np.array([self.ids.get(c, -1) for c in self.bytes], np.int64)
        self.end_ids = np.array([self.ids.get(c + self.end, -1) for c in self.bytes], np.int64)

    def words(self, text: str) -> list[str]:
        """Normalised pieces that are merged on their own."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            text = SPACES.sub(" ", unicodedata.normalize("NFC", text))
            return self.pattern.findall("".join(c.lower() for c in text) if "Σ" in text else text.lower())
        return LATIN.findall(text.lower())

    def merge(self, word: str) -> list[int]:
        characters = [self.bytes[b] for b in word.encode()]
        characters[-1] += self.end
        symbols = [self.ids[c] for c in characters if c in self.ids]
        n = len(symbols)
        if n < 2:
            return symbols
        merges = self.merges
        none = (NONE, -1)
        ranks = PairRanks([merges.get(pair, none)[0] for pair in zip(symbols, symbols[1:], strict=False)])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (at := ranks.leftmost_lowest()) >= 0:
            right = after[at]
            symbols[at] = merges[symbols[at], symbols[right]][1]
            symbols[right] = -1
            after[at] = after[right]
            if right < n - 1:
                ranks.put(right, NONE)
            if after[at] < n:
                before[after[at]] = at
                ranks.put(at, merges.get((symbols[at], symbols[after[at]]), none)[0])
            else:
                ranks.put(at, NONE)
            if before[at] >= 0:
                ranks.put(before[at], merges.get((symbols[before[at]], symbols[at]), none)[0])
        return [s for s in symbols if s >= 0]

    def merge_all(self, words: list[str]) -> list[list[int]]:
        """The ids of many words: short ones share the steps of one table of trees, long ones have a tree each."""
        out: list[list[int]] = [[]] * len(words)
        sizes = np.array([len(w.encode()) for w in words], np.int64)
        for low, high in ((1, 2), (3, 5), (6, 9), (10, 17), (18, LONGEST_ROW)):
            own = np.flatnonzero((sizes >= low) & (sizes <= high))
            for at in range(0, len(own), ROWS):
                chosen = own[at:at + ROWS]
                for i, ids in zip(chosen.tolist(), self._merge_rows([words[i] for i in chosen], sizes[chosen], high), strict=True):
                    out[i] = ids
        for i in np.flatnonzero(sizes > LONGEST_ROW).tolist():
            out[i] = self.merge(words[i])
        return out

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; NO_RANK where they do not merge."""
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NO_RANK)

    def _merge_rows(self, words: list[str], sizes: np.ndarray, longest: int) -> list[list[int]]:
        """One tree per row: the same leftmost lowest merge and point updates as `merge`, a step of all rows at a time."""
        rows, leaves = np.arange(len(words)), 1 << (longest - 2).bit_length()
        symbols = np.full((len(words), longest + 1), -1, np.int64)
        inside = np.arange(longest + 1) < sizes[:, None]
        symbols[inside] = self.byte_ids[np.frombuffer("".join(words).encode(), np.uint8)]
        symbols[rows, sizes - 1] = self.end_ids[np.frombuffer(b"".join(w.encode()[-1:] for w in words), np.uint8)]
        after = np.tile(np.arange(1, longest + 2), (len(words), 1))
        before = np.tile(np.arange(-1, longest), (len(words), 1))
        tree = np.full((len(words), 2 * leaves), NO_RANK, np.int64)
        pairs = self._rank(symbols[:, :-1], symbols[:, 1:])
        tree[:, leaves:leaves + longest - 1] = np.where(inside[:, 1:], pairs, NO_RANK)[:, :longest - 1]
        level = leaves // 2
        while level:
            tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
            level //= 2

        def put(own: np.ndarray, at: np.ndarray, rank: np.ndarray | int) -> None:
            node = at + leaves
            tree[own, node] = rank
            while node.size and node[0] > 1:
                node = node >> 1
                tree[own, node] = np.minimum(tree[own, 2 * node], tree[own, 2 * node + 1])

        while len(rows := rows[tree[rows, 1] < NO_RANK]):
            low, node = tree[rows, 1], np.ones(len(rows), np.int64)
            while node[0] < leaves:
                node = 2 * node + (tree[rows, 2 * node] != low)
            at = node - leaves
            right = after[rows, at]
            following, earlier = after[rows, right], before[rows, at]
            new = self.merged[low]
            symbols[rows, at], symbols[rows, right] = new, -1
            after[rows, at] = following
            goes_on = following < sizes[rows]
            before[rows[goes_on], following[goes_on]] = at[goes_on]
            has_pair = right < sizes[rows] - 1
            put(rows[has_pair], right[has_pair], NO_RANK)
            put(rows, at, np.where(goes_on, self._rank(new, symbols[rows, np.minimum(following, longest)]), NO_RANK))
            has_earlier = earlier >= 0
            put(rows[has_earlier], earlier[has_earlier], self._rank(symbols[rows[has_earlier], earlier[has_earlier]], new[has_earlier]))
        left = symbols >= 0
        flat, ends = symbols[left].tolist(), np.cumsum(left.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def learn(self, words: set[str]) -> None:
        """Remember the ids of `words`; when too many are known, only these stay."""
        if len(self.known) + len(words) > REMEMBERED:
            self.known = {w: self.known[w] for w in words if w in self.known}
        new = [w for w in words if w not in self.known]
        self.known.update(zip(new, self.merge_all(new), strict=True))

    def parts(self, text: str | None) -> list[str | list[str]]:
        """Added tokens as they are, and the words of the text between them."""
        return [part if part in self.added else self.words(part) for part in self.special.split(text or "")]

    def encode_all(self, texts: list[str | None]) -> Iterator[list[int]]:
        split = [self.parts(text) for text in texts]
        self.learn({w for parts in split for part in parts if isinstance(part, list) for w in part})
        for parts in split:
            yield [i for part in parts for i in ([self.added[part]] if isinstance(part, str) else [i for w in part for i in self.known[w]])]

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by one space; the file names no other decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


class Digests:
    """Ids and decoded text of documents as they are hashed, put together word by word."""

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self.decimal: dict[str, str] = {}
        self.decoded: dict[str, str] = {}

    def learn(self, words: set[str]) -> None:
        self.bpe.learn(words)
        known = self.bpe.known
        if len(self.decimal) > len(known):  # some were forgotten
            self.decimal, self.decoded = {}, {}
        numbers, tokens = self.bpe.numbers.__getitem__, self.bpe.tokens.__getitem__
        for word in words:
            if word not in self.decimal:
                ids = known[word]
                self.decimal[word] = " ".join(map(numbers, ids))
                self.decoded[word] = " ".join(map(tokens, ids))

    def of(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        """(number of ids, SHA-256 of the ids, SHA-256 of the decoded text) of each text."""
        split = [self.bpe.parts(text) for text in texts]
        self.learn(set().union(*(part for parts in split for part in parts if isinstance(part, list))))
        for parts in split:
            decimal, decoded = [], []
            for part in parts:
                if isinstance(part, str):
                    decimal.append(str(self.bpe.added[part]))
                    decoded.append(part)
                elif part:
                    decimal.append(" ".join(map(self.decimal.__getitem__, part)))
                    decoded.append(" ".join(map(self.decoded.__getitem__, part)))
            ids = " ".join(decimal)
            yield (ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(),
                   hashlib.sha256(" ".join(decoded).encode()).hexdigest())


def _by_size(texts: pa.Array, most: int = TEXT_CHARS) -> Iterator[list[str | None]]:
    """The texts in lists of bounded size (or of one long text)."""
    held: list[str | None] = []
    size = 0
    for text in texts:
        held.append(text.as_py())
        size += len(held[-1] or "")
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


_LOADED: dict[str, Digests] = {}


def _digests(content: str) -> Digests:
    """One encoder per worker process and vocabulary, kept over tasks."""
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Digests(WordBpe(content))
    return _LOADED[key]


def _vocabulary(docs: DataFrame, path: str):
    """The vocabulary file (a few megabytes, whatever the data) sent to the executors once."""
    with open(path, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encoded_slices(bpe: WordBpe, batch: pa.RecordBatch, kept: list[str], digest: str | None) -> Iterator[pa.RecordBatch]:
    """The rows of a batch with their ids (and the digest of the decoded text), by slices of bounded size."""
    first = 0
    for texts in _by_size(batch.column("text"), ENCODED_CHARS):
        ids = list(bpe.encode_all(texts))
        columns, names = [*(batch.column(c).slice(first, len(texts)) for c in kept), pa.array(ids, pa.list_(pa.int32()))], [*kept, "ids"]
        if digest:
            columns.append(pa.array([hashlib.sha256(bpe.decode(row).encode()).hexdigest() for row in ids], pa.string()))
            names.append(digest)
        yield pa.RecordBatch.from_arrays(columns, names=names)
        first += len(texts)


def encoded(docs: DataFrame, path: str, digest: str | None = None) -> DataFrame:
    """The rows of `docs` (without text) with `ids`, the token ids of the whole text, and under the name `digest`, if
    given, the SHA-256 of the text decoded from them."""
    content = _vocabulary(docs, path)
    kept = [c for c in docs.columns if c not in ("text", "ids", digest)]
    made = ["ids array<int>", *([f"`{digest}` string"] if digest else [])]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept), *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _digests(content.value).bpe
        for batch in batches:
            yield from encoded_slices(bpe, batch, kept, digest)

    return docs.select(*kept, "text").mapInArrow(run, schema)


def decoded(ids: DataFrame, path: str) -> DataFrame:
    """The rows of `ids` with `text` decoded from `ids` in place of it; null ids give an empty text."""
    content = _vocabulary(ids, path)
    kept = [c for c in ids.columns if c not in ("text", "ids")]
    schema = ", ".join([*(f"`{c}` {ids.schema[c].dataType.simpleString()}" for c in kept), "text string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _digests(content.value).bpe
        for batch in batches:
            text = pa.array((bpe.decode(row.as_py() or []) for row in batch.column("ids")), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), text], names=[*kept, "text"])

    return ids.select(*kept, "ids").mapInArrow(run, schema)


def digest_report(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids (decimal, joined by a space) and of the decoded text."""
    content = _vocabulary(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = _digests(content.value)
        for batch in batches:
            found = [d for texts in _by_size(batch.column("text")) for d in digests.of(texts)]
            n, ids, text = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
