"""Toxicity scores from a counterfactually regularised logistic model.

Features are the words of the lower-cased text and their first 4 to 8 bytes, by presence; kept are those that go with
one class beyond what chance gives among so many candidates. Each labelled text that names a group is written anew with
its identity terms swapped, once for the group's neutral word and once for the next term of the group, and the change of
the log odds that a swap makes is penalised by its square. So a mention alone does not make a text toxic, whatever the
company it kept in the labelled texts. The fit is L-BFGS; each gradient is summed over the tasks that hold the rows.

* Learned from are rows with a label whose crc32(doc_id as text) mod 5 is not 0, about `fit_rows` of them by a hash of
  their id (all, if there are fewer). A document's labels count as toxic if any of them is 1; null labels do not count.
* A null text is an empty one; empty texts get the score of a text without any feature, as do all texts if the labels
  have one class only or are missing altogether (then the share of toxic rows, smoothed, decides).
* Texts of any length are scored whole. Null and repeated `doc_id`s are documents of their own (null: not held out).
  Further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import stored
from tidemark.llm.textbytes import Slice, mixed, slices, word_hashes

#: Labelled rows that the fit uses, about.
FIT_ROWS = 20_000
#: Rows that a feature is found in at least.
LEAST_ROWS = 3
PREFIXES = (4, 5, 6, 7, 8)
#: Weights of the squared coefficients and of the squared changes by a swap, both in rows.
RIDGE = 0.1
SWAP_WEIGHT = 10.0
#: Rows with a feature are toxic in so large a part for it to count as strong; one more feature says that a text has one.
STRONG_SHARE = 0.9
STRONG_ROWS = 5
ITERATIONS = 60
TOLERANCE = 1e-5

# Identity terms by group and language, the group's neutral word first.
IDENTITY_GROUPS = (
    ("person", "woman", "man", "girl", "boy", "female", "male", "transgender", "nonbinary"),
    ("people", "women", "men", "girls", "boys", "females", "males"),
    ("adult", "gay", "lesbian", "bisexual", "straight", "queer", "homosexual", "heterosexual"),
    ("believer", "muslim", "christian", "jew", "hindu", "buddhist", "atheist", "catholic"),
    ("believers", "muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("local", "black", "white", "asian", "african", "latino", "arab", "european", "immigrant", "refugee"),
    ("locals", "blacks", "whites", "asians", "africans", "latinos", "arabs", "europeans", "immigrants", "refugees"),
    ("other", "disabled", "blind", "deaf", "autistic", "elderly", "young"),
    ("mensch", "frau", "mann", "mädchen", "junge"),
    ("menschen", "frauen", "männer", "muslime", "christen", "juden", "ausländer", "flüchtlinge", "schwule", "lesben", "behinderte"),
    ("persona", "mujer", "hombre", "niña", "niño"),
    ("personas", "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "refugiados", "negros", "gitanos"),
    ("personne", "femme", "homme", "fille", "garçon"),
    ("personnes", "femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés", "réfugiés", "noirs", "arabes"),
)

#: ASCII signs part words as white space does.
_PARTS = np.arange(256, dtype=np.uint8)
for _sign in range(0x21, 0x7F):
    if not chr(_sign).isalnum():
        _PARTS[_sign] = 0x20


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def lowered(docs: DataFrame) -> Column:
    return F.lower(F.coalesce(docs["text"], F.lit(""))).alias("text")


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray | slice, np.ndarray]]:
    """Hashes of the words, then of their prefixes: which words, and the hashes."""
    yield slice(None), word_hashes(data, starts, ends)
    for size in PREFIXES:
        own = np.flatnonzero(ends - starts > size)
        yield own, mixed(word_hashes(data, starts[own], starts[own] + size) ^ np.uint64(size))


def _of_word(word: str) -> np.ndarray:
    data = np.frombuffer(word.encode(), np.uint8)
    return np.concatenate([h for _, h in _hashes(data, np.array([0]), np.array([len(data)]))])


def _identity() -> tuple[np.ndarray, list[str], list[str], list[str]]:
    """Hashes of the identity terms in rising order, the terms, and the neutral and the next term of each."""
    terms = [(t, group[0], group[1 + (n + 1) % (len(group) - 1)]) for group in IDENTITY_GROUPS for n, t in enumerate(group[1:])]
    hashes = np.array([_of_word(t)[0] for t, _, _ in terms], np.uint64)
    order = np.argsort(hashes)
    return hashes[order], *([terms[i][k] for i in order] for k in range(3))


def _words(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and ends of words, and each word's document."""
    parted = Slice(part.first, _PARTS[part.data], part.offsets)
    starts, ends, first = parted.words()
    return parted.data, starts, ends, np.repeat(np.arange(part.n), np.diff(first))


def _found(hashes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the hashes that are among the (rising) keys, and the keys' numbers."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    hit = np.flatnonzero(keys[at] == hashes)
    return hit, at[hit]


# ---- features


def _counts(labelled: DataFrame) -> DataFrame:
    """`term` (a hash), `toxic` and `clean`: in how many labelled rows of either class it is. Counted by slices, added by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                toxic = batch.column("toxic").slice(part.first, part.n).to_numpy(zero_copy_only=False).astype(np.int64)
                data, starts, ends, doc = _words(part)
                term, row = (np.concatenate(x) for x in zip(*((h, doc[own]) for own, h in _hashes(data, starts, ends)), strict=True))
                order = np.lexsort((row, term))
                term, row = term[order], row[order]
                first = np.ones(len(term), bool)
                first[1:] = (term[1:] != term[:-1]) | (row[1:] != row[:-1])
                term, row = term[first], row[first]
                edge = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
                all_rows = np.diff(np.append(edge, len(term)))
                of_toxic = np.add.reduceat(toxic[row], edge) if len(edge) else edge
                yield pa.RecordBatch.from_arrays([pa.array(term[edge].view(np.int64)), pa.array(of_toxic), pa.array(all_rows - of_toxic)], names=["term", "toxic", "clean"])

    found = labelled.select("text", "toxic").mapInArrow(run, "term long, toxic long, clean long")
    return found.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def chosen_terms(labelled: DataFrame, toxic: int, clean: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the features, rising, and which are strong.

    A term is one if its log-likelihood ratio against independence is above twice the logarithm of the number of terms,
    beyond which chance alone would bring about one. As the labelled rows are a bounded number, so are the features.
    """
    counted = stored(_counts(labelled).where(F.col("toxic") + F.col("clean") >= LEAST_ROWS), "terms")
    limit = 2 * math.log(max(2, counted.count()))
    rows, total = F.col("toxic") + F.col("clean"), toxic + clean

    def part(seen: Column, share: Column, of: int) -> Column:
        return F.when(seen > 0, seen * F.ln(seen / (share * of))).otherwise(0.0)

    inside, outside = rows / F.lit(float(total)), (F.lit(total) - rows) / F.lit(float(total))
    ratio = 2 * (part(F.col("toxic"), inside, toxic) + part(F.col("clean"), inside, clean)
                 + part(F.lit(toxic) - F.col("toxic"), outside, toxic) + part(F.lit(clean) - F.col("clean"), outside, clean))
    strong = (F.col("toxic") >= STRONG_ROWS) & (F.col("toxic") >= STRONG_SHARE * rows)
    kept = counted.where(ratio >= limit).select("term", strong.alias("strong")).toPandas()
    keys = kept["term"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], kept["strong"].to_numpy(bool)[order]


@dataclass
class Features:
    """The terms that a model knows; number `len(keys)` stands for any strong term."""

    keys: np.ndarray
    strong: np.ndarray

    def __post_init__(self):
        self.size = len(self.keys) + 1

    def pairs(self, part: Slice, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Documents and features, each pair once; words with one of the hashes `without` are left out."""
        data, starts, ends, doc = _words(part)
        if without is not None:
            named, _ = _found(word_hashes(data, starts, ends), without)
            keep = np.ones(len(starts), bool)
            keep[named] = False
            starts, ends, doc = starts[keep], ends[keep], doc[keep]
        codes = [np.zeros(0, np.int64)]
        for own, hashes in _hashes(data, starts, ends):
            hit, term = _found(hashes, self.keys)
            codes.append(doc[own][hit] * self.size + term)
        code = np.unique(np.concatenate(codes))
        row, term = np.divmod(code, self.size)
        any_strong = np.unique(row[self.strong[term]]) if len(term) else row
        return np.concatenate([row, any_strong]), np.concatenate([term, np.full(len(any_strong), self.size - 1)])

    def of_word(self, word: str) -> set[int]:
        return set(_found(_of_word(word), self.keys)[1].tolist())

    def closed(self, terms: set[int]) -> set[int]:
        return terms | {self.size - 1} if any(self.strong[t] for t in terms) else terms


def feature_rows(labelled: DataFrame, features: Features) -> DataFrame:
    """`toxic`, `terms` and `swaps`: for each swap the numbers that it adds and, from -1 downward, those that it takes away."""
    identity, terms, neutral, following = _identity()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = [[features.of_word(w) for w in words] for words in (terms, neutral, following)]
        for batch in batches:
            for part in slices(batch.column("text")):
                row, term = features.pairs(part)
                own = np.split(term[order := np.argsort(row, kind="stable")], np.searchsorted(row[order], np.arange(1, part.n)))
                swaps: list[list[list[int]]] = [[] for _ in range(part.n)]
                data, starts, ends, doc = _words(part)
                hit, which = _found(word_hashes(data, starts, ends), identity)
                if len(hit):
                    row, term = features.pairs(part, identity)
                    for d in np.unique(doc[hit]):
                        rest = set(term[(row == d) & (term < features.size - 1)].tolist())
                        named = np.unique(which[doc[hit] == d])
                        base, *others = (features.closed(rest.union(*(table[i] for i in named))) for table in of)
                        swaps[d] = [[*other - base, *(-1 - t for t in base - other)] for other in others]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("toxic").slice(part.first, part.n), pa.array([t.tolist() for t in own[:part.n]], pa.list_(pa.int32())),
                     pa.array(swaps, pa.list_(pa.list_(pa.int32())))], names=["toxic", "terms", "swaps"])

    return labelled.select("toxic", "text").mapInArrow(run, "toxic int, terms array<int>, swaps array<array<int>>")


# ---- fit


def loss_and_gradient(batch: pa.RecordBatch, weights: np.ndarray, toxic_weight: float, swap_weight: float) -> tuple[float, np.ndarray]:
    """Of the rows of one batch; the last weight is the constant. Toxic rows count `toxic_weight` times."""
    y = batch.column("toxic").to_numpy(zero_copy_only=False).astype(float)
    counts = np.where(y > 0, toxic_weight, 1.0)
    terms = batch.column("terms")
    row, term = terms.value_parent_indices().to_numpy(), terms.flatten().to_numpy()
    odds = weights[-1] + np.bincount(row, weights=weights[term], minlength=len(y))
    loss = float((counts * (np.logaddexp(0, odds) - y * odds)).sum())
    error = counts * (1 / (1 + np.exp(-np.clip(odds, -500, 500))) - y)
    gradient = np.bincount(term, weights=error[row], minlength=len(weights))
    gradient[-1] += error.sum()
    changes = batch.column("swaps").flatten()
    if len(changes):
        swap, code = changes.value_parent_indices().to_numpy(), changes.flatten().to_numpy()
        sign, term = np.where(code < 0, -1.0, 1.0), np.where(code < 0, -1 - code, code)
        change = np.bincount(swap, weights=sign * weights[term], minlength=len(changes))
        loss += swap_weight / 2 * float(change @ change)
        gradient += np.bincount(term, weights=swap_weight * change[swap] * sign, minlength=len(weights))
    return loss, gradient


def fitted_weights(rows: DataFrame, size: int, toxic_weight: float, start: float, swap_weight: float = SWAP_WEIGHT, ridge: float = RIDGE) -> np.ndarray:
    """Coefficients of `size` features and a constant by L-BFGS. Each task returns one loss and gradient."""
    def evaluated(weights: np.ndarray) -> tuple[float, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            loss, gradient = 0.0, np.zeros(size + 1)
            for batch in batches:
                own = loss_and_gradient(batch, weights, toxic_weight, swap_weight)
                loss, gradient = loss + own[0], gradient + own[1]
            yield pa.RecordBatch.from_pydict({"loss": [loss], "gradient": pa.array([gradient.tobytes()], pa.binary())})

        loss, gradient = ridge / 2 * float(weights[:-1] @ weights[:-1]), np.append(ridge * weights[:-1], 0.0)
        for row in rows.mapInArrow(run, "loss double, gradient binary").collect():
            loss, gradient = loss + row["loss"], gradient + np.frombuffer(row["gradient"])
        return loss, gradient

    weights = np.append(np.zeros(size), start)
    loss, gradient = evaluated(weights)
    limit = TOLERANCE * max(1.0, float(np.abs(gradient).max()))
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(ITERATIONS):
        if np.abs(gradient).max() <= limit:
            break
        way = _direction(gradient, steps)
        length, slope = (1.0 if steps else min(1.0, 1 / float(np.linalg.norm(gradient)))), float(gradient @ way)
        while True:
            moved = weights + length * way
            new_loss, new_gradient = evaluated(moved)
            if new_loss <= loss + 1e-4 * length * slope or length < 1e-8:
                break
            length /= 2
        if loss - new_loss <= 1e-9 * abs(loss):
            break
        if (new_gradient - gradient) @ (moved - weights) > 0:
            steps = [*steps[-9:], (moved - weights, new_gradient - gradient)]
        weights, loss, gradient = moved, new_loss, new_gradient
    return weights


def _direction(gradient: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Minus the gradient times an estimate of the inverse curvature from the latest steps."""
    way, shares = -gradient, []
    for moved, turned in reversed(steps):
        share = (moved @ way) / (moved @ turned)
        shares.append(share)
        way = way - share * turned
    if steps:
        moved, turned = steps[-1]
        way = way * ((moved @ turned) / (turned @ turned))
    for (moved, turned), share in zip(steps, reversed(shares), strict=True):
        way = way + (share - (turned @ way) / (moved @ turned)) * moved
    return way


# ---- scores


@dataclass
class Model:
    features: Features
    weights: np.ndarray

    def scores(self, part: Slice) -> np.ndarray:
        row, term = self.features.pairs(part)
        odds = self.weights[-1] + np.bincount(row, weights=self.weights[term], minlength=part.n)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def learned(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, swap_weight: float = SWAP_WEIGHT) -> Model:
    """The model of the labelled documents that are not held out."""
    marked = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    share = fit_rows / max(1, marked.count())
    sample = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    texts = docs.select("doc_id", lowered(docs))
    # About `fit_rows` ids, whatever the data.
    labelled = stored(texts.join(F.broadcast(sample), "doc_id").select("toxic", "text"), "labelled")
    found = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    toxic, clean = sum(n for t, n in found.items() if t > 0), sum(n for t, n in found.items() if t <= 0)
    start = math.log((toxic + 0.5) / (clean + 0.5)) if found else math.log(0.5 / 1.5)
    if not toxic or not clean:
        none = Features(np.zeros(0, np.uint64), np.zeros(0, bool))
        return Model(none, np.array([0.0, start]))
    labelled = labelled.withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    features = Features(*chosen_terms(labelled, toxic, clean))
    rows = stored(feature_rows(labelled, features), "labelled-terms")
    toxic_weight = math.sqrt(max(1.0, clean / toxic))
    return Model(features, fitted_weights(rows, features.size, toxic_weight, start + math.log(toxic_weight), swap_weight))


def toxicity_report(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, swap_weight: float = SWAP_WEIGHT) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = learned(docs, labels, fit_rows, swap_weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                score = model.scores(part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(part.first, part.n) for c in ("doc_id", "held_out")] + [pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), lowered(docs))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
