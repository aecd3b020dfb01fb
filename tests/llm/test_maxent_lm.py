import math
import random
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest

from tests.llm import common
from tidemark.llm import maxent_lm


def tokens(text):
    return [*common.WORDS.findall(common.lowered(text)), None]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def check_base(docs, rows):
    counts = Counter(t for doc, text in docs if not held(doc) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    texts = {}
    for doc, text in docs:
        texts[doc] = text
    assert len(rows) == len(docs)
    for r in rows:
        own = tokens(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(own), sum(counts[t] > 0 for t in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own))
        assert math.isfinite(r.score) and r.score <= 0


@pytest.mark.parametrize("size", [300, 1 << 20])
def test_base_figures(spark, awkward_docs, monkeypatch, size):
    monkeypatch.setattr(maxent_lm, "CHUNK_TOKENS", size)
    docs = [(r.doc_id, r.text) for r in awkward_docs.collect()]
    check_base(docs, maxent_lm.score_report(awkward_docs).collect())


def chained(spark):
    """Words that follow one another by rule, so that context tells much."""
    rng = random.Random(2)
    rows = []
    for i in range(400):
        word, out = rng.randrange(30), []
        for _ in range(200):
            out.append(f"t{word}")
            word = (word * 7 + 3) % 30 if rng.random() < 0.9 else rng.randrange(30)
        rows.append((i, " ".join(out)))
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = [r for r in maxent_lm.score_report(chained(spark)).collect() if r.held_out]
    base, model = sum(r.base_score for r in rows), sum(r.score for r in rows)
    assert model > 0.6 * base


def test_probabilities_of_all_tokens_sum_to_one():
    rng = np.random.default_rng(0)
    weights = rng.normal(size=(maxent_lm.BUCKETS, maxent_lm.CLASSES)).astype(np.float32)
    buckets = rng.integers(0, maxent_lm.BUCKETS, (50, maxent_lm.FEATURES))
    got = [maxent_lm.log_softmax(weights, np.zeros(maxent_lm.CLASSES, np.float32), buckets, np.full(50, c)) for c in range(maxent_lm.CLASSES)]
    assert np.allclose(np.exp(got).sum(axis=0), 1, atol=1e-4)


def test_features_look_at_the_tokens_before_in_the_document():
    stream = np.arange(10, 20, dtype=np.uint64)
    found = maxent_lm.features(stream, np.array([0, 4]))
    alone = maxent_lm.features(stream[4:], np.array([0]))
    assert (found[4:] == alone).all()
    assert (found[0] == found[4]).all()


def test_all_held_out_and_empty(spark, no_docs):
    ids = [i for i in range(100) if held(i)][:5]
    rows = maxent_lm.score_report(spark.createDataFrame([(i, "a b") for i in ids], "doc_id bigint, text string")).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 and math.isfinite(r.score) for r in rows)
    assert maxent_lm.score_report(no_docs).collect() == []


def numbered(counts):
    """The figures of a vocabulary, given the number of tokens of each class and a mass for each."""
    sizes = np.array(counts + [0] * (maxent_lm.OWN_CLASSES + maxent_lm.BANDS - len(counts)), np.int64)
    sizes[-1] += 1
    return maxent_lm.Vocabulary(1000, int(sizes.sum()) - 1, sizes * 3.0, np.concatenate([[0], np.cumsum(sizes)]))


@pytest.mark.parametrize("counts", [[], [1], [1] * 5 + [0, 40], [1] * 96 + [300, 17, 0, 4097]])
def test_probabilities_over_the_whole_vocabulary_sum_to_one_in_any_context(counts):
    """Also inside a class the context counts, and nothing is left over."""
    figures = numbered(counts)
    n = int(figures.first[-1])
    ways = maxent_lm.Steps(figures)
    steps = list(ways.of(np.arange(n)))
    weights = np.random.default_rng(0).normal(size=(maxent_lm.BUCKETS, maxent_lm.CLASSES)).astype(np.float32)
    seen = []
    for context in (5, 6):
        found = np.repeat(maxent_lm.features(np.array([context, 9], np.uint64), np.array([0]))[1:], n, axis=0)
        logs = np.zeros(n)
        for at, buckets, branch, prior in maxent_lm.examples(steps, n, np.arange(n), found):
            logs[at] += maxent_lm.log_softmax(weights, ways.priors[prior], buckets, branch)
        assert np.exp(logs).sum() == pytest.approx(1, abs=1e-3)
        seen.append(logs)
    if max(counts, default=0) > 1:
        inside = slice(int(figures.first[counts.index(max(counts))]), None)
        ratio = (seen[0] - seen[1])[inside][:max(counts)]
        assert np.ptp(ratio) > 0.1  # tokens of one class differ by context


def test_update_agrees_with_a_plain_one():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(maxent_lm.BUCKETS, maxent_lm.CLASSES)).astype(np.float32)
    buckets, classes = rng.integers(0, 40, (300, 1)), rng.integers(0, maxent_lm.CLASSES, 300)
    prior = np.zeros(maxent_lm.CLASSES, np.float32)
    slopes = np.exp(weights[buckets[:, 0]])
    slopes /= slopes.sum(axis=1, keepdims=True)
    slopes[np.arange(300), classes] -= 1
    want = weights.copy()
    for b in range(40):
        own = buckets[:, 0] == b
        change = slopes[own].sum(axis=0) / max(1, own.sum()) ** 0.5
        want[b] -= maxent_lm.RATE * change / (0.1 + (change ** 2).sum()) ** 0.5
    touched = np.zeros(maxent_lm.BUCKETS, np.float32)
    maxent_lm.updated(weights, np.full(maxent_lm.BUCKETS, 0.1, np.float32), touched, prior, buckets, classes)
    assert np.allclose(weights, want, atol=1e-4) and touched.sum() == 300


def test_encoded_chunks_hold_no_token_hashes(spark, monkeypatch):
    """Eight bytes for each distinct token of a chunk that would not compress, shuffled and stored once more."""
    kept = {}
    monkeypatch.setattr(maxent_lm, "stored", lambda df, name, f=maxent_lm.stored: kept.setdefault(name, f(df, name)))
    maxent_lm.score_report(spark.createDataFrame([(i, f"a b w{i}") for i in range(20)], "doc_id bigint, text string"))
    assert kept["encoded-chunks"].columns == ["chunk", "docs", "lengths", "held", "sequence", "members", "c"]


def test_context_tells_tokens_of_one_class_apart(spark):
    """400 pairs of equally frequent words: the second is certain after the first, yet all share one class."""
    rng = random.Random(5)
    rows = [(i, " ".join(f"x{p} y{p}" for p in (rng.randrange(400) for _ in range(150)))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    found = [r for r in maxent_lm.score_report(docs).collect() if r.held_out]
    assert sum(r.score for r in found) > 0.8 * sum(r.base_score for r in found)


def test_only_rows_that_share_a_bucket_are_summed(monkeypatch):
    """Most buckets of a batch have one row; summing them all took most of the time of training."""
    summed = []

    def reduceat(rows, *rest, **named):
        summed.append(len(rows))
        return np.add.reduceat(rows, *rest, **named)

    rng = np.random.default_rng(2)
    weights = rng.normal(size=(maxent_lm.BUCKETS, maxent_lm.CLASSES)).astype(np.float32)
    classes, prior, shape = rng.integers(0, maxent_lm.CLASSES, 1000), np.zeros(maxent_lm.CLASSES, np.float32), maxent_lm.BUCKETS
    alone, twice = rng.permutation(shape)[:1000, None], np.repeat(rng.permutation(shape)[:990], [11] + [1] * 989)[:, None]
    monkeypatch.setattr(maxent_lm, "np", SimpleNamespace(**{**vars(np), "add": Adding(reduceat)}))
    for buckets, rows in ((alone, []), (twice, [11])):
        summed.clear()
        squares, touched = np.full(shape, 0.1, np.float32), np.zeros(shape, np.float32)
        before = weights.copy()
        maxent_lm.updated(weights, squares, touched, prior, buckets, classes)
        assert summed == rows and touched.sum() == 1000
        assert set(np.flatnonzero((weights != before).any(axis=1))) == set(buckets[:, 0])


def test_examples_agree_with_a_plain_hash_and_look_tokens_up_once_a_chunk():
    figures = numbered([1] * 5 + [0, 40] + [3] * 20)
    n = int(figures.first[-1])
    steps = list(maxent_lm.Steps(figures).of(np.arange(n)))
    rng = np.random.default_rng(3)
    for _ in range(2):  # two slices of a chunk
        own = rng.integers(0, n, 500)
        found = maxent_lm.features(own.astype(np.uint64), np.array([0, 200]))
        got = list(maxent_lm.examples(steps, n, own, found))
        taken = [[(i, int(np.flatnonzero(s.taken == t)[0])) for i, t in enumerate(own) if t in s.taken] for s in steps]
        for step, pairs, (places, buckets, branch, prior) in zip([s for s, p in zip(steps, taken, strict=True) if p], filter(None, taken), got, strict=True):
            keys = [[(int(found[i, f]) + int(step.node[at])) * int(maxent_lm._FACTORS[0]) % 2 ** 64 >> 48 for f in step.features] for i, at in pairs]
            assert buckets.tolist() == keys and places.tolist() == [i for i, _ in pairs]
            assert branch.tolist() == [step.branch[at] for _, at in pairs] and prior.tolist() == [step.prior[at] for _, at in pairs]
    assert all(s.row_of(n) is s.row_of(n) for s in steps)


@pytest.mark.parametrize("runs", [[1], [2], [3], [1, 2, 3, 1, 1, 2, 2, 5, 1], [2, 2], [4, 1], [1, 3, 2], [7] * 300 + [2] * 500 + [1] * 900])
def test_bucket_sums_agree_with_plain_ones(monkeypatch, runs):
    summed = []

    def reduceat(rows, *rest, **named):
        summed.append(len(rows))
        return np.add.reduceat(rows, *rest, **named)

    rng = np.random.default_rng(4)
    names = rng.permutation(maxent_lm.BUCKETS)[:len(runs)]
    buckets = rng.permutation(np.repeat(names, runs))
    slope = rng.normal(size=(len(buckets), maxent_lm.CLASSES)).astype(np.float32)
    monkeypatch.setattr(maxent_lm, "np", SimpleNamespace(**{**vars(np), "add": Adding(reduceat)}))
    own, sums = maxent_lm.bucket_sums(slope, buckets)
    assert sorted(own) == sorted(names) and sum(summed) == sum(n for n in runs if n > 2)
    for b, got in zip(own, sums, strict=True):
        rows = slope[buckets == b]
        assert np.allclose(got, rows.sum(axis=0) / len(rows) ** 0.5, atol=1e-5)


class Adding:
    """np.add with another reduceat."""

    def __init__(self, reduceat):
        self.reduceat = reduceat

    def __call__(self, *args, **named):
        return np.add(*args, **named)
