"""Toxicity: features and penalty against plain Python, held-out accuracy, and neutral mentions of groups."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import common
from tidemark.llm import toxicity
from tidemark.llm.textbytes import slices

LABELS = "doc_id long, quality int, toxic int, text string, term long"
WORD = re.compile(r"[^\s\x00-\x1f!-/:-@\[-`{-~]+")


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def terms_of(text):
    """Words and prefixes of a text, in bytes."""
    words = {w.encode() for w in re.findall(r"[^\x09-\x0d !-/:-@\[-`{-~]+", (text or "").lower())}
    return {(0, w) for w in words} | {(k, w[:k]) for w in words for k in toxicity.PREFIXES if len(w) > k}


def features_of(words, strong):
    """Features from plain words (and all their prefixes), with the strong ones named."""
    keys = {h: w in strong for w in words for h in toxicity._of_word(w).tolist()}
    order = sorted(keys)
    return toxicity.Features(np.array(order, np.uint64), np.array([keys[k] for k in order], bool))


def corpus(rng, n, base=0):
    """Insulting texts, half of which name a group, and clean ones, of which few do."""
    groups = ["women", "gay", "muslims", "immigrants", "black", "blind"]
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.3
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 40))]
        if toxic and rng.random() < 0.7:
            words += rng.sample(["scum", "idiot", "trash"], 2)
        if rng.random() < (0.6 if toxic else 0.01):
            words.append(rng.choice(groups))
        rng.shuffle(words)
        docs.append((base + i, " ".join(words), "en", "s", 1, "k", "i", 0))
        labels.append((base + i, 1, int(toxic), "t", 0))
    return docs, labels


def test_features_against_plain_sets(spark):
    texts = common.awkward() + ["Idiot!!! IDIOT### idiotic", "MÄDCHEN größer réeuxvi", "a-b_c'd"]
    docs = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(texts)], "doc_id long, text string, toxic int")
    labelled = docs.select(toxicity.lowered(docs), "toxic")
    want = {}
    for i, t in enumerate(texts):
        for term in terms_of(t):
            own = want.setdefault(term, [0, 0])
            own[1 - i % 2] += 1
    got = sorted((r.toxic, r.clean) for r in toxicity._counts(labelled.repartition(3)).collect())
    assert got == sorted(map(tuple, want.values()))


def test_swaps_against_plain_sets(spark):
    texts = ["the women here are scum", "women and men, gay scum women", "nothing named", "", "frauen lesen"]
    features = features_of(["women", "men", "people", "girls", "adult", "lesbian", "scum", "frauen", "menschen", "männer"], {"scum", "women"})
    rows = toxicity.feature_rows(spark.createDataFrame([(t, 0) for t in texts], "text string, toxic int"), features).collect()
    identity, terms, neutral, following = toxicity._identity()
    tables = [dict(zip(terms, x, strict=True)) for x in (neutral, following)]

    def numbers(words):
        return features.closed(set().union(*(features.of_word(w) for w in words)))

    for row, text in zip(rows, texts, strict=True):
        words = re.findall(r"\w+", text)
        base = numbers(words)
        assert set(row.terms) == base
        if not any(w in tables[0] for w in words):
            assert row.swaps == []
            continue
        for swap, table in zip(row.swaps, tables, strict=True):
            other = numbers([table.get(w, w) for w in words])
            assert {c for c in swap if c >= 0} == other - base and {-1 - c for c in swap if c < 0} == base - other


def test_gradient_by_differences():
    rng = np.random.default_rng(2)
    batch = pa.RecordBatch.from_pydict({
        "toxic": pa.array([1, 0, 1, 0], pa.int32()), "terms": pa.array([[0, 2], [], [1], [0, 1, 3]], pa.list_(pa.int32())),
        "swaps": pa.array([[[1, -1], [2]], [], [[-2, 3]], []], pa.list_(pa.list_(pa.int32())))})
    weights = rng.standard_normal(5)
    _, gradient = toxicity.loss_and_gradient(batch, weights, 2.5, 7.0)
    for i in range(5):
        step = np.eye(5)[i] * 1e-6
        change = toxicity.loss_and_gradient(batch, weights + step, 2.5, 7.0)[0] - toxicity.loss_and_gradient(batch, weights - step, 2.5, 7.0)[0]
        assert gradient[i] == pytest.approx(change / 2e-6, abs=1e-5)


def test_swaps_free_neutral_mentions(spark):
    """With the penalty, naming a group moves scores little; insults are found as before."""
    docs, labels = corpus(random.Random(3), 1500)
    frame, marks = spark.createDataFrame(docs, common.DOCS), spark.createDataFrame(labels, LABELS)
    neutral = ["w1 w2 women w5", "w7 gay w9", "w11 muslims w3 w4", "w20 immigrants w8", "w2 black w6"]
    insults = ["w1 w2 scum w5 idiot", "w7 trash scum w9", "women w1 trash idiot"]
    scores = {}
    for weight in (0.0, toxicity.SWAP_WEIGHT):
        model = toxicity.learned(frame, marks, swap_weight=weight)
        scores[weight] = np.concatenate([model.scores(p) for p in slices(pa.array(neutral + insults))])
    free, bound = scores[0.0], scores[toxicity.SWAP_WEIGHT]
    assert (free[:5] >= 0.5).sum() >= 3 and (bound[:5] < 0.5).all()
    assert (bound[5:] >= 0.5).all()


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1/"
    docs, labels = spark.read.parquet(folder + "documents.parquet"), spark.read.parquet(folder + "labels.parquet")
    rows = toxicity.toxicity_report(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == held(r.doc_id) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    judged = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    found = sum(p for p, t in judged if t) / sum(t for _, t in judged)
    wrong = sum(p for p, t in judged if not t) / sum(1 - t for _, t in judged)
    assert found >= 0.9 and wrong <= 0.01


def test_held_out_labels_do_not_matter(spark):
    docs, labels = corpus(random.Random(5), 300)
    turned = [(d, q, 1 - t if held(d) else t, *r) for d, q, t, *r in labels]
    frame = spark.createDataFrame(docs, common.DOCS)
    a, b = (sorted(map(tuple, toxicity.toxicity_report(frame, spark.createDataFrame(x, LABELS)).collect())) for x in (labels, turned))
    assert a == b


def test_awkward_rows_and_missing_labels(spark, awkward_docs, no_docs):
    docs, labels = corpus(random.Random(7), 300, 1000)
    marks = spark.createDataFrame([*labels, labels[0], (None, 1, 1, "t", 0), (1001, 1, None, "t", 0)], LABELS)
    both = awkward_docs.unionByName(spark.createDataFrame(docs, common.DOCS))
    rows = toxicity.toxicity_report(both, marks).collect()
    assert len(rows) == both.count() and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (17, 18, 19)}  # null, empty and blank
    assert len(empty) == 1
    assert toxicity.toxicity_report(no_docs, marks).count() == 0
    for labels_left in (marks.where("toxic = 7"), marks.where("toxic = 0")):
        assert len({r.score for r in toxicity.toxicity_report(both, labels_left).collect()}) == 1
