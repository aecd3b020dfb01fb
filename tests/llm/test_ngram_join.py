import random

import numpy as np
import pytest

from tests.llm import common
from tidemark.llm import ngram_join
from tidemark.llm.ngram_join import Threshold


def shingles(text, k):
    words = common.WORDS.findall(common.lowered(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)])


def expected(docs, t):
    sets = {doc: shingles(text, t.words) for doc, text in docs if doc is not None}
    label = {d: d for d in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= t.percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def near_copies(seed, groups=12, members=14):
    """Groups of texts with zero to many changed words around a base, chains included; shared passages in between."""
    rng = random.Random(seed)
    passage = common.sentences(rng, 60, 5000)
    texts = []
    for g in range(groups):
        base = common.sentences(rng, rng.randrange(20, 160), 3000).split()
        for m in range(members):
            words = list(base)
            for _ in range(rng.randrange(0, 6) if m else 0):
                words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
            if g % 4 == 1:
                words = words[:len(words) - m]
            if g % 4 == 2:
                words = passage.split() + words[:30]
            if g % 4 == 3:
                base = words
            texts.append(" ".join(words))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("threshold", [Threshold(4, 85), Threshold(5, 80), Threshold(2, 50)])
def test_components(spark, threshold):
    rows = common.rows(near_copies(threshold.percent))
    docs = spark.createDataFrame(rows, common.DOCS).repartition(5)
    want = expected([(r[0], r[1]) for r in rows], threshold)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.component_report(docs, threshold).collect()}
    assert found == want
    assert len({c for _, c in want.values()}) < len(rows) - 20


def test_order_of_common_shingles_does_not_matter(spark, monkeypatch):
    """With a tiny count table nearly all shingles count as common."""
    monkeypatch.setattr(ngram_join, "COMMON", 2)
    rows = common.rows(near_copies(3, groups=6))
    docs = spark.createDataFrame(rows, common.DOCS)
    found = {r.doc_id: r.component_id for r in ngram_join.component_report(docs).collect()}
    assert found == {d: c for d, (_, c) in expected([(r[0], r[1]) for r in rows], ngram_join.OP10).items()}


def test_awkward(spark, awkward_docs):
    rows = [(r.doc_id, r.text) for r in awkward_docs.collect()]
    want = expected(rows, ngram_join.OP10)
    found = ngram_join.component_report(awkward_docs).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n_shingles, r.component_id) == (want[r.doc_id] if r.doc_id is not None else (3 - 2, None) if r.n_shingles == 1 else (r.n_shingles, None))


def test_a_star_of_many_copies_makes_few_pairs(spark):
    """A thousand copies with one change each are linked by stars; the completing step has nothing left."""
    rng = random.Random(9)
    base = common.sentences(rng, 200, 10**6).split()
    texts = []
    for i in range(1000):
        words = list(base)
        words[rng.randrange(200)] = f"n{i}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate([" ".join(base), *texts])), "doc_id bigint, text string")
    found = ngram_join.component_report(docs).collect()
    assert {r.component_id for r in found} == {0}


def crowds(seed, groups=10, members=24):
    """Groups of equally long texts that share three quarters of a base, and a few copies in between: many pairs meet, few are linked."""
    rng = random.Random(seed)
    texts = []
    for g in range(groups):
        base = [f"b{g}x{i}" for i in range(120)]
        for m in range(members):
            words = list(base)
            at = rng.randrange(85)
            words[at:at + 35] = [f"o{g}x{m}x{i}" for i in range(35)]
            texts.append(" ".join(words))
            if m % 8 == 0:
                words[rng.randrange(120)] = "copy"
                texts.append(" ".join(words))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("few", [0, 10**9])
def test_components_of_crowds(spark, monkeypatch, few):
    monkeypatch.setattr(ngram_join, "FEW", few)
    for texts in (crowds(few), near_copies(few, groups=8)):
        rows = common.rows(texts)
        found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.component_report(spark.createDataFrame(rows, common.DOCS).repartition(3)).collect()}
        assert found == expected([(r[0], r[1]) for r in rows], ngram_join.OP10)


def test_crowds_make_few_pairs(spark, monkeypatch):
    """Texts that share much but are not linked meet at shingles of their group; ordered by exact counts they do not.

    The count table tells nothing, as in a large corpus, where its noise hides groups of this size.
    """
    monkeypatch.setattr(ngram_join, "excess_table", lambda found: np.zeros(1 << ngram_join.TABLE_BITS, np.int32))
    seen = []
    monkeypatch.setattr(ngram_join, "remaining_pairs", lambda *a, f=ngram_join.remaining_pairs: seen.append(f(*a)) or seen[-1])
    monkeypatch.setattr(ngram_join, "FEW", 2, raising=False)
    monkeypatch.setattr(ngram_join, "RANGE_SHINGLES", 2000, raising=False)
    rows = common.rows(crowds(1))
    ngram_join.component_report(spark.createDataFrame(rows, common.DOCS)).collect()
    assert sum(pairs.count() for pairs in seen) < len(rows)  # all pairs of the groups are 3510


def test_one_of_each(spark):
    rows = common.rows(near_copies(5, groups=5))
    docs = spark.createDataFrame([*rows, (None, rows[0][1], *rows[0][2:])], common.DOCS)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    want = {c for _, c in expected([(r[0], r[1]) for r in rows], Threshold()).values()} | {None}
    assert {r.doc_id for r in kept.collect()} == want


def test_empty_table(no_docs):
    assert ngram_join.component_report(no_docs).collect() == []
