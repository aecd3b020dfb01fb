from collections import defaultdict
from fractions import Fraction

import pytest

from tests.llm import common
from tidemark.llm import mixing


def period(parts):
    """Earliest deadline first, slot by slot, in plain Python."""
    total, done, out = sum(parts.values()), dict.fromkeys(parts, 0), []
    for slot in range(total):
        ready = [(-(-(done[k] + 1) * total // p), k) for k, p in sorted(parts.items()) if done[k] < p and done[k] * total // p <= slot]
        k = min(ready)[1]
        done[k] += 1
        out.append(k)
    return out


@pytest.mark.parametrize("weights", [{"a": 1.0}, {"a": 5.0, "b": 3.0, "c": 2.0}, {None: 1.0, "x": 7.5, "": 0.01}, {f"s{i:02}": 1.0 / (i + 1) for i in range(21)}])
def test_period_against_plain_steps(spark, weights):
    frame = spark.createDataFrame(list(weights.items()), "source string, weight double")
    parts = mixing.shares(frame, 120)
    row = parts.first()
    counts = {x.key: x.part for x in row["items"]}
    assert sum(counts.values()) == row.period == 120
    total = sum(weights.values())
    for key, part in counts.items():
        name = key[1:] if key[0] == "1" else None
        assert abs(part - 120 * weights[name] / total) <= 1 + len(weights) * weights[name] / total
    slots = mixing.period_slots(parts).orderBy("slot").collect()
    assert [r.key for r in slots] == period(counts)
    done = defaultdict(int)
    for t, r in enumerate(slots, 1):
        assert r.nth == done[r.key]
        done[r.key] += 1
        assert all(abs(done[k] - Fraction(t * p, 120)) < 1 for k, p in counts.items())


def corpus(spark):
    rows = [(i, "x" * (10 + i % 90), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(4000)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")


def test_every_row_once_and_in_its_window(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_ROWS", 100)
    docs = corpus(spark)
    rows = mixing.scheduled(docs, block_size=500).collect()
    assert sorted(r.doc_id for r in rows) == list(range(4000))
    owners, starts = defaultdict(set), defaultdict(list)
    for r in rows:
        assert r._release <= r._slot < r._deadline
        owners[r._slot].add((r.source, r._block))
        starts[r.source].append((r._start, len(r.text), r._block))
    assert all(len(x) == 1 for x in owners.values())
    for places in starts.values():  # the rows of a source lie end to end
        places.sort()
        assert places[0][0] == 0
        assert all(a + n == b for (a, n, _), (b, _, _) in zip(places, places[1:], strict=False))
        assert all(block == at // 500 for at, _, block in places)


def test_mixed_rows_lie_in_the_order_of_the_schedule(spark):
    docs = corpus(spark)
    slot = {r.doc_id: (r._slot, r._start) for r in mixing.scheduled(docs, block_size=500).collect()}
    mixed = mixing.mixed(docs, block_size=500, file_size=20_000)
    assert mixed.columns == docs.columns
    assert mixed.rdd.getNumPartitions() > 5
    order = [slot[r.doc_id] for r in mixed.collect()]
    assert order == sorted(order) and len(order) == 4000


def test_given_weights_and_sources_without(spark):
    docs = corpus(spark)
    weights = spark.createDataFrame([("hot", 3.0), ("s0", 1.0), ("unknown", 2.0)], "source string, weight double")
    rows = mixing.scheduled(docs, weights, 500).collect()
    assert len(rows) == 4000
    assert {r.source for r in rows if r._slot is not None} == {"hot", "s0"}
    assert mixing.mixed(docs, weights).count() == 4000


def test_awkward(spark, awkward_docs, no_docs):
    rows = mixing.mixing_report(awkward_docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((r.doc_id is None, r.doc_id or 0) for r in awkward_docs.collect())
    assert all(r.slot is not None for r in rows)
    mixed = mixing.mixed(awkward_docs)
    assert mixed.columns == awkward_docs.columns and mixed.count() == awkward_docs.count()
    assert mixing.mixing_report(no_docs).collect() == [] and mixing.mixed(no_docs).collect() == []


def test_plain_rows(spark):
    docs = spark.createDataFrame(common.rows(["abc"] * 5), common.DOCS)
    assert mixing.mixing_report(docs).count() == 5


@pytest.mark.parametrize("weights", [{f"s{i:03}": 1.0 for i in range(500)} | {"half": 500.0}, {"quarter": 0.25, "tiny": 1e-6, **{f"s{i}": 0.0416 for i in range(18)}}])
def test_true_weights_are_met_over_many_blocks(spark, weights):
    """No least part and no rounding: after any number of slots each source is within a block of its own weight."""
    blocks = {k: 3000 for k in weights}
    total = sum(map(Fraction, weights.values()))
    done, checked = dict.fromkeys(weights, 0), 0
    for t, (key, block, release, due, slot) in enumerate(mixing.block_slots([(k, w, blocks[k]) for k, w in weights.items()])):
        assert t == slot and block == done[key] and release <= slot < due
        done[key] += 1
        if t % 500 == 499:
            checked += 1
            assert all(abs(done[k] - (t + 1) * Fraction(w) / total) < 1 for k, w in weights.items())
        if t == 2999:
            break
    assert checked == 6


def test_scheduled_takes_the_true_weights(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS", 100)
    docs = spark.createDataFrame([(i, "x" * 10, ("big", "small", *(f"s{i % 100}",))[i % 3]) for i in range(3000)], "doc_id bigint, text string, source string")
    weights = {"big": 0.5, "small": 1e-6, **{f"s{i}": 0.004999 for i in range(100)}}
    frame = spark.createDataFrame(list(weights.items()), "source string, weight double")
    total = sum(map(Fraction, weights.values()))
    rows = mixing.scheduled(docs, frame, 10).collect()
    assert len(rows) == 3000 and len({r._slot for r in rows}) == 3000
    for r in rows:
        w = Fraction(weights[r.source]) / total
        assert (r._release, r._deadline) == (r._block / w // 1, -(-(r._block + 1) / w // 1))
        assert r._release <= r._slot < r._deadline
