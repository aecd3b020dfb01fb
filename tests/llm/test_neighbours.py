import numpy as np

from tidemark.llm import neighbours

SCHEMA = "vec_id bigint, embedding array<float>, label int, cell string, vector int"


def brute(rows, every, k=10):
    ids = np.array([r[0] for r in rows])
    data = np.array([r[1] for r in rows], np.float32).astype(np.float64)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        apart = np.sqrt(((data - data[i]) ** 2).sum(axis=1))
        out[ids[i]] = [(ids[j], apart[j]) for j in np.lexsort((ids, apart)) if j != i][:k]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(int(i), None if v is None else [None if x is None else float(x) for x in v], 1, "c", 2) for i, v in rows], SCHEMA).repartition(7)


def check(spark, rows, every, least):
    want = brute([r for r in rows], every)
    found = {}
    for r in neighbours.nearest(frame(spark, rows), every).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == {q for q in want if want[q]}
    hits = 0
    for q, near in found.items():
        near.sort()
        assert [r for r, _, _ in near] == list(range(1, len(want[q]) + 1))
        assert [(s, v) for _, v, s in near] == sorted((s, v) for _, v, s in near)
        truth = dict(want[q])
        hits += sum(v in truth for _, v, _ in near)
        for _, v, s in near:
            assert v not in truth or abs(s - truth[v]) < 1e-9
    assert hits >= least * sum(map(len, want.values()))


def test_recall_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 200)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 30)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 32))
    rows = [(i, centres[i % 20] + 0.6 * rng.normal(size=32)) for i in range(3000)]
    check(spark, rows, 50, 0.9)


def test_a_very_common_vector(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 150)
    rng = np.random.default_rng(2)
    rows = [(i, [1.0] * 16 if i % 3 == 0 else rng.normal(size=16)) for i in range(1500)]
    check(spark, rows, 50, 0.9)


def test_few_rows_and_bad_vectors(spark):
    good = [(0, [1, 2, 3]), (100, [1, 2, 3]), (7, [0, 0, 1]), (200, [4, 4, 4])]
    bad = [(300, None), (400, [0, 0, 0]), (500, [1, None, 2]), (600, [1, float("nan"), 2]), (700, [1, float("inf"), 2]), (800, []), (900, [1, 2])]
    rows = neighbours.nearest(frame(spark, good + bad + good[:1])).collect()
    assert {(r.query_id, r["rank"], r.vec_id) for r in rows if r.query_id == 0} == {(0, 1, 100), (0, 2, 7), (0, 3, 200)}
    assert {r.query_id for r in rows} == {0, 100, 200}
    assert neighbours.nearest(frame(spark, [])).collect() == []
    assert neighbours.nearest(frame(spark, bad[:2])).collect() == []
    assert neighbours.nearest(frame(spark, good[:1])).collect() == []
