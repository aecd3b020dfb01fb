import random
from collections import Counter

import numpy as np

from tests.llm import common
from tidemark.llm import quality


def base(text):
    words = common.WORDS.findall(text or "")
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\f\r")]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_base_statistics(awkward_docs):
    texts = {r.doc_id: r.text for r in awkward_docs.collect() if r.doc_id is not None}
    rows = quality.quality_report(awkward_docs).collect()
    assert len(rows) == awkward_docs.count()
    for r in rows:
        if r.doc_id is not None:
            assert tuple(r[n] for n in quality.STATISTICS) == base(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def corpus(spark, n=1500, bad=40):
    rng = random.Random(8)
    clean = [(i, " ".join(rng.choice(["ab", "abc", "word", "longer", "sentences"]) + str(rng.randrange(900)) for _ in range(rng.randrange(60, 300))),
              "en", "s0" if i % 3 else f"s{i % 5}") for i in range(n)]
    junk = [(n + i, " ".join(w + "***" for w in clean[i][1].split()), "en", "s0") for i in range(bad)]
    few = [(n + bad + i, clean[i][1], None, f"rare{i}") for i in range(20)]
    return spark.createDataFrame(clean + junk + few, "doc_id bigint, text string, lang string, source string")


def test_outliers_go_and_clean_stays(spark):
    rows = quality.quality_report(corpus(spark)).collect()
    assert not any(r.kept for r in rows if 1500 <= r.doc_id < 1540)
    assert sum(r.kept for r in rows if r.doc_id < 1500) >= 1498
    assert all(r.kept for r in rows if r.doc_id >= 1540)  # too few for an estimate of their own


def test_estimate_is_that_of_the_inner_rows(spark):
    """Against plain numpy concentration steps from the same start."""
    rng = np.random.default_rng(3)
    data = np.vstack([rng.normal([1, .2, .3, .1], [.3, .2, .2, .3], (900, 4)), rng.normal(6, .1, (100, 4))])
    frame = spark.createDataFrame([("en", "s", [float(x) for x in row]) for row in data], "lang string, source string, _v array<double>")
    found = quality.estimates(frame).first()
    inner = data[:900]
    assert np.allclose(found.e_mean, inner.mean(axis=0), atol=0.05)
    inverse = np.array(found.e_inverse).reshape(4, 4)
    assert np.allclose(np.linalg.inv(inverse), np.cov(inner.T), atol=0.03)


def test_kept_documents_keep_their_columns(spark, awkward_docs):
    kept = quality.kept_documents(awkward_docs)
    assert kept.columns == awkward_docs.columns
    verdicts = {r.doc_id for r in quality.quality_report(awkward_docs).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == verdicts


def test_empty_table(no_docs):
    assert quality.quality_report(no_docs).collect() == []
    assert quality.kept_documents(no_docs).collect() == []


def texts(n, rng):
    """Clean texts of 200 words on 20 lines."""
    return ["\n".join(" ".join(rng.choice(["ab", "abc", "word", "longer", "sentences"]) + str(rng.randrange(900)) for _ in range(10)) for _ in range(20))
            for _ in range(n)]


def verdicts(spark, groups):
    """Kept shares by group from {name: (texts, lang, source)}."""
    rows = [(t, lang, source, name) for name, (found, lang, source) in groups.items() for t in found]
    frame = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(rows)], "doc_id bigint, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.quality_report(frame).collect()}
    out = {name: [] for name in groups}
    for i, r in enumerate(rows):
        out[r[3]].append(kept[i])
    return {name: sum(x) / len(x) for name, x in out.items()}


def test_each_statistic_rejects_alone(spark):
    """Texts far from the rest of their group in one statistic, by less than the fixed floors once let pass."""
    rng = random.Random(5)
    symbols = [t.replace(" ", " # ", 12) for t in texts(10, rng)]
    lines = ["\n".join([*t.split("\n"), *(f"again{i}" for i in range(6) for _ in range(2))]) for t in texts(10, rng)]
    words = [t + "".join(" " + " ".join(t.split()[i:i + 3]) for i in range(0, 30, 3)) for t in texts(10, rng)]
    one = [t.replace(" ", " # ", 1) + "\n" + t.split("\n")[0].split()[0] for t in texts(10, rng)]
    kept = verdicts(spark, {"clean": (texts(600, rng), "en", "s"), "symbols": (symbols, "en", "s"), "lines": (lines, "en", "s"),
                            "words": (words, "en", "s"), "one": (one, "en", "s")})
    assert kept["symbols"] == kept["lines"] == kept["words"] == 0
    assert kept["clean"] > 0.995 and kept["one"] == 1


def test_rare_groups_and_small_tables_are_judged(spark):
    rng = random.Random(6)
    junk = lambda n: [" ".join(w + "***" for w in t.split()) for t in texts(n, rng)]
    kept = verdicts(spark, {"clean": (texts(600, rng), "en", "s"), "rare": (junk(100), "en", "new"), "other": (junk(5), None, None),
                            "fine": (texts(5, rng), "de", "s")})
    assert kept["rare"] == kept["other"] == 0 and kept["clean"] > 0.995 and kept["fine"] == 1
    few = verdicts(spark, {"clean": (texts(80, rng), "en", "s"), "junk": (junk(6), "en", "s")})
    assert few["junk"] == 0 and few["clean"] > 0.95
