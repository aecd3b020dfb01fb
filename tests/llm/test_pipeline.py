import hashlib
import random

import corpus_pipeline
from tests.llm import common
from tests.llm.test_ngram_join import expected as components
from tidemark.llm import bpe, mixing, quality
from tidemark.llm.ngram_join import Threshold
from tidemark.llm.queries import tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents(spark):
    rng = random.Random(12)
    line = "A line that many documents share, long enough to count as one"
    clean = [common.sentences(rng, 150, 4000) for _ in range(300)]
    texts = [f"{t}\n{line}" if i % 10 == 0 else t for i, t in enumerate(clean)]
    texts += [texts[5], texts[6].replace("w1", "w2", 1), "short", None, "", " ".join(w + "***" for w in clean[7].split())]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return texts, spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_stages(spark, tmp_path):
    texts, docs = documents(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_copies", "mixing", "bpe"]
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {r.doc_id for r in quality.quality_report(at).where("kept").collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, at, str(tmp_path))
        if name != "bpe":
            assert out.columns == COLUMNS
        out.write.parquet(str(tmp_path / f"{number}"))
        before, at = at, spark.read.parquet(str(tmp_path / f"{number}"))
        rows = {r.doc_id: r for r in at.collect()}
        if name == "quality":
            assert set(rows) == kept and set(range(300)) <= kept and not {302, 303, 304, 305} & kept
        if name == "line_dedup":
            assert set(rows) == kept
            holders = [i for i in kept if i < 300 and i % 10 == 0]
            assert all(("A line" in rows[i].text) == (i == max(holders)) for i in holders)
        if name == "near_copies":
            want = components([(r.doc_id, r.text) for r in before.collect()], Threshold())
            assert set(rows) == {c for _, c in want.values()} and 300 not in rows and 301 not in rows
        if name == "mixing":
            assert {i: r.text for i, r in rows.items()} == {r.doc_id: r.text for r in before.collect()} and at.count() == before.count()
        if name == "bpe":
            ours = bpe.WordBpe(open(tokenizer("word_bpe_49k.json"), encoding="utf-8").read())
            for r in before.collect():
                assert rows[r.doc_id].ids == next(iter(ours.encode_all([r.text]))) and rows[r.doc_id].n_tokens == len(rows[r.doc_id].ids)
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {(r.doc_id, tuple(r.ids)) for r in whole} == {(r.doc_id, tuple(r.ids)) for r in rows.values()}


def test_empty_documents(spark, tmp_path):
    documents(spark)[1].limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_places_follow_the_mix_over_files_of_different_size(spark, tmp_path):
    """The rows of the last stage carry the order of the schedule, whatever order the files are read in."""
    rng = random.Random(3)
    rows = [(i, common.sentences(rng, 20 if i % 3 else 400), "en", f"s{i % 3}", 0) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    slots = {r.doc_id: (r._slot, r._start) for r in mixing.scheduled(docs, block_size=3000).collect()}
    mixing.mixed(docs, block_size=3000, file_size=40_000).write.parquet(str(tmp_path / "mixed"))
    files = list((tmp_path / "mixed").glob("*.parquet"))
    assert len(files) > 5 and len({f.stat().st_size for f in files}) > 1
    out = corpus_pipeline.bpe_stage(spark, spark.read.parquet(str(tmp_path / "mixed")), "").collect()
    assert sorted(r.place for r in out) == list(range(400))
    assert [r.doc_id for r in sorted(out, key=lambda r: r.place)] == sorted(slots, key=slots.get)
    ours = bpe.WordBpe(open(tokenizer("word_bpe_49k.json"), encoding="utf-8").read())
    assert all(r.decoded_sha256 == hashlib.sha256(ours.decode(r.ids).encode()).hexdigest() for r in out)
