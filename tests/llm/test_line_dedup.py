import hashlib
from collections import defaultdict

from tests.llm import common
from tidemark.llm import line_dedup

BLANKS = " \t\n\x0b\f\r"
LONG = "This line is long enough to count, és ÉCOLE number"


def expected(docs, min_chars=40, min_docs=5):
    holders = defaultdict(set)
    key = lambda line: common.lowered(line.strip(BLANKS))
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(doc)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def texts():
    few = [f"own {i}\n  {LONG} A \nmiddle\n{LONG.upper()} a\t\n{'y' * 39}\n" for i in range(4)]
    many = [f"{LONG} {i % 7}\nbetween\n\n{LONG} {i % 7}" for i in range(60)]
    tall = "\n".join(f"{LONG} {i % 9} " if i % 3 else str(i) for i in range(1000))
    return [*few, *many, tall, None, "", "\n", f"{LONG} 1", f"{LONG} 1"]


def found(docs):
    return sorted((tuple(r) for r in line_dedup.line_report(docs).collect()), key=repr)


def test_report(spark):
    rows = common.rows(texts())
    rows += [rows[5], (rows[6][0], f"another text\n{LONG} 6", *rows[6][2:]), (None, f"{LONG} 1", "en", "s0", 1, "k", "i", 0)]
    docs = spark.createDataFrame(rows, common.DOCS).repartition(6)
    assert found(docs) == expected([(r[0], r[1]) for r in rows])


def test_awkward(spark, awkward_docs):
    assert found(awkward_docs) == expected([(r.doc_id, r.text) for r in awkward_docs.collect()])


def test_dropped_text_and_columns(spark):
    rows = common.rows(texts())
    docs = spark.createDataFrame(rows, common.DOCS)
    kept = line_dedup.drop_lines(docs)
    assert kept.columns == docs.columns
    report = {r[0]: r[3] for r in expected([(r[0], r[1]) for r in rows])}
    for r in kept.collect():
        assert hashlib.sha256((r.text or "").encode()).hexdigest() == report[r.doc_id]
        assert r.text is not None or rows[r.doc_id][1] is None


def test_bitmaps_list_only_words_with_dropped_lines(spark):
    lines = [str(i) for i in range(300)]
    lines[200] = LONG
    docs = spark.createDataFrame([(i, "\n".join(lines)) for i in range(6)], "doc_id bigint, text string")
    rows = line_dedup.keep_bitmaps(docs).collect()
    assert len(rows) == 5
    assert all([tuple(w) for w in r["keep"]] == [(3, ~(1 << 8))] and r.n_dropped == 1 for r in rows)


def test_hot_line_is_dealt_to_many_groups(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", f"concat('{LONG}', '\n', id) as text")
    groups = line_dedup.line_keys(docs).groupBy("_h1", "_h2", "_salt").count()
    assert groups.count() == line_dedup.SALTS
    assert line_dedup.line_report(docs).where("n_dropped = 1").count() == 2999


def test_empty_table(no_docs):
    assert found(no_docs) == []
