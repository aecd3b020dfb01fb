"""N-gram Jaccard join by vertical partitioning, and the components of its links.

Every document is a set of distinct word shingles (A-Z lower-cased). All shingles have one global order, the rarest
first; it is cut into fragments, overlaps of a pair are counted fragment by fragment, and their sum decides.

1. Documents with equal sets are one class; its smallest doc_id stands for it. Only classes are joined.
2. The order puts shingles by how far their count exceeds the usual one in a fixed-size table of hashed counts, then by
   hash. Any fixed order gives the same links; this one keeps common shingles out of the first fragment.
3. The first fragment of a set is its prefix: two linked sets share a shingle there, and the places of the first shared
   one bound how many they can share at all. Shingles found in one prefix only are dropped.
4. Linking: each class is paired with one promising partner (the class least changed before a shared shingle, by votes
   of its shingles), which connects groups of copies by stars instead of all their pairs.
5. Completing: all pairs that share a prefix shingle, may still reach the threshold by their sizes and places, and are
   not yet in one component. A pair is made where it meets first, as far as the shingles before tell. A set that meets
   few others of about its size at a shingle is paired outright there. The sets that meet more are ordered anew among
   themselves, by the exact number of these sets that hold a shingle, so that what a set has alone or with few comes
   first; they are paired by their prefixes in that order. Nothing is left out: a pair not tested here is connected already or cannot be linked.
6. A pair's overlap is counted in the first fragment, where most fail, then in the others, summed over fragments.

* A null text, or one without words, has no shingles, links with nothing and is its own component.
* A text with fewer words than a shingle has one shingle, the whole text's words.
* Rows that share a doc_id are one document; if their texts differ, the smallest fingerprint speaks for it. Rows with a
  null doc_id link with nothing and have a null component. Further columns are ignored.
* Shingles are 64-bit hashes; class fingerprints have 128 bits.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import textbytes
from tidemark.llm.store import remove, stored, written

#: The table of hashed shingle counts: a fixed 4 MB at any size of the corpus.
TABLE_BITS = 20
TABLE_PARTS = 16
#: Bits of the filter that spares texts without candidate pairs: a fixed 1 MB; more documents only filter less.
FILTER_BITS = 1 << 23
#: Fragments of the global order behind the prefix: by leading hash bits, then common and very common shingles.
HASH_FRAGMENTS = 8
COMMON = 1000
#: Holders of a shingle, of about a set's size and itself included, that are paired outright; sets that meet more are ordered anew.
FEW = 16
#: Shingles of a range of hashes that one task counts, about.
RANGE_SHINGLES = 1_000_000


@dataclass(frozen=True)
class Threshold:
    """Jaccard similarity of at least `percent` hundredths on `words`-word shingles."""

    words: int = 5
    percent: int = 80

    def prefix(self, n: np.ndarray) -> np.ndarray:
        """Shingles of a set of n of which a linked set must share one: all but the least overlap, and one."""
        return n + (-self.percent * n) // 100 + 1

    def prefix_of(self, n: Column) -> Column:
        return n + 1 + F.floor(-self.percent * n / F.lit(100)).cast("int")

    def linked(self, common: Column, n: Column, m: Column) -> Column:
        return 100 * common >= self.percent * (n + m - common)


OP10 = Threshold(words=4, percent=85)


# ---- sets of a text


def _sets(text: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingles) of each row with words."""
    for part in textbytes.slices(text):
        starts, ends, first = part.words()
        hashes, at = textbytes.shingles(textbytes.word_hashes(part.data, starts, ends, lower=True), first, words)
        for row in np.flatnonzero(np.diff(at)):
            yield part.first + int(row), np.unique(hashes[at[row]:at[row + 1]])


def _slot(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def profiles(docs: DataFrame, words: int) -> DataFrame:
    """Per row doc_id, n and fingerprint (f1, f2); besides, per task and part of the count table a row with its counts."""
    schema = "doc_id bigint, n int, f1 bigint, f2 bigint, part int, counts binary"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def table(columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << TABLE_BITS, np.int64)
        for batch in batches:
            rows = batch.num_rows
            n, prints = np.zeros(rows, np.int32), np.zeros((rows, 2), np.int64)
            gathered: list[np.ndarray] = []
            for row, found in _sets(batch.column("text"), words):
                n[row] = len(found)
                prints[row] = np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), np.int64)
                gathered.append(_slot(found))
                if len(gathered) >= 1000:
                    counts += np.bincount(np.concatenate(gathered), minlength=len(counts))
                    gathered = []
            if gathered:
                counts += np.bincount(np.concatenate(gathered), minlength=len(counts))
            yield table([batch.column("doc_id"), n, prints[:, 0], prints[:, 1], [None] * rows, [None] * rows])
        if counts.any():
            parts = [zlib.compress(p.astype("<u4").tobytes(), 1) for p in np.split(counts, TABLE_PARTS)]
            yield table([[None] * TABLE_PARTS, *[[0] * TABLE_PARTS] * 3, list(range(TABLE_PARTS)), parts])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


def excess_table(found: DataFrame) -> np.ndarray:
    """Per slot of the count table, by how much it exceeds the usual count; 0 for most."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts"), strict=True):
                own = np.frombuffer(zlib.decompress(counts.as_py()), "<u4").astype(np.int64)
                sums[part] = sums[part] + own if part in sums else own
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([zlib.compress(v.tobytes(), 1) for v in sums.values()], pa.binary())],
                                         names=["part", "counts"])

    parts = found.where("part is not null").select("part", "counts").repartition(TABLE_PARTS, "part")
    table = np.zeros((TABLE_PARTS, (1 << TABLE_BITS) // TABLE_PARTS), np.int64)
    for r in parts.mapInArrow(total, "part int, counts binary").collect():
        table[r["part"]] = np.frombuffer(zlib.decompress(bytes(r["counts"])), np.int64)
    usual = float(table.mean())
    return np.maximum(table.ravel() - int(usual + 4 * usual ** 0.5), 0).clip(max=1 << 30).astype(np.int32)


def _ordered(shingles: np.ndarray, excess: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A set in the global order (excess, hash), with the excess of each."""
    over = excess[_slot(shingles)]
    if not over.any():
        return shingles, over
    order = np.lexsort((shingles, over))
    return shingles[order], over[order]


def prefixes(docs: DataFrame, excess, threshold: Threshold) -> DataFrame:
    """(doc_id, f1, f2, n, last, prefix): the first fragment of each set in the global order, and the excess of its end."""
    schema = "doc_id bigint, f1 bigint, f2 bigint, n int, last int, prefix array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = excess.value
        for batch in batches:
            rows, n, prints, last, kept = [], [], [], [], []
            for row, found in _sets(batch.column("text"), threshold.words):
                ordered, over = _ordered(found, table)
                size = int(threshold.prefix(np.int64(len(found))))
                rows.append(row)
                n.append(len(found))
                prints.append(np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), np.int64))
                last.append(over[size - 1])
                kept.append(ordered[:size].view(np.int64))
            prints = np.array(prints, np.int64).reshape(-1, 2)
            ends = np.concatenate([[0], np.cumsum([len(k) for k in kept])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(kept) if kept else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(prints[:, 0]), pa.array(prints[:, 1]), pa.array(n, pa.int32()),
                 pa.array(last, pa.int32()), lists], names=["doc_id", "f1", "f2", "n", "last", "prefix"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


def _sieve(wanted: DataFrame):
    """A broadcast bit table that lets the documents in `wanted` (doc) through, and a few others."""
    bit = F.pmod(F.xxhash64("doc"), F.lit(FILTER_BITS))
    cells = wanted.select(bit.alias("b")).groupBy(F.expr("cast(b div 64 as int)").alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("bits"))
    table = np.zeros(FILTER_BITS // 64, np.int64)
    for r in cells.collect():  # at most FILTER_BITS / 64 rows
        table[r["cell"]] = r["bits"]
    return wanted.sparkSession.sparkContext.broadcast(table)


def _marked(docs: DataFrame) -> DataFrame:
    """(doc_id, text, _bit): documents with an id and their places in a sieve."""
    named = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return named.withColumn("_bit", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)))


def _let_through(batch: pa.RecordBatch, bits: np.ndarray) -> pa.RecordBatch:
    at = batch.column("_bit").to_numpy(zero_copy_only=False)
    return batch.take(pa.array(np.flatnonzero((bits[at // 64] >> (at % 64)) & 1)))


def _chosen(parts: DataFrame, wanted: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows of the wanted documents whose text is the one that speaks for its document."""
    return parts.join(wanted, "doc", "left_semi").join(sets.select("doc", "f1"), ["doc", "f1"], "left_semi")


def fragments(docs: DataFrame, wanted: DataFrame, excess, words: int) -> DataFrame:
    """(doc, f1, fragment, shingles) of the documents in `wanted` (doc), and of a few others that the filter lets through."""
    sieve = _sieve(wanted)
    schema = "doc bigint, f1 bigint, fragment int, shingles array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over_table, bits = excess.value, sieve.value
        for batch in batches:
            chosen = _let_through(batch, bits)
            docs_of, prints, numbers, lists = [], [], [], []
            for row, found in _sets(chosen.column("text"), words):
                over = over_table[_slot(found)]
                number = np.where(over == 0, (found >> np.uint64(61)).astype(np.int64), np.where(over < COMMON, HASH_FRAGMENTS, HASH_FRAGMENTS + 1))
                own = int(np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), np.int64)[0])
                doc = chosen.column("doc_id")[row].as_py()
                for f in np.unique(number):
                    docs_of.append(doc)
                    prints.append(own)
                    numbers.append(int(f))
                    lists.append(found[number == f].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(docs_of, pa.int64()), pa.array(prints, pa.int64()), pa.array(numbers, pa.int32()), pa.array(lists, pa.list_(pa.int64()))],
                                             names=["doc", "f1", "fragment", "shingles"])

    return _marked(docs).mapInArrow(run, schema)


def _ranges(docs: DataFrame, wanted: DataFrame, excess, threshold: Threshold, count: int) -> DataFrame:
    """(doc, f1, n, rare, part, shingles) of the documents in `wanted`, and of a few others that the filter lets through.

    All `rare` shingles of a set without excess, by `count` ranges of their hashes; where they do not fill the prefix, the
    next in the order as part -1.
    """
    sieve, width = _sieve(wanted), -(-(1 << 64) // count)
    schema = "doc bigint, f1 bigint, n int, rare int, part int, shingles array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bits = excess.value, sieve.value
        edges = np.array([width * p for p in range(1, count)], np.uint64)
        for batch in batches:
            chosen = _let_through(batch, bits)
            rows, prints, n, rare, parts, lists = [], [], [], [], [], []
            for row, found in _sets(chosen.column("text"), threshold.words):
                ordered, over = _ordered(found, table)
                own = int(np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), np.int64)[0])
                front = int(np.count_nonzero(over == 0))
                ends = np.searchsorted(ordered[:front], edges)
                pieces = [*np.split(ordered[:front], ends), ordered[front:int(threshold.prefix(np.int64(len(found))))]]
                for part, piece in zip([*range(count), -1], pieces, strict=True):
                    if len(piece):
                        rows.append(row)
                        prints.append(own)
                        n.append(len(found))
                        rare.append(front)
                        parts.append(part)
                        lists.append(piece.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [chosen.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(prints, pa.int64()), pa.array(n, pa.int32()), pa.array(rare, pa.int32()),
                 pa.array(parts, pa.int32()), pa.array(lists, pa.list_(pa.int64()))], names=["doc", "f1", "n", "rare", "part", "shingles"])

    return _marked(docs).mapInArrow(run, schema)


def _held_by_several(part: pa.Table) -> pa.Table:
    """(doc, n, rare, shingle, holders) of the shingles of a range that two sets or more hold."""
    lists = part.column("shingles").combine_chunks()
    shingles = lists.flatten().to_numpy()
    _, at, holders = np.unique(shingles, return_inverse=True, return_counts=True)
    several = np.flatnonzero(holders[at] > 1)
    row = pa.array(np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())[several])
    return pa.Table.from_arrays([*(part.column(c).take(row) for c in ("doc", "n", "rare")), pa.array(shingles[several]), pa.array(holders[at][several].astype(np.int32))],
                                names=["doc", "n", "rare", "shingle", "holders"])


# ---- pairs


def shared_prefixes(sets: DataFrame) -> DataFrame:
    """(shingle, doc, n, place) of prefix shingles that two sets or more hold."""
    postings = sets.select("doc", "n", F.posexplode("prefix").alias("place", "shingle"))
    common = postings.groupBy("shingle").agg(F.count("*").alias("holders")).where("holders > 1").select("shingle")
    return postings.join(common, "shingle")


def _may_link(shared: DataFrame, threshold: Threshold) -> DataFrame:
    """Add `most`: the largest partner a set can be linked with if this is their first shared shingle."""
    both = 100 + threshold.percent
    return shared.withColumn("most", F.expr(f"cast(({both} * (n - place)) div {threshold.percent} as int) - n"))


def first_meetings(shared: DataFrame) -> DataFrame:
    """Without the shingles at which no pair of sets can meet first, and with the shared shingle `before` of each set.

    If all holders of a shingle have the same shared shingle right before it, every pair that meets at the one has met
    at the other. A passage that many sets hold is left with few shingles.
    """
    before = shared.withColumn("before", F.lag("shingle").over(Window.partitionBy("doc").orderBy("place")))
    later = before.groupBy("shingle").agg(F.min("before").alias("x"), F.max("before").alias("y"), F.count("before").alias("n"), F.count("*").alias("m"))
    return before.join(later.where("x = y and n = m").select("shingle"), "shingle", "left_anti")


def promising_pairs(shared: DataFrame) -> DataFrame:
    """(a, b) with a < b: each set with the leader that most of its shingles name, the least changed set of the shingle."""
    least = F.min(F.struct((F.col("place") / F.col("n")).alias("changed"), F.col("doc").alias("leader"), F.col("n").alias("m"), F.col("most").alias("most_m")))
    leaders = shared.groupBy("shingle").agg(least.alias("l")).select("shingle", "l.leader", "l.m", "l.most_m")
    votes = (shared.join(leaders, "shingle").where("doc <> leader and n <= most_m and m <= most")
             .groupBy("doc", "leader").agg(F.count("*").alias("votes")))
    chosen = votes.groupBy("doc").agg(F.max(F.struct("votes", (-F.col("leader")).alias("minus"))).alias("x"))
    pair = chosen.select("doc", (-F.col("x.minus")).alias("leader"))
    return pair.select(F.least("doc", "leader").alias("a"), F.greatest("doc", "leader").alias("b")).distinct()


def meetings(shared: DataFrame, labels: DataFrame, threshold: Threshold) -> DataFrame:
    """Rows of `shared` at whose shingle sets of different components (c) meet first, with the number `near` of its holders of about a set's size."""
    named = first_meetings(shared).join(labels, "doc", "left").withColumn("c", F.coalesce("label", "doc")).drop("label")
    mixed = named.groupBy("shingle").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x < y").select("shingle")
    # Linked sets differ less in size than a band is wide.
    met = named.join(mixed, "shingle").withColumn("band", F.floor(F.log("n") / math.log(101 / threshold.percent)).cast("int"))
    sizes = met.groupBy("shingle", "band").agg(F.count("*").alias("own"))
    around = sizes.select("shingle", "own", F.explode(F.expr("sequence(band - 1, band + 1)")).alias("band")).groupBy("shingle", "band").agg(F.sum("own").alias("near"))
    return met.join(around, ["shingle", "band"]).drop("band")


def met_pairs(met: DataFrame, few: int | None = None) -> DataFrame:
    """(a, b) with a < b of all pairs that meet, may be linked and lie in different components; if given, where one of them meets `few`.

    Two sets with the same shared shingle right before have met there.
    """
    side = lambda x: met.select("shingle", F.col("doc").alias(x), *(F.col(v).alias(f"{v}_{x}") for v in ("n", "most", "c", "before", "near")))
    pairs = side("a").join(side("b"), "shingle").where(
        "a < b and c_a <> c_b and n_a <= most_b and n_b <= most_a and (before_a is null or before_b is null or before_a <> before_b)"
        + (f" and least(near_a, near_b) <= {few}" if few is not None else ""))
    return pairs.select("a", "b").distinct()


def reordered(wanted: DataFrame, sets: DataFrame, docs: DataFrame, excess, threshold: Threshold) -> DataFrame:
    """What `shared_prefixes` gives, of the documents in `wanted` (doc) and in another order of all shingles.

    Shingles without excess come first, by the number of the wanted sets that hold them, then by hash; the others follow
    as before.
    """
    size = sets.join(wanted, "doc", "left_semi").agg(F.sum("n")).first()[0] or 0
    ranges = _ranges(docs, wanted, excess, threshold, int(size // RANGE_SHINGLES) + 1)
    parts = stored(_chosen(ranges, wanted, sets).dropDuplicates(["doc", "part"]), "set-ranges")
    several = parts.where("part >= 0").groupBy("part").applyInArrow(_held_by_several, "doc bigint, n int, rare int, shingle bigint, holders int")
    own = Window.partitionBy("doc")
    rank = F.row_number().over(own.orderBy("holders", "shingle"))
    front = several.select("shingle", "doc", "n", (F.col("rare") - F.count("*").over(own) + rank - 1).cast("int").alias("place"))
    back = parts.where("part < 0").select("doc", "n", "rare", F.posexplode("shingles").alias("at", "shingle"))
    both = front.union(back.select("shingle", "doc", "n", (F.col("rare") + F.col("at")).alias("place")))
    return both.where(F.col("place") < threshold.prefix_of(F.col("n")))


def remaining_pairs(shared: DataFrame, labels: DataFrame, sets: DataFrame, docs: DataFrame, excess, threshold: Threshold) -> DataFrame:
    """(a, b) with a < b of pairs in different components, all that are linked among them."""
    met = stored(meetings(shared, labels, threshold), "meetings")
    crowd = stored(met.where(F.col("near") > FEW).select("doc").distinct(), "crowd")
    again = stored(_may_link(reordered(crowd, sets, docs, excess, threshold), threshold), "reordered")
    return met_pairs(met, FEW).union(met_pairs(meetings(again, labels, threshold))).distinct()


def _sides(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    own = lambda side: sets.select(F.col("doc").alias(side), F.col("n").alias(f"n_{side}"), F.col("last").alias(f"last_{side}"), F.col("prefix").alias(f"p_{side}"))
    return pairs.join(own("a"), "a").join(own("b"), "b")


def past_first_fragment(pairs: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """Pairs whose overlap in the first fragment leaves the threshold within reach.

    The set whose prefix ends first in the global order has shared all it can of that prefix; of the rest of it, all
    may be shared.
    """
    both = _sides(pairs, sets).withColumn("common", F.size(F.array_intersect("p_a", "p_b")))
    # Hashes order as unsigned numbers: flip the sign bit to compare.
    end = lambda side: F.struct(f"last_{side}", F.element_at(f"p_{side}", -1).bitwiseXOR(F.lit(-(1 << 63))))
    rest = F.when(end("a") <= end("b"), F.col("n_a") - F.size("p_a")).otherwise(F.col("n_b") - F.size("p_b"))
    return both.where(threshold.linked(F.col("common") + rest, F.col("n_a"), F.col("n_b"))).select("a", "b", "n_a", "n_b")


def links(pairs: DataFrame, sets: DataFrame, docs: DataFrame, excess, threshold: Threshold) -> DataFrame:
    """The linked pairs (a, b): overlaps counted by fragment and summed."""
    likely = stored(past_first_fragment(pairs, sets, threshold), "likely-pairs")
    wanted = likely.select(F.col("a").alias("doc")).union(likely.select("b")).distinct()
    parts = _chosen(fragments(docs, wanted, excess, threshold.words), wanted, sets)
    parts = stored(parts.dropDuplicates(["doc", "fragment"]), "set-fragments")
    left = parts.select(F.col("doc").alias("a"), "fragment", F.col("shingles").alias("s_a"))
    right = parts.select(F.col("doc").alias("b"), "fragment", F.col("shingles").alias("s_b"))
    met = likely.join(left, "a").join(right, ["b", "fragment"])
    summed = met.groupBy("a", "b", "n_a", "n_b").agg(F.sum(F.size(F.array_intersect("s_a", "s_b"))).alias("common"))
    return summed.where(threshold.linked(F.col("common"), F.col("n_a"), F.col("n_b"))).select("a", "b")


# ---- components


def components(edges: DataFrame) -> DataFrame:
    """(doc, label) of every node of the edges (a, b): label is the smallest node reachable.

    Rounds of taking the smallest label around, then the label's own label, until nothing changes.
    """
    both = stored(edges.select(F.col("a").alias("doc"), F.col("b").alias("near")).union(edges.select("b", "a")), "edges")
    labels, path = both.select("doc").distinct().withColumn("label", F.col("doc")), None
    while True:
        around = both.join(labels.select(F.col("doc").alias("near"), F.col("label").alias("of_near")), "near").groupBy("doc").agg(F.min("of_near").alias("m"))
        lower = labels.join(around, "doc").select("doc", F.least("label", "m").alias("low"), F.col("label").alias("old"))
        jumped = lower.join(labels.select(F.col("doc").alias("low"), F.col("label").alias("further")), "low")
        next_path = written(jumped.select("doc", F.least("low", "further").alias("label"), "old"), "labels")
        found = both.sparkSession.read.parquet(next_path)
        if path:
            remove(both.sparkSession, path)
        labels, path = found.select("doc", "label"), next_path
        if not found.where("label <> old").limit(1).count():
            return labels


# ---- the join


def component_report(docs: DataFrame, threshold: Threshold = OP10) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every row."""
    spark = docs.sparkSession
    found = stored(profiles(docs, threshold.words), "profiles")
    excess = spark.sparkContext.broadcast(excess_table(found))
    rows = found.where("part is null").select("doc_id", "n", "f1", "f2")
    single = rows.where("doc_id is not null and n > 0").groupBy(F.col("doc_id").alias("doc")).agg(F.min(F.struct("f1", "f2", "n")).alias("x")).select("doc", "x.*")
    single = stored(single, "documents-sets")
    classes = stored(single.groupBy("f1", "f2").agg(F.min("doc").alias("rep")), "classes")

    chosen = classes.select(F.col("rep").alias("doc_id"), "f1", "f2")
    sets = prefixes(docs, excess, threshold).join(chosen, ["doc_id", "f1", "f2"], "left_semi").dropDuplicates(["doc_id"])
    sets = stored(sets.withColumnRenamed("doc_id", "doc"), "prefixes")
    shared = stored(_may_link(shared_prefixes(sets), threshold), "shared-prefixes")
    linked = stored(links(promising_pairs(shared), sets, docs, excess, threshold), "links")
    labels = components(linked)
    further = stored(links(remaining_pairs(shared, labels, sets, docs, excess, threshold), sets, docs, excess, threshold), "further-links")
    final = components(linked.union(further))

    of_class = classes.join(final.withColumnRenamed("doc", "rep"), "rep", "left").select("f1", "f2", F.coalesce("label", "rep").alias("component"))
    of_doc = single.join(of_class, ["f1", "f2"]).select(F.col("doc").alias("doc_id"), "component")
    return rows.join(of_doc, "doc_id", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, threshold: Threshold = Threshold()) -> DataFrame:
    """The rows of `docs` whose document is the smallest of its component; rows with a null doc_id stay."""
    report = component_report(docs, threshold)
    gone = stored(report.where("component_id <> doc_id").select("doc_id").distinct(), "near-copies")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
