"""Mixing sources to target weights with a proportionate-fair schedule of source blocks.

The rows of each source, in a shuffled but fixed order, are cut into blocks of about `block_size` (characters here).
Block j (from 0) of a source with weight w is released at slot floor(j/w) and due at ceil((j+1)/w); in every slot the
released block with the earliest deadline runs. As the weights sum to one, every deadline is met, so after any number of
slots each source has run its share to within less than one block. The weights are taken as they are, as exact fractions:
no part is rounded, none has a least size, and nothing repeats. Only the blocks there are, one for some 64,000 characters,
are stepped through, on the driver and in slices; a slot in which none is ready is passed over at once.

Every row appears exactly once. A source that has run out leaves its later slots empty; the others keep their slots.

* A null source is a source of its own. A null or empty text has size zero and goes where the rows around it go.
* A row belongs to the block in which its first character lies; a long text fills several blocks of its source.
* Rows are ordered by hash of id and text; equal rows may swap places without effect. Further columns pass through.
* An empty table gives an empty result. Sources without a weight get no slots and follow after the others, as do
  blocks released only after 2^62 slots.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from math import lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.store import boxed, stored, unboxed

BLOCK_SIZE = 1 << 16
RESOLUTION = 1000
#: Shares grow with this power of a source's size: below 1, large sources give way to small ones.
FLATTENING = 0.7
#: Rows of a source are dealt to groups of about this many for their running totals.
GROUP_ROWS = 4096
#: Blocks whose slots are found before they are written.
SLOTS = 1 << 18
#: Slots and deadlines end here.
LAST = 1 << 62
#: Characters of a file of mixed rows, about.
FILE_SIZE = 32 << 20


def source_sizes(docs: DataFrame) -> DataFrame:
    """(source, size, rows): characters and rows of each source."""
    return docs.groupBy("source").agg(
        F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long")).alias("size"), F.count("*").alias("rows"))


def flattened_weights(sizes: DataFrame, power: float = FLATTENING) -> DataFrame:
    """Target weights (source, weight) from sizes; they need not sum to one."""
    return sizes.select("source", F.pow(F.greatest("size", F.lit(1)).cast("double"), power).alias("weight"))


def _struct_of(source: Column) -> Column:
    """A sort and join key in which null differs from every string."""
    return F.concat(F.when(source.isNull(), F.lit("0")).otherwise(F.lit("1")), F.coalesce(source, F.lit("")))


def shares(weights: DataFrame, resolution: int = RESOLUTION) -> DataFrame:
    """A rounded, repeating form of the weights for a plan of a fixed length; `scheduled` does not use it.

    One row: `items`, the sources as (key, part) with whole parts of a period that sum to `period`.

    Parts are rounded by largest remainder and at least one; with more sources than half the resolution, the period
    grows to twice their number.
    """
    keyed = weights.where("weight > 0").select(_struct_of(F.col("source")).alias("key"), "weight")
    one = keyed.agg(F.sort_array(F.collect_list(F.struct("key", "weight"))).alias("w"), F.sum("weight").alias("total"))
    sized = one.where("size(w) > 0").withColumn("period", F.greatest(F.lit(resolution), 2 * F.size("w")))
    free = F.col("period") - F.size("w")
    exact = sized.withColumn("x", F.transform("w", lambda w: F.struct(w["key"].alias("key"), (w["weight"] / F.col("total") * free).alias("exact"))))
    ranked = exact.withColumn("r", F.sort_array(F.transform("x", lambda x: F.struct(
        (F.floor(x["exact"]) - x["exact"]).alias("less"), x["key"].alias("key"), F.floor(x["exact"]).cast("int").alias("whole")))))
    left = ranked.withColumn("left", free - F.aggregate("r", F.lit(0), lambda a, r: a + r["whole"]))
    parts = F.transform("r", lambda r, i: F.struct(
        r["key"].alias("key"), (1 + r["whole"] + F.when(i < F.col("left"), 1).otherwise(0)).cast("int").alias("part")))
    return left.select(F.sort_array(parts).alias("items"), F.col("period").cast("int").alias("period"))


def period_slots(parts: DataFrame) -> DataFrame:
    """(key, nth, slot, part, period): in which slot of the period a source's nth block runs; `period` rows in all."""
    whole = lambda c: c.cast("int")
    state = F.struct(F.transform("items", lambda x: F.lit(0)).alias("done"), F.array().cast("array<int>").alias("order"))

    def step(acc: Column, slot: Column) -> Column:
        waiting = F.transform("items", lambda x, i: F.when(
            (F.get(acc["done"], i) < x["part"]) & (whole(F.floor(F.get(acc["done"], i) * F.col("period") / x["part"])) <= slot),
            F.struct(whole(F.ceil((F.get(acc["done"], i) + 1) * F.col("period") / x["part"])).alias("due"), i.alias("at"))))
        first = F.array_min(waiting)["at"]
        return F.struct(F.transform(acc["done"], lambda n, i: n + F.when(i == first, 1).otherwise(0)).alias("done"),
                        F.concat(acc["order"], F.array(first)).alias("order"))

    order = parts.select("items", "period", F.aggregate(F.sequence(F.lit(0), F.col("period") - 1), state, step)["order"].alias("order"))
    slots = order.select("items", "period", F.posexplode("order").alias("slot", "at"))
    named = slots.select(F.get("items", F.col("at"))["key"].alias("key"), F.get("items", F.col("at"))["part"].alias("part"), "period", "slot")
    return named.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("slot")) - 1)


def blocks(docs: DataFrame, sizes: DataFrame, block_size: int = BLOCK_SIZE) -> DataFrame:
    """Rows of `docs` with `_key`, `_block` (from 0) and `_start` (characters of the source before the row).

    A large source is cut by hash into groups of bounded size; totals of the groups carry the running totals over.
    """
    order = F.xxhash64("doc_id", "text")
    counts = sizes.select(_struct_of(F.col("source")).alias("_key"), F.greatest(F.lit(1), F.expr(f"rows div {GROUP_ROWS}")).alias("_groups"))
    keyed = docs.withColumns({"_key": _struct_of(F.col("source")), "_order": order, "_size": F.coalesce(F.length("text"), F.lit(0)).cast("long")})
    grouped = keyed.join(counts, "_key").withColumn("_group", F.pmod("_order", "_groups")).drop("_groups")
    totals = grouped.groupBy("_key", "_group").agg(F.sum("_size").alias("_total"))
    before = F.sum("_total").over(Window.partitionBy("_key").orderBy("_group")) - F.col("_total")
    carried = totals.select("_key", "_group", before.alias("_before"))
    inside = Window.partitionBy("_key", "_group").orderBy("_order", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = grouped.withColumn("_inside", F.sum("_size").over(inside) - F.col("_size")).join(carried, ["_key", "_group"])
    start = F.col("_before") + F.col("_inside")
    return placed.withColumns({"_start": start, "_block": F.expr(f"(_before + _inside) div {block_size}")}).drop(
        "_group", "_before", "_inside", "_order", "_size")


def block_slots(sources: list[tuple[str, float, int]]) -> Iterator[tuple[str, int, int, int, int]]:
    """(key, block, release, deadline, slot) of all blocks of the sources (key, weight, number of blocks), slot by slot."""
    exact = [Fraction(w) for _, w, _ in sources]
    scale = lcm(*(w.denominator for w in exact))
    parts = [int(w * scale) for w in exact]
    total = sum(parts)
    ready: list[tuple[int, str, int, int, int]] = []
    coming: list[tuple[int, int, int]] = [(0, at, 0) for at, (_, _, blocks) in enumerate(sources) if blocks]
    slot = 0
    while ready or coming:
        if not ready:
            slot = max(slot, coming[0][0])
        while coming and coming[0][0] <= slot:
            release, at, block = heapq.heappop(coming)
            heapq.heappush(ready, (-(-(block + 1) * total // parts[at]), sources[at][0], at, block, release))
        due, key, at, block, release = heapq.heappop(ready)
        yield key, block, release, min(due, LAST), slot
        following = (block + 1) * total // parts[at]
        if block + 1 < sources[at][2] and following < LAST:
            heapq.heappush(coming, (following, at, block + 1))
        slot += 1


_SLOTS = pa.schema([("_key", pa.string()), ("_block", pa.int64()), ("_release", pa.int64()), ("_deadline", pa.int64()),
                    ("_slot", pa.int64()), ("_nth", pa.int64())])


def schedule(sizes: DataFrame, weights: DataFrame, block_size: int = BLOCK_SIZE) -> DataFrame:
    """(_key, _block, _release, _deadline, _slot, _nth): the window and slot of every block, and its number in their order."""
    spark = sizes.sparkSession
    keyed = weights.where("weight > 0").groupBy(_struct_of(F.col("source")).alias("_key")).agg(F.sum("weight").alias("weight"))
    # A source without rows keeps its weight; its slots stay empty.
    counts = sizes.select(_struct_of(F.col("source")).alias("_key"), F.expr(f"size div {block_size} + 1").alias("blocks"))
    sources = [(r["_key"], r["weight"], r["blocks"] or 0) for r in keyed.join(counts, "_key", "left").collect()]
    found: DataFrame | None = None
    rows: list[tuple] = []

    def out() -> DataFrame:
        columns = zip(*rows, strict=True) if rows else [()] * len(_SLOTS)
        made = spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SLOTS, strict=True)], schema=_SLOTS))
        part = stored(made, "block-slots")
        return part if found is None else found.union(part)

    for nth, row in enumerate(block_slots(sources)):
        rows.append((*row, nth))
        if len(rows) >= SLOTS:
            found, rows = out(), []
    return out() if rows or found is None else found


def scheduled(docs: DataFrame, weights: DataFrame | None = None, block_size: int = BLOCK_SIZE) -> DataFrame:
    """Rows of `docs` with `_block`, `_release`, `_deadline`, `_slot`, `_nth` and `_start`.

    `weights` is (source, weight); without it the flattened sizes are taken. Sources without a weight have null slots.
    """
    sizes = stored(source_sizes(docs), "source-sizes")
    slots = schedule(sizes, weights if weights is not None else flattened_weights(sizes), block_size)
    return blocks(docs, sizes, block_size).join(slots, ["_key", "_block"], "left").drop("_key")


def mixing_report(docs: DataFrame) -> DataFrame:
    """doc_id, source, its block with release and deadline, the slot it runs in, and the place inside the block."""
    found = scheduled(docs.select("doc_id", "source", "text"))
    return found.select("doc_id", "source", F.col("_block").alias("block"), F.col("_release").alias("release"),
                        F.col("_deadline").alias("deadline"), F.col("_slot").alias("slot"),
                        F.expr(f"_start % {BLOCK_SIZE}").alias("offset"))


def mixed(docs: DataFrame, weights: DataFrame | None = None, block_size: int = BLOCK_SIZE, file_size: int = FILE_SIZE) -> DataFrame:
    """The rows of `docs` in the order of the schedule: partition by partition, so file by file, and inside each."""
    used = ("doc_id", "source", "text")
    found = scheduled(boxed(docs, *used), weights, block_size)
    n, chars = docs.agg(F.count("*"), F.sum(F.length("text"))).first()
    last = found.agg(F.max("_nth")).first()[0] if n else None
    files = max(1, -(-(chars or 0) // file_size))
    place = F.least(F.lit(files - 1), F.expr(f"_nth * {files} div {(last or 0) + 1}").cast("int"))
    ordered = found.withColumn("_file", F.coalesce(place, F.lit(files - 1)))
    dealt = ordered.repartitionById(files, F.col("_file")).sortWithinPartitions(F.col("_slot").asc_nulls_last(), "_start", "doc_id")
    return unboxed(dealt, docs.columns, *used)
