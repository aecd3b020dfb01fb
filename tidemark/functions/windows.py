"""Window arithmetic that stays distributed when one key holds a large share of the rows.

``Window.partitionBy(key)`` puts a whole key into one task, and a sliding range frame re-reads its
rows for every output row. The helpers here express the same results with bounded groups:

* rows are first combined per (key, second), so a task never sees more rows of a key than there are
  seconds in a block of time, however many claims share them;
* time is cut into blocks as long as the window, so that a window touches at most two of them and
  every group is (key, block) instead of key;
* only frames that grow from one side are used, which cost one step per row.

The statistics are then joined back on (key, second) with null-safe equality; adaptive execution
splits that join when a second is hot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Money adds up as whole ten-thousandths: leaving a window then undoes entering it exactly. The sums
# are checked for overflow (9e14 pounds per key and window).
_UNITS = 10_000


def block_start(at: Column, length: int) -> Column:
    """Start of the block of ``length`` seconds that contains ``at`` (also before the epoch)."""
    return at - F.pmod(at, F.lit(length))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on equality that treats nulls as equal; the right side's keys are dropped."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    condition = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def sliding_stats(df: DataFrame, keys: list[str], at: str, before: int, after: int = 0, *,
                  count: str | None = None, sums: dict[str, str] | None = None,
                  distinct: tuple[str, str] | None = None, entered: list | None = None) -> DataFrame:
    """Statistics of the rows of the same key with ``at`` in [at - before, at + after].

    Gives one row per existing (keys, at). ``count`` names the row count, ``sums`` maps output names
    to columns (summed exactly in units of a ten-thousandth, nulls ignored, given as double;
    ``<name>_n`` counts the non-null ones), ``distinct`` is (output name, column).

    Each second contributes to the outputs between ``at - after`` and ``at + before``. Entering and
    leaving that interval are a plus and a minus entry; the running total at a second is the
    window's value. A distinct item contributes from its own entry, or from where its previous
    occurrence has left, so overlapping occurrences count once. An interval is never longer than a
    block, so it reaches into one following block at most and each block is totalled on its own.
    ``entered``, if given, receives the frame that enters the running window.
    """
    sums = sums or {}
    length = before + after + 1
    rows = df.where(F.col(at).isNotNull())
    exact = {name: F.round(F.col(column) * _UNITS).cast("long") for name, column in sums.items()}
    parts = []
    for name, value in exact.items():
        parts += [F.sum(value).alias(name), F.count(value).alias(f"{name}_n")]
    totals = ["_rows", *[c for name in sums for c in (name, f"{name}_n")]]

    start = F.col(at) - after
    end = F.col(at) + before + 1
    per_item = rows
    if distinct:
        item = distinct[1]
        per_item = rows.groupBy(*keys, at, item).agg(F.count("*").alias("_rows"), *parts)
        recount = [F.sum("_rows").alias("_rows")] + [F.sum(c).alias(c) for c in totals[1:]]
        per_second = per_item.groupBy(*keys, at).agg(*recount)
    else:
        per_second = rows.groupBy(*keys, at).agg(F.count("*").alias("_rows"), *parts)
    per_second = per_second.na.fill(0, totals)
    kinds = {**{c: per_second.schema[c].dataType for c in totals}, "_items": "long"}

    def turn(block, point, values=None, probing=False):
        given = values or {}
        return F.struct(block.alias("_block"), point.alias("_point"), *[
            given.get(c, F.lit(0)).cast(kind).alias(c) for c, kind in kinds.items()], F.lit(probing).alias("_probe"))

    def spread(frame, start, end, values, probing=False, more=()):
        """Entries of one contribution per row: plus at its start, minus at its end, and plus where a block begins that
        has it running. One pass over the frame instead of one per kind of entry."""
        first, last = block_start(start, length), block_start(end, length)
        plus, minus = {c: F.col(c) for c in values}, {c: -F.col(c) for c in values}
        turns = [turn(first, start, plus, probing), turn(last, end, minus), *more]
        return frame.select(*keys, F.inline(F.when(first < last, F.array(*turns, turn(last, last, plus))).otherwise(F.array(*turns))))

    # Where a second's own entry starts at the second itself, it also reads the total there.
    probe = [] if after == 0 else [turn(block_start(F.col(at), length), F.col(at), probing=True)]
    sheets = [spread(per_second, start, end, totals, after == 0, probe)]
    if distinct:
        seen = Window.partitionBy(*keys, item).orderBy(at)
        gone = F.lag(at).over(seen) + before + 1
        visible = (per_item.where(F.col(item).isNotNull())
                   .select(*keys, at, F.greatest(start, gone).alias("_from")).withColumn("_items", F.lit(1).cast("long")))
        # Combined per point before the window: many items that change at one second are one row there.
        combined = (spread(visible, F.col("_from"), end, ["_items"]).groupBy(*keys, "_block", "_point")
                    .agg(F.sum("_items").alias("_items")))
        sheets.append(combined.select("*", *[F.lit(0).cast(kinds[c]).alias(c) for c in totals], F.lit(False).alias("_probe")))
    sheet = reduce(DataFrame.unionByName, sheets)
    if entered is not None:
        entered.append(sheet)

    running = (Window.partitionBy(*keys, "_block").orderBy("_point")
               .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    out = sheet.select(*keys, F.col("_point").alias(at), "_probe",
                       *[F.sum(c).over(running).alias(c) for c in [*totals, "_items"]]).where("_probe")
    columns = []
    if count:
        columns.append(F.col("_rows").alias(count))
    for name in sums:
        columns += [(F.col(name) / F.lit(float(_UNITS))).alias(name), F.col(f"{name}_n")]
    if distinct:
        columns.append(F.col("_items").alias(distinct[0]))
    return out.select(*keys, at, *columns)


def sliding_extremes(df: DataFrame, keys: list[str], at: str, before: int, after: int,
                     aggregates: dict[str, tuple[str, str | None]]) -> DataFrame:
    """Like ``sliding_stats`` for any aggregates that combine: ``{"top": ("max", "amount")}``.

    Kinds are count, sum, max and min. The window [lo, hi] is exactly one block long, so it is the
    end of lo's block joined to the beginning of hi's block (or one whole block): a running value
    from the back, read at lo, combined with a running value from the front, read at hi. Nothing is
    subtracted, so maxima work and doubles do not cancel. ``after`` may be negative to exclude the
    current second (``after=-1``).
    """
    length = before + after + 1
    kinds = {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}
    rows = df.where(F.col(at).isNotNull())
    first = {
        name: (F.count(F.col(column) if column else F.lit(1)) if kind == "count" else kinds[kind](column)).alias(name)
        for name, (kind, column) in aggregates.items()
    }
    per_second = rows.groupBy(*keys, at).agg(*first.values())
    names = list(aggregates)
    def entry(point, side=None):
        """A second's own values, or where a window of it is read on one side. All three come from one pass."""
        values = [F.col(n) if side is None else F.lit(None).cast(per_second.schema[n].dataType).alias(n) for n in names]
        return F.struct(block_start(point, length).alias("_block"), point.alias("_point"),
                        (F.lit(None) if side is None else F.col(at)).cast("bigint").alias("_for"),
                        F.lit(side).cast("string").alias("_side"), *values)

    sheet = per_second.select(*keys, F.inline(F.array(
        entry(F.col(at)), entry(F.col(at) - before, "lo"), entry(F.col(at) + after, "hi"))))
    group = Window.partitionBy(*keys, "_block")
    upward = group.orderBy("_point").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    downward = group.orderBy(F.desc("_point")).rangeBetween(Window.unboundedPreceding, Window.currentRow)

    def read(name):
        combine = kinds[aggregates[name][0]]
        return (F.when(F.col("_side") == "hi", combine(name).over(upward))
                .otherwise(combine(name).over(downward)).alias(name))

    halves = sheet.select(*keys, "_for", "_side", "_block", "_point", *[read(n) for n in names]).where("_for IS NOT NULL")
    # A window that is one whole block is already complete on its lo side.
    whole = (F.col("_side") == "hi") & (F.col("_point") - F.col("_block") == length - 1)
    merged = halves.where(~whole).groupBy(*keys, F.col("_for").alias(at)).agg(
        *[kinds[aggregates[n][0]](n).alias(n) for n in names])
    zeros = {n: 0 for n, (kind, _) in aggregates.items() if kind == "count"}
    return merged.na.fill(zeros) if zeros else merged


def running_stats(df: DataFrame, keys: list[str], at: str, ties: list[str], bucket: int,
                  aggregates: dict[str, tuple[str, Column | None]]) -> DataFrame:
    """Running aggregates per key in the order of (at, ties), the current row included.

    Rows are windowed within (key, time bucket); the totals of earlier buckets, one row per
    (key, bucket), are accumulated apart and added. Kinds are count, sum, max and min.
    """
    kinds = {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}
    # Keys and bucket as one value that is never null: the rows are exchanged for the window only, the join takes them as they lie.
    bucketed = df.withColumn("_bucket", F.coalesce(block_start(F.col(at), bucket), F.lit(-(2 ** 62))))
    place = F.struct(*keys, "_bucket").alias("_place")
    inner = {name: (F.lit(1).cast("long") if value is None else value) for name, (_, value) in aggregates.items()}
    local = (Window.partitionBy("_place").orderBy(at, *ties)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = bucketed.groupBy(*keys, "_bucket").agg(
        *[kinds[kind](inner[name]).alias(f"_c_{name}") for name, (kind, _) in aggregates.items()])
    carried = carried.select(place, *[
        kinds[kind](f"_c_{name}").over(earlier).alias(f"_c_{name}") for name, (kind, _) in aggregates.items()])
    placed = bucketed.select(*df.columns, place)
    within = placed.withColumns({name: kinds[kind](inner[name]).over(local) for name, (kind, _) in aggregates.items()})
    joined = within.join(carried, "_place", "left")

    def combine(name, kind):
        here, there = F.col(name), F.col(f"_c_{name}")
        if kind in ("count", "sum"):
            return F.coalesce(here + there, here, there)
        return F.greatest(here, there) if kind == "max" else F.least(here, there)

    return (joined.withColumns({name: combine(name, kind) for name, (kind, _) in aggregates.items()})
            .drop("_place", *[f"_c_{name}" for name in aggregates]))


def numbered_rows(df: DataFrame, keys: list[str], at: str, ties: list[str], bucket: int, name: str) -> DataFrame:
    """Row number per key in the order of (at, ties), without gathering a key."""
    return running_stats(df, keys, at, ties, bucket, {name: ("count", None)})


def with_previous(df: DataFrame, keys: list[str], number: str, steps: int, columns: dict[str, str],
                  chunk: int = 100_000) -> DataFrame:
    """Add, as arrays named by ``columns``, a column's values on the last ``steps`` rows and this one.

    ``number`` must be the row number per key. Rows go to chunks of consecutive numbers; the last
    ``steps`` rows of a chunk also visit the next one, so every row meets its predecessors there.
    """
    own = ((F.col(number) - 1) / F.lit(chunk)).cast("long")
    near_end = F.pmod(F.col(number) - 1, F.lit(chunk)) >= chunk - steps
    spread = df.withColumn("_chunk", F.explode(F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))))
    w = Window.partitionBy(*keys, "_chunk").orderBy(number).rowsBetween(-steps, 0)
    return (spread.withColumns({out: F.collect_list(column).over(w) for out, column in columns.items()})
            .where(F.col("_chunk") == own).drop("_chunk"))


def neighbour(df: DataFrame, keys: list[str], at: str, ties: list[str], bucket: int, columns: dict[str, str],
              forward: bool = False) -> DataFrame:
    """Add a column's value on the previous (or, ``forward``, the next) row of the key.

    The order is (at, ties). Neighbours inside a time bucket come from a window on (key, bucket); at
    its edge the nearest earlier bucket's outermost row, one per (key, bucket), is carried over.
    """
    bucketed = df.withColumn("_bucket", F.coalesce(block_start(F.col(at), bucket), F.lit(-(2 ** 62))))
    values = F.struct(*[F.col(c).alias(out) for out, c in columns.items()])
    local = Window.partitionBy(*keys, "_bucket").orderBy(at, *ties)
    edge = (F.min_by if forward else F.max_by)(values, F.struct(at, *ties)).alias("_edge")
    buckets = Window.partitionBy(*keys).orderBy("_bucket")
    carried = bucketed.groupBy(*keys, "_bucket").agg(edge).withColumn(
        "_edge", (F.lead if forward else F.lag)("_edge").over(buckets))
    within = bucketed.withColumn("_near", (F.lead if forward else F.lag)(values).over(local))
    return (null_safe_join(within, carried, [*keys, "_bucket"])
            .withColumn("_near", F.coalesce("_near", "_edge"))
            .select(*df.columns, *[F.col(f"_near.{out}").alias(out) for out in columns]))
