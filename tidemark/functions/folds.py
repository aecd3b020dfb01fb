"""A per-key score recurrence evaluated as a parallel scan.

Each score depends on the mean of all earlier scores of its key::

    risk_n  = min((r_n + mean(score_1 .. score_n-1)) / 2, 1)      (r_n itself, capped, for n = 1)
    score_n = min(base_n + w * risk_n, 1)

so with S = the sum of the scores so far, one row maps S to S + min(a + b * S, d): the smaller of two
straight lines with positive slope. Maps of that kind can be chained without knowing S, staying the
lower envelope of a few lines, which makes long keys divisible:

1. rows are numbered per key and cut into chunks of consecutive rows;
2. each full chunk that has a successor is summarised into its envelope (in parallel);
3. per key, the few summaries are applied one after another to give every chunk its starting sum;
4. all chunks are evaluated from their starting sums (in parallel).

Keys shorter than a chunk only take step 4, which goes row number by row number over all keys of an Arrow batch at once
and hands the other columns on as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def _lower_envelope(lines: list[tuple[float, float]], top: float) -> list[tuple[float, float]]:
    """The lines that are the minimum somewhere on [0, top]."""
    best: dict[float, float] = {}
    for slope, intercept in lines:
        if slope not in best or intercept < best[slope]:
            best[slope] = intercept
    kept: list[tuple[float, float]] = []
    for slope, intercept in sorted(best.items(), reverse=True):
        while len(kept) >= 2:
            (s1, i1), (s2, i2) = kept[-2], kept[-1]
            if (intercept - i1) * (s1 - s2) <= (i2 - i1) * (s1 - slope):
                kept.pop()
            else:
                break
        kept.append((slope, intercept))
    # Going through falling slopes, a line takes over where it crosses the one before it.
    crossings = [(b[1] - a[1]) / (a[0] - b[0]) for a, b in zip(kept, kept[1:])]
    return [line for k, line in enumerate(kept)
            if (k == len(crossings) or crossings[k] >= 0.0) and (k == 0 or crossings[k - 1] <= top)]


def _summaries(weight: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, lines, top = None, [], 0.0

        def flushed():
            return pd.DataFrame([{"_key": current[0], "_chunk": current[1], "_slopes": [s for s, _ in lines],
                                  "_offsets": [o for _, o in lines]}])
        for pdf in batches:
            for key, chunk, n, base, risk in zip(pdf["_key"], pdf["_chunk"], pdf["_n"], pdf["_base"], pdf["_risk"]):
                if (key, chunk) != current:
                    if current is not None:
                        yield flushed()
                    current, lines, top = (key, chunk), [(1.0, 0.0)], float(n - 1)
                flat = min(base + weight, 1.0)
                if n == 1:
                    flat = min(base + weight * min(risk, 1.0), 1.0)
                    lines = [(s, o + flat) for s, o in lines]
                else:
                    grow = 1.0 + weight / 2 / (n - 1)
                    step = base + weight / 2 * risk
                    lines = _lower_envelope([(s * grow, o * grow + step) for s, o in lines]
                                            + [(s, o + flat) for s, o in lines], top)
        if current is not None:
            yield flushed()
    return run


def _starts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key, total = None, 0.0
    for pdf in batches:
        out = []
        for k, chunk, slopes, offsets in zip(pdf["_key"], pdf["_chunk"], pdf["_slopes"], pdf["_offsets"]):
            if k != key:
                key, total = k, 0.0
            total = min(s * total + o for s, o in zip(slopes, offsets))
            out.append((k, chunk + 1, total))
        yield pd.DataFrame(out, columns=["_key", "_chunk", "_start"])


# Below so many keys a step of all of them costs more than going through their rows one by one.
_FEW = 12


def _evaluate(firsts: np.ndarray, lengths: np.ndarray, n: np.ndarray, base: np.ndarray, risk: np.ndarray, totals: np.ndarray,
              weight: float) -> tuple[np.ndarray, np.ndarray]:
    """(risk, score) of every row; runs of rows start at ``firsts`` and ``totals`` are their sums so far, updated in place.

    One step takes the next row of every run that has one, longest runs first.
    """
    risks, scores = np.empty(len(n)), np.empty(len(n))
    order = np.argsort(-lengths, kind="stable")
    first, length, total = firsts[order], lengths[order], totals[order]
    step, active = 0, len(order)
    while active >= _FEW:
        rows = first[:active] + step
        seen = np.where(n[rows] == 1, risk[rows], (risk[rows] + total[:active] / np.maximum(n[rows] - 1, 1)) / 2)
        risks[rows] = np.minimum(seen, 1.0)
        scores[rows] = np.minimum(base[rows] + weight * risks[rows], 1.0)
        total[:active] += scores[rows]
        step += 1
        active = int(np.searchsorted(-length, -step, "left"))
    for run in range(active):
        so_far = float(total[run])
        for row in range(first[run] + step, first[run] + length[run]):
            seen = risk[row] if n[row] == 1 else (risk[row] + so_far / (n[row] - 1)) / 2
            risks[row] = min(seen, 1.0)
            scores[row] = min(base[row] + weight * risks[row], 1.0)
            so_far += scores[row]
        total[run] = so_far
    totals[order] = total
    return risks, scores


def _scores(weight: float, kept: list[str], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, carried = None, 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("_key").to_numpy(zero_copy_only=False)
            chunks, n, base, risk, start = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_chunk", "_n", "_base", "_risk", "_start"))
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (chunks[1:] != chunks[:-1])
            firsts = np.flatnonzero(new)
            lengths = np.diff(np.append(firsts, len(keys)))
            totals = start[firsts].copy()
            if current == (keys[0], chunks[0]):
                totals[0] = carried
            risks, scores = _evaluate(firsts, lengths, n, base, risk, totals, weight)
            current, carried = (keys[-1], chunks[-1]), totals[-1]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(risks), pa.array(scores)], names=[*kept, *names])
    return run


def sequential_scores(df: DataFrame, key: str, number: str, base: str, risk: str, weight: float,
                      risk_name: str, score_name: str, chunk: int = 50_000) -> DataFrame:
    """The rows of ``df`` with the risk and score of the recurrence above.

    ``number`` is the row number per key (see ``numbered_rows``), ``base`` and ``risk`` are
    non-negative. The frame is read three times, so it should be a stored one.
    """
    rows = df.withColumns({
        "_key": F.col(key), "_n": F.col(number).cast("long"), "_base": F.col(base).cast("double"),
        "_risk": F.col(risk).cast("double"), "_chunk": ((F.col(number) - 1) / F.lit(chunk)).cast("long")})
    ordered = lambda frame, *by: (frame.repartition(*[F.col(c) for c in by[:-1]])
                                  .sortWithinPartitions(*by))
    followed = rows.where((F.col("_chunk") > 0) & (F.pmod(F.col("_n") - 1, F.lit(chunk)) == 0)).select(
        "_key", (F.col("_chunk") - 1).alias("_chunk"))
    facts = rows.select("_key", "_chunk", "_n", "_base", "_risk")
    envelopes = ordered(facts.join(followed, ["_key", "_chunk"], "left_semi"), "_key", "_chunk", "_n").mapInPandas(
        _summaries(weight), "_key string, _chunk long, _slopes array<double>, _offsets array<double>")
    starts = ordered(envelopes, "_key", "_chunk").mapInPandas(_starts, "_key string, _chunk long, _start double")
    begun = rows.join(starts, ["_key", "_chunk"], "left").withColumn("_start", F.coalesce("_start", F.lit(0.0)))
    schema = StructType([*df.schema.fields, StructField(risk_name, DoubleType()), StructField(score_name, DoubleType())])
    return ordered(begun, "_key", "_chunk", "_n").mapInArrow(_scores(weight, df.columns, [risk_name, score_name]), schema)
