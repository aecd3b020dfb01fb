"""Quality rules: plain limits, then robust multivariate outliers per language and source.

For every (language, source) the minimum-covariance-determinant estimate of the transformed statistics is found
by concentration steps over all rows: start from medians and deviations, keep the three quarters nearest by
Mahalanobis distance, take their mean and covariance, and repeat. A row is rejected if its distance to the final,
reweighted estimate is beyond a chi-square limit.

* A null or empty text has no words; fewer than `min_words` words fail the base rule.
* A null language or source is a group of its own. A group of fewer than `min_rows` rows that pass the base rules is
  judged by the estimate over all rows of its language, and where these are too few, over all rows of the table.
* Equal rows get equal verdicts; further columns pass through `judged`.
* Each spread has a floor of the noise of counting, so a statistic that is zero in most rows does not reject each text
  in which it is not.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes
from tidemark.llm.store import boxed, stored, unboxed

MIN_WORDS = 50
MAX_REPEATED = 50
MIN_ROWS = 200
#: Share of the rows the determinant is minimised over, and the number of concentration steps.
SHARE = 0.75
STEPS = 4
#: Least standard deviation of each transformed statistic: the noise of counting in a text of some 300 words, where the
#: square root of a share of n has a deviation of 0.5 / sqrt(n), and a repeat covers six words. Beyond it the rows decide.
FLOORS = [0.01, 0.03, 0.06, 0.06]
#: Added to the lines of a text, so that one repeated line of a few is no outlier.
FEW_LINES = 8
#: 0.99999 and 0.975 quantiles of chi-square with four degrees of freedom.
REJECT = 28.473
REWEIGH = 11.143
N = len(FLOORS)

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: The reported statistics and the number of lines that are not blank.
MEASURED = [*STATISTICS, "n_lines"]

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LEAD = (np.arange(256) & 0xC0) != 0x80


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of set flags between consecutive offsets."""
    places = np.flatnonzero(flags)
    return np.diff(np.searchsorted(places, offsets))


def _repeated(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per document: words inside three-word windows that occur twice or more in it."""
    out = np.zeros(len(first) - 1, dtype=np.int64)
    windows, at = textbytes.shingles(words, first, 3)
    for d in np.flatnonzero(np.diff(first) > 3):
        own = windows[at[d]:at[d + 1]]
        order = np.argsort(own, kind="stable")
        ranked = own[order]
        same = ranked[1:] == ranked[:-1]
        if same.any():
            again = np.zeros(len(own), dtype=bool)
            again[order[1:][same]] = True
            again[order[:-1][same]] = True
            covered = np.zeros(len(own) + 2, dtype=bool)
            covered[:-2] |= again
            covered[1:-1] |= again
            covered[2:] |= again
            out[d] = covered.sum()
    return out


def _lines(texts: list[str | None]) -> np.ndarray:
    """Per text: lines that are not blank, and those of them that repeat an earlier one."""
    out = np.zeros((len(texts), 2), dtype=np.int64)
    for at, text in enumerate(texts):
        filled = [line for line in (text or "").split("\n") if line.strip(" \t\n\x0b\f\r")]
        out[at] = len(filled), len(filled) - len(set(filled))
    return out


def statistics(text: pa.Array) -> list[pa.Array]:
    """The base statistics of a text column, as in `MEASURED`."""
    found: list[list[np.ndarray]] = [[], [], [], [], []]
    for part in textbytes.slices(text):
        starts, ends, first = part.words()
        words = textbytes.word_hashes(part.data, starts, ends)
        found[0].append(np.diff(first))
        found[1].append(_sums(_LEAD[part.data] & ~textbytes.SPACE[part.data], part.offsets))
        found[2].append(_sums(_SYMBOL[part.data], part.offsets))
        found[3].append(_repeated(words, first))
        found[4].append(_lines(text.slice(part.first, part.n).to_pylist()))
    n_words, chars, symbols, repeated = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in found[:4])
    lines, same = np.concatenate(found[4]).T if found[4] else np.zeros((2, 0), np.int64)
    return [pa.array(x.astype(np.int64)) for x in (n_words, chars, symbols, same, repeated, lines)]


def with_statistics(docs: DataFrame, keep_text: bool) -> DataFrame:
    """Append the base statistics (under `_q_` names, so that no column of the input clashes)."""
    kept = [c for c in docs.columns if keep_text or c != "text"]
    named = [f"_q_{name}" for name in MEASURED]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept), *(f"{c} bigint" for c in named)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            text = batch.column(batch.schema.get_field_index("text"))
            yield pa.RecordBatch.from_arrays([*columns, *statistics(text)], names=[*kept, *named])

    return docs.mapInArrow(run, schema)


def base_failed(min_words: int = MIN_WORDS, max_repeated: int = MAX_REPEATED) -> Column:
    words = F.col("_q_n_words")
    return (words < min_words) | (100 * F.col("_q_n_repeat_words") > max_repeated * words)


def vector() -> Column:
    """The transformed statistics: log of the mean word length, and square roots of the symbols for each word, the
    repeated among the lines and among the words, whose spread hardly depends on their size. Length itself is no fault
    and left out."""
    words = F.greatest(F.col("_q_n_words"), F.lit(1)).cast("double")
    return F.array(F.log(F.greatest(F.col("_q_word_chars"), F.lit(1)) / words), F.sqrt(F.col("_q_n_symbols") / words),
                   F.sqrt(F.col("_q_n_dup_lines") / (F.col("_q_n_lines") + FEW_LINES)), F.sqrt(F.col("_q_n_repeat_words") / words))


def _estimate(moments: DataFrame, name: str, factor: float) -> DataFrame:
    """Mean and inverse covariance of each group from its sums; one small row per group."""
    pairs = [(i, j) for i in range(N) for j in range(i, N)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            means, inverses = [], []
            for n, first, second in zip(frame["n"], frame["first"], frame["second"], strict=True):
                mean = np.asarray(first) / n
                cov = np.zeros((N, N))
                for (i, j), s in zip(pairs, second, strict=True):
                    cov[i, j] = cov[j, i] = s / n - mean[i] * mean[j]
                cov = cov * factor
                spread = np.sqrt(np.maximum(np.diag(cov), 0))
                cov[np.diag_indices(N)] += np.maximum(np.square(FLOORS) - np.square(spread), 1e-4 * np.square(FLOORS))
                means.append(mean)
                inverses.append(np.linalg.inv(cov).ravel())
            yield pd.DataFrame({"_group": frame["_group"], f"{name}_mean": means, f"{name}_inverse": inverses})

    return moments.mapInPandas(run, f"_group string, {name}_mean array<double>, {name}_inverse array<double>")


def _distance(name: str) -> Column:
    """Squared Mahalanobis distance of `_v` from an estimate."""
    apart = [F.get("_v", F.lit(i)) - F.get(f"{name}_mean", F.lit(i)) for i in range(N)]
    terms = [apart[i] * apart[j] * F.get(f"{name}_inverse", F.lit(i * N + j)) for i in range(N) for j in range(N)]
    return reduce(lambda a, b: a + b, terms)


def _moments(rows: DataFrame) -> DataFrame:
    at = lambda i: F.get("_v", F.lit(i))
    return rows.groupBy("_group").agg(
        F.count("*").alias("n"), F.array(*(F.sum(at(i)) for i in range(N))).alias("first"),
        F.array(*(F.sum(at(i) * at(j)) for i in range(N) for j in range(i, N))).alias("second"))


def groups(rows: DataFrame, min_rows: int) -> DataFrame:
    """(_lang, _source, _group, _within): the group whose estimate judges these rows, and all groups they are counted in."""
    counted = rows.groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source")).agg(F.count("*").alias("_n"))
    own = F.concat(F.lit("s"), F.to_json(F.struct("_lang", "_source")))
    of_lang = F.concat(F.lit("l"), F.to_json(F.struct("_lang")))
    by_lang = counted.groupBy("_lang").agg(F.sum("_n").alias("_m"), (F.min("_n") < min_rows).alias("_some")).select(
        F.col("_lang").alias("_l"), "_m", "_some")
    last = by_lang.agg((F.min("_m") < min_rows).alias("_few"))
    judged = F.when(F.col("_n") >= min_rows, own).when(F.col("_m") >= min_rows, of_lang).otherwise(F.lit("all"))
    within = F.array_compact(F.array(F.when(F.col("_n") >= min_rows, own), F.when(F.col("_some") & (F.col("_m") >= min_rows), of_lang),
                                     F.when(F.col("_few"), F.lit("all"))))
    return counted.join(by_lang, F.col("_lang").eqNullSafe(F.col("_l")), "left").join(last, F.lit(True), "left").select(
        "_lang", "_source", judged.alias("_group"), within.alias("_within"))


def estimates(rows: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Per (lang, source): mean and inverse covariance to judge by. `rows` has lang, source and `_v`, base rules passed."""
    named = stored(groups(rows, min_rows), "quality-groups")
    on = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    grouped = stored(rows.join(named, on).select(F.explode("_within").alias("_group"), "_v"), "quality-vectors")
    middle = grouped.groupBy("_group").agg(F.array(*(F.percentile_approx(F.get("_v", F.lit(i)), 0.5, 1000) for i in range(N))).alias("_m"))
    near = grouped.join(F.broadcast(middle), "_group").select("_group", "_v", *(
        F.abs(F.get("_v", F.lit(i)) - F.get("_m", F.lit(i))).alias(f"_a{i}") for i in range(N)), "_m")
    spread = near.groupBy("_group").agg(
        F.first("_m").alias("e_mean"),
        F.array(*(F.greatest(1.4826 * F.percentile_approx(f"_a{i}", 0.5, 1000), F.lit(FLOORS[i])) for i in range(N))).alias("_s"))
    zero = F.lit(0.0)
    found = spread.select("_group", "e_mean", F.array(*(
        1 / F.pow(F.get("_s", F.lit(i)), 2) if i == j else zero for i in range(N) for j in range(N))).alias("e_inverse"))
    for _ in range(STEPS):
        found = stored(found, "quality-estimate")
        measured = grouped.join(found, "_group").select("_group", "_v", _distance("e").alias("_d"))
        limit = measured.groupBy("_group").agg(F.percentile_approx("_d", SHARE, 1000).alias("_limit"))
        inner = measured.join(F.broadcast(limit), "_group").where(F.col("_d") <= F.col("_limit"))
        found = _estimate(_moments(inner), "e", 1.0)
    found = stored(found, "quality-estimate")
    # The inner rows' covariance is too small: scale it so that the median distance is that of chi-square (3.357).
    measured = grouped.join(found, "_group").select("_group", "_v", _distance("e").alias("_d"))
    scale = measured.groupBy("_group").agg((F.percentile_approx("_d", 0.5, 1000) / 3.357).alias("_scale"))
    inner = measured.join(F.broadcast(scale), "_group").where(F.col("_d") <= REWEIGH * F.greatest("_scale", F.lit(1.0)))
    final = _estimate(_moments(inner), "e", 1.0)
    return stored(named.drop("_within").join(final, "_group", "left"), "quality-final")


def verdicts(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Add `_failed`, `_d` (squared distance) and `_kept` to rows with statistics."""
    on = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    joined = rows.withColumns({"_failed": base_failed(), "_v": vector()}).join(found, on, "left")
    far = F.coalesce(_distance("e"), F.lit(0.0))
    return joined.withColumn("_d", far).withColumn("_kept", ~F.col("_failed") & (F.col("_d") <= REJECT))


def passing(rows: DataFrame) -> DataFrame:
    return rows.where(~base_failed()).select("lang", "source", vector().alias("_v"))


def quality_report(docs: DataFrame) -> DataFrame:
    rows = stored(with_statistics(docs.select("doc_id", "lang", "source", "text"), keep_text=False), "quality-statistics")
    judged = verdicts(rows, estimates(passing(rows)))
    return judged.select("doc_id", *(F.col(f"_q_{n}").alias(n) for n in STATISTICS),
                         F.col("_failed").alias("base_failed"), F.col("_kept").alias("kept"), F.col("_d").alias("distance"))


def _triple(lang: str = "lang", source: str = "source", text: str = "text") -> Column:
    """A 128-bit key of language, source and text; a null text is an empty one, other nulls are values of their own."""
    part = lambda c: F.when(F.col(c).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(c)))
    return F.md5(F.concat_ws("\x00", part(lang), part(source), F.coalesce(F.col(text), F.lit(""))).cast("binary"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that pass, with their own columns.

    A verdict depends on language, source and text alone. So only these go through Python, once and into statistics; the
    keys that pass are stored and the rows look theirs up, and equal rows share one key.
    """
    keyed = docs.select("lang", "source", "text", _triple().alias("_q_key"))
    rows = stored(with_statistics(keyed, keep_text=False), "quality-statistics")
    passed = stored(verdicts(rows, estimates(passing(rows))).where("_kept").select("_q_key").distinct(), "quality-passed")
    used = ("lang", "source", "text")
    marked = boxed(docs, *used).withColumn("_q_key", _triple())
    return unboxed(marked.join(passed, "_q_key", "left_semi"), docs.columns, *used)
