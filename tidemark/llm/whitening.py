"""Embedding whitening by a bidiagonal qd solver.

The distinct vectors are centred exactly, and each task reduces its own to a triangle R by QR, block by block; triangles
are stacked and reduced again until one is left, whose size depends on the dimensions alone. On the driver, Householder
reflections make R bidiagonal, dqds finds its singular values, and twisted factorisations give the directions. The
covariance itself is never formed, so small values keep their digits.

* `whiten` leaves out rows whose vector is null, empty, or holds null or non-finite entries, and rows of another than
  the commonest length (of equally common ones the shorter).
* An entry c counts as floor(256 * c), as a double and held to the range of long.
* Fitted are the distinct vectors, so copies of a row weigh nothing more. Repeated and null ids are rows as others.
* A component without spread (to rounding) has null `whitened`; without any spread `explained` is null, too. A
  `deviation` beyond the range of long is null. Fewer dimensions than components give as many rows as dimensions. An
  empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidemark.llm.store import stored

COMPONENTS = 4
#: Vectors of one block.
BLOCK = 4096
#: Triangles that one task reduces to one.
FAN_IN = 16
EPS = np.finfo(float).eps
LONG = np.iinfo(np.int64)
REPORT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# ---- singular values and vectors of a triangle


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of B, and Z, with R = U B Z^T by Householder reflections."""
    a, n = np.array(r, float), r.shape[1]
    z = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        norm = np.linalg.norm(x)
        if norm == 0 or not np.any(x[1:]):
            return None
        v = x.copy()
        v[0] += norm if v[0] >= 0 else -norm
        return v / np.linalg.norm(v)

    for k in range(n):
        if (v := reflector(a[k:, k])) is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < n - 2 and (v := reflector(a[k, k + 1:])) is not None:
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ v, v)
            z[:, k + 1:] -= 2 * np.outer(z[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), z


def _sweep(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float] | None:
    """One differential qd step with a shift; None where the shift was too large. Also gives the least auxiliary value."""
    n = len(q)
    new_q, new_e = np.empty(n), np.empty(n - 1)
    d = q[0] - shift
    least = d
    for i in range(n - 1):
        if d < 0:
            return None
        new_q[i] = d + e[i]
        if new_q[i] == 0:
            new_e[i], d = 0.0, q[i + 1] - shift
        else:
            ratio = q[i + 1] / new_q[i]
            new_e[i], d = e[i] * ratio, d * ratio - shift
        least = min(least, d)
    if d < 0:
        return None
    new_q[-1] = d
    return new_q, new_e, least


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling."""
    scale = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    if scale == 0:
        return np.zeros(len(diagonal))
    found: list[float] = []
    parts = [((diagonal / scale) ** 2, (above / scale) ** 2, 0.0)]
    while parts:
        q, e, shifted = parts.pop()
        trial = 0.0
        for _ in range(200 * len(q) + 200):
            if len(q) == 1:
                break
            small = np.flatnonzero(e <= EPS ** 2 * (np.minimum(q[:-1], q[1:]) + shifted))
            if len(small):
                break
            if q[0] < q[-1] / 1.5:  # the small values are to gather at the end
                q, e = q[::-1].copy(), e[::-1].copy()
            step = _sweep(q, e, trial)
            while step is None:
                trial = trial / 4 if trial > EPS * q.min() else 0.0
                step = _sweep(q, e, trial)
            q, e, least = step
            shifted += trial
            # A lower bound of the least eigenvalue, from the part that couples least.
            trial = max(0.0, min(least, q[-1]) - np.sqrt(e[-1] * q[-1])) * 0.9 if len(e) else 0.0
        else:
            raise ArithmeticError("dqds did not end")
        if len(q) == 1:
            found.append(q[0] + shifted)
            continue
        edges = [0, *(small + 1), len(q)]
        parts += [(q[lo:hi].copy(), e[lo:hi - 1].copy(), shifted) for lo, hi in zip(edges[:-1], edges[1:], strict=True)]
    return np.sort(np.array(found))[::-1] * scale ** 2


class Twisted:
    """Twisted factorisations of B^T B - value I: from the top and from the bottom, joined where they meet best."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, value: float):
        n = len(diagonal)
        q, e, a = diagonal ** 2, above ** 2, diagonal[:-1] * above
        tiny = EPS ** 2 * max(q.max(), e.max(initial=0), np.finfo(float).tiny)
        down, up = np.empty(n), np.empty(n)
        s, p = np.empty(n), np.empty(n)
        s[0] = -value
        for i in range(n - 1):
            down[i] = s[i] + q[i]
            down[i] = down[i] if abs(down[i]) > tiny else -tiny
            s[i + 1] = e[i] * (s[i] / down[i]) - value
        down[-1] = s[-1] + q[-1]
        p[-1] = q[-1] - value
        for i in range(n - 2, -1, -1):
            up[i + 1] = p[i + 1] + e[i]
            up[i + 1] = up[i + 1] if abs(up[i + 1]) > tiny else -tiny
            p[i] = q[i] * (p[i + 1] / up[i + 1]) - value
        up[0] = p[0]
        self.lower, self.upper = a / down[:-1], a / up[1:]
        self.down, self.up = down, up
        self.gamma = s + p + value
        self.twist = int(np.argmin(np.abs(self.gamma)))
        self.tiny = tiny

    def vector(self) -> tuple[np.ndarray, float]:
        """The unit vector at the twist and the correction of the value by its Rayleigh quotient."""
        n, k = len(self.gamma), self.twist
        z = np.zeros(n)
        z[k] = 1.0
        for i in range(k - 1, -1, -1):
            z[i] = -self.lower[i] * z[i + 1]
        for i in range(k, n - 1):
            z[i + 1] = -self.upper[i] * z[i]
        square = z @ z
        return z / np.sqrt(square), self.gamma[k] / square

    def solve(self, x: np.ndarray) -> np.ndarray:
        """One step of inverse iteration for a start of its own, as close values need."""
        n, k, y = len(x), self.twist, np.array(x, float)
        for i in range(k):
            y[i + 1] -= self.lower[i] * y[i]
        for i in range(n - 1, k, -1):
            y[i - 1] -= self.upper[i - 1] * y[i]
        y[:k] /= self.down[:k]
        y[k + 1:] /= self.up[k + 1:]
        y[k] /= self.gamma[k] if abs(self.gamma[k]) > self.tiny else self.tiny
        for i in range(k - 1, -1, -1):
            y[i] -= self.lower[i] * y[i + 1]
        for i in range(k, n - 1):
            y[i + 1] -= self.upper[i] * y[i]
        top = np.abs(y).max()
        return y / np.linalg.norm(y / top) / top


def right_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray, wanted: int) -> np.ndarray:
    """Unit right singular vectors of the `wanted` largest values, as columns.

    A value away from all others has the vector of its own twisted factorisation. Vectors of values within 0.001 of each
    other are iterated together from different starts and turned so that each has its own quotient.
    """
    n = len(diagonal)
    out, k = np.zeros((n, wanted)), 0
    limit = n * EPS * values[0]
    rng = np.random.default_rng(7)
    while k < wanted:
        end = k + 1
        while end < n and values[end - 1] - values[end] <= max(1e-3 * values[end - 1], 4 * limit):
            end += 1
        if end == k + 1:
            value = values[k]
            for _ in range(3):
                z, change = Twisted(diagonal, above, value).vector()
                if abs(change) <= 4 * EPS * abs(value):
                    break
                value += change
            group = z[:, None]
        else:
            group = np.stack([Twisted(diagonal, above, values[j]).vector()[0] for j in range(k, end)], axis=1)
            group += 1e-3 * rng.standard_normal(group.shape) / np.sqrt(n)
            for _ in range(4):
                group = np.linalg.qr(group)[0]
                group = np.stack([Twisted(diagonal, above, values[k + j] * (1 + 2 * EPS * j)).solve(group[:, j]) for j in range(end - k)], axis=1)
                group = np.linalg.qr(group)[0]
                image = diagonal[:, None] * group
                image[:-1] += above[:, None] * group[1:]
                turn = np.linalg.svd(image, full_matrices=False)[2].T
                group = group @ turn
        if k:  # rounding only, but for vectors of values that are zero
            for _ in range(2):
                group = np.linalg.qr(group - out[:, :k] @ (out[:, :k].T @ group))[0]
        take = min(end, wanted) - k
        out[:, k:k + take] = group[:, :take]
        k += take
    return out


def principal(r: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """All eigenvalues of R^T R, falling, and unit eigenvectors of the `wanted` largest as columns."""
    diagonal, above, z = bidiagonal(r)
    values = dqds(diagonal, above)
    wanted = min(wanted, len(values))
    if values[0] == 0:
        return values, np.eye(len(values))[:, :wanted]
    return values, z @ right_vectors(diagonal, above, values, wanted)


# ---- vectors on Spark


@dataclass
class Fit:
    """What every row is whitened by: counts and sums of the distinct vectors, directions over root values, shares."""

    n: int
    sums: list[int]
    directions: np.ndarray
    roots: np.ndarray
    explained: np.ndarray
    error: float | None = None

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n*x - sums, exact as long as it fits a double's 53 bits or a long, and the same over n."""
        wide = self.n * max(int(np.abs(x.astype(float)).max(initial=0)), 1) + max(map(abs, self.sums), default=0)
        if wide < LONG.max // 4:
            whole = self.n * x - np.array(self.sums, np.int64)
            return whole, whole.astype(float) / self.n
        whole = self.n * x.astype(object) - np.array(self.sums, object)
        return whole, (whole / self.n).astype(float)

    def deviation(self, whole: np.ndarray) -> pa.Array:
        top = int(np.abs(whole).max(initial=0))
        if top * top * whole.shape[1] < LONG.max:
            return pa.array((whole * whole).sum(axis=1), pa.int64())
        exact = [sum(int(v) ** 2 for v in row) for row in whole]
        return pa.array([v if v <= LONG.max else None for v in exact], pa.int64())

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        """A column for each component; NaN for one without spread."""
        return np.where(self.roots > 0, centred @ self.directions / np.where(self.roots > 0, self.roots, 1), np.nan)


def levels(vector: Column) -> Column:
    """floor(256 * c) of each entry, as long."""
    return F.transform(vector, lambda c: F.floor(F.lit(256.0) * c.cast("double")).cast("long"))


def _sound(vector: Column) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _blocks(batch: pa.RecordBatch, rows: int = BLOCK) -> Iterator[pa.RecordBatch]:
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)


def _sums(distinct: DataFrame, dimensions: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sum of each dimension: partial sums of tasks, added by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dimensions
        for batch in batches:
            for part in _blocks(batch):
                x = _matrix(part.column(0))
                high, low = x >> 32, x & 0xFFFFFFFF
                total = [t + (int(h) << 32) + int(v) for t, h, v in zip(total, high.sum(axis=0), low.sum(axis=0), strict=True)]
                n += len(x)
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(-1, dimensions), pa.int32()), "total": pa.array([str(t) for t in [n, *total]])})

    rows = distinct.mapInArrow(run, "at int, total string").groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    found = {r["at"]: int(r["total"]) for r in rows}
    return found.get(-1, 0), [found.get(i, 0) for i in range(dimensions)]


def _packed(r: np.ndarray, dimensions: int) -> bytes:
    square = np.zeros((dimensions, dimensions))
    square[:len(r)] = r
    return square.tobytes()


def _merged(distinct: DataFrame, first: Callable, again: Callable, schema: str) -> list[Row]:
    """At most `FAN_IN` rows: one from each task by `first`, then one from each `FAN_IN` by `again` as often as needed."""
    rows, count = distinct.mapInArrow(first, schema), distinct.rdd.getNumPartitions()
    while count > FAN_IN:
        count = -(-count // FAN_IN)
        rows = rows.repartition(count).mapInArrow(again, schema)
    return rows.collect()


def triangle(distinct: DataFrame, fit: Fit, dimensions: int) -> np.ndarray:
    """R of the centred vectors: a triangle from each task, then from each `FAN_IN` triangles, until one is left."""
    def reduced(blocks: Iterator[np.ndarray]) -> np.ndarray:
        r = np.zeros((0, dimensions))
        for block in blocks:
            r = np.linalg.qr(np.vstack([r, block]), mode="r")
        return r

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = reduced(fit.centred(_matrix(part.column(0)))[1] for batch in batches for part in _blocks(batch))
        if len(r):
            yield pa.RecordBatch.from_pydict({"r": pa.array([_packed(r, dimensions)], pa.large_binary())})

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = reduced(np.frombuffer(x.as_py()).reshape(dimensions, dimensions) for batch in batches for x in batch.column("r"))
        if len(r):
            yield pa.RecordBatch.from_pydict({"r": pa.array([_packed(r, dimensions)], pa.large_binary())})

    held = [np.frombuffer(row["r"]).reshape(dimensions, dimensions) for row in _merged(distinct, first, again, "r binary")]
    return reduced(iter(held)) if held else np.zeros((dimensions, dimensions))


def _identity_error(distinct: DataFrame, fit: Fit) -> float | None:
    """Largest entry of the whitened vectors' covariance minus the identity, from the moments of tasks."""
    used = np.flatnonzero(fit.roots > 0)
    k = len(used)
    if not k:
        return None

    def joined(a, b):
        (n, mean, spread), (m, other, more) = a, b
        gap = other - mean
        return n + m, mean + gap * (m / (n + m)), spread + more + np.outer(gap, gap) * (n * m / (n + m))

    def moments(parts) -> Iterator[pa.RecordBatch]:
        n, mean, spread = reduce(joined, parts, (0, np.zeros(k), np.zeros((k, k))))
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n], "mean": [mean.tolist()], "spread": [spread.ravel().tolist()]})

    def own(part: pa.RecordBatch):
        w = fit.whitened(fit.centred(_matrix(part.column(0)))[1])[:, used]
        mean = w.mean(axis=0)
        return len(w), mean, (w - mean).T @ (w - mean)

    def held(row):
        return row["n"], np.array(row["mean"]), np.array(row["spread"]).reshape(k, k)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from moments(own(part) for batch in batches for part in _blocks(batch))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from moments(held(row) for batch in batches for row in batch.to_pylist())

    total = reduce(joined, map(held, _merged(distinct, first, again, "n long, mean array<double>, spread array<double>")))
    return float(np.abs(total[2] / total[0] - np.eye(k)).max())


def fitted(distinct: DataFrame, dimensions: int, components: int = COMPONENTS) -> Fit:
    """Directions and figures from the distinct vectors (one column `x` of longs, all of `dimensions` entries)."""
    n, sums = _sums(distinct, dimensions)
    wanted = min(components, dimensions)
    fit = Fit(n, sums, np.zeros((dimensions, wanted)), np.zeros(wanted), np.full(wanted, np.nan))
    r = triangle(distinct, fit, dimensions) / np.sqrt(max(n, 1))
    values, vectors = principal(r, wanted)
    values = np.where(values > (max(n, dimensions) * EPS) ** 2 * values[0], values, 0.0)
    fit.directions, fit.roots = vectors, np.sqrt(values[:wanted])
    if (trace := float((r * r).sum())) > 0:
        fit.explained = values[:wanted] / trace
    fit.error = _identity_error(distinct, fit)
    return fit


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """REPORT: each sound row's values on the first `components` components of the distinct vectors."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("v")).where(_sound(F.col("v"))).select("vec_id", levels(F.col("v")).alias("x"))
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dimensions = common[0]["d"] if common else 1
    rows = rows.where(F.size("x") == dimensions)
    distinct = stored(rows.groupBy("x").agg(F.lit(1).alias("one")).select("x"), "distinct-vectors")
    fit = fitted(distinct, dimensions, components)
    wanted = len(fit.roots)
    explained = [None if np.isnan(v) else float(v) for v in fit.explained]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _blocks(batch):
                whole, centred = fit.centred(_matrix(part.column("x")))
                m = part.num_rows
                each = pa.array(np.repeat(np.arange(m), wanted))
                yield pa.RecordBatch.from_arrays([
                    part.column("vec_id").take(each), pa.array(np.tile(np.arange(1, wanted + 1), m), pa.int32()), pa.array(np.full(m * wanted, fit.n)),
                    fit.deviation(whole).take(each), pa.array(fit.whitened(centred).ravel(), from_pandas=True), pa.array(explained * m, pa.float64()),
                    pa.array([fit.error] * (m * wanted), pa.float64())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(run, REPORT)
