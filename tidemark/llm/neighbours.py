"""Approximate nearest neighbours by stable projections in kd-trees with a chi-square stopping test.

Vectors are projected to `m` Gaussian (2-stable) coordinates: the squared distance there, over the true one, follows
chi-square with m degrees of freedom. A query takes the cells of a kd-tree over projected points in order of distance,
verifies their points with the true distance, and stops when the next cell is so far that a closer neighbour than the
k-th found so far would lie beyond it with a chance of at most 1 - confidence.

A top tree of at most `MAX_CELLS` cells (from a bounded sample; every row is assigned) deals the rows to blocks of
bounded size, and each block builds a tree of its own. A query is searched in its own block first, which bounds its k-th
distance, and then in every block whose cell that bound reaches.

* Vectors that are null, zero, or hold null or non-finite components take no part, nor do those of another length
  than the most frequent one (ties: the longer). Rows without an id take no part.
* Rows with the same id are one row, the smallest vector of them. Equal distances go to the smaller id.
* A query with fewer candidates than k gets all of them. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.store import stored

K = 10
QUERY_EVERY = 100
DIMENSIONS = 8
#: 0.98 quantile of chi-square with 8 degrees of freedom: the chance that the test stops before a true neighbour is 2 %.
STOP = 18.168
SEED = 5
ROUNDING = 1e-9
SAMPLE_ROWS = 20_000
MAX_CELLS = 256
BLOCK_ROWS = 8192
LEAF_ROWS = 64
#: Queries searched together in a block; more of them meet the block in further groups.
QUERY_ROWS = 4096

_FOUND = "query_id bigint, vec_id bigint, score double"


def projection(length: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((length, DIMENSIONS))


class TopTree:
    """Median splits of a sample; `cell` finds the leaf of projected points."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.depth = max(0, int(cells).bit_length() - 1)
        self.axis = np.zeros(1 << self.depth, np.int64)
        self.value = np.zeros(1 << self.depth)
        groups = [sample]
        for level in range(self.depth):
            following = []
            for i, points in enumerate(groups):
                node = (1 << level) + i
                if len(points):
                    self.axis[node] = int(np.argmax(np.ptp(points, axis=0)))
                    self.value[node] = float(np.median(points[:, self.axis[node]]))
                right = points[:, self.axis[node]] > self.value[node]
                following += [points[~right], points[right]]
            groups = following

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + (points[np.arange(len(points)), self.axis[node]] > self.value[node])
        return node - (1 << self.depth)


class Block:
    """kd-tree over the projected points of a block, kept as its leaves: boxes and the points in them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, matrix: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.points = vectors @ matrix
        self.leaves: list[np.ndarray] = []
        stack = [np.arange(len(ids))]
        while stack:
            own = stack.pop()
            low, high = self.points[own].min(axis=0), self.points[own].max(axis=0)
            axis = int(np.argmax(high - low))
            if len(own) <= LEAF_ROWS or high[axis] == low[axis]:
                self.leaves.append(own)
                continue
            half = len(own) // 2
            order = own[np.argpartition(self.points[own, axis], half)]
            stack += [order[:half], order[half:]]
        self.low = np.array([self.points[x].min(axis=0) for x in self.leaves])
        self.high = np.array([self.points[x].max(axis=0) for x in self.leaves])

    def search(self, query_id: int, vector: np.ndarray, point: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the up to K nearest within the stopping test; `bound`: a k-th distance known already."""
        outside = np.maximum(np.maximum(self.low - point, point - self.high), 0.0)
        distance = (outside * outside).sum(axis=1)
        order = np.argsort(distance, kind="stable")
        ids, scores = np.zeros(0, np.int64), np.zeros(0)
        limit, at, step = bound, 0, 2
        while at < len(order) and distance[order[at]] <= reach(limit, point):
            leaves = order[at:at + step]
            own = np.concatenate([self.leaves[i] for i in leaves[distance[leaves] <= reach(limit, point)]])
            at, step = at + step, min(64, step * 2)
            apart = self.points[own] - point
            own = own[((apart * apart).sum(axis=1) <= reach(limit, point)) & (self.ids[own] != query_id)]
            if not len(own):
                continue
            apart = self.vectors[own] - vector
            ids = np.concatenate([ids, self.ids[own]])
            scores = np.concatenate([scores, np.sqrt((apart * apart).sum(axis=1))])
            best = np.lexsort((ids, scores))[:K]
            ids, scores = ids[best], scores[best]
            if len(ids) == K:
                limit = min(limit, scores[-1])
        return ids, scores


def reach(limit: float, point: np.ndarray) -> float:
    """Squared projected distance up to which a neighbour within `limit` is looked for, and a little for rounding."""
    return STOP * limit * limit + ROUNDING * (1.0 + float(point @ point))


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0)).select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def assigned(rows: DataFrame, tree: TopTree, length: int) -> DataFrame:
    """Add `cell`, the leaf of the top tree that holds the projected vector."""
    matrix = projection(length)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield frame.assign(cell=tree.cell(_stack(frame["vector"]) @ matrix))

    return rows.mapInPandas(run, "vec_id bigint, vector array<double>, cell bigint")


def nearest(embeddings: DataFrame, every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the K nearest rows of each row whose id is divisible by `every`."""
    spark = embeddings.sparkSession
    rows = stored(usable(embeddings), "vectors")
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if lengths is None:
        return empty
    length, total = lengths
    rows = rows.where(F.size("vector") == length)
    matrix = projection(length)
    sample = rows.orderBy(F.xxhash64("vec_id")).limit(SAMPLE_ROWS).select("vector").toPandas()
    cells = 1 << min(MAX_CELLS.bit_length() - 1, max(0, (total // BLOCK_ROWS)).bit_length())
    tree = TopTree(_stack(sample["vector"]) @ matrix, cells)
    placed = assigned(rows, tree, length)
    # At most MAX_CELLS rows: how many blocks each cell is dealt to.
    counts = placed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    blocks = {r["cell"]: r["blocks"] for r in counts.collect()}
    dealt = F.array(*(F.lit(blocks.get(c, 1)) for c in range(cells)))
    part = F.pmod(F.xxhash64("vec_id"), F.get(dealt, F.col("cell").cast("int"))).cast("int")
    data = stored(placed.withColumn("part", part), "vector-blocks")

    def own_block(frame: pd.DataFrame) -> pd.DataFrame:
        ids, vectors = frame["vec_id"].to_numpy(), _stack(frame["vector"])
        block = Block(ids, vectors, matrix)
        queries = np.flatnonzero(ids % every == 0)
        return _found((ids[i], *block.search(ids[i], vectors[i], block.points[i], np.inf)) for i in queries)

    first = stored(data.groupBy("cell", "part").applyInPandas(own_block, _FOUND), "neighbours-near")
    bounds = first.groupBy("query_id").agg(F.when(F.count("*") >= K, F.max("score")).alias("bound"))
    queries = data.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector", "cell", "part")
    queries = stored(queries.join(bounds, "query_id", "left"), "neighbour-queries")
    groups = max(1, -(-queries.count() // QUERY_ROWS))

    boxes = _boxes(data, length)
    asked = queries.mapInPandas(_reach(boxes, blocks, matrix), "query_id bigint, vector array<double>, bound double, cell bigint, part int")
    asked = asked.withColumn("q", F.pmod(F.xxhash64("query_id"), F.lit(groups)))
    spread = data.withColumn("q", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))))

    def other_block(frame: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(frame) or not len(asked):
            return _found(())
        block = Block(frame["vec_id"].to_numpy(), _stack(frame["vector"]), matrix)
        return _found((i, *block.search(i, np.asarray(v, np.float64), np.asarray(v, np.float64) @ matrix, np.inf if np.isnan(b) else b))
                      for i, v, b in zip(asked["query_id"], asked["vector"], asked["bound"], strict=True))

    keys = ["cell", "part", "q"]
    further = spread.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(other_block, _FOUND)
    ranked = first.unionByName(further).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= K).select("query_id", "rank", "vec_id", "score")


def _found(results) -> pd.DataFrame:
    rows = [(np.full(len(ids), query, np.int64), ids, scores) for query, ids, scores in results]
    columns = [np.concatenate(x) for x in zip(*rows, strict=True)] if rows else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))


def _boxes(data: DataFrame, length: int) -> pd.DataFrame:
    """Projected bounds of each cell; at most MAX_CELLS rows come to the driver."""
    matrix = projection(length)
    names = [f"{side}{i}" for side in ("low", "high") for i in range(DIMENSIONS)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                points = pd.DataFrame(_stack(frame["vector"]) @ matrix).assign(cell=frame["cell"].to_numpy()).groupby("cell")
                both = np.hstack([points.min().to_numpy(), points.max().to_numpy()])
                yield pd.DataFrame(both, columns=names).assign(cell=points.min().index)

    partial = data.select("vector", "cell").mapInPandas(run, ", ".join(f"{n} double" for n in names) + ", cell bigint")
    return partial.groupBy("cell").agg(*(F.min(n).alias(n) for n in names[:DIMENSIONS]), *(F.max(n).alias(n) for n in names[DIMENSIONS:])).toPandas()


def _reach(boxes: pd.DataFrame, blocks: dict[int, int], matrix: np.ndarray):
    """Each query once for every block of the cells it reaches, but for its own block."""
    low = boxes[[f"low{i}" for i in range(DIMENSIONS)]].to_numpy()
    high = boxes[[f"high{i}" for i in range(DIMENSIONS)]].to_numpy()
    cells = boxes["cell"].to_numpy()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for query, vector, cell, part, bound in zip(frame["query_id"], frame["vector"], frame["cell"], frame["part"], frame["bound"], strict=True):
                point = np.asarray(vector, np.float64) @ matrix
                outside = np.maximum(np.maximum(low - point, point - high), 0.0)
                near = (outside * outside).sum(axis=1) <= reach(np.inf if np.isnan(bound) else bound, point)
                rows += [(query, vector, bound, c, p) for c in cells[near] for p in range(blocks[c]) if (c, p) != (cell, part)]
            yield pd.DataFrame(rows, columns=["query_id", "vector", "bound", "cell", "part"])

    return run
