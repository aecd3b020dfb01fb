"""Starting, stopping, restarting and watching named streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.monitoring import progress_rows


class StreamGroup:
    """Named queries with the functions that start them.

    A restarted query goes on from its checkpoint, so the starting function must use the same one.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._starters: dict[str, Callable[[], StreamingQuery]] = {}
        self._queries: dict[str, StreamingQuery] = {}

    def start(self, name: str, starter: Callable[[], StreamingQuery]) -> StreamingQuery:
        if name in self._queries and self._queries[name].isActive:
            raise ValueError(f"{name} is already running")
        self._starters[name] = starter
        self._queries[name] = starter()
        return self._queries[name]

    def stop(self, name: str) -> bool:
        """Stop a query; false if it was not running."""
        query = self._queries[name]
        running = query.isActive
        query.stop()
        return running

    def restart(self, name: str) -> StreamingQuery:
        self.stop(name)
        return self.start(name, self._starters[name])

    def await_all(self, seconds: int = 600) -> None:
        """Wait until every query has ended; one that still runs after ``seconds`` is an error."""
        for name, query in self._queries.items():
            if not query.awaitTermination(seconds):
                raise TimeoutError(f"{name} still runs after {seconds} seconds")

    def status(self) -> list[dict]:
        """Name, activity, message and batches so far of each query."""
        out = []
        for name, query in self._queries.items():
            last = query.lastProgress
            out.append({"name": name, "active": query.isActive, "message": query.status["message"],
                        "batch": last["batchId"] if last else None,
                        "error": str(query.exception()) if query.exception() else None})
        return out

    def metrics(self) -> DataFrame:
        """The reported progress of all queries as metric points."""
        return record_stream_metrics(self.spark, *self._queries.values())


def record_stream_metrics(spark: SparkSession, *queries: StreamingQuery) -> DataFrame:
    """Progress reports of the queries as metric points (name, value, ts, tags).

    Spark keeps the latest reports of a query only (100 by default), so call it more often than that.
    """
    rows = [row for query in queries for progress in query.recentProgress for row in progress_rows(progress)]
    points = [(r["name"], r["value"], r["ts"], r["tags"]) for r in rows]
    frame = spark.createDataFrame(points, "name string, value double, ts string, tags map<string,string>")
    return frame.withColumn("ts", frame["ts"].cast("timestamp"))
