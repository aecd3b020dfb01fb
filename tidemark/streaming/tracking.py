"""Per-holder score tracking with arbitrary state."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.config import FraudConfig

OUTPUT = ("policyholder_id string, claim_id string, claim_number long, fraud_score double, recent_mean double, "
          "blacklists_holder boolean")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 86_400_000

Claim = tuple[int, str, float | None]


def _rank(claim: Claim) -> tuple:
    """Incident time, then claim id; nulls last."""
    at, claim_id, _ = claim
    return at is None, at or 0, claim_id is None, claim_id or ""


class Runs:
    """Claims in order without holding them all: sorted runs lie as blocks in map state and are merged block by block."""

    def __init__(self, blocks, run_rows: int, block_rows: int):
        self.blocks, self.run_rows, self.block_rows = blocks, run_rows, block_rows

    def ordered(self, claims: Iterable[Claim]) -> Iterator[Claim]:
        run, held = 0, []
        for claim in claims:
            held.append(claim)
            if len(held) == self.run_rows:
                self._store(run, held)
                run, held = run + 1, []
        held.sort(key=_rank)
        yield from heapq.merge(*(self._stored(n) for n in range(run)), held, key=_rank)

    def _store(self, run: int, claims: list[Claim]) -> None:
        claims.sort(key=_rank)
        for n, first in enumerate(range(0, len(claims), self.block_rows)):
            self.blocks.updateValue((run, n), tuple(list(column) for column in zip(*claims[first:first + self.block_rows], strict=True)))

    def _stored(self, run: int) -> Iterator[Claim]:
        n = 0
        while self.blocks.containsKey((run, n)):
            at, ids, scores = self.blocks.getValue((run, n))
            self.blocks.removeKey((run, n))
            yield from zip(at, ids, scores, strict=True)
            n += 1


class HolderScores(StatefulProcessor):
    """The number of a holder's claims and the latest scores; claims of a micro-batch are taken one by one in their order."""

    def __init__(self, cfg: FraudConfig, idle_days: int | None, ttl_hours: int | None, run_rows: int, block_rows: int):
        self.cfg, self.idle_days, self.ttl = cfg, idle_days, ttl_hours and ttl_hours * 3_600_000
        self.run_rows, self.block_rows = run_rows, block_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.claims = handle.getValueState("claims", "n long, last long", self.ttl)
        self.recent = handle.getListState("recent", "score double", self.ttl)
        self.runs = Runs(handle.getMapState("blocks", "run int, block int", "at array<long>, ids array<string>, scores array<double>"),
                         self.run_rows, self.block_rows)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        keep, limit = self.cfg.recent_scores, self.cfg.high
        count, last = self.claims.get() if self.claims.exists() else (0, None)
        recent = [r[0] for r in self.recent.get()] if self.recent.exists() else []
        idle = None if self.idle_days is None else self.idle_days * DAY_MS * 1000
        for at, claim_id, score in self.runs.ordered((r.at, r.claim_id, r.fraud_score) for r in rows):
            if idle is not None and None not in (at, last) and at - last > idle:
                count, recent = 0, []
            count += 1
            recent = [*recent, score][-keep:]
            mean = sum(recent) / keep if len(recent) == keep and None not in recent else None
            last = at if last is None or at is not None and at > last else last
            yield Row(policyholder_id=key[0], claim_id=claim_id, claim_number=count, fraud_score=score, recent_mean=mean,
                      blacklists_holder=bool(mean is not None and mean > limit))
        self.claims.update((count, last))
        self.recent.put([(score,) for score in recent])
        if idle is not None and last is not None:
            end = (last + idle) // 1000
            earlier = list(self.handle.listTimers())
            if end > max(earlier, default=0):
                for timer in earlier:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(end)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.claims.clear()
        self.recent.clear()
        return iter(())

    def close(self) -> None:
        pass


def track_scores(claims: DataFrame, cfg: FraudConfig = FraudConfig(), *, idle_days: int | None = None, ttl_hours: int | None = None,
                 run_rows: int = 20_000, block_rows: int = 500) -> DataFrame:
    """Scores per holder in the order of arrival: count and last scores per holder are the state.

    ``fraud_tracking`` goes by incident date over all claims; the two agree where claims arrive in that order. The claims
    of a holder in one micro-batch are taken by incident date and claim id. They are never held together: beyond
    ``run_rows`` they go through sorted runs in the state store. A claim without score counts, and there is no mean
    while it is among the latest.

    State ends in one of two ways. With ``idle_days`` a claim that long after the holder's last one starts again at the
    first, and the holder is forgotten when the watermark of ``incident_date`` (which the caller sets; claims behind it
    are dropped) has passed that time. With ``ttl_hours`` the store drops a holder so long after the last update by the
    clock; such a stream goes on making batches and needs a trigger, as it does not end when all data are read. With
    neither it is kept without end.

    ``claims`` needs policyholder_id, claim_id, incident_date and fraud_score. State lies in RocksDB; the setting is
    made in the session.
    """
    if idle_days is not None and ttl_hours is not None:
        raise ValueError("state ends by event time (idle_days) or by the clock (ttl_hours), not by both")
    use_rocksdb(claims.sparkSession)
    mode = "EventTime" if idle_days is not None else "ProcessingTime" if ttl_hours is not None else "None"
    narrow = claims.select("policyholder_id", "claim_id", "incident_date", F.unix_micros("incident_date").alias("at"), "fraud_score")
    return narrow.groupBy("policyholder_id").transformWithState(
        HolderScores(cfg, idle_days, ttl_hours, run_rows, block_rows), OUTPUT, "Append", mode)


def use_rocksdb(spark: SparkSession) -> None:
    """State of the session's next streams in RocksDB, off the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
