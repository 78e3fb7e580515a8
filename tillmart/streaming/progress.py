"""What streaming queries have done so far, and when a bounded read ends.

A listener adds up the progress of every micro-batch, however many there are: a query itself remembers its last hundred only.
"""

from __future__ import annotations

import threading
import time
from dataclasses import dataclass, field, replace
from weakref import WeakSet

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

# A bounded read ends after so many seconds without a new event, or in all.
IDLE_SECONDS, TOTAL_SECONDS = 30.0, 120.0

ANNOUNCED, IDLE, TIME, ENDED = "announced", "idle", "time", "ended"
_WANTED = "wanted_events"


@dataclass
class Sums:
    """Of all micro-batches of one run: rows read, rows of the awaited batch, rows dropped as late, micro-batches with rows."""

    rows: int = 0
    wanted: int = 0
    late: int = 0
    micro_batches: int = 0
    changed: float = field(default_factory=time.monotonic)
    ended: bool = False


class Tally(StreamingQueryListener):
    """Sums by run of a query."""

    def __init__(self) -> None:
        self.news = threading.Condition()
        self.runs: dict[str, Sums] = {}
        self.sessions: WeakSet[SparkSession] = WeakSet()

    def listen(self, spark: SparkSession) -> Tally:
        """Hear of the queries that the session starts from now on."""
        if spark not in self.sessions:
            spark.streams.addListener(self)
            self.sessions.add(spark)
        return self

    def onQueryStarted(self, event) -> None:
        with self.news:
            self._of(event.runId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self.news:
            sums = self._of(progress.runId)
            sums.late += sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
            if progress.numInputRows > 0:
                sums.rows += progress.numInputRows
                sums.micro_batches += 1
                sums.changed = time.monotonic()
            if _WANTED in progress.observedMetrics:
                sums.wanted += progress.observedMetrics[_WANTED]["events"]
            self.news.notify_all()

    def onQueryTerminated(self, event) -> None:
        with self.news:
            self._of(event.runId).ended = True
            self.news.notify_all()

    def _of(self, run) -> Sums:
        return self.runs.setdefault(str(run), Sums())

    def finished(self, query: StreamingQuery, patience: float = 60.0) -> Sums:
        """All sums of a run that has ended; its last events may still be on their way."""
        with self.news:
            if not self.news.wait_for(lambda: self._of(query.runId).ended, patience):
                raise TimeoutError("The end of the query was not reported; was its session listened to before it began?")
            return replace(self._of(query.runId))


TALLY = Tally()


def awaited(messages: DataFrame, is_wanted: Column) -> DataFrame:
    """The messages, counting those of the awaited batch as they pass."""
    return messages.observe(_WANTED, F.count_if(is_wanted).alias("events"))


@dataclass(frozen=True)
class Outcome:
    """Why a bounded read ended, and what it had read by then."""

    reason: str
    wanted: int
    rows: int
    micro_batches: int


def end_when(
    query: StreamingQuery, announced: int, idle: float = IDLE_SECONDS, total: float = TOTAL_SECONDS, begun: float | None = None
) -> Outcome:
    """Wait until ``announced`` events of the awaited batch were written, or no event came for ``idle`` seconds, or ``total``
    seconds have passed since ``begun`` (by the monotonic clock; default: now); then stop the query.

    Events that are still being written have come, so a micro-batch that takes longer than ``idle`` does not end the read.

    ``query`` reads what :func:`awaited` counts and polls for more, in a session that :data:`TALLY` listens to. Only whole micro-batches
    count, so one that is cut short by the stop is read again by the next run. A query that fails raises its error here.
    """
    begun = time.monotonic() if begun is None else begun
    with TALLY.news:
        sums = TALLY._of(query.runId)
        sums.changed = max(sums.changed, begun)
        while True:
            now = time.monotonic()
            if query.status["isDataAvailable"]:
                sums.changed = now
            if sums.wanted >= announced:
                reason = ANNOUNCED
            elif sums.ended or not query.isActive:
                reason = ENDED
            elif now - begun >= total:
                reason = TIME
            elif now - sums.changed >= idle:
                reason = IDLE
            else:
                TALLY.news.wait(max(0.05, min(1.0, begun + total - now, sums.changed + idle - now)))
                continue
            break
    query.stop()
    query.awaitTermination()  # raises what the query failed with
    last = TALLY.finished(query)
    return Outcome(reason, last.wanted, last.rows, last.micro_batches)
