"""The states of batches, kept by a stream over their events.

A batch's events may come in any order: its state is what its events give in the order of their times, and a batch that
was left running for too long at any time counts as interrupted from then on. Timers tell when nothing more comes.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from loomlake.operators.state import TRANSITIONS

#: A batch that runs for longer is interrupted.
MINUTES = 30
#: The rows that say what a batch's state is. ``events`` grows with each event of a batch: the last row of a batch counts.
STATES = "batch_id string, status string, rows long, retry_count int, retryable boolean, events int, as_of long"
#: What a run adds to a batch's events: one text, a JSON list of [at, seq, [status], rows]. Events come to the workers as such
#: texts, too: a row of values for each, in the state or on the way, would cost several times as much.
_CHUNK = T.StructType().add("events", "string")
_RUNS = ("running", "retrying")


def fold(events: Iterable[tuple], now: int | None, minutes: int = MINUTES) -> tuple:
    """(status, rows, retry_count, retryable, since) of events (at, seq, status, rows), times in milliseconds.

    A batch is queued at first. An event that its state doesn't allow changes nothing. One that has been running for more
    than ``minutes`` at an event, or at ``now``, failed then and may be retried. rows keep their last known value.
    ``since`` is when the present run began, None if it isn't running.
    """
    status, rows, retries, retryable, since = "queued", None, 0, False, None

    def overdue(at: int | None) -> bool:
        return since is not None and at is not None and at > since + minutes * 60_000

    for at, _, wanted, count in sorted(events, key=lambda e: (e[0], e[1])):
        if overdue(at):
            status, retryable, since = "failed", True, None
        if wanted in TRANSITIONS.get(status, ()):
            status = wanted
            rows = count if count is not None else rows
            retries += wanted == "retrying"
            since = at if wanted in _RUNS else None
            retryable = False if wanted in _RUNS else retryable
    if overdue(now):
        status, retryable, since = "failed", True, None
    return status, rows, retries, retryable, since


def _list(events: Iterable[str]) -> str:
    return f"[{','.join(events)}]"


def _events(chunk: str) -> list[tuple]:
    return [(at, seq, status, rows) for at, seq, (status,), rows in json.loads(chunk)]


class _States(StatefulProcessor):
    def __init__(self, minutes: int):
        self.minutes = minutes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", _CHUNK)

    def _known(self) -> list[tuple]:
        return [e for (chunk,) in self.events.get() for e in _events(chunk)]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self._known()
        old, texts = set(known), dict.fromkeys(e for some in rows for e in some["event"].tolist())
        fresh = {e: t for t, e in zip(texts, _events(_list(texts)), strict=True) if e not in old}
        if fresh:
            self.events.appendValue((_list(fresh.values()),))
        yield self._said(key, [*known, *fresh], timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._said(key, self._known(), timerValues.getCurrentWatermarkInMs())

    def _said(self, key, events: list[tuple], now: int) -> pd.DataFrame:
        status, rows, retries, retryable, since = fold(events, now, self.minutes)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if since is not None:
            self.handle.registerTimer(max(since + self.minutes * 60_000, now) + 1)
        return pd.DataFrame({"batch_id": [key[0]], "status": [status], "rows": pd.array([rows], dtype="Int64"), "retry_count": [retries], "retryable": [retryable], "events": [len(events)], "as_of": [now]})

    def close(self) -> None: ...


def batch_states(events: DataFrame, clock: str = "at", delay: str = "0 seconds", minutes: int = MINUTES) -> DataFrame:
    """A stream of STATES from a stream of (batch_id, at, seq, status, rows), at being when an event happened.

    ``clock`` is the column by which time goes on: when events arrived, or ``at``; rows later than ``delay`` behind it are
    left out. An event that comes twice counts once. Rows without a batch, a time or a status are left out.
    State is the events of each batch, in RocksDB (spark.sql.streaming.stateStore.providerClass).
    """
    whole = events.filter("batch_id IS NOT NULL AND at IS NOT NULL AND status IS NOT NULL")
    ms = F.unix_millis(F.col("at").cast("timestamp"))
    number = lambda c: F.coalesce(F.col(c).cast("long").cast("string"), F.lit("null"))
    event = F.concat(F.lit("["), ms.cast("string"), F.lit(","), number("seq"), F.lit(","), F.to_json(F.array("status")), F.lit(","), number("rows"), F.lit("]"))
    rows = whole.select(F.col("batch_id").cast("string").alias("batch_id"), event.alias("event"), F.col(clock).cast("timestamp").alias("clock"))
    return rows.withWatermark("clock", delay).groupBy("batch_id").transformWithStateInPandas(_States(minutes), STATES, "Update", "eventTime")


def latest_states(said: DataFrame) -> DataFrame:
    """The last row of each batch among all that the stream has said."""
    last = said.groupBy("batch_id").agg(F.max_by(F.struct("status", "rows", "retry_count", "retryable"), F.struct("as_of", "events", F.col("status") == "failed")).alias("s"))
    return last.select("batch_id", "s.*")
