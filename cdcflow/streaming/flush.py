"""Write batches by size or idle delay, and a byte rate held by feedback."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructType

SIZE, IDLE = "size", "idle"


class FlushBuffer(StatefulProcessor):
    """Rows of a channel wait until ``rows`` of them are there or none has come for ``idle_ms``; then they go as one batch.

    Batches are numbered by channel.  Waiting rows are a list in the state store: a row is written once,
    and a batch is read when it goes.
    """

    def __init__(self, schema: StructType, rows: int, idle_ms: int):
        self.schema, self.columns, self.rows, self.idle_ms = schema, schema.names, rows, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.schema)
        self.counts = handle.getValueState("counts", StructType().add("waiting", LongType()).add("batch", LongType()))

    def _counts(self) -> tuple[int, int]:
        return tuple(self.counts.get()) if self.counts.exists() else (0, 0)

    def _batch(self, rows: list[tuple], number: int, why: str) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=self.columns).assign(flush=number, reason=why)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, number = self._counts()
        for frame in rows:
            frame = frame.set_axis(self.columns, axis=1)
            clean = frame.astype(object).where(frame.notna(), None)
            fresh = list(clean.itertuples(index=False, name=None))
            while held + len(fresh) >= self.rows:
                now, fresh = fresh[: self.rows - held], fresh[self.rows - held :]
                before = list(self.waiting.get()) if held else []
                self.waiting.clear()
                yield self._batch(before + now, number, SIZE)
                held, number = 0, number + 1
            if fresh:
                self.waiting.appendList(fresh)
                held += len(fresh)
        self.counts.update((held, number))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if held:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, number = self._counts()
        if held:
            rows = list(self.waiting.get())
            self.waiting.clear()
            self.counts.update((0, number + 1))
            yield self._batch(rows, number, IDLE)

    def close(self) -> None:
        pass


def flush_batches(rows: DataFrame, channel: str, size: int, idle_seconds: float) -> DataFrame:
    """A stream of rows with ``flush`` (number of their batch in the channel) and ``reason`` (size or idle).

    ``size`` rows of a channel make a batch; fewer go when the channel was idle.  Start it inside
    ``txn_state.keyed_state`` and with a trigger that runs on, for the timers.
    """
    out = StructType(list(rows.schema.fields)).add("flush", LongType()).add("reason", StringType())
    return rows.groupBy(channel).transformWithStateInPandas(FlushBuffer(rows.schema, size, int(idle_seconds * 1000)), out, "Append", "processingTime")


@dataclass
class ByteRate:
    """Holds a stream at ``limit`` bytes a second by what its batches turn out to weigh.

    After each batch the bytes are charged; while more was charged than time allows, the next batch waits.
    Idle time earns at most ``burst`` seconds of credit.  ``rows`` says how many rows of the weight seen
    lately, newer batches counting more, fit into a span of time.
    """

    limit: int
    burst: float = 1.0
    weight: float = 0.5
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    bytes_per_row: float | None = None
    _free_at: float | None = field(default=None, repr=False)

    def charge(self, rows: int, size: int) -> float:
        """Book a batch and wait off its debt; returns the seconds waited."""
        now = self.clock()
        if rows:
            seen = size / rows
            self.bytes_per_row = seen if self.bytes_per_row is None else (1 - self.weight) * self.bytes_per_row + self.weight * seen
        start = now - self.burst if self._free_at is None else max(self._free_at, now - self.burst)
        self._free_at = start + size / self.limit
        wait = max(0.0, self._free_at - now)
        if wait:
            self.sleep(wait)
        return wait

    def rows(self, seconds: float) -> int | None:
        """Rows that fit into ``seconds``, one at least; None before anything was weighed."""
        return None if not self.bytes_per_row else max(1, int(self.limit * seconds / self.bytes_per_row))


def row_bytes(columns: list[str]):
    """The length of the printed row."""
    return F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])))
