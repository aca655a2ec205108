"""Batches by size or idle delay with a test clock, and the byte rate."""

import json
import os
import time

import pandas as pd
import pytest
from pyspark.sql.types import LongType, StringType, StructType

from cdcflow.plans.job import SyncJob
from cdcflow.session import scratch_path
from cdcflow.streaming import flush as flushing
from cdcflow.streaming.flush import ByteRate, FlushBuffer, flush_batches
from cdcflow.streaming.txn_state import keyed_state

SCHEMA = StructType().add("channel", StringType()).add("n", LongType())


class _State:
    """A list and a value of one key, and timers against a test clock."""

    def __init__(self):
        self.rows, self.value, self.timers, self.now, self.written = [], None, [], 0, 0

    # lists and values
    def getListState(self, name, schema):
        return self

    def getValueState(self, name, schema):
        outer = self

        class Value:
            exists = staticmethod(lambda: outer.value is not None)
            get = staticmethod(lambda: outer.value)
            update = staticmethod(lambda v: setattr(outer, "value", v))

        return Value

    def appendList(self, rows):
        self.rows += rows
        self.written += len(rows)

    def get(self):
        return iter(self.rows)

    def clear(self):
        self.rows = []

    # timers
    def listTimers(self):
        return iter(self.timers)

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)

    def getCurrentProcessingTimeInMs(self):
        return self.now


def _run(script, size=4, idle=1000):
    """Batches that come out of (time, rows) steps: (time, flush, reason, rows)."""
    state, out, n = _State(), [], 0
    buffer = FlushBuffer(SCHEMA, size, idle)
    buffer.init(state)
    for at, count in script:
        for due in [t for t in sorted(state.timers) if t <= at]:
            state.now = due
            state.timers.remove(due)
            out += [(due, f) for f in buffer.handleExpiredTimer(("c",), state, None)]
        state.now = at
        if count:
            frame = pd.DataFrame({"channel": "c", "n": range(n, n + count)})
            n += count
            out += [(at, f) for f in buffer.handleInputRows(("c",), iter([frame]), state)]
    return [(t, int(f.flush.iloc[0]), f.reason.iloc[0], f.n.tolist()) for t, f in out], state


def test_size_and_idle_by_a_test_clock():
    out, state = _run([(0, 3), (500, 2), (900, 1), (1899, 0), (1901, 0), (5000, 9), (7000, 0)])
    assert out == [(500, 0, "size", [0, 1, 2, 3]), (1900, 1, "idle", [4, 5]), (5000, 2, "size", [6, 7, 8, 9]), (5000, 3, "size", [10, 11, 12, 13]), (6000, 4, "idle", [14])]
    assert not state.rows and not state.timers and state.written == 3 + 1 + 1 + 1


def test_a_busy_channel_never_goes_idle():
    out, _ = _run([(i * 900, 1) for i in range(10)], size=100)
    assert out == []


def test_batches_of_a_stream(spark):
    src, out, at = (scratch_path(spark, x) for x in ("in", "out", "checkpoint"))
    rows = spark.range(25).selectExpr("case when id < 21 then 'a' else 'b' end channel", "id n")
    rows.coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(rows.schema).parquet(src)
    with keyed_state(spark):
        query = flush_batches(stream, "channel", 10, 0.5).writeStream.format("parquet").option("path", out).option("checkpointLocation", at).trigger(processingTime="1 second").start()
    try:
        found, until = [], time.monotonic() + 60
        while len(found) < 25 and time.monotonic() < until and query.exception() is None:
            time.sleep(1)
            found = spark.read.schema("channel string, n long, flush long, reason string").parquet(out).collect() if os.path.isdir(out) else []
    finally:
        query.stop()
    sizes = {}
    for r in found:
        sizes[r.channel, r.flush, r.reason] = sizes.get((r.channel, r.flush, r.reason), 0) + 1
    assert sizes == {("a", 0, "size"): 10, ("a", 1, "size"): 10, ("a", 2, "idle"): 1, ("b", 0, "idle"): 4} and sorted(r.n for r in found) == list(range(25))


def _clocked(limit, **more):
    state = {"now": 0.0}
    return ByteRate(limit, clock=lambda: state["now"], sleep=lambda s: state.update(now=state["now"] + s), **more), state


def test_rate_follows_what_batches_weigh():
    rate, state = _clocked(1000)
    for size in [500, 3000, 100, 8000, 0, 4000] * 5:
        rate.charge(10, size)
    assert 15_600 * 5 / 1000 - 1 <= state["now"] <= 15_600 * 5 / 1000
    rate, state = _clocked(1000)
    assert rate.rows(1) is None
    rate.charge(10, 1000)
    assert rate.rows(1) == 10
    for _ in range(20):
        rate.charge(10, 5000)
    assert rate.rows(1) == 2 and rate.rows(0.001) == 1


def test_idle_time_earns_a_bounded_credit():
    rate, state = _clocked(1000, burst=2.0)
    assert rate.charge(1, 1000) == 0
    state["now"] += 1000
    assert rate.charge(1, 2000) == 0 and rate.charge(1, 500) == pytest.approx(0.5)


def test_a_streamed_job_is_held_at_its_byte_rate(spark, monkeypatch):
    src, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    rows = spark.range(100).selectExpr("'t' topic", "0 partition", "id offset", "current_timestamp() timestamp", "cast(null as string) key", "repeat('x', 100) value")
    rows.coalesce(1).write.parquet(src)
    charged = []
    monkeypatch.setattr(flushing.ByteRate, "charge", lambda self, n, size: charged.append((self.limit, n, size)))
    job = {
        "content": [{"reader": {"name": "kafkareader", "parameter": {"topic": "t", "path": src}}, "writer": {"name": "kafkawriter", "parameter": {"topic": "x", "path": out}}}],
        "setting": {"speed": {"bytes": 5000}, "restore": {"isStream": True, "availableNow": True, "checkpoint": scratch_path(spark, "checkpoint")}},
    }
    SyncJob.from_json(json.dumps({"job": job})).run(spark)
    assert [(limit, n) for limit, n, _ in charged] == [(5000, 100)] and 11_000 < charged[0][2] < 16_000
    assert spark.read.parquet(out).count() == 100
