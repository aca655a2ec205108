"""Transaction assembly on keyed state: open changes wait in the state store, only what a batch adds is written.

Per (source, xid) the state holds the changes that no boundary has ended yet, as a list in RocksDB:
adding to it writes the new rows alone, however many are there.  A boundary releases or drops what
stands before it.  A timer gives up transactions that never end.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain, islice
from tempfile import TemporaryFile

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegralType, LongType, StringType, StructType

from cdcflow.operators.txn import BOUNDARY, DML, RANK, TXN_KEYS, txn_ties, with_rank

RELEASED, ORPHAN = "released", "orphan"
#: Rows of a transaction that are in memory at once.
CHUNK_ROWS = 10_000
#: Changes of a key and batch that are held in memory until its boundaries are known; more wait in a local file.
HELD_ROWS = 50_000
# Spark's settings for a state store that writes changes instead of snapshots.
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """The session with a state store of this kind where none is set; queries started inside keep it."""
    added = {k: v for k, v in STORE.items() if spark.conf.get(k, None) in (None, "") or k.endswith("providerClass") and "HDFSBacked" in spark.conf.get(k)}
    before = {k: spark.conf.get(k, None) for k in added}
    for k, v in added.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class _Held:
    """Frames of one key and batch: the first rows in memory, the rest in a file that goes with its last reader."""

    def __init__(self):
        self.frames: list[pd.DataFrame] = []
        self.rows = 0
        self.file = None

    def add(self, frame: pd.DataFrame) -> None:
        if not len(frame):
            return
        if self.rows + len(frame) <= HELD_ROWS:
            self.frames.append(frame)
            self.rows += len(frame)
            return
        self.rows = HELD_ROWS  # later frames follow this one
        self.file = self.file or TemporaryFile()
        pickle.dump(frame, self.file, pickle.HIGHEST_PROTOCOL)

    def __iter__(self) -> Iterator[pd.DataFrame]:
        yield from self.frames
        if self.file is None:
            return
        with self.file as kept:
            end = kept.tell()
            kept.seek(0)
            while kept.tell() < end:
                yield pickle.load(kept)


class TransactionBuffer(StatefulProcessor):
    """Changes and boundaries of one transaction id in, ended changes out.

    A change belongs to the next boundary in log order: COMMIT releases it with its position, ROLLBACK
    and START drop it.  Rows of a batch come in any order and in chunks; they are held, in memory or in a
    local file, until all boundaries of the batch are known.  Only changes that no boundary ends go
    to the state: to the list of what waits already or, where a boundary ends that list, to the other of
    two, so that neither has to fit in memory.
    """

    def __init__(self, schema: StructType, order: tuple[str, ...], max_age_ms: int | None):
        self.schema, self.order, self.max_age_ms = schema, list(order), max_age_ms
        self.columns = schema.names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lists = [handle.getListState(f"open_{i}", self.schema) for i in (0, 1)]
        self.at = handle.getValueState("list", StructType().add("i", LongType()))

    def _place(self) -> int:
        return self.at.get()[0] if self.at.exists() else 0

    def _frames(self, rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        while chunk := list(islice(rows, CHUNK_ROWS)):
            yield pd.DataFrame(chunk, columns=self.columns)

    def _keep(self, place: int, changes: pd.DataFrame) -> None:
        if not len(changes):
            return
        columns = []
        for f in self.schema.fields:  # whole numbers beside NULLs arrive as floats
            column = changes[f.name].astype("Int64") if isinstance(f.dataType, IntegralType) else changes[f.name]
            columns.append(column.astype(object).where(column.notna(), None).tolist())
        self.lists[place].appendList(list(zip(*columns, strict=True)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        rows = (frame.set_axis(self.columns, axis=1) for frame in rows)  # computed columns come without their names
        place = self._place()
        waiting = self.lists[place].exists()
        ends: list[tuple] = []
        fresh = _Held()
        for frame in rows:
            bounds = frame[frame["op"].isin(BOUNDARY)]
            ends += [(*at, op, scn) for *at, op, scn in bounds[[*self.order, "op", "scn"]].itertuples(index=False)]
            fresh.add(frame[frame["op"].isin(DML)])
        if not ends:
            for frame in fresh:
                self._keep(place, frame)
                waiting = True
            return self._wait(waiting)
        ends.sort()
        held = self._frames(self.lists[place].get()) if waiting else iter(())
        return self._end(place, ends, chain(held, fresh))

    def _wait(self, waiting: bool) -> Iterator[pd.DataFrame]:
        if waiting and self.max_age_ms is not None and not list(self.handle.listTimers()):
            self.handle.registerTimer(self._now + self.max_age_ms)
        return iter(())

    def _end(self, place: int, ends: list[tuple], frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marks = [e[: len(self.order)] for e in ends]
        left = 0
        for frame in frames:
            to = [bisect_left(marks, at) for at in frame[self.order].itertuples(index=False, name=None)]
            op = np.array([ends[i][-2] if i < len(ends) else "" for i in to], str)
            done, rest = frame[op == "commit"], frame[op == ""]
            left += len(rest)
            self._keep(1 - place, rest)
            if len(done):
                yield done.assign(commit_scn=[ends[i][-1] for i, o in zip(to, op, strict=True) if o == "commit"], state=RELEASED)
        self.lists[place].clear()
        self.at.update((1 - place,))
        for timer in list(self.handle.listTimers()) if self.max_age_ms is not None else []:
            self.handle.deleteTimer(timer)
        yield from self._wait(left > 0)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """What has waited too long comes out marked, and the transaction is forgotten."""
        place = self._place()
        for frame in self._frames(self.lists[place].get()):
            yield frame.assign(commit_scn=None, state=ORPHAN)
        self.lists[place].clear()

    def close(self) -> None:
        pass


class _Timed(TransactionBuffer):
    def handleInputRows(self, key, rows, timerValues):
        self._now = timerValues.getCurrentProcessingTimeInMs()
        yield from super().handleInputRows(key, rows, timerValues)


class _Untimed(TransactionBuffer):
    def handleInputRows(self, key, rows, timerValues):
        yield from super().handleInputRows(key, rows, timerValues)


def ended_changes(rows: DataFrame, max_age_ms: int | None = None) -> DataFrame:
    """A stream of log rows as a stream of ended changes: ``commit_scn`` and ``state`` (released, or orphan) are added.

    Columns must be plain values (structs are carried as JSON by ``stream_transactions``).
    """
    known = with_rank(rows.where(F.col("op").isin(*DML, *BOUNDARY)))
    schema = known.schema
    out = StructType(list(schema.fields)).add("commit_scn", schema["scn"].dataType).add("state", StringType())
    kind = _Untimed if max_age_ms is None else _Timed
    buffer = kind(schema, ("scn", *txn_ties(rows)), max_age_ms)
    mode = "none" if max_age_ms is None else "processingTime"
    return known.groupBy(*TXN_KEYS).transformWithStateInPandas(buffer, out, "Append", mode).drop(RANK)


def stream_transactions(
    rows: DataFrame, path: str, checkpoint: str, *, max_age_ms: int | None = None, every: str | None = None
) -> StreamingQuery:
    """Start assembling transactions of a streamed log on keyed state; ended changes are appended to files, once each.

    It drains what is there unless ``every`` is given.  With ``max_age_ms`` it must be: timers need batches
    that come without data.
    """
    if max_age_ms is not None and every is None:
        raise ValueError("a stream with timers runs on: say how often")
    nested = {f.name: f.dataType for f in rows.schema.fields if not f.dataType.simpleString().isidentifier()}
    flat = rows.withColumns({c: F.to_json(c) for c in nested}) if nested else rows
    with keyed_state(rows.sparkSession):
        ended = ended_changes(flat, max_age_ms)
        if nested:
            ended = ended.withColumns({c: F.from_json(c, t) for c, t in nested.items()})
        writer = ended.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def ended(spark: SparkSession, path: str, state: str = RELEASED) -> DataFrame:
    """The changes written so far that ended this way."""
    return spark.read.parquet(path).where(F.col("state") == state).drop("state")
