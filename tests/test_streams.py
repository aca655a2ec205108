"""Keyed transaction state, position offsets, and streamed jobs that start again."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from cdcflow.operators.txn import committed_changes
from cdcflow.plans.job import SyncJob
from cdcflow.session import scratch_path
from cdcflow.sources.position_log import position_log, write_position_log
from cdcflow.streaming.txn_state import ORPHAN, ended, stream_transactions

ROW = "source string, xid string, op string, scn long, seq long, after struct<k: bigint, v: string>"
SF = "/root/testdata/sf0.001"


def _log(spark, rows):
    return spark.createDataFrame([("s", x, op, scn, i, (scn, f"v{scn}")) for i, (scn, op, x) in enumerate(rows)], ROW)


def _stream(spark, path):
    return spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(path)


def _append(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def test_keyed_state_releases_what_one_batch_would(spark):
    src, out, at = (scratch_path(spark, x) for x in ("in", "out", "checkpoint"))
    log = [(1, "start", "a"), (2, "insert", "a"), (3, "insert", "b"), (4, "update", "a"), (5, "commit", "b"), (6, "insert", "c"), (7, "commit", "a"),
           (8, "rollback", "c"), (9, "insert", "a"), (10, "start", "a"), (10, "insert", "a"), (10, "commit", "a"), (30, "insert", "b"), (31, "commit", "b"), (40, "insert", "z")]
    for part in (log[:4], log[4:5], log[5:11][::-1], log[11:]):
        _append(_log(spark, log).where(F.col("seq").isin([log.index(r) for r in part])), src)
        stream_transactions(_stream(spark, src), out, at).awaitTermination()
    want = sorted((r.scn, r.seq, r.commit_scn, r.after.v) for r in committed_changes(_log(spark, log)).collect())
    assert sorted((r.scn, r.seq, r.commit_scn, r.after.v) for r in ended(spark, out).collect()) == want and len(want) == 5
    stream_transactions(_stream(spark, src), out, at).awaitTermination()
    assert ended(spark, out).count() == 5


def _bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names)


def test_an_open_transaction_is_not_written_again(spark):
    """Batches of equal size write equally much state, however many changes wait already."""
    src, out, at = (scratch_path(spark, x) for x in ("in", "out", "checkpoint"))
    text = F.concat(F.lit("value "), F.sha2(F.col("id").cast("string"), 256), F.sha2((-F.col("id")).cast("string"), 256))
    grown, before = [], 0
    for batch in range(6):
        rows = spark.range(batch * 3000, (batch + 1) * 3000).select(
            F.lit("s").alias("source"), F.lit("big").alias("xid"), F.lit("insert").alias("op"), (F.col("id") + 1).alias("scn"), F.col("id").alias("seq"),
            F.struct(F.col("id").alias("k"), text.alias("v")).alias("after"),
        )
        _append(rows, src)
        stream_transactions(_stream(spark, src), out, at).awaitTermination()
        now = _bytes(f"{at}/state")
        grown.append(now - before)
        before = now
    assert max(grown[1:]) < 1.5 * min(grown[1:])
    _append(spark.createDataFrame([("s", "big", "commit", 99_999, 0, None)], ROW), src)
    stream_transactions(_stream(spark, src), out, at).awaitTermination()
    found = ended(spark, out)
    assert found.count() == 18_000 and found.select("scn").distinct().count() == 18_000 and found.where("commit_scn <> 99999").count() == 0


def test_timers_give_up_what_never_ends(spark):
    src, out, at = (scratch_path(spark, x) for x in ("in", "out", "checkpoint"))
    _append(_log(spark, [(1, "insert", "lost"), (2, "insert", "kept"), (3, "commit", "kept")]), src)
    with pytest.raises(ValueError):
        stream_transactions(_stream(spark, src), out, at, max_age_ms=500)
    query = stream_transactions(_stream(spark, src), out, at, max_age_ms=500, every="1 second")
    try:
        orphans, until = [], time.monotonic() + 60
        while not orphans and time.monotonic() < until:
            time.sleep(1)
            if query.exception():
                raise query.exception()
            if query.lastProgress and os.path.isdir(out):
                orphans = ended(spark, out, ORPHAN).collect() if spark.read.parquet(out).count() else []
    finally:
        query.stop()
    assert [(r.xid, r.scn, r.commit_scn) for r in orphans] == [("lost", 1, None)]
    assert [(r.xid, r.commit_scn) for r in ended(spark, out).collect()] == [("kept", 3)]


# ---- positions as offsets ---------------------------------------------------------------------


def _messages(spark, slot, positions):
    return spark.createDataFrame([(slot, p, bytearray(f"{slot}{p}".encode())) for p in positions], "slot string, pos long, msg binary")


def test_positions_are_read_once_whatever_files_hold_them(spark):
    path, out, at = scratch_path(spark, "log"), scratch_path(spark, "out"), scratch_path(spark, "checkpoint")

    def run():
        rows = position_log(spark, path, "slot string, pos long, msg binary", partition_rows=3)
        rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", at).trigger(availableNow=True).start().awaitTermination()
        return sorted((r.slot, r.pos, bytes(r.msg).decode()) for r in spark.read.parquet(out).collect())

    write_position_log(_messages(spark, "a", range(10)), path)
    write_position_log(_messages(spark, "b/é", range(5, 8)), path)
    want = {("a", p, f"a{p}") for p in range(10)} | {("b/é", p, f"b/é{p}") for p in range(5, 8)}
    assert run() == sorted(want) and run() == sorted(want)
    write_position_log(_messages(spark, "a", range(8, 14)), path)  # overlaps what was read
    write_position_log(_messages(spark, "c", [1]), path)
    want |= {("a", p, f"a{p}") for p in range(14)} | {("c", 1, "c1")}
    assert run() == sorted(want)
    whole = position_log(spark, path, "slot string, pos long, msg binary", since=6, streaming=False)
    assert {r.pos for r in whole.where("slot = 'a'").collect()} == set(range(7, 14)) and whole.where("slot = 'c'").count() == 0


# ---- jobs -------------------------------------------------------------------------------------


def _job(reader, writer, **setting):
    return SyncJob.from_json(json.dumps({"job": {"content": [{"reader": reader, "writer": writer}], "setting": setting}}))


def _stream_setting(spark):
    return {"isStream": True, "availableNow": True, "checkpoint": scratch_path(spark, "checkpoint")}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
@pytest.mark.parametrize("reader", ["pgwalreader", "pg9walreader"])
def test_captured_jobs_stream_with_context_dirty_rows_and_a_failure(spark, reader):
    from cdcflow.operators.dirty import ErrorLimitExceeded
    from cdcflow.operators.pg9 import pg9_changes
    from cdcflow.operators.pgoutput import pg_changes
    from cdcflow.workload.wirelog import pg9_messages, pg_messages

    log, decode = (pg_messages(spark, SF), pg_changes) if reader == "pgwalreader" else (pg9_messages(spark, SF), pg9_changes)
    path, out, dirty = scratch_path(spark, "log"), scratch_path(spark, "out"), scratch_path(spark, "dirty")
    setting = {"restore": _stream_setting(spark), "dirty": {"path": dirty}, "restart": {"restartAttempts": 0}}
    read = {"name": reader, "parameter": {"path": path, "interval": 1}}
    run = lambda **more: _job(read, {"name": "filewriter", "parameter": {"path": out}}, **setting, **more).run(spark)
    cut = log.approxQuantile("pos", [0.3], 0.01)[0]
    write_position_log(log.where(F.col("pos") <= cut), path)
    run()
    spoilt = spark.createDataFrame([(log.first().slot, int(cut) + 1_000_000_000, bytearray(b"?bad"))], "slot string, pos long, msg binary")
    write_position_log(log.where(F.col("pos") > cut).unionByName(spoilt), path)
    with pytest.raises(Exception) as failed:
        run()
    assert ErrorLimitExceeded.__name__ in str(failed.value)
    run(errorLimit={"record": 1})
    landed = spark.read.parquet(out)
    want = sorted((r.slot, r.pos, r.op) for r in decode(log).collect())
    assert sorted((r.pos, r.type) for r in landed.collect()) == sorted((p, o) for _, p, o in want) and len(want) > 1000
    assert landed.where("lsn is null").count() == 0 and spark.read.text(dirty).count() == 1


def test_raw_redo_stream_joins_statements_across_batches(spark):
    path, out = scratch_path(spark, "log"), scratch_path(spark, "out")
    columns = "source string, pos long, scn long, commit_scn long, xidusn string, xidslt string, xidsqn string, operation string, seg_owner string, table_name string, username string, info string, sql_redo string, rs_id string, csf int, row_id string, rollback int"
    row = lambda pos, scn, text, csf, op="INSERT": ("db", pos, scn, None, "1", "2", "3", op, "S", "T", "APP", None, text, f"r{scn}", csf, "A", 0)
    batches = [[row(1, 1, "insert in", 1)], [row(2, 1, "to t va", 1)], [row(3, 1, "lues (1)", 0), row(4, 2, "delete", 0)]]
    job = _job({"name": "logminerreader", "parameter": {"path": path, "scn": 0, "whiteList": ["S.*"], "mode": "raw"}}, {"name": "filewriter", "parameter": {"path": out}}, restore=_stream_setting(spark))
    for rows in batches:
        write_position_log(spark.createDataFrame(rows, columns), path, "source")
        job.run(spark)
    assert sorted((r.SCN, r.SEQ, r.SQL_REDO) for r in spark.read.parquet(out).collect()) == [(1, 1, "insert into t values (1)"), (2, 4, "delete")]


def test_declared_columns_that_do_not_fit_make_dirty_rows(spark):
    from cdcflow.operators.dirty import ErrorLimitExceeded

    src, out, dirty = (scratch_path(spark, x) for x in ("in", "out", "dirty"))
    spark.createDataFrame([("1", "2024-01-02", "x"), ("oops", "2024-01-02", "y"), ("", None, "z"), (None, "never", "w")], "a string, b string, c string").write.parquet(src)
    read = {"name": "filereader", "parameter": {"path": src, "column": [{"name": "a", "type": "INT"}, {"name": "b", "type": "DATE"}, "c", {"name": "k", "value": "const", "type": "STRING"}]}}
    write = {"name": "filewriter", "parameter": {"path": out}}
    with pytest.raises(ErrorLimitExceeded):
        _job(read, write).run(spark)
    assert not os.path.exists(out)
    _job(read, write, errorLimit={"record": 2}, dirty={"path": dirty}).run(spark)
    assert sorted((r.a, str(r.b), r.c, r.k) for r in spark.read.parquet(out).where("a is not null").collect()) == [(1, "2024-01-02", "x", "const")]
    assert sorted(r.c for r in spark.read.parquet(out).collect()) == ["x", "z"]
    lines = sorted(r.value for r in spark.read.text(dirty).collect())
    assert len(lines) == 2 and any("oops" in x and "conversion" in x for x in lines) and any("never" in x for x in lines)
    plain = _job({"name": "filereader", "parameter": {"path": src, "column": ["a", "c"]}}, {"name": "filewriter", "parameter": {"path": out + "-2"}})
    plain.run(spark)
    assert spark.read.parquet(out + "-2").count() == 4


def test_rows_with_errors_are_read_once(spark):
    from cdcflow.operators.dirty import ERROR_TYPE, ERRORS
    from cdcflow.plans.job import register_source

    read = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    def source(s, p, job):
        rows = s.range(100).mapInArrow(touch, "id long")
        bad = F.when(F.col("id") % 10 == 0, F.array(F.struct(F.lit("id").alias("col"), F.lit("conversion").alias("type"), F.lit("no").alias("msg")))).otherwise(F.array())
        return rows.withColumn(ERRORS, bad.cast(ERROR_TYPE))

    register_source("counted", source)
    out, dirty = scratch_path(spark, "out"), scratch_path(spark, "dirty")
    _job({"name": "counted", "parameter": {}}, {"name": "filewriter", "parameter": {"path": out}}, errorLimit={"record": 10, "percentage": 10}, dirty={"path": dirty}).run(spark)
    assert spark.read.parquet(out).count() == 90 and spark.read.text(dirty).count() == 10 and read.value == 100


def test_streamed_append_lands_each_batch_once_though_the_ledger_writes_first(spark):
    """A batch whose commit went through but whose checkpoint did not is run again and passed over."""
    src, base, out = (scratch_path(spark, x) for x in ("in", "base", "table"))
    rows = spark.createDataFrame([(i, "v") for i in range(6)], "id long, v string")
    rows.where("id < 0").write.parquet(base)
    rows.write.parquet(src)
    writer = {"name": "tablewriter", "parameter": {"path": out, "base": base, "writeMode": "append", "buckets": 4}}
    job = _job({"name": "filereader", "parameter": {"path": src}}, writer)
    for _ in range(2):
        job._land(rows, {**writer["parameter"], "batchId": 0})
    job._land(rows, {**writer["parameter"], "batchId": 1})
    from cdcflow.sinks.tables import read_version

    assert read_version(spark, out).count() == 12


@pytest.mark.parametrize("kind", ["table", "files"])
def test_saved_positions_survive_a_death_between_rows_and_position(spark, monkeypatch, kind):
    from cdcflow.plans import job as jobs
    from cdcflow.sinks import manifest
    from cdcflow.sinks.tables import read_version

    src, base, out = (scratch_path(spark, x) for x in ("in", "base", "out"))
    restore = {"isRestore": True, "restoreColumnName": "id", "checkpoint": scratch_path(spark, "state")}
    spark.range(0).withColumn("v", F.lit("x")).write.parquet(base)
    more = lambda a, b: spark.range(a, b).withColumn("v", F.lit("x")).write.mode("append").parquet(src)
    if kind == "table":
        writer = {"name": "tablewriter", "parameter": {"path": out, "base": base, "writeMode": "append", "buckets": 4}}
        found, place, name = lambda: read_version(spark, out), manifest.BucketTable, "_publish"
    else:
        writer = {"name": "filewriter", "parameter": {"path": out}}
        found, place, name = lambda: spark.read.option("recursiveFileLookup", "true").parquet(out), jobs, "save_offsets"
    run = lambda: _job({"name": "filereader", "parameter": {"path": src}}, writer, restore=restore).run(spark)
    ids = lambda: sorted(r.id for r in found().collect())
    more(0, 10)
    run()
    run()
    assert ids() == list(range(10))
    more(10, 20)

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(place, name, die)
        with pytest.raises(RuntimeError):
            run()
    more(20, 25)
    run()
    run()
    assert ids() == list(range(25))


def test_replay_order_has_the_place_within_an_scn(spark):
    from cdcflow.plans.job import statement_rows

    redo = spark.createDataFrame([(7, 5, 2, "b"), (7, 5, 1, "a")], "COMMIT_SCN long, SCN long, SEQ long, SQL_REDO string")
    assert [r.sql_redo for r in statement_rows(redo).orderBy("commit_scn", "scn", "seq").collect()] == ["a", "b"]


def test_reader_channels_and_rebalance(spark):
    from cdcflow.plans.job import Speed, register_sink

    assert Speed(channel=2).readers == 2 and Speed(channel=2, reader_channel=5).readers == 5
    assert "REBALANCE" in Speed(rebalance=True).shape(spark.range(9).repartition(3))._jdf.queryExecution().toString().upper()
    taken = []
    register_sink("taken-too", lambda df, p, job: taken.extend(df.collect()))
    reader = {"name": "streamreader", "parameter": {"column": [{"type": "id"}], "sliceRecordCount": [4]}}
    _job(reader, {"name": "taken-too", "parameter": {}}, speed={"channel": 1, "readerChannel": 3}).run(spark)
    assert len(taken) == 12


def test_staged_statements_land_once_and_replay_in_order(spark):
    """Two runs of each batch, statements of one SCN among them: the stage holds each once, its order is total."""
    from cdcflow.sinks.tables import read_version

    path = scratch_path(spark, "stage")
    writer = {"name": "logminerwriter", "parameter": {"path": path, "buckets": 3}}
    job = _job({"name": "logminerreader", "parameter": {"path": "-"}}, writer)
    columns = "COMMIT_SCN long, SCN long, SEQ long, SQL_REDO string"
    batches = [[(7, 5, 2, "b"), (7, 5, 1, "a"), (7, 6, 1, "c")], [(9, 8, 1, "d"), (9, 8, 2, "e"), (9, 8, 3, None)]]
    for number, rows in enumerate(batches):
        for _ in range(2):
            job._land(spark.createDataFrame(rows, columns), {**writer["parameter"], "batchId": number})
    staged = read_version(spark, path)
    assert [(r.batch_id, r.sql_redo) for r in staged.orderBy("commit_scn", "scn", "seq").collect()] == [(0, "a"), (0, "b"), (0, "c"), (1, "d"), (1, "e")]


class _List:
    def __init__(self):
        self.rows, self.written = [], 0

    def exists(self):
        return bool(self.rows)

    def get(self):
        return iter(list(self.rows))

    def appendList(self, rows):
        self.rows += rows
        self.written += len(rows)

    def clear(self):
        self.rows = []


class _Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class _Handle:
    def getListState(self, name, schema):
        return _List()

    def getValueState(self, name, schema):
        return _Value()


@pytest.mark.parametrize("held", [3, 10_000])
def test_changes_that_end_in_their_batch_never_reach_the_state(held, monkeypatch):
    import pandas as pd
    from pyspark.sql.types import LongType, StringType, StructType

    from cdcflow.streaming import txn_state

    monkeypatch.setattr(txn_state, "HELD_ROWS", held, raising=False)
    schema = StructType().add("op", StringType()).add("scn", LongType())
    buffer = txn_state.TransactionBuffer(schema, ("scn",), None)
    buffer.init(_Handle())
    rows = [("insert", i) for i in range(20)] + [("commit", 20)] + [("update", i) for i in range(21, 27)]
    frames = [pd.DataFrame(rows[i::4], columns=schema.names) for i in range(4)]
    done = [r for f in buffer.handleInputRows(("s", "x"), iter(frames), None) for r in zip(f["scn"], f["commit_scn"])]
    assert sorted(done) == [(i, 20) for i in range(20)]
    assert sum(x.written for x in buffer.lists) == 6
    done = [r for f in buffer.handleInputRows(("s", "x"), iter([pd.DataFrame([("commit", 30)], columns=schema.names)]), None) for r in zip(f["scn"], f["commit_scn"])]
    assert sorted(done) == [(i, 30) for i in range(21, 27)] and not any(x.exists() for x in buffer.lists)


def test_a_redo_batch_is_read_once(spark):
    from cdcflow.streaming.steps import redo_step
    from cdcflow.workload.redolog import redo_pieces

    pieces = redo_pieces(spark, SF)
    total, path, seen = pieces.count(), scratch_path(spark, "state"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    found = 0
    step = redo_step(path, -1, ["SALES.*"])
    middle = pieces.approxQuantile("pos", [0.5], 0.01)[0]
    for batch, part in enumerate((pieces.where(F.col("pos") <= middle), pieces.where(F.col("pos") > middle))):
        found += step(part.mapInArrow(counted, part.schema), batch).count()
    assert seen.value == total and found > 0
    assert sorted(os.listdir(f"{path.removeprefix('file:')}/mined")) == ["batch=1"]


def _mined(spark, rows):
    """(pos, scn, operation, xid, text, csf) as mined rows or pieces of one source."""
    columns = "source string, pos long, scn long, commit_scn long, xidusn string, xidslt string, xidsqn string, operation string, seg_owner string, table_name string, username string, info string, sql_redo string, rs_id string, csf int, row_id string, rollback int"
    return spark.createDataFrame([("db", pos, scn, None, "1", "2", x, op, "S", "T", "APP", None, text, f"r{scn}", csf, "A", 0) for pos, scn, op, x, text, csf in rows], columns)


def test_a_redo_job_stores_only_columns_that_it_reads(spark):
    path, out, setting = scratch_path(spark, "log"), scratch_path(spark, "out"), _stream_setting(spark)
    job = _job({"name": "logminerreader", "parameter": {"path": path, "scn": 0, "whiteList": ["S.*"]}}, {"name": "filewriter", "parameter": {"path": out}}, restore=setting)
    parts = [[(1, 1, "START", "a", None, 0), (2, 2, "INSERT", "a", "insert in", 1), (3, 2, "INSERT", "a", "to t", 0), (4, 3, "INSERT", "b", "left", 0)],
             [(5, 4, "COMMIT", "a", None, 0), (6, 5, "COMMIT", "b", None, 0), (7, 6, "DELETE", "a", "open", 0)]]
    for part in parts:
        write_position_log(_mined(spark, part), path, "source")
        job.run(spark)
    rows = spark.read.parquet(out)
    assert sorted((r.SCN, r.COMMIT_SCN, r.SEQ, r.TABLE_NAME, r.SQL_REDO) for r in rows.collect()) == [(2, 4, 2, "T", "insert into t"), (3, 5, 4, "T", "left")]
    kept = {x: spark.read.parquet(f"{setting['checkpoint']}-context/{x}") for x in ("batch=1", "mined", "statements")}
    assert [(r.scn, r.sql_redo) for r in kept["batch=1"].collect()] == [(6, "open")]
    for name, rows in kept.items():
        assert not {"row_id", "rollback", "username", "xidusn"} & set(rows.columns), name
    assert "info" not in kept["statements"].columns


def test_shuffle_files_of_a_write_go_with_it(spark):
    from cdcflow.sinks.files import file_sink
    from cdcflow.streaming.steps import Context

    key, disk = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}

    rows, before = spark.range(5_000).select("id", (F.col("id") % 2).cast("string").alias("slot")).repartition(3, "id"), spark.conf.get(key, None)
    path, context, out = (scratch_path(spark, x) for x in ("log", "state", "out"))
    for write in (lambda: write_position_log(rows, path), lambda: Context(spark, context).keep(rows, 0), lambda: file_sink(rows, out)):
        held = shuffled()
        write()
        until = time.time() + 10
        while (left := shuffled() - held) and time.time() < until:
            time.sleep(0.1)
        assert not left
    assert spark.conf.get(key, None) == before
    assert sorted(x for x in os.listdir(path.removeprefix("file:")) if x.startswith("slot")) == ["slot=0", "slot=1"]
    assert [spark.read.parquet(p).count() for p in (path, f"{context}/batch=0", out)] == [5_000] * 3


@pytest.mark.parametrize("held", [None, 0], ids=["few open", "many open"])
def test_open_rows_are_those_behind_the_last_boundary(spark, monkeypatch, held):
    from cdcflow.operators.txn import open_changes
    from cdcflow.streaming import steps

    if held is not None:
        monkeypatch.setattr(steps, "HELD_OPEN", held)
    log = [("s", "a", "INSERT", 1, 0), ("s", "a", "COMMIT", 2, 0), ("s", "a", "UPDATE", 2, 0), ("s", "a", "UPDATE", 2, 1), ("s", "a", "UPDATE", 2, 1), ("s", "a", "UPDATE", 3, None),
           (None, "a", "INSERT", 1, 0), (None, "b", "INSERT", 4, 1), (None, "b", "START", 4, 1), (None, "b", "DELETE", 4, 1), ("s", "c", "DDL", 5, None), ("s", "c", "ROLLBACK", 5, None),
           ("s", "d", "COMMIT", 9, 0), ("s", None, "INSERT", 1, None), ("s", "e", "START", 1, 0), ("s", "e", "OTHER", 2, 0), ("s", "f", "INSERT", 7, None), ("s", "f", "COMMIT", 7, 0), ("s", "f", "INSERT", 8, 0)]
    rows = spark.createDataFrame([(*r, f"q{i}") for i, r in enumerate(log)], "source string, xid string, operation string, scn long, seq long, sql_redo string")
    got = steps.open_rows(rows)
    if held is None:
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "strategy=broadcast" in plan  # the rows themselves are not dealt out
    texts = lambda df: sorted(r.sql_redo for r in df.collect())
    want = lambda df: texts(open_changes(df.withColumn("op", F.lower("operation"))))
    assert texts(got) == want(rows) == sorted(f"q{i}" for i in (3, 4, 5, 6, 7, 9, 13, 18))
    assert got.columns == rows.columns
    plain = rows.drop("seq")
    assert texts(steps.open_rows(plain)) == want(plain) == sorted(f"q{i}" for i in (5, 6, 7, 9, 13, 18))


def test_pieces_go_to_as_many_tasks_as_they_fill(spark, monkeypatch):
    from cdcflow.streaming import steps

    monkeypatch.setattr(steps, "PIECES_PER_TASK", 2)
    log = [(i, i // 2 + 1, "INSERT", "a", f"{'insert' if i % 2 == 0 else ' done'}", 1 - i % 2) for i in range(20)] + [(20, 50, "COMMIT", "a", None, 0)]
    rows = _mined(spark, log).withColumn("xid", F.concat_ws(".", "xidusn", "xidslt", "xidsqn"))
    plans = []

    def store(whole):
        plans.append(whole._jdf.queryExecution().optimizedPlan().toString())
        return whole

    found = sorted((r.scn, r.sql_redo) for r in steps.redo_rows(rows, store=store, size=21).collect())
    assert found == sorted((r.scn, r.sql_redo) for r in steps.redo_rows(rows).collect()) == [(i + 1, "insert done") for i in range(10)]
    assert "RepartitionByExpression" in plans[0] and ", 11" in plans[0]


def test_a_staged_log_goes_when_it_is_copied_unless_others_hold_it(spark):
    from cdcflow.workload.registry import derived, staged

    build = lambda s, _: s.range(10)
    name = f"staged-{time.time_ns()}"
    own, copied = staged(spark, "nowhere", name, build)
    at = own.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert own.count() == 10 and os.path.isdir(at)
    copied()
    assert not os.path.exists(at)
    held = derived(spark, "nowhere", name, build)
    again, copied = staged(spark, "nowhere", name, build)
    copied()
    assert again.inputFiles() == held.inputFiles() and again.count() == 10
