import json
import os

import pytest
from pyspark.sql import functions as F

from cdcflow.operators.dirty import ErrorLimitExceeded, dirty_lines, enforce_limit, error_limit_verdict, failure_runs, split_dirty, to_typed
from cdcflow.operators.filters import filter_lists, filter_tables
from cdcflow.operators.metrics import observe_reads, rate_limit_plan, stream_rate
from cdcflow.operators.offsets import load_offsets, offset_rows, save_offsets
from cdcflow.operators.positions import Slices
from cdcflow.operators.splits import assign_split, even_segments, split_bounds, split_predicates
from cdcflow.plans.job import SyncJob, fail_on, register_sink, register_source, route_channel, statement_rows, substitute
from cdcflow.session import scratch_path
from cdcflow.sinks.files import file_sink, rows_per_file
from cdcflow.sources.jdbc import merge_url
from cdcflow.sources.messages import MessageSource, message_source
from cdcflow.sources.synthetic import synthetic_rows
from cdcflow.streaming.restart import RestartPolicy, run_with_restart
from cdcflow.streaming.txn_stream import committed_batch, released_changes


# ---- splits -----------------------------------------------------------------------------------


@pytest.mark.parametrize("lo, hi, n", [(0, 100, 7), (5, 5, 3), (10, 0, 4), (0, 3, 8), (-7, 13, 5), (0, 1, 1)])
def test_split_bounds_cover_without_overlap(spark, lo, hi, n):
    b = split_bounds(lo, hi, n)
    assert b[0] == min(lo, hi) and b[-1] == max(lo, hi) and b == sorted(b)
    df = spark.range(min(lo, hi), max(lo, hi) + 1).withColumnRenamed("id", "v")
    parts = [df.where(p).count() for p in split_predicates("v", b)]
    assert sum(parts) == df.count()
    assigned = {r.split_id: r["count"] for r in assign_split(df, "v", n).groupBy("split_id").count().collect()}
    assert [assigned.get(i, 0) for i in range(len(parts))] == parts


@pytest.mark.parametrize("rows, n", [(10, 3), (2, 5), (7, 7)])
def test_even_segments(spark, rows, n):
    df = spark.range(100, 100 + rows)
    got = {r.id - 100: r.segment for r in even_segments(df, "id", n, slices=Slices((0, 103, 200), 2)).collect()}
    size = rows // n
    assert got == {i: (n - 1 if size == 0 else min(i // size, n - 1)) for i in range(rows)}


# ---- dirty rows and limits --------------------------------------------------------------------


def test_dirty_lines_layout(spark):
    df = spark.createDataFrame([(1, "x\"y"), (2, "3")], "id int, v string")
    good, dirty = split_dirty(to_typed(df, [("v", "n", "INT", None)]))
    assert [(r.id, r.n) for r in good.collect()] == [(2, 3)]
    row, kind, message, at = dirty_lines(dirty, ["id", "v"]).first().value.split("\u0001")
    assert json.loads(row) == {"id": 1, "v": 'x"y'} and kind == "conversion"
    assert json.loads(message) == "can't read as INT: x\"y" and len(at) == 19


@pytest.mark.parametrize(
    "errors, read, record, percentage, ok",
    [(5, 100, 5, None, True), (6, 100, 5, None, False), (5, 100, None, 5.0, True), (6, 100, None, 5.0, False),
     (0, 0, 0, 0.0, True), (1, 0, None, 0.0, True), (9, 10, -1, -1, True), (1, 10, 0, 0.0, False)],
)
def test_error_limits(spark, errors, read, record, percentage, ok):
    counts = spark.createDataFrame([(read, errors)], "num_read long, errors long")
    assert error_limit_verdict(counts, record, percentage).first().ok is ok


def test_enforce_limit_raises_before_the_write(spark):
    df = to_typed(spark.createDataFrame([("x",), ("1",)], "v string"), [("v", "n", "INT", None)])
    enforce_limit(df, 1, None)
    with pytest.raises(ErrorLimitExceeded):
        enforce_limit(df)


def test_failure_runs(spark):
    pattern = "..xxx.xx.xxxx"
    df = spark.createDataFrame([("c", i, ch == "x") for i, ch in enumerate(pattern)], "channel string, pos long, bad boolean")
    for layout in (Slices((0, 0), 1), Slices((0, 4, 11, 20), 1)):
        got = {tuple(r) for r in failure_runs(df, "channel", "pos", F.col("bad"), 3, slices=layout).collect()}
        assert got == {("c", 2, 4, 3), ("c", 9, 12, 4)}


# ---- sources, sinks, filters ------------------------------------------------------------------


def test_url_parameters():
    got = merge_url("jdbc:x://h/db?a=1&useCursorFetch=false", {"b": "2"})
    assert got == "jdbc:x://h/db?a=1&useCursorFetch=true&b=2&rewriteBatchedStatements=true"
    assert merge_url("jdbc:x") == "jdbc:x?useCursorFetch=true&rewriteBatchedStatements=true"


def test_long_table_lists_filter_like_short_ones(spark):
    df = spark.createDataFrame([("S", f"T{i}", i) for i in range(300)] + [("R", "T1", -1)], "schema string, table string, i int")
    names = [f"S.T{i}" for i in range(0, 300)]
    assert filter_tables(df, names[:3]).count() == 3
    assert filter_tables(df, names[:250]).count() == 250
    assert {r.i for r in filter_lists(df, ["R.*", "S.T5"], ["R.T1"]).collect()} == {5}


def test_synthetic_rows_are_repeatable(spark):
    kinds = ["id", "int", "byte", "boolean", "char", "short", "long", "float", "double", "date", "timestamp", "bigdecimal",
             "biginteger", "int[]", "string[]", "binary", "string"]
    cols = [{"name": f"c{i}", "type": k} for i, k in enumerate(kinds)] + [{"name": "k", "type": "long", "value": "null"}]
    a = synthetic_rows(spark, cols, [5, 0, 9], seed=1).collect()
    b = synthetic_rows(spark, cols, [5, 0, 9], seed=1, rows_per_task=2).collect()
    assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) == 14
    assert {r._channel for r in a} == {0, 2} and {r.c0 for r in a} == set(range(1, 15)) and all(r.k is None for r in a)


def test_files_of_wanted_size(spark):
    df = spark.range(20_000).withColumn("t", F.lit("x" * 90))
    assert 900 <= rows_per_file(df, 100_000) <= 1100
    path = scratch_path(spark, "sized")
    file_sink(df, path, fmt="json", compression="gzip", max_file_bytes=500_000)
    file_sink(df.limit(1), path, fmt="json", compression="gzip")
    back = spark.read.json(path)
    assert back.count() == 20_001 and len(back.inputFiles()) > 4
    with pytest.raises(ValueError):
        file_sink(df, path, mode="nope")


def test_message_source_rules(spark):
    with pytest.raises(ValueError):
        message_source(spark, MessageSource("t"))
    with pytest.raises(ValueError):
        message_source(spark, MessageSource("t", kind="queue"))
    assert MessageSource("a, b,,c").topic_list == ["a", "b", "c"]


def test_observed_counters(spark):
    df, seen = observe_reads(spark.createDataFrame([("ab", 1), ("c", 22)], "a string, b int"))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"num_read": 2, "byte_read": 8}


def test_rate_limit_shares(spark):
    stats = spark.createDataFrame([("a", 3000, 30000), ("b", 1000, 10000), ("c", 0, 0)], "channel string, num_read long, byte_read long")
    got = {r.channel: r.rows_per_second for r in rate_limit_plan(stats, 1000.0).collect()}
    assert got == {"a": 75.0, "b": 25.0, "c": 1000.0}


def test_offsets_grow_and_load(spark):
    path = scratch_path(spark, "offsets")
    for lo in (0, 10):
        rows = spark.range(lo, lo + 10).withColumn("ch", F.col("id") % 2)
        save_offsets(offset_rows(rows, F.lit("job"), "ch", "id"), path)
    got = {(r.channel, r.position, r.rows) for r in load_offsets(spark.read.parquet(path)).collect()}
    assert got == {(0, 18, 10), (1, 19, 10)}


# ---- streams ----------------------------------------------------------------------------------

LOG = [(1, "start", "a"), (2, "insert", "a"), (3, "insert", "b"), (4, "update", "a"), (5, "commit", "b"), (6, "insert", "c"),
       (7, "commit", "a"), (8, "rollback", "c"), (9, "insert", "a"), (30, "insert", "b"), (31, "commit", "b")]


def _batches(spark, cuts):
    df = spark.createDataFrame([("s", x, op, scn) for scn, op, x in LOG], "source string, xid string, op string, scn long")
    edges = [0, *cuts, 99]
    return [df.where((F.col("scn") > a) & (F.col("scn") <= b)) for a, b in zip(edges, edges[1:])]


@pytest.mark.parametrize("cuts", [[], [3], [2, 4, 6, 8], list(range(1, 10))])
def test_batches_release_what_one_batch_would(spark, cuts):
    path = scratch_path(spark, "txn")
    run = committed_batch(path)
    for i, batch in enumerate(_batches(spark, cuts)):
        run(batch, i)
        run(batch, i)  # a batch that is run again changes nothing
    got = {(r.scn, r.commit_scn) for r in released_changes(spark, path).collect()}
    assert got == {(2, 7), (4, 7), (3, 5), (30, 31)}


def test_old_open_rows_become_orphans(spark):
    path = scratch_path(spark, "txn")
    run = committed_batch(path, max_age_scn=10)
    for i, batch in enumerate(_batches(spark, [9])):
        run(batch, i)
    rows = spark.read.parquet(path).where("state = 'orphan'").collect()
    assert {r.scn for r in rows} == {9}


def test_stream_rate_window(spark):
    rows = spark.createDataFrame([("a", "2024-01-01 00:00:01"), ("a", "2024-01-01 00:00:02")], "ch string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    got = stream_rate(rows, "ts", "ch").agg(F.max("rate")).first()[0]
    assert got == 0.1


class _Query:
    def __init__(self, fail):
        self.fail = fail

    def awaitTermination(self):
        if self.fail:
            raise RuntimeError("down")


def test_restart_policies():
    def starts(fails):
        state = {"n": 0}

        def start():
            state["n"] += 1
            return _Query(state["n"] <= fails)

        return start

    quiet = {"sleep": lambda s: None}
    assert run_with_restart(RestartPolicy(), starts(5), **quiet) == 5
    with pytest.raises(RuntimeError):
        run_with_restart(RestartPolicy(), starts(6), **quiet)
    with pytest.raises(RuntimeError):
        run_with_restart(RestartPolicy("NoRestart"), starts(1), **quiet)
    times = iter([0, 1, 2, 200, 201])
    assert run_with_restart(RestartPolicy("failureRate"), starts(2), clock=lambda: next(times), **quiet) == 2
    times = iter([0, 1, 2])
    with pytest.raises(RuntimeError):
        run_with_restart(RestartPolicy("failureRate"), starts(3), clock=lambda: next(times), **quiet)


# ---- jobs -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def sf():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("test tables are not here")
    return path


def _job(reader, writer, **setting):
    return SyncJob.from_json(json.dumps({"job": {"content": [{"reader": reader, "writer": writer}], "setting": setting}}))


def test_job_text_and_checks():
    assert substitute("${a}-${b}-${c}", "a=1,b=x=y") == "1-x=y-${c}"
    for bad in ({}, {"job": {"content": []}}, {"job": {"content": [{"reader": {"name": "r", "parameter": {}}}]}},
                {"job": {"content": [{"reader": {"parameter": {}}, "writer": {"name": "w", "parameter": {}}}]}},
                {"job": {"content": [{"reader": {"name": "r"}, "writer": {"name": "w", "parameter": {}}}]}}):
        with pytest.raises(ValueError):
            SyncJob.from_json(json.dumps(bad))
    job = _job({"name": "r", "parameter": {"password": "p", "url": "u"}}, {"name": "w", "parameter": {}}, speed={"channel": 3, "bytes": 1000})
    assert job.masked()["reader"]["parameter"] == {"password": "******", "url": "u"}
    assert job.reader["parameter"]["password"] == "p"
    assert job.speed.channel == 3 and job.speed.limited and job.batch_rows(100.0) == 10
    assert job.error_limit == (0, 0.0)
    assert _job(job.reader, job.writer, errorLimit={"record": 7}).error_limit == (7, None)
    assert job.restart.strategy == "NoRestart"
    assert _job(job.reader, job.writer, restore={"isStream": True}).restart == RestartPolicy()


def test_job_from_messages_to_files(spark):
    src, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    rows = [("t", 0, i, v) for i, v in enumerate(['{"a":1}', "plain", None, " ", '{"a":2,"b":null}'])]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, value string")
    df.withColumns({"timestamp": F.current_timestamp(), "key": F.lit(None).cast("string")}).write.parquet(src)
    _job(
        {"name": "kafkareader", "parameter": {"topic": "t,u", "path": src, "codec": "json", "blankIgnore": True}},
        {"name": "kafkawriter", "parameter": {"topic": "to-%{a}", "path": out}},
        speed={"channel": 2, "rebalance": True},
    ).run(spark)
    got = {r.topic: json.loads(r.value) for r in spark.read.parquet(out).collect()}
    assert got["to-1"] == {"a": "1", "message": '{"a":1}'}
    assert got["to-%{a}"] == {"message": "plain"} and got["to-2"]["b"] is None and len(got) == 3


def test_print_sink_prints_every_row(spark, capsys):
    reader = {"name": "streamreader", "parameter": {"column": [{"type": "id"}], "sliceRecordCount": [50]}}
    _job(reader, {"name": "streamwriter", "parameter": {"print": True}}).run(spark)
    assert len(capsys.readouterr().out.split()) == 50


def test_redo_job_lands_whole_statements_of_committed_transactions(spark, sf):
    from cdcflow.operators.redo import mined_rows, redo_statements
    from cdcflow.operators.txn import committed_changes
    from cdcflow.workload.redolog import redo_pieces

    pieces, src, out = redo_pieces(spark, sf), scratch_path(spark, "in"), scratch_path(spark, "out")
    pieces.withColumn("timestamp", F.current_timestamp()).write.parquet(src)
    reader = {"name": "logminerreader", "parameter": {"path": src, "scn": -1, "whiteList": ["SALES.*"]}}
    _job(reader, {"name": "filewriter", "parameter": {"path": out}}).run(spark)
    whole = redo_statements(mined_rows(pieces, -1, ["SALES.*"])).withColumn("op", F.lower("operation")).drop("commit_scn")
    want = sorted((r.scn, r.commit_scn, r.sql_redo) for r in committed_changes(whole).collect())
    got = spark.read.parquet(out)
    assert sorted((r.SCN, r.COMMIT_SCN, r.SQL_REDO) for r in got.collect()) == want and len(want) > 1000 and "TIMESTAMP" in got.columns


def test_apply_job_folds_changes_into_versions(spark, sf):
    from cdcflow.operators.apply import apply_changes
    from cdcflow.operators.txn import committed_changes
    from cdcflow.sinks.tables import read_version, table_versions
    from cdcflow.workload.changelog import base_table, changelog

    src, base, out = scratch_path(spark, "changes"), scratch_path(spark, "base"), scratch_path(spark, "table")
    changes = committed_changes(changelog(spark, sf))
    changes.write.parquet(src)
    base_table(spark, sf).write.parquet(base)
    job = _job({"name": "filereader", "parameter": {"path": src}}, {"name": "applywriter", "parameter": {"path": out, "base": base, "keys": ["k"]}})
    want = sorted(map(tuple, apply_changes(base_table(spark, sf), changes, ["k"]).collect()))
    for _ in range(4):  # the same changes again change nothing
        job.run(spark)
        assert sorted(map(tuple, read_version(spark, out).collect())) == want
    assert table_versions(spark, out) == [2, 3]


def test_table_job_upserts_and_refuses(spark):
    from cdcflow.sinks.tables import read_version

    src, base, out, dirty = (scratch_path(spark, x) for x in ("rows", "base", "table", "dirty"))
    spark.createDataFrame([(1, "a", 1), (2, "b", 2), (2, "c", 3)], "id long, v string, n long").write.parquet(src)
    spark.createDataFrame([(1, "old", 0), (9, "kept", 0)], "id long, v string, n long").write.parquet(base)
    reader = {"name": "filereader", "parameter": {"path": src}}
    to = {"path": out, "base": base, "keys": ["id"], "order": ["n"]}
    _job(reader, {"name": "tablewriter", "parameter": {**to, "writeMode": "upsert"}}).run(spark)
    assert sorted(map(tuple, read_version(spark, out).collect())) == [(1, "a", 1), (2, "c", 3), (9, "kept", 0)]
    insert = {"name": "tablewriter", "parameter": {**to, "path": out + "-2", "writeMode": "insert"}}
    with pytest.raises(ErrorLimitExceeded):
        _job(reader, insert).run(spark)
    _job(reader, insert, errorLimit={"record": 2}, dirty={"path": dirty}).run(spark)
    assert sorted(map(tuple, read_version(spark, out + "-2").collect())) == [(1, "old", 0), (2, "b", 2), (9, "kept", 0)]
    assert spark.read.text(dirty).count() == 2


def test_statements_keep_their_order_and_passwords_are_masked(spark):
    redo = spark.createDataFrame([(7, 5, "s")], "COMMIT_SCN long, SCN long, SQL_REDO string")
    assert [tuple(r) for r in statement_rows(redo).collect()] == [("s", 7, 5)]
    events = spark.createDataFrame([({"SQL_REDO": "t"},)], "event map<string,string>")
    assert [tuple(r) for r in statement_rows(events).collect()] == [("t", None, None)]
    job = _job({"name": "jdbcreader", "parameter": {"connection": [{"password": "p1"}], "password": "p2"}}, {"name": "x", "parameter": {}})
    assert "p1" not in str(job.masked()) and "p2" not in str(job.masked())


def test_job_with_generated_rows_dirty_rows_and_limits(spark):
    out, dirty = scratch_path(spark, "out"), scratch_path(spark, "dirty")
    register_source("checked", lambda s, p, job: to_typed(s.createDataFrame([("1",), ("x",)], "v string"), [("v", "n", "INT", None)]))
    writer = {"name": "filewriter", "parameter": {"path": out, "writeMode": "OVERWRITE"}}
    with pytest.raises(ErrorLimitExceeded):
        _job({"name": "checked", "parameter": {}}, writer).run(spark)
    _job({"name": "checked", "parameter": {}}, writer, errorLimit={"record": 1}, dirty={"path": dirty}).run(spark)
    assert [r.n for r in spark.read.parquet(out).collect()] == [1]
    assert spark.read.text(dirty).count() == 1
    reader = {"name": "streamreader", "parameter": {"column": [{"type": "id"}, {"name": "c", "type": "string", "value": "k"}], "sliceRecordCount": [4]}}
    _job(reader, {"name": "streamwriter", "parameter": {"print": True}}).run(spark)
    taken = []
    register_sink("taken", lambda df, p, job: taken.extend(df.collect()))
    _job(reader, {"name": "taken", "parameter": {}}, speed={"channel": 2, "writerChannel": 1}).run(spark)
    assert len(taken) == 8
    with pytest.raises(ValueError):
        _job({"name": "nosuch", "parameter": {}}, writer).run(spark)


def test_fault_injection_and_channel_routing(spark):
    with pytest.raises(Exception, match="boom"):
        fail_on(spark.range(10).coalesce(1), 3, "boom").collect()
    assert fail_on(spark.range(2).coalesce(1), 3).count() == 2
    parts = route_channel(spark.range(100).withColumn("_channel", F.col("id") % 3), 4).withColumn("p", F.spark_partition_id())
    assert parts.groupBy("_channel").agg(F.count_distinct("p").alias("n")).where("n > 1").count() == 0


def test_streaming_job_lands_each_batch_once(spark):
    src, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    rows = spark.range(50).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.current_timestamp().alias("timestamp"), F.lit(None).cast("string").alias("key"),
        F.concat(F.lit('{"a":'), F.col("id"), F.lit("}")).alias("value"),
    )
    rows.write.parquet(src)
    job = _job(
        {"name": "kafkareader", "parameter": {"topic": "t", "path": src, "codec": "json"}},
        {"name": "kafkawriter", "parameter": {"topic": "x", "path": out}},
        restore={"isStream": True, "availableNow": True, "checkpoint": scratch_path(spark, "checkpoint")},
    )
    job.run(spark)
    job.run(spark)
    assert spark.read.parquet(out).count() == 50


def test_statements_of_redo_events(spark):
    events = [{"SQL_REDO": "a"}, {"message": '{"SQL_REDO":"b"}'}, {"message": "{SCN=1, SQL_REDO=c, OPERATION=UPDATE}"}, {"message": "other"}]
    df = spark.createDataFrame([(e,) for e in events], "event map<string,string>")
    assert {r.sql_redo for r in statement_rows(df).collect()} == {"a", "b", "c"}
    assert statement_rows(spark.createDataFrame([("z",)], "SQL_REDO string")).first().sql_redo == "z"
