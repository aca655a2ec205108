"""Queries over sinks and streams: what was written is read back and compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.operators.dirty import LINE_SEPARATOR
from cdcflow.operators.filters import filter_blank
from cdcflow.operators.records import decode_messages
from cdcflow.operators.txn import committed_changes
from cdcflow.plans.job import SyncJob
from cdcflow.session import materialize, scratch_path
from cdcflow.sinks.files import file_sink
from cdcflow.sinks.manifest import BucketTable
from cdcflow.sinks.tables import read_version, write_table
from cdcflow.sources.captured import MESSAGE_SCHEMA, captured_source
from cdcflow.sources.messages import MessageSource, message_source
from cdcflow.sources.position_log import write_position_log
from cdcflow.streaming.pg_stream import decoded_events, stream_pg_changes
from cdcflow.streaming.txn_state import ended, stream_transactions
from cdcflow.streaming.txn_stream import fold_deltas, released_changes, stream_apply, stream_committed
from cdcflow.workload import texts as X
from cdcflow.workload.changelog import LOG_SQL, base_table, changelog, flat
from cdcflow.workload.queries_redo import ALL_ROWS, REDO
from cdcflow.workload.queries_wire import HEAD, show_events
from cdcflow.workload.redolog import build_redo_log, pieces
from cdcflow.workload.registry import ORACLES, query, staged, table
from cdcflow.workload.wirelog import pg9_messages, pg_messages

FILES_PER_STEP = 8
BUCKETS = 32


@query("file_sink_roundtrip", "select o_orderkey, o_orderstatus, o_orderdate from orders")
def _roundtrip(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    path = scratch_path(spark, "file-sink")
    file_sink(orders, path, mode="overwrite", compression="zstd", max_file_bytes=200_000)
    return spark.read.schema(orders.schema).parquet(path)


def _users(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Target: every customer, under each third number.  Batch: every event, keyed by its user."""
    target = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") * 3).alias("id"), F.lit("base").alias("kind"), F.lit(-1).cast("long").alias("event")
    )
    batch = X.events(spark, sf_dir).select(
        F.col("user_id").alias("id"), F.col("event_type").alias("kind"), F.col("event_id").alias("event")
    )
    return target, batch


USERS = """with target as (select c_custkey * 3 id, 'base' kind, -1 event from customer),
 batch as (select user_id id, event_type kind, event_id event from events),
 firsts as (select * from batch qualify row_number() over (partition by id order by event) = 1),
 lasts as (select * from batch qualify row_number() over (partition by id order by event desc) = 1)"""


@query(
    "write_mode_insert",
    f"""{USERS}, won as (select * from firsts where id not in (select id from target))
        select id, kind, event, 'table' side from target union all select id, kind, event, 'table' from won
        union all select id, kind, event, 'duplicate' from batch where event not in (select event from won)""",
)
def _insert(spark, sf_dir):
    target, batch = _users(spark, sf_dir)
    result, refused = write_table(batch, target, "insert", ["id"], ["event"])
    return result.withColumn("side", F.lit("table")).unionByName(
        refused.select("id", "kind", "event", F.col("_errors")[0]["type"].alias("side"))
    )


@query(
    "write_mode_update",
    f"{USERS} select t.id, coalesce(l.kind, t.kind) kind, coalesce(l.event, t.event) event from target t left join lasts l using (id)",
)
def _update(spark, sf_dir):
    target, batch = _users(spark, sf_dir)
    return write_table(batch, target, "update", ["id"], ["event"])[0]


@query(
    "write_mode_upsert",
    f"{USERS} select id, kind, event from lasts union all select id, kind, event from target where id not in (select id from lasts)",
)
def _upsert(spark, sf_dir):
    target, batch = _users(spark, sf_dir)
    return write_table(batch, target, "upsert", ["id"], ["event"])[0]


@query("write_mode_append", f"{USERS} select * from target union all select * from batch")
def _append(spark, sf_dir):
    target, batch = _users(spark, sf_dir)
    return write_table(batch, target, "append")[0]


@query("write_mode_overwrite", f"{USERS} select * from batch")
def _overwrite(spark, sf_dir):
    target, batch = _users(spark, sf_dir)
    return write_table(batch, target, "overwrite")[0]


# ---- streams ----------------------------------------------------------------------------------


def _in_steps(df: DataFrame, pos: str, label: str, steps: int = 3) -> str:
    """The whole log written in ``steps`` runs of positions, as a source leaves it over time."""
    cuts = df.approxQuantile(pos, [i / steps for i in range(1, steps)], 0.001)
    path = scratch_path(df.sparkSession, label)
    low = None
    for cut in [*cuts, None]:
        part = df if low is None else df.where(F.col(pos) > low)
        part = part if cut is None else part.where(F.col(pos) <= cut)
        part.repartition(FILES_PER_STEP).write.mode("append").parquet(path)
        low = cut
    return path


def _read_stream(spark, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_STEP).parquet(path)


def _run_committed(spark, sf_dir) -> str:
    log = changelog(spark, sf_dir)
    source = _in_steps(log, "scn", "log-in")
    out = scratch_path(spark, "log-out")
    stream_committed(_read_stream(spark, source, log.schema), out, scratch_path(spark, "checkpoint")).awaitTermination()
    return out


@query(
    "stream_committed",
    f"with {LOG_SQL} select '7.3.' || (t%97) xid, op, scn, seq, commit_scn, bk, bst, bc, ak, ast, ac from live",
)
def _stream_committed(spark, sf_dir):
    return flat(released_changes(spark, _run_committed(spark, sf_dir)), "xid", "op", "scn", "seq", "commit_scn")


@query("stream_transactions", f"with {LOG_SQL} select '7.3.' || (t%97) xid, op, scn, seq, commit_scn, bk, bst, bc, ak, ast, ac from live")
def _stream_transactions(spark, sf_dir):
    log = changelog(spark, sf_dir)
    source, out = _in_steps(log, "scn", "log-in"), scratch_path(spark, "log-out")
    stream_transactions(_read_stream(spark, source, log.schema), out, scratch_path(spark, "checkpoint")).awaitTermination()
    return flat(ended(spark, out), "xid", "op", "scn", "seq", "commit_scn")


@query(
    "bucket_apply",
    f"""with {LOG_SQL},
    alive as (select g.* from g join tx using (t) where t%11 <> 0 and not is_last),
    fin as (select case when rekey then -k-1 else k end k, cst st, cc cents from alive where not del)
    select k, st, cents from fin
    union all select k, 'B', cents from o where k not in (select k from alive)""",
)
def _bucket_apply(spark, sf_dir):
    """The change log folded into a bucketed table in three batches, each of them twice."""
    changes = committed_changes(changelog(spark, sf_dir))
    table = BucketTable(spark, scratch_path(spark, "buckets"), base_table(spark, sf_dir), ["k"], BUCKETS)
    low, high = changes.approxQuantile("commit_scn", [0.5, 0.999], 0.0001)
    at = F.col("commit_scn")
    for batch, part in enumerate((at <= low, (at > low) & (at <= high), at > high)):
        for _ in range(2):
            table.fold_changes(changes.where(part), store=lambda delta: materialize(delta, "delta"), writer="log", batch=batch)
    return table.read()


def _position_stream(spark, log: DataFrame, key: str, pos: str, label: str, steps: int = 3) -> tuple[str, list[DataFrame]]:
    """An empty position log and the parts of a log that will be appended to it one after the other."""
    cuts = [None, *log.approxQuantile(pos, [i / steps for i in range(1, steps)], 0.001), None]
    parts = []
    for low, high in zip(cuts, cuts[1:]):
        part = log if low is None else log.where(F.col(pos) > low)
        parts.append(part if high is None else part.where(F.col(pos) <= high))
    return scratch_path(spark, label), parts


def _run_job(spark, reader: str, parameter: dict, parts: list[DataFrame], key: str, copied: Callable[[], None] = lambda: None) -> DataFrame:
    """A streamed job, started again after each part of its log; what it landed.  ``copied`` is called when the log holds all parts."""
    out, state = scratch_path(spark, "landed"), scratch_path(spark, "state")
    job = SyncJob(
        {"name": reader, "parameter": parameter}, {"name": "filewriter", "parameter": {"path": out}},
        {"restore": {"isStream": True, "availableNow": True, "checkpoint": state}},
    )
    for part in parts:
        write_position_log(part, parameter["path"], key)
        if part is parts[-1]:
            copied()
        job.run(spark)
    return spark.read.parquet(out)


@query("stream_pg9_changes", ORACLES["pg9_changes"])
def _stream_pg9(spark, sf_dir):
    path, parts = _position_stream(spark, pg9_messages(spark, sf_dir), "slot", "pos", "messages-in")
    events = _run_job(spark, "pg9walreader", {"path": path}, parts, "slot")
    return show_events(events.withColumnRenamed("type", "op"), *HEAD)


@query(
    "stream_redo",
    f"""{REDO}, {ALL_ROWS}, mined as (select *, operation in ('START','COMMIT','ROLLBACK') b from rows_ where operation not in ('START','COMMIT','ROLLBACK') or username <> 'SYS'),
        placed as (select *, first_value(case when b then operation end ignore nulls) over later outcome, first_value(case when b then scn end ignore nulls) over later commit_scn
                   from mined window later as (partition by xid order by scn rows between 1 following and unbounded following))
        select scn, commit_scn, operation, sql_redo from placed where not b and outcome = 'COMMIT' and sql_redo <> 'drop x' and not contains(sql_redo, 'temporary tables z')""",
)
def _stream_redo(spark, sf_dir):
    # The position log is the stored form of the pieces; they are cut from the stored statements as it grows.
    whole, copied = staged(spark, sf_dir, "redo_log", build_redo_log, "zstd")
    path, parts = _position_stream(spark, pieces(whole), "source", "pos", "redo-in")
    rows = _run_job(spark, "logminerreader", {"path": path, "scn": -1, "whiteList": ["SALES.*"]}, parts, "source", copied)
    return rows.select(F.col("SCN").alias("scn"), F.col("COMMIT_SCN").alias("commit_scn"), F.col("OPERATION").alias("operation"), F.col("SQL_REDO").alias("sql_redo"))


@query(
    "stream_apply",
    f"""with {LOG_SQL},
    alive as (select g.* from g join tx using (t) where t%11 <> 0 and not is_last),
    fin as (select case when rekey then -k-1 else k end k, cst st, cc cents from alive where not del)
    select k, st, cents from fin
    union all select k, 'B', cents from o where k not in (select k from alive)""",
)
def _stream_apply(spark, sf_dir):
    changes = released_changes(spark, _run_committed(spark, sf_dir))
    source = _in_steps(changes, "commit_scn", "changes-in")
    out = scratch_path(spark, "deltas")
    stream_apply(
        _read_stream(spark, source, changes.schema), out, scratch_path(spark, "checkpoint"), ["k"]
    ).awaitTermination()
    merged = scratch_path(spark, "merged")
    fold_deltas(spark, out, merged, ["k"], base_table(spark, sf_dir))
    return read_version(spark, merged)


@query("stream_pg_changes", ORACLES["pg_changes"])
def _stream_pg(spark, sf_dir):
    log = pg_messages(spark, sf_dir)
    source, out = _in_steps(log, "pos", "messages-in"), scratch_path(spark, "events")
    stream = captured_source(spark, source, "pos", schema=MESSAGE_SCHEMA, streaming=True, files_per_trigger=FILES_PER_STEP)
    stream_pg_changes(stream, out, scratch_path(spark, "checkpoint")).awaitTermination()
    return show_events(decoded_events(spark, out), *HEAD)


@query(
    "stream_file_sink",
    f"""with {X.MESSAGE_SQL} select topic, pos "offset", case when v like '{{%' then cast(j::json->>'event_id' as bigint) end event_id, v message
        from (select *, case when v like '{{%' then v else '{{}}' end j from msg where v is not null and trim(v) <> '')""",
)
def _stream_files(spark, sf_dir):
    messages = X.messages(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    source = _in_steps(messages, "offset", "messages-in")
    spec = MessageSource(
        "view,signup,click,error,purchase", kind="files", path=source, streaming=True, per_trigger=FILES_PER_STEP
    )
    rows = decode_messages(filter_blank(message_source(spark, spec), "value", True), "json")
    out = scratch_path(spark, "messages-out")
    (
        rows.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(out).select(
        "topic", "offset", F.col("event.event_id").cast("long").alias("event_id"), F.col("event.message").alias("message")
    )


@query(
    "job_dirty_columns",
    """select event_id, case when event_id % 10 = 3 then 'dirty' else 'good' end side, case when event_id % 10 <> 3 then event_id * 2 end n,
        case when event_id % 10 = 3 then 'x' || event_id end refused from events""",
)
def _dirty_columns(spark, sf_dir):
    """A job whose declared type does not fit every text: what it lands, and what it puts aside."""
    number = F.when(F.col("event_id") % 10 == 3, F.concat(F.lit("x"), F.col("event_id").cast("string"))).otherwise((F.col("event_id") * 2).cast("string"))
    source, out, dirty = (scratch_path(spark, x) for x in ("events-in", "landed", "dirty"))
    X.events(spark, sf_dir).select("event_id", number.alias("n")).write.parquet(source)
    job = SyncJob(
        {"name": "filereader", "parameter": {"path": source, "column": ["event_id", {"name": "n", "type": "BIGINT"}]}},
        {"name": "filewriter", "parameter": {"path": out}}, {"errorLimit": {"record": -1, "percentage": 10.0}, "dirty": {"path": dirty}},
    )
    job.run(spark)
    good = spark.read.parquet(out).select("event_id", F.lit("good").alias("side"), "n", F.lit(None).cast("string").alias("refused"))
    line = F.split("value", LINE_SEPARATOR)
    text = F.regexp_extract(line[2], r"can't read as BIGINT: (x\d+)", 1)
    put_aside = spark.read.text(dirty).select(F.get_json_object(line[0], "$.event_id").cast("long").alias("event_id"), F.lit("dirty").alias("side"), F.lit(None).cast("long").alias("n"), text.alias("refused"))
    return good.unionByName(put_aside)
