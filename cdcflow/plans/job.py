"""JSON jobs: one reader, one writer, and settings for speed, errors, dirty rows and restore."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from copy import deepcopy
from dataclasses import dataclass, field
from hashlib import md5
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from cdcflow.operators.dirty import ERRORS, judge_counts, staged_split, write_dirty
from cdcflow.operators.filters import filter_blank, filter_category, filter_empty_events, filter_tables
from cdcflow.operators.envelope import envelope
from cdcflow.operators.metrics import rows_per_trigger
from cdcflow.operators.offsets import incremental_scan, load_offsets, save_offsets
from cdcflow.operators.pg9 import pg9_events
from cdcflow.operators.pgoutput import messages_since, pg_events
from cdcflow.operators.positions import plan_slices
from cdcflow.operators.records import decode_messages, project_checked, to_message_records
from cdcflow.operators.redo import mined_rows, redo_from_message
from cdcflow.session import materialize, shared_dir
from cdcflow.sinks.files import discard, file_sink, print_rows
from cdcflow.sinks.manifest import DEFAULT_BUCKETS, BucketTable
from cdcflow.sinks.tables import write_table
from cdcflow.sources.jdbc import Connection, jdbc_scan, merge_url
from cdcflow.sources.messages import MessageSource, message_source
from cdcflow.sources.position_log import position_log
from cdcflow.sources.synthetic import synthetic_rows, synthetic_stream
from cdcflow.streaming.flush import ByteRate, row_bytes
from cdcflow.streaming.restart import RestartPolicy, run_with_restart
from cdcflow.streaming.steps import Step, pg9_step, pg_step, redo_rows, redo_step

MASK = "******"
#: Writers that fold each batch into one table, whose ledger knows the batches it holds.
VERSIONED = ("applywriter", "tablewriter", "logminerwriter")
UNLIMITED_BYTES = 2**63 - 1
#: What a redo record is made of, where the log has it.
REDO_COLUMNS = ("scn", "seq", "pos", "seg_owner", "table_name", "timestamp", "sql_redo", "operation")

Reader = Callable[[SparkSession, Mapping[str, Any], "SyncJob"], DataFrame]
Writer = Callable[[DataFrame, Mapping[str, Any], "SyncJob"], None]
SOURCES: dict[str, Reader] = {}
SINKS: dict[str, Writer] = {}
#: What streamed jobs of a reader do with each batch before it lands, given the job and a folder for their context.
STEPS: dict[str, Callable[["SyncJob", str], Step]] = {}
DECODERS: dict[str, Callable] = {}


def register_source(name: str, fn: Reader) -> None:
    SOURCES[name.lower()] = fn


def register_sink(name: str, fn: Writer) -> None:
    SINKS[name.lower()] = fn


def register_decoder(name: str, fn: Callable) -> None:
    DECODERS[name] = fn


def substitute(text: str, params: str | Mapping[str, str] | None) -> str:
    """Replace ``${name}``; parameters may come as ``a=1,b=2``."""
    if isinstance(params, str):
        params = dict(p.split("=", 1) for p in params.split(",") if "=" in p)
    for name, value in (params or {}).items():
        text = text.replace("${" + name + "}", value)
    return text


@dataclass(frozen=True)
class Speed:
    channel: int = 1
    reader_channel: int = -1
    writer_channel: int = -1
    bytes: int = UNLIMITED_BYTES
    rebalance: bool = False

    @property
    def readers(self) -> int:
        """Tasks that read, where a source can be split."""
        return max(self.reader_channel if self.reader_channel > 0 else self.channel, 1)

    @property
    def limited(self) -> bool:
        return 0 < self.bytes < UNLIMITED_BYTES

    def shape(self, df: DataFrame) -> DataFrame:
        """Spread rows as the job asks: a rebalance, or fewer writers than readers."""
        n = self.writer_channel if self.writer_channel > 0 else self.channel
        if self.rebalance:
            return df.repartition(n) if n > 1 else df.hint("rebalance")
        return df.coalesce(self.writer_channel) if self.writer_channel > 0 else df


def route_channel(df: DataFrame, n: int, channel: str = "_channel") -> DataFrame:
    """Send rows of a channel to the same task."""
    return df.repartition(n, channel)


@dataclass(frozen=True)
class SyncJob:
    """A parsed job."""

    reader: Mapping[str, Any]
    writer: Mapping[str, Any]
    setting: Mapping[str, Any] = field(default_factory=dict)

    @classmethod
    def from_json(cls, text: str, params: str | Mapping[str, str] | None = None) -> "SyncJob":
        job = json.loads(substitute(text, params)).get("job")
        if not job:
            raise ValueError("the JSON has no job")
        content = job.get("content")
        if not content:
            raise ValueError("the job has no content")
        for side in ("reader", "writer"):
            part = content[0].get(side)
            if part is None:
                raise ValueError(f"the job's content lacks its {side}")
            if part.get("name") is None:
                raise ValueError(f"the {side} is not named")
            if part.get("parameter") is None:
                raise ValueError(f"the {side} has no parameter block")
        return cls(content[0]["reader"], content[0]["writer"], job.get("setting") or {})

    def masked(self) -> dict[str, Any]:
        """The job without its passwords, for logs."""
        out = {"reader": deepcopy(dict(self.reader)), "writer": deepcopy(dict(self.writer)), "setting": deepcopy(dict(self.setting))}
        for side in ("reader", "writer"):
            part = out[side]["parameter"]
            for place in [part, *(part.get("connection") or [])]:
                if "password" in place:
                    place["password"] = MASK
        return out

    @property
    def speed(self) -> Speed:
        s = self.setting.get("speed") or {}
        return Speed(
            int(s.get("channel", 1)), int(s.get("readerChannel", -1)), int(s.get("writerChannel", -1)),
            int(s.get("bytes", UNLIMITED_BYTES)), bool(s.get("rebalance", False)),
        )

    @property
    def error_limit(self) -> tuple[int | None, float | None]:
        """(records, percentage); without the block both are 0, inside it a missing one is off."""
        block = self.setting.get("errorLimit")
        if block is None:
            return 0, 0.0
        record = int(block.get("record", -1))
        return (None if record == -1 else record), block.get("percentage")

    @property
    def restart(self) -> RestartPolicy:
        if not (self.setting.get("restore") or {}).get("isStream", False):
            return RestartPolicy(strategy="NoRestart")
        return RestartPolicy.from_setting(self.setting.get("restart"))

    def batch_rows(self, bytes_per_row: float, trigger_seconds: float = 1.0) -> int | None:
        """Rows per trigger under the byte limit, or None when there is no limit."""
        return rows_per_trigger(self.speed.bytes, trigger_seconds, bytes_per_row) if self.speed.limited else None

    def read(self, spark: SparkSession) -> DataFrame:
        name = self.reader["name"].lower()
        if name not in SOURCES:
            raise ValueError(f"unknown reader {name!r}; register_source adds one")
        df = SOURCES[name](spark, self.reader["parameter"], self)
        fail_after = int((self.setting.get("test") or {}).get("failedPerRecord", 0))
        return fail_on(df, fail_after, (self.setting.get("test") or {}).get("errorMsg")) if fail_after > 0 else df

    def run(self, spark: SparkSession) -> None:
        """Read, check the error limits, keep dirty rows aside, write the good ones."""
        df = self.read(spark)
        if df.isStreaming:
            run_with_restart(self.restart, lambda: self.start(df))
        else:
            self._land(df, self.writer["parameter"])

    @property
    def name(self) -> str:
        """A digest of what is read and written: the job's name in ledgers and saved positions."""
        return md5(json.dumps([self.reader, self.writer], sort_keys=True).encode()).hexdigest()

    @property
    def restores(self) -> bool:
        """A batch job that saves how far it came, by the values of its restore column."""
        restore = self.setting.get("restore") or {}
        return bool(restore.get("isRestore", False)) and bool(restore.get("restoreColumnName")) and not self.streaming

    @property
    def streaming(self) -> bool:
        return bool((self.setting.get("restore") or {}).get("isStream", False))

    def state_path(self, spark: SparkSession) -> str:
        """Where the job keeps its checkpoint, context and positions."""
        return (self.setting.get("restore") or {}).get("checkpoint") or f"{shared_dir(spark)}/jobs/{self.name}"

    def start(self, df: DataFrame) -> StreamingQuery:
        """Start the streaming form: every micro-batch is landed like a batch job.

        Batches written to a path get a folder each, so one that is run again replaces itself; tables
        pass over batches that their ledger holds.  Under a byte limit each batch is weighed while it is
        written, and the next one waits until the rate allows it.
        """
        params = self.writer["parameter"]
        restore = self.setting.get("restore") or {}
        checkpoint = self.state_path(df.sparkSession)
        make = STEPS.get(self.reader["name"].lower())
        step = make(self, f"{checkpoint}-context") if make else None

        rate = ByteRate(self.speed.bytes) if self.speed.limited else None

        def land(batch: DataFrame, batch_id: int) -> None:
            seen = None
            if rate is not None:
                seen = Observation()
                batch = batch.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(batch.columns)), F.lit(0)).alias("bytes"))
            write(batch, batch_id)
            if seen is not None:
                rate.charge(seen.get["rows"], seen.get["bytes"])

        def write(batch: DataFrame, batch_id: int) -> None:
            own = {**params, "batchId": batch_id}
            if params.get("path") and self.writer["name"].lower() not in VERSIONED:
                own |= {"path": f"{params['path']}/batch={batch_id}", "writeMode": "overwrite"}
            self._land(batch if step is None else step(batch, batch_id), own)

        writer = df.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
        if restore.get("availableNow"):
            return writer.trigger(availableNow=True).start()
        seconds = self.reader["parameter"].get("interval", 5)
        return writer.trigger(processingTime=f"{seconds} seconds").start()

    def _land(self, df: DataFrame, params: Mapping[str, Any]) -> None:
        """Write what has no errors.  Rows that may have some are read once: staged by verdict, counted on the way."""
        speed_test = (self.setting.get("test") or {}).get("speedTest")
        if speed_test == "reader":
            return discard(df)
        if ERRORS in df.columns:
            df, dirty, counts = staged_split(df)
            judge_counts(counts["num_read"], counts["errors"], *self.error_limit)
            where = (self.setting.get("dirty") or {}).get("path")
            if where and counts["errors"]:
                write_dirty(dirty, [c for c in df.columns], where)
        name = self.writer["name"].lower()
        if name not in SINKS:
            raise ValueError(f"unknown writer {name!r}; register_sink adds one")
        SINKS[name](self.speed.shape(df), params, self)


def fail_on(df: DataFrame, every: int, message: str | None = None) -> DataFrame:
    """Fault injection: a task fails when it has read ``every`` rows.

    Row numbers here only count within a task, as the test switch means them.
    """
    count = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    text = F.lit(message or "test failure")
    return df.withColumn("_fail", F.when(count >= every, F.raise_error(text)).otherwise(F.lit(None).cast("string"))).where(
        F.col("_fail").isNull()
    ).drop("_fail")


# ---- readers and writers a job may name -------------------------------------------------------


def _kafka_reader(spark: SparkSession, p: Mapping[str, Any], job: SyncJob) -> DataFrame:
    settings = p.get("consumerSettings") or {}
    starting = settings.get("auto.offset.reset", "earliest")
    kind = "files" if p.get("path") else "kafka"
    spec = MessageSource(
        p["topic"], kind=kind, path=p.get("path"), fmt=p.get("format", "parquet"),
        settings={k: str(v) for k, v in settings.items() if k != "auto.offset.reset"},
        starting=starting, streaming=bool((job.setting.get("restore") or {}).get("isStream", False)),
        per_trigger=job.batch_rows(float(p.get("bytesPerRow", 1000)), float(p.get("interval", 5))) if kind == "kafka" else None,
    )
    rows = filter_blank(message_source(spark, spec), "value", bool(p.get("blankIgnore", False)))
    return filter_empty_events(decode_messages(rows, p.get("codec", "plain"), decoders=DECODERS)).select("event")


def _stream_reader(spark: SparkSession, p: Mapping[str, Any], job: SyncJob) -> DataFrame:
    counts = [int(n) for n in p.get("sliceRecordCount") or []]
    columns = [{"name": c.get("name") or f"c{i}", **{k: v for k, v in c.items() if k != "name"}} for i, c in enumerate(p["column"])]
    if not counts or min(counts) <= 0:
        return synthetic_stream(spark, columns)
    channels = job.speed.readers
    per = [counts[i] if i < len(counts) else counts[-1] for i in range(max(channels, len(counts)))]
    return synthetic_rows(spark, columns, per).drop("_channel")


def _log_stream(spark: SparkSession, p: Mapping[str, Any], key: str, position: str) -> DataFrame:
    """A captured log as a stream by positions; its folders are ``<key>=<value>``."""
    found = spark.read.format(p.get("format", "parquet")).load(p["path"]).schema
    schema = StructType([StructField(f.name, StringType()) if f.name == key else f for f in found])
    return position_log(spark, p["path"], schema, key=key, position=position, partition_rows=int(p.get("partitionRows", 1_000_000)))


def _captured(decode: Callable) -> Reader:
    def read(spark: SparkSession, p: Mapping[str, Any], job: SyncJob) -> DataFrame:
        if job.streaming:
            return _log_stream(spark, p, "slot", "pos")
        messages = spark.read.format(p.get("format", "parquet")).load(p["path"])
        if lsn := int(p.get("lsn") or 0):
            messages = messages_since(messages, lsn)
        events = decode(messages, p.get("cat") or "insert,update,delete", p.get("tableList") or None, slices=plan_slices(messages, "pos", ["slot"]))
        return envelope(events, flat=bool(p.get("pavingData", False)))

    return read


def _captured_step(make: Callable) -> Callable[["SyncJob", str], Step]:
    def steps(job: SyncJob, path: str) -> Step:
        p = job.reader["parameter"]
        step, lsn = make(path, p.get("cat") or "insert,update,delete", p.get("tableList") or None), int(p.get("lsn") or 0)

        def run(batch: DataFrame, batch_id: int) -> DataFrame:
            events = step(batch, batch_id)
            return envelope(events.where(F.col("pos") >= lsn) if lsn else events, flat=bool(p.get("pavingData", False)))

        return run

    return steps


def _redo_reader(spark: SparkSession, p: Mapping[str, Any], job: SyncJob) -> DataFrame:
    """Whole statements of committed transactions (``mode: "raw"``: of all), from mined rows or their pieces."""
    if job.streaming:
        names = spark.read.format(p.get("format", "parquet")).load(p["path"]).columns
        return _log_stream(spark, p, "source", "pos" if "pos" in names else "scn")
    log = spark.read.format(p.get("format", "parquet")).load(p["path"])
    return _redo_result(redo_rows(mined_rows(log, int(p.get("scn") or 0), p["whiteList"], p.get("blackList") or []), p.get("mode", "committed")), p)


def _redo_steps(job: SyncJob, path: str) -> Step:
    p = job.reader["parameter"]
    step = redo_step(path, int(p.get("scn") or 0), p["whiteList"], p.get("blackList") or [], p.get("mode", "committed"), REDO_COLUMNS)
    return lambda batch, batch_id: _redo_result(step(batch, batch_id), p)


def _redo_result(rows: DataFrame, p: Mapping[str, Any]) -> DataFrame:
    """The columns of a redo record; SEQ tells statements of one SCN apart where the log has an order for them."""
    if p.get("cat"):
        rows = filter_category(rows.withColumn("table", F.col("table_name")), p["cat"], "operation")
    when = [F.col("timestamp").alias("TIMESTAMP")] if "timestamp" in rows.columns else []
    place = next((c for c in ("seq", "pos") if c in rows.columns), None)
    return rows.select(
        F.col("scn").alias("SCN"), F.col("commit_scn").alias("COMMIT_SCN"), *([F.col(place).cast("long").alias("SEQ")] if place else []),
        F.col("seg_owner").alias("SEG_OWNER"), F.col("table_name").alias("TABLE_NAME"),
        *when, F.col("sql_redo").alias("SQL_REDO"), F.col("operation").alias("OPERATION"),
    )


def saved_position(spark: SparkSession, job: SyncJob) -> int | None:
    """How far the job has come: from the manifest of the table it writes, or from its saved positions."""
    p = job.writer["parameter"]
    if job.writer["name"].lower() in VERSIONED and p.get("path"):
        held = BucketTable(spark, p["path"]).manifest()
        return None if held is None else held.positions.get(job.name)
    try:
        saved = load_offsets(spark.read.parquet(f"{job.state_path(spark)}-positions")).where(F.col("job") == job.name).first()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
            raise
        return None
    return None if saved is None else saved["position"]


def _file_reader(spark: SparkSession, p: Mapping[str, Any], job: SyncJob) -> DataFrame:
    df = spark.read.format(p.get("format", "parquet")).options(**(p.get("options") or {})).load(p["path"])
    if p.get("tableList"):
        df = filter_tables(df, p["tableList"])
    restore = job.setting.get("restore") or {}
    column, start = restore.get("restoreColumnName"), p.get("startLocation")
    if job.restores and (saved := saved_position(spark, job)) is not None:
        start = saved
    if start is not None and column:
        df = incremental_scan(df, column, start)
    return project_checked(df, p.get("column") or ["*"])


def _jdbc_reader(spark: SparkSession, p: Mapping[str, Any], job: SyncJob) -> DataFrame:
    out = None
    for c in p["connection"]:
        urls = c["jdbcUrl"] if isinstance(c["jdbcUrl"], list) else [c["jdbcUrl"]]
        for url in urls:
            for table in c["table"]:
                target = Connection(
                    merge_url(url) if p.get("mergeUrl", False) else url, table, c.get("username") or p.get("username"),
                    c.get("password") or p.get("password"), p.get("driver"), c.get("schema"),
                )
                one = jdbc_scan(spark, target, p.get("splitPk"), job.speed.readers, p.get("where"))
                out = one if out is None else out.unionByName(one)
    return project_checked(out, p.get("column") or ["*"])


def _kafka_writer(df: DataFrame, p: Mapping[str, Any], job: SyncJob) -> None:
    records = to_message_records(df, p["topic"], p.get("tableFields"), p.get("timezone", "UTC"))
    if p.get("path"):
        return file_sink(records, p["path"], p.get("format", "parquet"))
    out = records.write.format("kafka")
    for name, value in (p.get("producerSettings") or {}).items():
        out = out.option(f"kafka.{name}", str(value))
    out.save()


def statement_rows(df: DataFrame) -> DataFrame:
    """The statements carried by redo rows, event maps or printed messages, one per row, with their order."""
    if "SQL_REDO" in df.columns:
        sql = F.col("SQL_REDO")
    else:
        event = F.col("event")
        message = F.try_element_at(event, F.lit("message"))
        sql = F.coalesce(
            F.try_element_at(event, F.lit("SQL_REDO")),
            redo_from_message(message, "json"),
            F.nullif(redo_from_message(message, "map"), F.lit("")),
        )
    order = [F.col(c).alias(c.lower()) if c in df.columns else F.lit(None).cast("bigint").alias(c.lower()) for c in ("COMMIT_SCN", "SCN")]
    order += [F.col("SEQ").alias("seq")] if "SEQ" in df.columns else []
    out = df.select(sql.alias("sql_redo"), *order)
    return out.where(F.col("sql_redo").isNotNull())


def _redo_writer(df: DataFrame, p: Mapping[str, Any], job: SyncJob) -> None:
    """Statements to a staging table with a batch id and their order.

    The database replays a batch by (commit_scn, scn, seq) in its own transaction and marks the batch as
    done, so a batch that is staged again is passed over.  With a ``path`` the stage is a bucketed table of
    files instead, whose ledger passes over a batch that it holds.
    """
    if p.get("path"):
        rows = statement_rows(df).withColumn("batch_id", F.lit(int(p.get("batchId", 0))).cast("bigint"))
        empty = df.sparkSession.createDataFrame([], rows.schema)
        stage = BucketTable(df.sparkSession, p["path"], empty, ["commit_scn"], int(p.get("buckets", DEFAULT_BUCKETS)))
        stage.commit(added=rows, **_commit_as(job, p, None))
        return
    target = Connection(p["url"], p.get("stagingTable", "REDO_STAGE"), p.get("username"), p.get("password"), p.get("driver"))
    statement_rows(df).withColumn("batch_id", F.lit(int(p.get("batchId", 0))).cast("bigint")).write.mode("append").option("batchsize", int(p.get("batchsize", 1))).jdbc(
        target.url, target.qualified, properties=target.properties()
    )


def _target(df: DataFrame, p: Mapping[str, Any]) -> BucketTable:
    """The table a job writes; before its first version it holds the rows of the table named as ``base``."""
    spark = df.sparkSession
    table = BucketTable(spark, p["path"])
    if table.manifest() is None:
        base = spark.read.format(p.get("format", "parquet")).load(p["base"])
        table = BucketTable(spark, p["path"], base, p.get("keys") or (), int(p.get("buckets", DEFAULT_BUCKETS)))
    return table


def _commit_as(job: SyncJob, p: Mapping[str, Any], reached: Mapping[str, int] | None) -> dict[str, Any]:
    """How a batch is entered: streamed ones in the ledger, restorable ones with the position they reach."""
    own: dict[str, Any] = {"positions": reached}
    if p.get("batchId") is not None:
        own |= {"writer": job.name, "batch": int(p["batchId"])}
    return own


def _counted(df: DataFrame, job: SyncJob, label: str) -> tuple[DataFrame, dict[str, int] | None]:
    """The rows stored once, and the position they reach if the job saves one; found while they are written."""
    column = (job.setting.get("restore") or {}).get("restoreColumnName")
    if not job.restores or column not in df.columns:
        return materialize(df, label), None
    seen = Observation()
    rows = materialize(df.observe(seen, F.max(F.col(column)).cast("long").alias("reached")), label)
    reached = seen.get["reached"]
    return rows, None if reached is None else {job.name: reached}


def _apply_writer(df: DataFrame, p: Mapping[str, Any], job: SyncJob) -> None:
    """Changes (``before`` and ``after`` structs, in commit order) folded into the touched buckets of a table."""
    table = _target(df, p)
    rows, reached = _counted(df, job, "changes") if job.restores else (df, None)
    table.fold_changes(rows, p.get("order"), store=lambda delta: materialize(delta, "delta"), **_commit_as(job, p, reached))
    table.vacuum(int(p.get("keepVersions", 2)))


def _table_writer(df: DataFrame, p: Mapping[str, Any], job: SyncJob) -> None:
    """Rows written into the touched buckets of a table; rows that an insert refuses go to the dirty path."""
    table, mode, keys, order = _target(df, p), p.get("writeMode", "upsert").lower(), p.get("keys") or (), p.get("order") or ()
    entry = _commit_as(job, p, None)
    if table.before().holds(entry.get("writer"), entry.get("batch")):
        return
    rows, entry["positions"] = _counted(df, job, "rows")
    refused: list[DataFrame] = []

    def change(held: DataFrame, _: Any) -> DataFrame:
        out, bad = write_table(rows, held, mode, keys, order)
        refused.extend([] if bad is None else [bad])
        return out

    def check() -> None:
        for bad in refused:
            count = bad.count()
            judge_counts(rows.count(), count, *job.error_limit)
            where = (job.setting.get("dirty") or {}).get("path")
            if where and count:
                write_dirty(bad, [c for c in df.columns], where)

    if mode == "append":
        table.commit(added=rows, **entry)
    else:
        table.commit(change, touched=None if mode == "overwrite" else rows, check=check, **entry)
    table.vacuum(int(p.get("keepVersions", 2)))


def _print_writer(df: DataFrame, p: Mapping[str, Any], job: SyncJob) -> None:
    if p.get("print", False):
        return print_rows(df, p.get("writeDelimiter", "|"))
    discard(df)


def _file_writer(df: DataFrame, p: Mapping[str, Any], job: SyncJob) -> None:
    """Files; a job that saves its position writes what follows a position into a folder named after it.

    The position is saved after the rows: a run that dies between the two leaves a folder that the next
    run, which starts at the same position, writes over.
    """
    path, mode, column = p["path"], (p.get("writeMode") or "append").lower(), (job.setting.get("restore") or {}).get("restoreColumnName")
    seen = None
    if job.restores and column in df.columns:
        start = saved_position(df.sparkSession, job)
        path, mode, seen = f"{path}/after={'start' if start is None else start}", "overwrite", Observation()
        df = df.observe(seen, F.max(F.col(column)).cast("long").alias("reached"), F.count(F.lit(1)).alias("rows"))
    file_sink(
        df, path, p.get("format", "parquet"), mode, p.get("compress"),
        int(p["maxFileSize"]) if p.get("maxFileSize") else None, charset=p.get("charSetName"),
    )
    if seen is not None and seen.get["reached"] is not None:
        spark = df.sparkSession
        done = spark.createDataFrame([(job.name, 0, seen.get["reached"], seen.get["rows"])], "job string, channel int, position long, rows long")
        save_offsets(done, f"{job.state_path(spark)}-positions")


for _name, _fn in {
    "kafkareader": _kafka_reader,
    "streamreader": _stream_reader,
    "pgwalreader": _captured(pg_events),
    "pg9walreader": _captured(pg9_events),
    "logminerreader": _redo_reader,
    "filereader": _file_reader,
    "jdbcreader": _jdbc_reader,
}.items():
    register_source(_name, _fn)
for _name, _sink in {"kafkawriter": _kafka_writer, "streamwriter": _print_writer, "filewriter": _file_writer, "logminerwriter": _redo_writer, "applywriter": _apply_writer, "tablewriter": _table_writer}.items():
    register_sink(_name, _sink)
for _name, _steps in {"pgwalreader": _captured_step(pg_step), "pg9walreader": _captured_step(pg9_step), "logminerreader": _redo_steps}.items():
    STEPS[_name] = _steps
