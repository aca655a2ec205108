"""What a streamed job does with each micro-batch of a captured log before it lands.

A batch alone lacks what came before it: transaction context, table definitions, open transactions,
unfinished statements.  Each step stores those rows of its input under the batch number and puts them
before the next batch.  A batch that is run again reads the same rows and stores the same.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cdcflow.operators.pg9 import pg9_events
from cdcflow.operators.pgoutput import context_messages, pg_events
from cdcflow.operators.positions import ROWS_PER_SLICE, SLICES_PER_TASK, WHOLE, plan_slices
from cdcflow.operators.redo import drop_internal, mined_rows, redo_statements
from cdcflow.operators.txn import BOUNDARY, DML, TXN_KEYS, committed_changes
from cdcflow.session import materialize, settings
from cdcflow.sinks.tables import drop_folder, numbered_folders

Step = Callable[[DataFrame, int], DataFrame]
#: Batches whose context is kept: the last one's, and the one before for a batch that is run again.
KEPT_CONTEXTS = 2
#: Open transactions that may be broadcast to the rows of a batch; beyond, the same join shuffles.
HELD_OPEN = 20_000
PIECES_PER_TASK = ROWS_PER_SLICE * SLICES_PER_TASK
#: What pieces are stitched by, statements judged by and transactions assembled by.
REDO_FACTS = ("source", "xid", "rs_id", "pos", "csf", "scn", "seq", "operation", "info", "sql_redo")


class Context:
    """Rows that one batch leaves for the next, in a folder per batch."""

    def __init__(self, spark: SparkSession, path: str, kept: int = KEPT_CONTEXTS):
        self.spark, self.path, self.kept = spark, path, kept

    def before(self, batch_id: int, schema: StructType) -> DataFrame | None:
        """What the last batch before this one left."""
        known = [n for n in numbered_folders(self.spark, self.path, "batch") if n < batch_id]
        return self.spark.read.schema(schema).parquet(f"{self.path}/batch={known[-1]}") if known else None

    def keep(self, rows: DataFrame, batch_id: int) -> None:
        with settings(self.spark):
            rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}", compression="zstd")
        for old in numbered_folders(self.spark, self.path, "batch")[: -self.kept]:
            drop_folder(self.spark, f"{self.path}/batch={old}")

    def stored(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """The rows as written once, for a batch that several passes read; those of the batch before go first."""
        for old in numbered_folders(self.spark, self.path, "batch"):
            if old < batch_id:
                drop_folder(self.spark, f"{self.path}/batch={old}")
        self.keep(rows, batch_id)
        return self.spark.read.schema(rows.schema).parquet(f"{self.path}/batch={batch_id}")


def _joined(batch: DataFrame, context: Context, batch_id: int) -> DataFrame:
    earlier = context.before(batch_id, batch.schema)
    return batch if earlier is None else batch.unionByName(earlier)


def message_step(decode: Callable, path: str, cat: str, tables: Sequence[str] | None) -> Step:
    """Messages of a batch as change events, damaged and unknown ones with their errors.

    Context is the last BEGIN of each slot and the last definition of each table; it gives no events.
    """

    def step(batch: DataFrame, batch_id: int) -> DataFrame:
        context = Context(batch.sparkSession, path)
        rows = _joined(batch.select("slot", "pos", "msg"), context, batch_id)
        context.keep(context_messages(rows), batch_id)
        return decode(rows, cat, tables, slices=plan_slices(rows, "pos", ["slot"]))

    return step


def pg_step(path: str, cat: str = "insert,update,delete", tables: Sequence[str] | None = None) -> Step:
    return message_step(pg_events, path, cat, tables)


def pg9_step(path: str, cat: str = "insert,update,delete", tables: Sequence[str] | None = None) -> Step:
    return message_step(pg9_events, path, cat, tables)


def redo_rows(
    rows: DataFrame, mode: str = "committed", store: Callable[[DataFrame], DataFrame] | None = None, size: int | None = None
) -> DataFrame:
    """Whole statements of committed transactions (``raw``: of all), from mined rows or their pieces.

    Statements are stored once, since their slices are planned before they are read; ``store`` says where.
    ``size`` is the number of rows where it is known: pieces then go to as many tasks as they fill, if the
    session would use fewer, so that a task sorts its share in memory.
    """
    store = store or (lambda whole: materialize(whole, "redo-statements"))
    if "csf" in rows.columns:
        slices, tasks = plan_slices(rows, "pos", ["source", "rs_id"]), -(-(size or 0) // PIECES_PER_TASK)
        if slices.single and tasks > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")):
            rows = rows.repartition(tasks, "source", "xid", "rs_id")
        rows = redo_statements(rows, slices=slices)
    else:
        rows = drop_internal(rows)
    rows = rows.drop("commit_scn").withColumn("op", F.lower("operation"))
    if mode != "raw":
        rows = store(rows)
    rows = committed_changes(rows, mode=mode, slices=WHOLE if mode == "raw" else plan_slices(rows, "scn", TXN_KEYS))
    return rows.where(F.col("sql_redo").isNotNull())


def open_rows(rows: DataFrame, mode: str = "committed", store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Mined rows, pieces included, that a later batch may still need: those behind the last boundary of their transaction.

    In ``raw`` mode only statements whose last piece has not come yet are needed.  Transactions that are
    still open are found first, from their positions alone, and stored; ``store`` says where.  The rows
    themselves are read in place while these are few.
    """
    if mode == "raw":
        if "csf" not in rows.columns:
            return rows.where(F.lit(False))
        last = rows.groupBy("source", "xid", "rs_id").agg(F.max_by("csf", "pos").alias("_more"))
        return rows.join(last.where("_more = 1").drop("_more"), ["source", "xid", "rs_id"], "left_semi")
    store = store or (lambda found: materialize(found, "open-transactions"))
    known = rows.withColumn("op", F.lower("operation")).withColumn("_at", F.struct("scn", "seq") if "seq" in rows.columns else F.col("scn"))
    change, latest = F.col("op").isin(*DML), lambda kinds: F.max(F.when(F.col("op").isin(*kinds), F.col("_at")))

    def behind(at: Column) -> Column:
        """Behind every boundary, where START stands first and COMMIT or ROLLBACK last at its position."""
        return (F.col("_start").isNull() | (at >= F.col("_start"))) & (F.col("_end").isNull() | (at > F.col("_end")))

    found = known.groupBy(*TXN_KEYS).agg(latest(BOUNDARY[:1]).alias("_start"), latest(BOUNDARY[1:]).alias("_end"), latest(DML).alias("_last"))
    still = store(found.where(F.col("_last").isNotNull() & behind(F.col("_last"))).select(*[F.col(k).alias(f"_{k}") for k in TXN_KEYS], "_start", "_end"))
    few = still.count() <= HELD_OPEN
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in TXN_KEYS]
    return known.where(change).join(F.broadcast(still) if few else still, same).where(behind(F.col("_at"))).select(*rows.columns)


def redo_step(
    path: str, since: int, white: Sequence[str], black: Sequence[str] = (), mode: str = "committed", columns: Sequence[str] | None = None
) -> Step:
    """Mined rows of a batch as whole statements; open transactions and unfinished statements wait for the next batch.

    The source is read once per batch: its mined rows are stored, and so are the statements made of them.
    ``columns`` are those that the caller reads; without it all are stored and come out.
    """

    def only(rows: DataFrame, needed: Sequence[str]) -> DataFrame:
        return rows if columns is None else rows.select(*[c for c in rows.columns if c in (*needed, *columns)])

    def step(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        context = Context(spark, path)
        mined, still, whole = (Context(spark, f"{path}/{x}", 1) for x in ("mined", "open", "statements"))
        rows = mined.stored(_joined(only(mined_rows(batch, since, white, black), REDO_FACTS), context, batch_id), batch_id)
        waiting = open_rows(rows, mode, lambda found: still.stored(found, batch_id))
        context.keep(waiting, batch_id)
        size = rows.count()
        if mode == "raw" and "csf" in rows.columns:
            rows = rows.join(context.before(batch_id + 1, rows.schema).select("source", "xid", "rs_id").distinct(), ["source", "xid", "rs_id"], "left_anti")
        return redo_rows(rows, mode, lambda statements: whole.stored(only(statements, (*TXN_KEYS, "scn", "seq", "op", "sql_redo")), batch_id), size)

    return step
