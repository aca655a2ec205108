"""Streaming forms of transaction assembly and change application.

State lives in tables in the shared folder, one version per micro-batch, not in per-key memory: a
transaction of any size is sorted and spilled like any other data, and a batch that is run again
writes the same version again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cdcflow.operators.apply import compact_changes, live_images, order_of
from cdcflow.operators.positions import carry, plan_slices
from cdcflow.operators.txn import BOUNDARY, DML, RANK, TXN_KEYS, txn_ties, with_rank
from cdcflow.session import materialize
from cdcflow.sinks.manifest import DEFAULT_BUCKETS, BucketTable
from cdcflow.sinks.tables import drop_folder, numbered_folders

RELEASED, OPEN, ORPHAN = "released", "open", "orphan"


def _version(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def _read_version(spark: SparkSession, path: str, batch_id: int, schema) -> DataFrame | None:
    """The rows left open by an earlier batch, or None before the first one."""
    if batch_id < 0:
        return None
    return spark.read.schema(schema).parquet(_version(path, batch_id)).where(F.col("state") == OPEN)


def committed_batch(path: str, max_age_scn: int | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that releases committed changes and carries open ones over.

    Each batch writes ``path/batch=N`` with a ``state``: released, open (input of the next batch),
    or orphan (open for more than ``max_age_scn`` positions).
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.where(F.col("op").isin(*DML, *BOUNDARY))
        out_schema = rows.withColumn("commit_scn", F.col("scn")).withColumn("state", F.lit(OPEN)).schema
        earlier = _read_version(spark, path, batch_id - 1, out_schema)
        if earlier is not None:
            rows = rows.unionByName(earlier.select(*rows.columns))
        slices = plan_slices(rows, "scn", TXN_KEYS)
        end = F.struct(F.col("op").alias("outcome"), F.col("scn").alias("commit_scn"))
        ended = carry(
            with_rank(rows), TXN_KEYS, "scn", end, F.col("op").isin(*BOUNDARY), "_end", backward=True, ties=txn_ties(rows), slices=slices
        ).where(F.col("op").isin(*DML)).drop(RANK)
        state = F.when(F.col("_end").isNull(), OPEN).when(F.col("_end.outcome") == "commit", RELEASED)
        if max_age_scn is not None:
            top = rows.agg(F.max("scn")).first()[0] or 0
            state = F.when(F.col("_end").isNull() & (F.col("scn") < top - max_age_scn), ORPHAN).otherwise(state)
        done = ended.withColumns({"commit_scn": F.col("_end.commit_scn"), "state": state}).drop("_end")
        done.where(F.col("state").isNotNull()).write.mode("overwrite").parquet(_version(path, batch_id))

    return run


def stream_committed(
    rows: DataFrame, path: str, checkpoint: str, *, max_age_scn: int | None = None, every: str | None = None
) -> StreamingQuery:
    """Start assembling transactions of a streamed log; drains what is there unless ``every`` is given."""
    writer = rows.writeStream.foreachBatch(committed_batch(path, max_age_scn)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def released_changes(spark: SparkSession, path: str) -> DataFrame:
    """All committed changes written so far."""
    return spark.read.parquet(path).where(F.col("state") == RELEASED).drop("state", "batch")


def delta_batch(path: str, keys: Sequence[str], order: Sequence[str] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends the compacted changes of a batch to the delta log.

    The target itself is not rewritten per batch; readers merge, and a merge job folds deltas in.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        compact_changes(batch, keys, order).write.mode("overwrite").parquet(_version(path, batch_id))

    return run


def stream_apply(
    changes: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str] | None = None, every: str | None = None
) -> StreamingQuery:
    """Start turning a stream of committed changes into deltas of a keyed table."""
    writer = changes.writeStream.foreachBatch(delta_batch(path, keys, order)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def last_actions(deltas: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """The last action of every key over several batches' deltas."""
    at = F.struct(*[F.col(c) for c in order_of(deltas, order)])
    return deltas.groupBy(*keys).agg(F.max_by(F.struct("live", "image"), at).alias("l")).select(*keys, "l.live", "l.image")


def merged_table(base: DataFrame, deltas: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """The table with its deltas folded in; written back, it is the new base."""
    last = last_actions(deltas, keys, order)
    kept = base.join(last.select(*keys), list(keys), "left_anti").select(*base.columns)
    return kept.unionByName(live_images(last, base.columns))


def fold_deltas(
    spark: SparkSession, deltas: str, table: str, keys: Sequence[str], base: DataFrame | None = None, order: Sequence[str] | None = None,
    buckets: int = DEFAULT_BUCKETS,
) -> int | None:
    """The merge job: fold all finished deltas into the next version of a bucketed table, then drop them.

    Only buckets with a changed key are rewritten.  ``base`` is the table before its first version.
    Returns the new version, or None when there was nothing to fold.  A run that stops between the two
    steps folds the same deltas again, which changes nothing.  Run it by itself, beside the stream:
    batches that arrive meanwhile wait.
    """
    done = numbered_folders(spark, deltas, "batch")
    if not done:
        return None
    paths = [_version(deltas, n) for n in done]
    rows = spark.read.parquet(*paths)
    target = BucketTable(spark, table, base, keys, buckets)
    number = target.fold(materialize(last_actions(rows, keys, order), "delta")).version
    target.vacuum()
    for path in paths:
        drop_folder(spark, path)
    return number
