"""Streaming decode of captured replication messages.

What a later batch needs from earlier ones is small and known: the last BEGIN of each slot and the
last definition of each table.  Those messages are kept as a table version per micro-batch and put
in front of the next batch; they give no events themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cdcflow.operators.pgoutput import context_messages, pg_changes
from cdcflow.operators.positions import plan_slices

MESSAGE = "slot string, pos bigint, msg binary"


def decode_batch(
    path: str, cat: str = "insert,update,delete", tables: Sequence[str] | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes the events of a batch under ``path/events``."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select("slot", "pos", "msg")
        if batch_id > 0:
            rows = rows.unionByName(spark.read.schema(MESSAGE).parquet(f"{path}/context/batch={batch_id - 1}"))
        events = pg_changes(rows, cat, tables, slices=plan_slices(rows, "pos", ["slot"]))
        events.write.mode("overwrite").parquet(f"{path}/events/batch={batch_id}")
        context_messages(rows).write.mode("overwrite").parquet(f"{path}/context/batch={batch_id}")

    return run


def stream_pg_changes(
    messages: DataFrame, path: str, checkpoint: str, cat: str = "insert,update,delete",
    tables: Sequence[str] | None = None, every: str | None = None,
) -> StreamingQuery:
    """Start decoding a streamed log; drains what is there unless ``every`` is given."""
    writer = messages.writeStream.foreachBatch(decode_batch(path, cat, tables)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def decoded_events(spark: SparkSession, path: str) -> DataFrame:
    """All events written so far."""
    return spark.read.parquet(f"{path}/events").drop("batch")
