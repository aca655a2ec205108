"""Positions: where to start, what is done, and what comes next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.operators.positions import WHOLE, Slices, carry


def start_position(requests: DataFrame, offsets: DataFrame, current: DataFrame, reset: bool = False) -> DataFrame:
    """Per source: the position asked for (not 0), else the saved one, else the current one.

    ``reset`` goes straight to the current position.
    """
    saved = offsets.groupBy("source").agg(F.max("position").alias("saved"))
    joined = requests.join(saved, "source", "left").join(current, "source", "left")
    wanted = F.nullif(F.col("requested"), F.lit(0))
    start = F.col("current_scn") if reset else F.coalesce(wanted, F.col("saved"), F.col("current_scn"))
    how = F.when(F.lit(reset), "current").when(wanted.isNotNull(), "requested").when(F.col("saved").isNotNull(), "saved").otherwise("current")
    return joined.select("source", start.alias("start"), how.alias("how"))


def incremental_scan(df: DataFrame, col: str, last: object, upto: object | None = None) -> DataFrame:
    """Rows newer than ``last`` (and not beyond ``upto``); the predicate reaches the scan."""
    keep = F.col(col) > F.lit(last)
    return df.where(keep & (F.col(col) <= F.lit(upto)) if upto is not None else keep)


def high_water(df: DataFrame, col: str) -> DataFrame:
    """The new mark after a scan."""
    return df.agg(F.max(col).alias("high_water"))


def offset_rows(df: DataFrame, job: Column, channel: str, position: str) -> DataFrame:
    """What a batch finished: job, channel, position, rows."""
    return df.groupBy(job.alias("job"), F.col(channel).alias("channel")).agg(
        F.max(position).alias("position"), F.count(F.lit(1)).alias("rows")
    )


def save_offsets(offsets: DataFrame, path: str) -> None:
    """Append finished positions; written after the data they describe."""
    offsets.write.mode("append").parquet(path)


def load_offsets(offsets: DataFrame) -> DataFrame:
    """Latest position and total rows per job and channel."""
    return offsets.groupBy("job", "channel").agg(F.max("position").alias("position"), F.sum("rows").alias("rows"))


def restore_boundaries(df: DataFrame, col: str, channel: str, pos: str, *, slices: Slices = WHOLE) -> DataFrame:
    """Add ``boundary``: the restore column changed from the row before it in its channel."""
    before = carry(df, [channel], pos, F.struct(F.col(col).alias("v")), F.lit(True), "_prev", strict=True, slices=slices)
    changed = F.col("_prev").isNotNull() & ~F.col(col).eqNullSafe(F.col("_prev.v"))
    return before.withColumn("boundary", changed).drop("_prev")
