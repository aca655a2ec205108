"""Counters, totals, rates and limits, as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cdcflow.functions.text import render_row
from cdcflow.operators.dirty import ERRORS

# Span and step of the rate meter; rows seen before the byte limit adapts.
RATE_SPAN_SECONDS, RATE_STEP_SECONDS = 20, 5
MIN_ROWS_FOR_RATE = 1000
INITIAL_ROWS_PER_SECOND = 1000.0


def row_bytes(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """Size of a row: the length of its printed text."""
    return F.length(render_row(df, ",", cols)).cast("long")


def read_metrics(df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Rows and bytes read."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("num_read"), F.coalesce(F.sum(row_bytes(df, cols)), F.lit(0)).alias("byte_read")
    )


def observe_reads(df: DataFrame, name: str = "read") -> tuple[DataFrame, Observation]:
    """The same counters filled in by the job itself, without a second pass."""
    seen = Observation(name)
    return (
        df.observe(seen, F.count(F.lit(1)).alias("num_read"), F.sum(row_bytes(df)).alias("byte_read")),
        seen,
    )


def write_metrics(checked: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row of write counters from a checked batch: written, bytes, errors by kind."""
    kind = F.when(F.size(ERRORS) > 0, F.col(ERRORS)[0]["type"])
    size = row_bytes(checked, cols)

    def count(cond: Column) -> Column:
        return F.count(F.when(cond, 1))

    return checked.agg(
        count(kind.isNull()).alias("num_write"),
        F.coalesce(F.sum(F.when(kind.isNull(), size)), F.lit(0)).alias("byte_write"),
        count(kind.isNotNull()).alias("n_errors"),
        count(kind == "npe").alias("null_errors"),
        count(kind == "duplicate").alias("duplicate_errors"),
        count(kind == "conversion").alias("conversion_errors"),
        count(kind == "other").alias("other_errors"),
    )


def channel_metrics(df: DataFrame, channel: str, size: Column, pos: str) -> DataFrame:
    """Counters per channel and for the whole job (channel ``all``)."""
    return (
        df.withColumn("_size", size)
        .rollup(channel)
        .agg(
            F.grouping(channel).alias("_total"),
            F.count(F.lit(1)).alias("num_read"),
            F.sum("_size").alias("byte_read"),
            F.max(pos).alias("last_position"),
        )
        .withColumn(channel, F.when(F.col("_total") == 1, "all").otherwise(F.col(channel).cast("string")))
        .drop("_total")
    )


def metrics_long(metrics: DataFrame) -> DataFrame:
    """One row of counters as (name, value) rows."""
    return metrics.unpivot([], metrics.columns, "name", "value").orderBy("name")


def rate(
    df: DataFrame, ts: str, channel: str, span: int = RATE_SPAN_SECONDS, step: int = RATE_STEP_SECONDS
) -> DataFrame:
    """Rows per second over the last ``span`` seconds at every ``step``, per channel.

    Rows shrink to one count per step.  A rate can only change at a step that holds rows or lies
    one span after it, so quiet stretches take no rows of output: the rate there is 0.
    """
    at = (F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(step * 1_000_000)) * step).cast("long")
    counts = df.groupBy(channel, at.alias("at")).agg(F.count(F.lit(1)).alias("n"))
    lags = F.explode(F.sequence(F.lit(0), F.lit(span // step - 1)))
    return (
        counts.select(channel, "n", "at", lags.alias("lag"))
        .groupBy(channel, (F.col("at") + F.col("lag") * step).alias("at"))
        .agg(F.sum("n").alias("rows_in_span"))
        .withColumn("rate", F.col("rows_in_span") / F.lit(span))
    )


def stream_rate(df: DataFrame, ts: str, channel: str, late: str = "1 minute") -> DataFrame:
    """The same rate on a stream, as a sliding window."""
    span, step = f"{RATE_SPAN_SECONDS} seconds", f"{RATE_STEP_SECONDS} seconds"
    return (
        df.withWatermark(ts, late)
        .groupBy(channel, F.window(ts, span, step))
        .agg(F.count(F.lit(1)).alias("rows_in_span"))
        .withColumn("rate", F.col("rows_in_span") / F.lit(RATE_SPAN_SECONDS))
    )


def rate_limit_plan(stats: DataFrame, bytes_per_second: float) -> DataFrame:
    """Rows per second each channel may read so that the job stays under the byte limit.

    ``stats`` has channel, num_read, byte_read.  Limit / mean bytes per row * the channel's share.
    """
    total_rows = stats.agg(F.sum("num_read")).scalar()
    total_bytes = stats.agg(F.sum("byte_read")).scalar()
    known = (total_rows > MIN_ROWS_FOR_RATE) & (total_bytes > 0) & (F.col("num_read") > 0)
    allowed = F.lit(bytes_per_second) / (total_bytes / total_rows) * (F.col("num_read") / total_rows)
    return stats.withColumn(
        "rows_per_second", F.when(known, allowed).otherwise(F.lit(INITIAL_ROWS_PER_SECOND))
    )


def rows_per_trigger(bytes_per_second: float, trigger_seconds: float, bytes_per_row: float) -> int:
    """Batch size that keeps a stream under a byte limit."""
    return max(1, int(bytes_per_second * trigger_seconds / max(bytes_per_row, 1.0)))
