"""Good/dirty split, error categories and limits, dirty lines, failure runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cdcflow.functions.plan import once
from cdcflow.functions.text import row_json
from cdcflow.functions.types import text_error, text_to
from cdcflow.operators.positions import WHOLE, Slices, running
from cdcflow.session import scratch_path

ERRORS = "_errors"
ERROR_TYPE = "array<struct<col:string,type:string,msg:string>>"

# Error kinds, the texts that mark a duplicate key, and the dirty line layout.
ERROR_KINDS = ("npe", "duplicate", "conversion", "other")
DUPLICATE_MARKS = ("duplicate entry", "unique constraint", "primary key constraint")
LINE_SEPARATOR = "\u0001"


def error_category(message: Column) -> Column:
    """npe, duplicate or conversion, from the error text."""
    low = F.lower(message)
    duplicate = F.lit(False)
    for mark in DUPLICATE_MARKS:
        duplicate = duplicate | low.contains(mark)
    return (
        F.when(low.contains("nullpointerexception"), "npe").when(duplicate, "duplicate").otherwise("conversion")
    )


def problem(col: str, kind: str, message: Column, when: Column) -> Column:
    """One error entry, or NULL."""
    return F.when(when, F.struct(F.lit(col).alias("col"), F.lit(kind).alias("type"), message.alias("msg")))


def to_typed(df: DataFrame, specs: Sequence[tuple[str, str, str, str | None]]) -> DataFrame:
    """Add typed columns and ``_errors``.  Each spec is (text column, new column, type, time format)."""
    values = {new: text_to(F.col(src), kind, fmt) for src, new, kind, fmt in specs}
    out = once(df, values)
    found = [
        problem(
            new, "conversion", F.concat(F.lit(f"can't read as {kind}: "), F.col(src)),
            text_error(F.col(src), F.col(new)),
        )
        for src, new, kind, _ in specs
    ]
    return once(out, {ERRORS: F.array_compact(F.array(*found)).cast(ERROR_TYPE)})


def split_dirty(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without errors (marker dropped), rows with errors."""
    bad = F.size(ERRORS) > 0
    return df.where(~bad).drop(ERRORS), df.where(bad)


def duplicate_keys(df: DataFrame, keys: Sequence[str], existing: DataFrame | None = None) -> DataFrame:
    """Keys that repeat in the batch or are already in the target, with their count."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if existing is None:
        return counts.where("n > 1")
    known = existing.select(*keys, F.lit(True).alias("_known")).dropDuplicates(list(keys))
    return counts.join(known, list(keys), "left").where("n > 1 or _known").drop("_known")


def dirty_lines(dirty: DataFrame, cols: Sequence[str], at: Column | None = None) -> DataFrame:
    """One text line per dirty row: row JSON, error type, error text as JSON, time."""
    first = F.col(ERRORS)[0]
    wrapped = F.to_json(F.struct(first["msg"].alias("m")))
    message = F.substr(wrapped, F.lit(6), F.length(wrapped) - 6)
    when = F.date_format(at if at is not None else F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    return dirty.select(
        F.concat_ws(LINE_SEPARATOR, row_json(cols), first["type"], message, when).alias("value")
    )


def write_dirty(dirty: DataFrame, cols: Sequence[str], path: str) -> None:
    """Append dirty lines as text files, one per task."""
    dirty_lines(dirty, cols).write.mode("append").text(path)


def error_counts(df: DataFrame) -> DataFrame:
    """One row: rows read, and rows with errors."""
    return df.agg(
        F.count(F.lit(1)).alias("num_read"),
        F.coalesce(F.sum((F.size(ERRORS) > 0).cast("long")), F.lit(0)).alias("errors"),
    )


def error_limit_verdict(counts: DataFrame, record: int | None, percentage: float | None) -> DataFrame:
    """Add ``ok``: errors within ``record`` and within ``percentage`` of the rows read.

    A limit that is absent or -1 is off; reaching a limit exactly still passes.
    """
    ratio = F.when(F.col("num_read") >= 1, F.col("errors") / F.col("num_read")).otherwise(F.lit(0.0))
    ok = F.lit(True)
    if record is not None and record != -1:
        ok = ok & (F.col("errors") <= record)
    if percentage is not None and percentage != -1:
        ok = ok & (ratio <= percentage / 100.0)
    return counts.withColumn("ok", ok)


class ErrorLimitExceeded(RuntimeError):
    """The job has more dirty rows than it allows."""


def staged_split(df: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Rows without errors (marker dropped), rows with errors, and ``num_read`` and ``errors``, by one pass over the input.

    The rows are written once, by verdict, to the shared folder and counted on the way; both sides are
    read from there.
    """
    seen, path = Observation(), scratch_path(df.sparkSession, "verdicts")
    bad = F.coalesce(F.size(ERRORS) > 0, F.lit(False))
    counted = df.withColumn("_bad", bad.cast("int")).observe(
        seen, F.count(F.lit(1)).alias("num_read"), F.coalesce(F.sum("_bad"), F.lit(0)).cast("long").alias("errors")
    )
    counted.write.partitionBy("_bad").parquet(path)
    spark, sides = df.sparkSession, []
    for side in (0, 1):
        filled = seen.get["errors"] if side else seen.get["num_read"] - seen.get["errors"]
        sides.append(spark.read.schema(df.schema).parquet(f"{path}/_bad={side}") if filled else spark.createDataFrame([], df.schema))
    return sides[0].drop(ERRORS), sides[1], dict(seen.get)


def judge_counts(num_read: int, errors: int, record: int | None = 0, percentage: float | None = 0.0) -> None:
    """Raise when counts already known exceed the error limits; see ``error_limit_verdict``."""
    over = record is not None and record != -1 and errors > record
    if percentage is not None and percentage != -1 and num_read:
        over |= errors / num_read > percentage / 100.0
    if over:
        raise ErrorLimitExceeded(f"{errors} of {num_read} rows are dirty")


def enforce_limit(df: DataFrame, record: int | None = 0, percentage: float | None = 0.0) -> None:
    """Raise before the write when the error limits are exceeded."""
    row = error_limit_verdict(error_counts(df), record, percentage).first()
    if not row["ok"]:
        raise ErrorLimitExceeded(f"{row['errors']} of {row['num_read']} rows are dirty")


def failure_runs(
    df: DataFrame, channel: str, pos: str, failed: Column, n: int = 3, *, slices: Slices = WHOLE
) -> DataFrame:
    """Runs of at least ``n`` failures in a row per channel: start, end, length.

    A run shares its running count of successes; the counts merge on the map side.
    """
    runs = running(
        df.select(channel, pos, failed.alias("_failed")),
        [channel], pos, {"_run": F.when(F.col("_failed"), 0).otherwise(1)}, slices=slices,
    )
    return (
        runs.where("_failed")
        .groupBy(channel, "_run")
        .agg(F.min(pos).alias("first"), F.max(pos).alias("last"), F.count(F.lit(1)).alias("length"))
        .where(F.col("length") >= n)
        .drop("_run")
    )
