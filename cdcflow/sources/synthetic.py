"""Generated rows: declared columns, constants, one slice per requested row count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.functions.types import lenient_number

ARRAY_LENGTH = 4


def constant(col: Column, type_name: str) -> Column:
    """Constant text as a value: ``null`` is NULL, a number that can't be read is 0."""
    kind = {"integer": "int", "smallint": "int", "tinyint": "int", "int": "int", "bigint": "bigint", "long": "bigint",
            "float": "float", "double": "double"}.get(type_name.lower())
    value = lenient_number(col, kind) if kind else col
    return F.when(F.lower(col) == "null", F.lit(None)).otherwise(value)


def _generated(type_name: str, row: Column, salt: int) -> Column:
    """A value that depends only on the row number and the seed, so a lost task makes it again."""
    kind = type_name.strip().lower()
    if kind.endswith("[]"):
        steps = F.sequence(F.lit(1), F.lit(ARRAY_LENGTH))
        return F.transform(steps, lambda i: _generated(kind[:-2], row * ARRAY_LENGTH + i, salt))
    h = F.xxhash64(row, F.lit(salt))
    if kind == "id":
        return row + 1
    if kind in ("int", "integer"):
        return F.pmod(h, F.lit(2**31)).cast("int")
    if kind == "byte":
        return F.pmod(h, F.lit(128)).cast("tinyint")
    if kind == "short":
        return F.pmod(h, F.lit(2**15)).cast("smallint")
    if kind == "long":
        return h
    if kind == "boolean":
        return F.pmod(h, F.lit(2)) == 0
    if kind in ("char", "character"):
        return F.chr((F.pmod(h, F.lit(26)) + 97).cast("int"))
    if kind in ("float", "double"):
        return (F.pmod(h, F.lit(10**9)) / 1e5).cast(kind)
    if kind in ("date", "timestamp"):
        return F.timestamp_seconds(F.pmod(h, F.lit(2_000_000_000))).cast(kind)
    if kind == "bigdecimal":
        return (h.cast("decimal(38,0)") / 1000).cast("decimal(38,3)")
    if kind == "biginteger":
        return h.cast("decimal(38,0)")
    if kind == "binary":
        return F.unhex(F.hex(h))
    return F.hex(h)


def _column(spec: Mapping, row: Column, salt: int) -> Column:
    value = spec.get("value")
    made = _generated(spec.get("type") or "string", row, salt) if value is None else constant(F.lit(str(value)), spec.get("type") or "string")
    return made.alias(spec["name"])


def synthetic_rows(
    spark: SparkSession, columns: Sequence[Mapping], slice_counts: Sequence[int], seed: int = 0, rows_per_task: int = 1_000_000
) -> DataFrame:
    """``slice_counts[i]`` rows in slice i, told apart by ``_channel``.

    Rows come from one range split evenly over tasks, so one huge slice is made by many of them.
    """
    ends, total = [], 0
    for n in slice_counts:
        total += int(n)
        ends.append(total)
    rows = spark.range(0, total, 1, max(len(ends), -(-total // rows_per_task), 1))
    channel = F.lit(len(ends) - 1)
    for i in reversed(range(len(ends) - 1)):
        channel = F.when(F.col("id") < ends[i], F.lit(i)).otherwise(channel)
    return rows.select(
        *[_column(spec, F.col("id"), seed * 1000 + i) for i, spec in enumerate(columns)], channel.alias("_channel")
    )


def synthetic_stream(spark: SparkSession, columns: Sequence[Mapping], rows_per_second: int = 1, seed: int = 0) -> DataFrame:
    """The same columns without end."""
    rows = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return rows.select(*[_column(spec, F.col("value"), seed * 1000 + i) for i, spec in enumerate(columns)])
