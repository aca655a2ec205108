"""File sink: append or overwrite, compression, files of a wanted size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.operators.metrics import row_bytes
from cdcflow.session import settings


def rows_per_file(df: DataFrame, max_file_bytes: int, bytes_per_row: float | None = None) -> int:
    """Rows that fill a file of the wanted size.

    The mean row size may be given; else it is the mean length of all rows as printed text, which
    takes a pass over the table.  It only sizes files: every row is written either way.
    """
    if bytes_per_row is None:
        bytes_per_row = df.agg(F.avg(row_bytes(df)).alias("b")).first()["b"] or 1.0
    return max(1, int(max_file_bytes / max(bytes_per_row, 1.0)))


def file_sink(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "append",
    compression: str | None = None,
    max_file_bytes: int | None = None,
    bytes_per_row: float | None = None,
    charset: str | None = None,
    partition_by: list[str] | None = None,
) -> None:
    """Write files; Spark's committer stages them and makes them visible only when the job ends."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown write mode {mode!r}")
    out = df.write.mode(mode).format(fmt)
    if compression:
        out = out.option("compression", compression)
    if charset and fmt in ("csv", "json"):
        out = out.option("encoding", charset)
    if max_file_bytes:
        out = out.option("maxRecordsPerFile", rows_per_file(df, max_file_bytes, bytes_per_row))
    if partition_by:
        out = out.partitionBy(*partition_by)
    with settings(df.sparkSession):
        out.save(path)


def print_rows(df: DataFrame, delimiter: str = "|") -> int:
    """Print every row as text; returns how many.

    Rows come to the driver one partition at a time.
    """
    from cdcflow.functions.text import render_row

    n = 0
    for row in df.select(render_row(df, delimiter).alias("row")).toLocalIterator():
        print(row["row"])
        n += 1
    return n


def discard(df: DataFrame) -> None:
    """Run the whole plan and drop the rows; the reading speed test."""
    df.write.format("noop").mode("overwrite").save()
