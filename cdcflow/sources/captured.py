"""Captured logs: tables or folders of raw messages or mined rows, read in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the two kinds of captured log.
MESSAGE_SCHEMA = "slot string, pos bigint, msg binary"


def captured_source(
    spark: SparkSession, path: str, pos: str, since: int | None = None, *, schema: str | None = None,
    fmt: str = "parquet", streaming: bool = False, files_per_trigger: int | None = None,
) -> DataFrame:
    """Rows after position ``since``; the predicate reaches the file scan."""
    reader = (spark.readStream if streaming else spark.read).format(fmt)
    if schema:
        reader = reader.schema(schema)
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.load(path)
    return rows if since is None else rows.where(F.col(pos) > since)


def redo_source(spark: SparkSession, path: str, since_scn: int | None = None, **options) -> DataFrame:
    """Mined rows newer than ``since_scn``."""
    return captured_source(spark, path, "scn", since_scn, **options)
