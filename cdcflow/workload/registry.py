"""Names of the registered queries, each beside its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cdcflow.session import scratch_path, settings
from cdcflow.sinks.tables import drop_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and its twin where SQL can say the same over the whole tables."""

    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_DERIVED: dict[tuple[str, str, str], str] = {}


def derived(spark: SparkSession, sf_dir: str, name: str, build: Query, compression: str = "snappy") -> DataFrame:
    """A log captured once per session into the shared folder, as a source would have left it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _DERIVED:
        path = scratch_path(spark, name)
        with settings(spark):
            build(spark, sf_dir).write.parquet(path, compression=compression)
        _DERIVED[key] = path
    return spark.read.parquet(_DERIVED[key])


def staged(spark: SparkSession, sf_dir: str, name: str, build: Query, compression: str = "snappy") -> tuple[DataFrame, Callable[[], None]]:
    """The same log for a caller that copies it, and what to call when that is done: a log that nobody else holds goes."""
    if (spark.sparkContext.applicationId, sf_dir, name) in _DERIVED:
        return derived(spark, sf_dir, name, build, compression), lambda: None
    path = scratch_path(spark, name)
    with settings(spark):
        build(spark, sf_dir).write.parquet(path, compression=compression)
    return spark.read.parquet(path), lambda: drop_folder(spark, path)
