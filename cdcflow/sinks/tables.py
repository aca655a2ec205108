"""Write modes of a keyed table: append, overwrite, insert, update, replace, upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.operators.dirty import ERROR_TYPE, ERRORS
from cdcflow.sinks.manifest import BucketTable

MODES = ("append", "overwrite", "insert", "update", "replace", "upsert")


def _winner(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str], last: bool) -> DataFrame:
    """One row per key, the first or last in order; map-side aggregation shrinks hot keys."""
    at = F.struct(*[F.col(c) for c in order])
    pick = F.max_by if last else F.min_by
    row = F.struct(*[F.col(c) for c in cols], at.alias("_at"))
    return df.groupBy(*keys).agg(pick(row, at).alias("_r")).select("_r.*")


def _folder(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def numbered_folders(spark: SparkSession, path: str, label: str) -> list[int]:
    """Numbers of the complete ``label=N`` folders below a path, in order."""
    at, fs = _folder(spark, path)
    found = [f.getPath() for f in fs.listStatus(at)] if fs.exists(at) else []
    done = [x.getName() for x in found if x.getName().startswith(f"{label}=") and fs.exists(x.suffix("/_SUCCESS"))]
    return sorted(int(n.split("=")[1]) for n in done)


def drop_folder(spark: SparkSession, path: str) -> None:
    at, fs = _folder(spark, path)
    fs.delete(at, True)


def table_versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a versioned or bucketed table, oldest first."""
    return BucketTable(spark, path).versions() or numbered_folders(spark, path, "version")


def read_version(spark: SparkSession, path: str) -> DataFrame | None:
    """The last complete version of a versioned or bucketed table, or None before the first."""
    if (rows := BucketTable(spark, path).read()) is not None:
        return rows
    known = table_versions(spark, path)
    return spark.read.parquet(f"{path}/version={known[-1]}") if known else None


def write_version(df: DataFrame, path: str, keep: int = 2) -> int:
    """Write the next version and drop all but the last ``keep``; readers of the one before are not disturbed.

    A run that fails leaves no ``_SUCCESS``, so its version does not count and is written over.
    """
    spark = df.sparkSession
    known = table_versions(spark, path)
    number = known[-1] + 1 if known else 0
    df.write.mode("overwrite").parquet(f"{path}/version={number}")
    for old in known[: max(0, len(known) + 1 - max(keep, 1))]:
        drop_folder(spark, f"{path}/version={old}")
    return number


def duplicate_error(key: Column) -> Column:
    """The error list of a row whose key is taken."""
    entry = F.struct(
        F.lit(None).cast("string").alias("col"), F.lit("duplicate").alias("type"),
        F.concat(F.lit("Duplicate entry for key "), key).alias("msg"),
    )
    return F.array(entry).cast(ERROR_TYPE)


def write_table(
    df: DataFrame, target: DataFrame, mode: str, keys: Sequence[str] = (), order: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame | None]:
    """New contents of ``target`` after writing ``df``, and the rows refused (insert only).

    ``order`` names columns of ``df`` that give each key's rows a unique order: the first row of a
    key wins an insert, the last one an update or upsert.
    """
    cols = target.columns
    if mode == "append":
        return target.unionByName(df.select(*cols)), None
    if mode == "overwrite":
        return df.select(*cols), None
    if mode not in MODES:
        raise ValueError(f"unknown write mode {mode!r}")
    if not keys or not order:
        raise ValueError(f"mode {mode} needs keys and an order of the rows of a key")
    keys = list(keys)
    at = F.struct(*[F.col(c) for c in order])
    if mode == "insert":
        first = df.groupBy(*keys).agg(F.min(at).alias("_first"))
        taken = target.select(*keys, F.lit(True).alias("_taken")).dropDuplicates(keys)
        marked = df.join(first.join(taken, keys, "left"), keys, "left").withColumn("_won", F.col("_taken").isNull() & (at == F.col("_first")))
        label = F.concat_ws("-", *[F.col(k).cast("string") for k in keys])
        refused = marked.where(~F.coalesce("_won", F.lit(False))).select(*df.columns).withColumn(ERRORS, duplicate_error(label))
        return target.unionByName(marked.where("_won").select(*cols)), refused
    latest = _winner(df, cols, keys, order, last=True)
    marked = latest.select(*keys, F.struct(*cols).alias("_new"))
    hit = F.col("_new").isNotNull()
    joined = target.join(marked, keys, "left" if mode == "update" else "full_outer")
    return joined.select(*[F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in cols]), None
