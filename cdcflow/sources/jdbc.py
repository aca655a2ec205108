"""JDBC tables: parallel scans by key range, and change application through a staging table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.operators.apply import compact_changes
from cdcflow.operators.splits import split_bounds, split_predicates

# Driver flags every URL gets.
URL_FLAGS = {"useCursorFetch": "true", "rewriteBatchedStatements": "true"}


def merge_url(url: str, extra: Mapping[str, str] | None = None) -> str:
    """URL with its own parameters, the extra ones, and the cursor and batch flags."""
    base, _, query = url.partition("?")
    params = dict(p.split("=", 1) for p in query.split("&") if "=" in p)
    params.update(extra or {})
    params.update(URL_FLAGS)
    return base + "?" + "&".join(f"{k}={v}" for k, v in params.items())


@dataclass(frozen=True)
class Connection:
    """One entry of a job's connection list."""

    url: str
    table: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    schema: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    @property
    def qualified(self) -> str:
        return f"{self.schema}.{self.table}" if self.schema else self.table

    def properties(self) -> dict[str, str]:
        out = {"user": self.user, "password": self.password, "driver": self.driver, **self.options}
        return {k: str(v) for k, v in out.items() if v is not None}


def jdbc_scan(
    spark: SparkSession, connection: Connection, split: str | None = None, parts: int = 8,
    where: str | None = None,
) -> DataFrame:
    """A table, read in ``parts`` ranges of the ``split`` column when one is given.

    Filters and columns applied to the result reach the database; large texts arrive as strings.
    """
    props = connection.properties()
    source = f"(select * from {connection.qualified} where {where}) q" if where else connection.qualified
    if split is None:
        return spark.read.jdbc(connection.url, source, properties=props)
    ends = spark.read.jdbc(
        connection.url, f"(select min({split}) lo, max({split}) hi from {source}) e", properties=props
    ).first()
    if ends[0] is None:
        return spark.read.jdbc(connection.url, source, properties=props)
    bounds = split_bounds(int(ends[0]), int(ends[1]), parts)
    predicates = split_predicates(split, bounds) + ([f"{split} IS NULL"])
    return spark.read.jdbc(connection.url, source, predicates=predicates, properties=props)


def stage_changes(
    changes: DataFrame, connection: Connection, keys: Sequence[str], order: Sequence[str], batch_id: int, batch_rows: int = 1000
) -> None:
    """Append one compacted row per key to a staging table, tagged with the batch.

    The target merges a batch by its number, so a repeated batch does no harm.
    """
    last = compact_changes(changes, keys, order)
    image = [f.name for f in changes.schema["after"].dataType.fields if f.name not in keys]
    rows = last.select(
        F.lit(batch_id).alias("batch_id"), *keys, F.col("live").cast("int").alias("live"),
        *[F.col(f"image.{c}").alias(c) for c in image],
    )
    rows.write.mode("append").option("batchsize", batch_rows).jdbc(
        connection.url, connection.qualified, properties=connection.properties()
    )
