"""Change events from column names and old/new values: nested maps, or one flat map."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.operators.dirty import ERRORS

EVENT_COLUMNS = ("slot", "schema", "table", "op", "lsn", "ts", "xid", "pos")


def _named(values: str) -> Column:
    """names -> values as a map; slots without a name and missing or damaged tuples are left out."""
    names, given = F.col("names"), F.col(values)
    pairs = F.filter(F.arrays_zip(names.alias("n"), given.alias("v")), lambda p: p["n"].isNotNull())
    return (
        F.when(F.size(names) != F.size(given), F.lit(None))
        .when(F.exists(names, lambda n: n.isNull()), F.map_from_entries(pairs))
        .otherwise(F.map_from_arrays(names, given))
    )


def images(decoded: DataFrame) -> DataFrame:
    """Decoded rows as events with ``before`` and ``after`` maps; malformed rows have ``ok`` false and no images."""
    good = F.coalesce(F.col("ok"), F.lit(False))
    return decoded.withColumnRenamed("kind", "op").select(
        *EVENT_COLUMNS,
        F.when(good, _named("old")).alias("before"),
        F.when(good, _named("new")).alias("after"),
        "unchanged",
        "ok",
        *[c for c in (ERRORS,) if c in decoded.columns],
    )


def envelope(events: DataFrame, flat: bool = False) -> DataFrame:
    """``type, schema, table, lsn, ts, ingestion`` with both images, nested or in one flat map.

    The flat map has ``before_x`` and ``after_x`` for every column of the row.  ``unchanged`` (columns
    not resent), ``ok`` and errors go along where the events have them.
    """
    head = [F.lower("op").alias("type"), "schema", "table", "lsn", "ts", (F.unix_micros(F.current_timestamp()) * 1000).alias("ingestion")]
    keep = [c for c in ("pos", "xid", "unchanged", "ok", ERRORS) if c in events.columns]
    if not flat:
        return events.select(*head, *keep, "before", "after")
    names = F.array_distinct(F.concat(
        F.coalesce(F.map_keys("before"), F.array().cast("array<string>")),
        F.coalesce(F.map_keys("after"), F.array().cast("array<string>")),
    ))

    def side(image: str) -> Column:
        return F.map_from_arrays(
            F.transform(names, lambda n: F.concat(F.lit(f"{image}_"), n)),
            F.transform(names, lambda n: F.try_element_at(F.col(image), n)),
        )

    return events.select(*head, *keep, F.map_concat(side("before"), side("after")).alias("data"))


def flat_columns(events: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The flat form of one table as plain columns, so that scans and joins can prune them."""
    return events.select(
        F.lower("op").alias("type"), "schema", "table", "lsn", "ts",
        *[F.try_element_at(side, F.lit(c)).alias(f"{side}_{c}") for c in columns for side in ("before", "after")],
    )
