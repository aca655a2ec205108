"""Filters on change events and messages: plain predicates that scans can take over."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_category(df: DataFrame, cat: str, op: str = "op") -> DataFrame:
    """Events of the listed kinds (``"insert,update"``); events of no table are dropped."""
    kinds = [c.strip().lower() for c in cat.split(",") if c.strip()]
    return df.where(F.col("table").isNotNull() & F.lower(F.col(op)).isin(*kinds))


def filter_tables(df: DataFrame, tables: Sequence[str]) -> DataFrame:
    """Events of the listed ``schema.table`` names: one set test per schema, which scans can take over."""
    by_schema: dict[str, list[str]] = {}
    for schema, name in (t.split(".", 1) for t in tables):
        by_schema.setdefault(schema, []).append(name)
    keep = [(F.col("schema") == s) & F.col("table").isin(*ts) for s, ts in by_schema.items()]
    return df.where(reduce(lambda a, b: a | b, keep, F.lit(False)))


def _listed(entry: str, owner: str, table: str) -> Column:
    schema, name = entry.split(".", 1)
    hit = F.col(owner) == schema
    return hit if name == "*" else hit & (F.col(table) == name)


def list_predicate(white: Sequence[str], black: Sequence[str] = (), owner: str = "schema", table: str = "table") -> Column:
    """One predicate of a white list and a black list with ``owner.*`` entries."""
    keep = reduce(lambda a, b: a | b, [_listed(e, owner, table) for e in white], F.lit(False))
    if black:
        keep = keep & ~reduce(lambda a, b: a | b, [_listed(e, owner, table) for e in black])
    return keep


def filter_lists(df: DataFrame, white: Sequence[str], black: Sequence[str] = (), owner: str = "schema", table: str = "table") -> DataFrame:
    """Events the lists let through."""
    return df.where(list_predicate(white, black, owner, table))


def filter_blank(df: DataFrame, col: str = "value", ignore_blank: bool = False) -> DataFrame:
    """Messages with a value, and with visible text when blanks are ignored."""
    keep = F.col(col).isNotNull()
    return df.where(keep & (F.trim(F.col(col)) != "")) if ignore_blank else df.where(keep)


def filter_empty_events(df: DataFrame, col: str = "event") -> DataFrame:
    """Events with at least one field."""
    return df.where(F.size(F.coalesce(F.col(col), F.create_map().cast("map<string,string>"))) > 0)
