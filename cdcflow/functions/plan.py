"""Plan shaping."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns whose expressions run exactly once per row.

    The optimizer copies a projected expression into every later filter and projection that uses
    it; a generator is a border it does not copy across.  Worth it for regular expressions and
    parsers that several later columns and a filter read.
    """
    made = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(made))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
