"""Split ranges and lists into parts for parallel reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.operators.positions import WHOLE, Slices, row_index


def split_bounds(lo: int, hi: int, n: int) -> list[int]:
    """Borders of ``[lo, hi]`` cut into n nearly equal parts; the first parts take the remainder."""
    if n < 1:
        raise ValueError("need at least one part")
    if lo == hi:
        return [lo, hi]
    lo, hi = min(lo, hi), max(lo, hi)
    step, rest = divmod(hi - lo, n)
    if step == 0:
        n = rest
    return [lo + i * step + min(i, rest) for i in range(n + 1)]


def split_predicates(col: str, bounds: Sequence[int]) -> list[str]:
    """One range predicate per part, for parallel JDBC reads; the last part is closed."""
    out = [f"{col} >= {a} AND {col} < {b}" for a, b in zip(bounds[:-2], bounds[1:-1])]
    return [*out, f"{col} >= {bounds[-2]} AND {col} <= {bounds[-1]}"]


def split_id(col: Column, lo: int, hi: int, n: int) -> Column:
    """Part a value falls in, as arithmetic on the value."""
    if lo == hi:
        return F.lit(0).cast("long")
    lo, hi = min(lo, hi), max(lo, hi)
    step, rest = divmod(hi - lo, n)
    if step == 0:
        n = rest
    off = col.cast("long") - F.lit(lo)
    wide = F.lit(rest * (step + 1))
    small = F.lit(rest) + F.call_function("div", off - wide, F.lit(max(step, 1)))
    part = F.when(off < wide, F.call_function("div", off, F.lit(step + 1))).otherwise(small)
    return F.least(part, F.lit(n - 1)).cast("long")


def assign_split(df: DataFrame, col: str, n: int, into: str = "split_id") -> DataFrame:
    """Add the part of each row; one small aggregate gives the ends of the range."""
    ends = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    if ends["lo"] is None:
        return df.withColumn(into, F.lit(None).cast("long"))
    return df.withColumn(into, split_id(F.col(col), int(ends["lo"]), int(ends["hi"]), n))


def even_segments(df: DataFrame, order_by: str, n: int, into: str = "segment", *, slices: Slices = WHOLE) -> DataFrame:
    """Cut the ordered rows into n runs of equal length; the last one takes the remainder."""
    size = df.count() // n
    out = row_index(df, order_by, "_i", slices=slices)
    segment = F.lit(n - 1).cast("long") if size == 0 else F.least(F.expr(f"_i div {size}"), F.lit(n - 1)).cast("long")
    return out.withColumn(into, segment).drop("_i")
