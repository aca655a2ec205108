"""Ordered-log primitives that never put a whole log, or a whole hot key, in one task.

A change log is ordered by a numeric position.  Carry-forward, as-of lookup, running totals and
global row numbers all need "everything before me"; a plain window would sort one key on one task.
Here the position axis is cut into slices holding a similar number of rows.  Each (key, slice) is
handled on its own, and only one summary row per (key, slice) goes through the key-wide window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ROWS_PER_SLICE = 64_000
GROUP_LIMIT = 250_000
COARSE_CUTS = 64
SKETCH_ITEMS = 10_000
#: Slices that one task handles, on average: its memory is theirs, whatever the size of the log.
SLICES_PER_TASK = 2

SLICE = "_slice"


@dataclass(frozen=True)
class Slices:
    """Cut points of the position axis: coarse quantiles, each cut evenly into ``fine`` parts."""

    bounds: tuple[int, ...]
    fine: int

    @property
    def single(self) -> bool:
        return len(self.bounds) <= 2 and self.fine == 1

    @property
    def tasks(self) -> int:
        """Partitions that rows dealt by key and slice go to."""
        return max(1, -(-(len(self.bounds) - 1) * self.fine // SLICES_PER_TASK))

    def of(self, pos: Column) -> Column:
        """Slice number of a position; non-decreasing in the position."""
        if self.single:
            return F.lit(0).cast("long")
        pos = pos.cast("long")

        def leaf(i: int) -> Column:
            low, high = self.bounds[i], self.bounds[i + 1]
            step = max(1, -(-(high - low + 1) // self.fine))
            inner = F.call_function("div", pos - F.lit(low), F.lit(step))
            inner = F.greatest(F.lit(0), F.least(F.lit(self.fine - 1), inner))
            return (F.lit(i * self.fine) + inner).cast("long")

        def tree(lo: int, hi: int) -> Column:
            if hi - lo == 1:
                return leaf(lo)
            mid = (lo + hi) // 2
            return F.when(pos < F.lit(self.bounds[mid]), tree(lo, mid)).otherwise(tree(mid, hi))

        return tree(0, len(self.bounds) - 1)


WHOLE = Slices((0, 0), 1)


def plan_slices(
    df: DataFrame,
    pos: str,
    keys: Sequence[str] = (),
    *,
    rows_per_slice: int | None = None,
    group_limit: int | None = None,
) -> Slices:
    """Choose slices from one column-pruned statistics pass (a single row reaches the driver).

    While no key holds more than ``group_limit`` rows, one slice is enough and the operators take
    their one-pass form.  A heavy-hitter sketch finds the largest key without shuffling the keys;
    where the table is too large for the sketch to rule hot keys out, the log is sliced.  Quantiles
    of the positions bound the rows of a coarse cut whatever the density, and the even split inside
    a cut only refines it.  Both forms give the same rows; ``group_limit=0`` asks for slices whatever
    the size, which is how tests run every query in the sliced form too.
    """
    rows_per_slice = ROWS_PER_SLICE if rows_per_slice is None else rows_per_slice
    group_limit = GROUP_LIMIT if group_limit is None else group_limit
    p = F.col(pos).cast("long")
    grid = [i / COARSE_CUTS for i in range(1, COARSE_CUTS)]
    names = ", ".join(f"`{k}`" for k in keys) or "0"
    row = df.agg(
        F.count(p).alias("n"),
        F.min(p).alias("lo"),
        F.max(p).alias("hi"),
        F.percentile_approx(p, grid, 2_000).alias("q"),
        F.expr(f"approx_top_k(xxhash64({names}), 1, {SKETCH_ITEMS})").alias("top"),
    ).first()
    n = row["n"] or 0
    largest = max([t["count"] for t in row["top"] or []], default=0)
    unseen = 0 if n <= SKETCH_ITEMS else n // (SKETCH_ITEMS // 2)
    if n <= group_limit or (largest <= group_limit and unseen <= group_limit):
        return WHOLE
    wanted = max(2, -(-n // rows_per_slice))
    take = min(COARSE_CUTS, wanted)
    inner = {row["q"][round(i * COARSE_CUTS / take) - 1] for i in range(1, take)}
    bounds = tuple(sorted({row["lo"], row["hi"] + 1} | {b for b in inner if b > row["lo"]}))
    return Slices(bounds, max(1, -(-wanted // COARSE_CUTS)))


def _with_edges(df: DataFrame, parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of a slice behind extra rows that bring in what other slices left (``_own`` false).

    The extra rows ride in the same shuffle and sort as the rows themselves; no join is needed.
    """
    out = df.withColumn("_own", F.lit(True))
    for edges in parts:
        filled = [
            F.col(c) if c in edges.columns else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns
        ]
        out = out.unionByName(edges.select(*filled, F.lit(False).alias("_own")))
    return out


def carry(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: Column,
    when: Column,
    into: str,
    *,
    backward: bool = False,
    strict: bool = False,
    ties: Sequence[str] = (),
    slices: Slices = WHOLE,
) -> DataFrame:
    """Add ``into``: ``value`` of the nearest row at or before ``pos`` for which ``when`` holds.

    ``backward`` looks at or after instead; ``strict`` leaves the row itself out.  ``value`` must
    not be null on marked rows.  ``(pos, *ties)`` must be unique per key.
    """
    return carry_all(
        df, keys, pos, {into: Mark((), value, when)}, backward=backward, strict=strict, ties=ties, slices=slices
    )


@dataclass(frozen=True)
class Mark:
    """A value to carry along: the keys it follows beside the common ones, and where it is set."""

    keys: Sequence[str]
    value: Column
    when: Column


def carry_all(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    marks: Mapping[str, Mark],
    *,
    backward: bool = False,
    strict: bool = False,
    ties: Sequence[str] = (),
    slices: Slices = WHOLE,
) -> DataFrame:
    """``carry`` for several values at once.

    Rows are shuffled once, by the common keys and the slice; a value with further keys sorts
    within that partitioning.  Sliced rows go to a number of tasks that grows with the log.  The
    sorts look at the finest key first, since they compare by the head of the first column.
    """
    order = [F.col(c).desc() if backward else F.col(c).asc() for c in (pos, *ties)]
    until = -1 if strict else Window.currentRow
    kept = [c for c in df.columns if c not in marks]
    df = df.withColumns({f"_mark_{n}": F.when(m.when, m.value) for n, m in marks.items()})
    group, lead = list(keys), []
    if not slices.single:
        df = df.withColumn(SLICE, slices.of(F.col(pos)))
        parts = [_edges(df, [*keys, *m.keys], pos, f"_mark_{n}", backward, ties) for n, m in marks.items()]
        group, lead = [*keys, SLICE], [F.col("_own")]
        df = _with_edges(df, parts).repartition(slices.tasks, *group)
    for n, m in marks.items():
        w = Window.partitionBy(*reversed([*group, *m.keys])).orderBy(*lead, *order).rowsBetween(Window.unboundedPreceding, until)
        df = df.withColumn(n, F.last(f"_mark_{n}", ignorenulls=True).over(w))
    return (df if slices.single else df.where("_own")).select(*kept, *marks)


def _edges(df: DataFrame, keys: Sequence[str], pos: str, mark: str, backward: bool, ties: Sequence[str]) -> DataFrame:
    """What each (key, slice) receives from the slices on the far side of it."""
    marked_pos = F.when(F.col(mark).isNotNull(), F.struct(pos, *ties))
    edge = F.min_by(mark, marked_pos) if backward else F.max_by(mark, marked_pos)
    far = Window.partitionBy(*keys).orderBy(F.col(SLICE).desc() if backward else F.col(SLICE).asc())
    return (
        df.groupBy(*keys, SLICE)
        .agg(edge.alias(mark))
        .withColumn(mark, F.last(mark, ignorenulls=True).over(far.rowsBetween(Window.unboundedPreceding, -1)))
        .where(F.col(mark).isNotNull())
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    amounts: Mapping[str, Column],
    *,
    how: str = "sum",
    ties: Sequence[str] = (),
    slices: Slices = WHOLE,
) -> DataFrame:
    """Add one inclusive running ``sum`` or ``max`` per entry of ``amounts``, in order per key."""
    total = {"sum": F.sum, "max": F.max}[how]
    names = list(amounts)
    kept = [c for c in df.columns if c not in names]
    df = df.withColumns({f"_amt_{n}": c.cast("long") for n, c in amounts.items()})

    def sums(window) -> dict[str, Column]:
        return {n: total(f"_amt_{n}").over(window.rowsBetween(Window.unboundedPreceding, 0)) for n in names}

    if slices.single:
        return df.withColumns(sums(Window.partitionBy(*reversed(keys)).orderBy(pos, *ties))).select(*kept, *names)
    df = df.withColumn(SLICE, slices.of(F.col(pos)))
    far = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        df.groupBy(*keys, SLICE)
        .agg(*[total(f"_amt_{n}").alias(f"_amt_{n}") for n in names])
        .withColumns({f"_amt_{n}": total(f"_amt_{n}").over(far) for n in names})
        .where(F.col(f"_amt_{names[0]}").isNotNull())
    )
    both = _with_edges(df, [edges]).repartition(slices.tasks, *keys, SLICE)
    near = Window.partitionBy(SLICE, *reversed(keys)).orderBy("_own", pos, *ties)
    return both.withColumns(sums(near)).where("_own").select(*kept, *names)


def row_index(
    df: DataFrame, pos: str, into: str, *, keys: Sequence[str] = (), ties: Sequence[str] = (), slices: Slices = WHOLE
) -> DataFrame:
    """Add a dense 0-based row number in ``pos`` order, per key or over the whole table.

    What meets on one task is one count per slice, never the rows.
    """
    if keys:
        out = running(df, keys, pos, {into: F.lit(1)}, ties=ties, slices=slices)
    else:
        out = running(df.withColumn("_all", F.lit(0)), ["_all"], pos, {into: F.lit(1)}, ties=ties, slices=slices)
    return out.withColumn(into, F.col(into) - 1).drop("_all")
