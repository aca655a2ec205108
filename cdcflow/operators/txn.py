"""Transaction work on a change log: commit assembly, partial rollback, resume, log gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cdcflow.operators.positions import WHOLE, Slices, carry, running
from cdcflow.session import materialize

DML = ("insert", "update", "delete", "ddl")
BOUNDARY = ("start", "commit", "rollback")
TXN_KEYS = ("source", "xid")
RANK = "_rank"


def with_rank(rows: DataFrame) -> DataFrame:
    """Where a row stands among rows of one SCN: START first, COMMIT and ROLLBACK last."""
    return rows.withColumn(RANK, F.when(F.col("op") == "start", 0).when(F.col("op").isin("commit", "rollback"), 2).otherwise(1))


def txn_ties(rows: DataFrame) -> tuple[str, ...]:
    """What orders rows of one SCN: ``seq`` where the log has it, and the rank of boundaries.

    A log without ``seq`` must not hold two changes of one row at one SCN; see ``repeated_positions``.
    """
    return ("seq", RANK) if "seq" in rows.columns else (RANK,)


def repeated_positions(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keys and positions that occur more than once: where an order is not unique, no row when it is."""
    return rows.groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _with_outcome(rows: DataFrame, slices: Slices) -> DataFrame:
    """Nearest transaction boundary after each row of the same xid; xids are reused freely."""
    end = F.struct(F.col("op").alias("outcome"), F.col("scn").alias("commit_scn"))
    known = with_rank(rows.where(F.col("op").isin(*DML, *BOUNDARY)))
    ended = carry(
        known, TXN_KEYS, "scn", end, F.col("op").isin(*BOUNDARY), "_end", backward=True, ties=txn_ties(rows), slices=slices
    )
    return ended.where(F.col("op").isin(*DML)).drop(RANK)


def committed_changes(rows: DataFrame, *, mode: str = "committed", slices: Slices = WHOLE) -> DataFrame:
    """Release the DML of committed transactions with its ``commit_scn``.

    A row belongs to the next boundary of its xid: COMMIT releases it; ROLLBACK drops it; START
    means the earlier work was never finished; no boundary means the transaction is still open.
    Rows of one SCN are ordered by ``seq`` if the log has it, with START first and the end last.
    ``(commit_scn, scn, seq)`` is the output order.  ``mode="raw"`` passes DML on as it was read.
    """
    if mode == "raw":
        return rows.where(F.col("op").isin(*DML)).withColumn("commit_scn", F.col("scn"))
    if mode != "committed":
        raise ValueError(f"unknown mode {mode!r}")
    return (
        _with_outcome(rows, slices)
        .where(F.col("_end.outcome") == "commit")
        .select("*", F.col("_end.commit_scn").alias("commit_scn"))
        .drop("_end")
    )


def open_changes(rows: DataFrame, *, slices: Slices = WHOLE) -> DataFrame:
    """DML whose transaction has no boundary yet; carried into the next batch."""
    return _with_outcome(rows, slices).where(F.col("_end").isNull()).drop("_end")


def remove_rollback_pairs(
    rows: DataFrame,
    *,
    keys: Sequence[str] = ("source", "xid", "commit_scn", "row_id"),
    flag: str = "rollback",
    pos: str = "scn",
    slices: Slices = WHOLE,
) -> DataFrame:
    """Drop each row flagged as an undo together with the change it undoes (last in, first out).

    Depth counts live changes.  At one depth, changes and undos alternate, so a change is undone
    exactly when the next row at its depth is an undo: two ordered passes, no per-group Python.
    """
    undo = F.coalesce(F.col(flag), F.lit(0)) == 1
    step = F.when(undo, F.lit(-1)).otherwise(F.lit(1))
    ties = [c for c in ("seq",) if c in rows.columns]
    depth = running(rows, keys, pos, {"_depth": step}, ties=ties, slices=slices)
    if not slices.single:
        # The next pass reads its input twice; store it rather than run the first pass twice.
        depth = materialize(depth, "undo-depth")
    depth = depth.withColumn("_depth", F.col("_depth") + F.when(undo, 1).otherwise(0))
    paired = carry(
        depth, [*keys, "_depth"], pos, undo, F.lit(True), "_next_undo",
        backward=True, strict=True, ties=ties, slices=slices,
    )
    return paired.where(~undo & ~F.coalesce(F.col("_next_undo"), F.lit(False))).drop("_depth", "_next_undo")


def after_position(last: Sequence[object], order: Sequence[str]) -> Column:
    """Row is strictly after ``last`` in the total order; built so that scans can prune on the head."""
    expr = F.lit(False)
    for name, value in reversed(list(zip(order, last))):
        col = F.col(name)
        expr = (col > F.lit(value)) | ((col == F.lit(value)) & expr)
    return (F.col(order[0]) >= F.lit(last[0])) & expr


def resume_after(rows: DataFrame, last: Sequence[object], order: Sequence[str] = ("scn", "commit_scn", "row_id")) -> DataFrame:
    """Rows after the last handled position."""
    return rows.where(after_position(last, order))


def log_gaps(rows: DataFrame, *, keys: Sequence[str] = ("source", "thread"), sequence: str = "sequence") -> DataFrame:
    """Places where the log sequence of a source's thread jumps by more than one.

    Rows shrink to one per (source, thread, sequence) by partial aggregation before the window.
    """
    seen = rows.groupBy(*keys, sequence).agg(F.count(F.lit(1)).alias("rows"))
    w = Window.partitionBy(*keys).orderBy(sequence)
    return (
        seen.withColumn("prev_sequence", F.lag(sequence).over(w))
        .where(F.col(sequence) - F.col("prev_sequence") > 1)
        .withColumn("missing", F.col(sequence) - F.col("prev_sequence") - 1)
        .drop("rows")
    )
