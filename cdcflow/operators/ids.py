"""Time-ordered 64-bit ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.operators.positions import WHOLE, Slices, running

# Bit widths of worker, data centre and sequence.
WORKER_BITS, CENTRE_BITS, SEQUENCE_BITS = 5, 5, 12
PER_MILLI = 1 << SEQUENCE_BITS


def pack_id(millis: Column, centre: Column, worker: Column, sequence: Column) -> Column:
    """Time, data centre, worker and sequence in one number."""
    time_shift = SEQUENCE_BITS + WORKER_BITS + CENTRE_BITS
    return (
        F.shiftleft(millis.cast("long"), time_shift)
        .bitwiseOR(F.shiftleft(centre.cast("long"), SEQUENCE_BITS + WORKER_BITS))
        .bitwiseOR(F.shiftleft(worker.cast("long"), SEQUENCE_BITS))
        .bitwiseOR(sequence.cast("long"))
    )


def snowflake_ids(
    df: DataFrame, millis: str, worker: str, centre: int, order_by: str, into: str = "id", *, slices: Slices = WHOLE
) -> DataFrame:
    """Add unique ids in ``(millis, order_by)`` order per worker.

    A worker hands out 4096 numbers per millisecond; the rest move on to the next one.  With row
    number i, the tick is ``i + max(millis * 4096 - i)`` over the rows so far: two running values.
    """
    if not 0 <= centre < 1 << CENTRE_BITS:
        raise ValueError("data centre out of range")
    rows = running(df, [worker], millis, {"_i": F.lit(1)}, ties=[order_by], slices=slices)
    lead = F.col(millis).cast("long") * PER_MILLI - F.col("_i")
    rows = running(rows, [worker], millis, {"_lead": lead}, how="max", ties=[order_by], slices=slices)
    tick = F.col("_i") + F.col("_lead")
    made = pack_id(
        F.shiftright(tick, SEQUENCE_BITS), F.lit(centre), F.col(worker), tick.bitwiseAND(F.lit(PER_MILLI - 1))
    )
    return rows.withColumn(into, made).drop("_i", "_lead")
