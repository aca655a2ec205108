"""Writing a batch that a sink may refuse as a whole: halves until the bad rows stand alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.operators.dirty import ERROR_TYPE, ERRORS, ErrorLimitExceeded, error_category
from cdcflow.session import materialize

ROW = "_row"
Write = Callable[[DataFrame], None]


def write_isolating(rows: DataFrame, write: Write, max_errors: int | None = None) -> DataFrame | None:
    """Write ``rows``; if ``write`` raises, write its halves by themselves, and so on down to single rows.

    Returns the rows that fail alone, each with its error, or None if there are none.  ``write`` must take
    all rows it is given or none (a transaction, a commit of a table).  A good row is tried once more for
    every halving, so about log2 n times at most, and k bad rows cost about 2 k log2 n tries; more than
    ``max_errors`` bad rows raise, and what was written until then stays written.  The rows are stored
    first: all tries see the same ones, repeated rows included.
    """
    try:
        return write(rows)
    except Exception as whole:  # whatever a sink raises
        stored = materialize(rows.withColumn(ROW, F.monotonically_increasing_id()), "batch")
        bounds = stored.agg(F.min(ROW), F.max(ROW)).first()
        if bounds[0] is None:
            raise
        waiting, bad = [(*bounds, whole)], []
    while waiting:
        low, high, error = waiting.pop()
        here = stored.where(F.col(ROW).between(low, high))
        if low == high:
            bad.append((low, str(error)[:2000]))
            if max_errors is not None and len(bad) > max_errors:
                raise ErrorLimitExceeded(f"more than {max_errors} rows are refused") from error
            continue
        middle = here.agg(F.percentile_approx(ROW, 0.5, 10_000)).first()[0]
        halves = [here.where(F.col(ROW) <= min(middle, high - 1)), here.where(F.col(ROW) > min(middle, high - 1))]
        for half in halves:
            edges = half.agg(F.min(ROW), F.max(ROW)).first()
            if edges[0] is None:
                continue
            try:
                write(half.drop(ROW))
            except Exception as e:
                waiting.append((*edges, e))
    if not bad:
        return None
    spark = rows.sparkSession
    errors = spark.createDataFrame(bad, f"{ROW} long, _message string")
    entry = F.struct(F.lit(None).cast("string").alias("col"), error_category(F.col("_message")).alias("type"), F.col("_message").alias("msg"))
    return stored.join(F.broadcast(errors), ROW).withColumn(ERRORS, F.array(entry).cast(ERROR_TYPE)).drop(ROW, "_message")
