"""Apply a change log to a table: the latest image per key wins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.session import materialize

ORDER = ("commit_scn", "scn", "seq")


def order_of(changes: DataFrame, order: Sequence[str] | None = None) -> list[str]:
    """The order of changes: as given, else ``ORDER`` without ``seq`` where the log lacks it.

    It must be unique per key, or the winner among equals is undefined; ``txn.repeated_positions``
    lists where it is not.
    """
    if order is not None:
        if not order:
            raise ValueError("changes need an order")
        return list(order)
    return [c for c in ORDER if c != "seq" or c in changes.columns]


def _key(image: str, keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"{image}.{k}").alias(k) for k in keys])


def _actions(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key touched: a delete, or a new image; a key change gives one of each."""
    old, new = _key("before", keys), _key("after", keys)
    moved = reduce(
        lambda a, b: a | b, [~F.col(f"before.{k}").eqNullSafe(F.col(f"after.{k}")) for k in keys]
    )
    no_image = F.lit(None).cast(changes.schema["after"].dataType)
    removal = F.struct(old.alias("key"), F.lit(False).alias("live"), no_image.alias("image"))
    arrival = F.struct(new.alias("key"), F.lit(True).alias("live"), F.col("after").alias("image"))
    actions = (
        F.when(F.col("after").isNull(), F.array(removal))
        .when(F.col("before").isNotNull() & moved, F.array(removal, arrival))
        .otherwise(F.array(arrival))
    )
    return changes.select(*order, F.explode(actions).alias("a")).select(
        *[F.col(f"a.key.{k}").alias(k) for k in keys], *order, "a.live", "a.image"
    )


def compact_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Last action per key: ``keys, live, image, *order``.

    ``max_by`` aggregates on the map side, so a key that holds most of the log shrinks to one row
    per map task before the shuffle.
    """
    order = order_of(changes, order)
    at = F.struct(*[F.col(c) for c in order])
    last = F.max_by(F.struct("live", "image", at.alias("at")), at)
    return (
        _actions(changes, keys, order)
        .groupBy(*keys)
        .agg(last.alias("l"))
        .select(*keys, "l.live", "l.image", *[F.col(f"l.at.{c}").alias(c) for c in order])
    )


def live_images(delta: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows that compacted changes leave behind."""
    return delta.where("live").select(*[F.col(f"image.{c}").alias(c) for c in columns])


def _same_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"b.{k}") == F.col(f"d.{k}") for k in keys])


def apply_changes(
    base: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    *,
    store_delta: bool = True,
) -> DataFrame:
    """State of ``base`` after ``changes``, whose ``before`` and ``after`` structs have its columns.

    The delta is written first, so that its size is known: below the broadcast threshold the base is
    filtered in place and never shuffled.  Without ``store_delta`` nothing runs while the plan is built;
    the delta is outer-joined, with one shuffle of either side by key.
    """
    delta = compact_changes(changes, keys, order)
    if store_delta:
        delta = materialize(delta, "delta")
        kept = base.join(delta.select(*keys), list(keys), "left_anti").select(*base.columns)
        return kept.unionByName(live_images(delta, base.columns))
    joined = base.alias("b").join(delta.alias("d"), _same_key(keys), "full_outer")
    touched = F.col("d.live").isNotNull()
    return joined.where(~touched | F.col("d.live")).select(
        *[F.when(touched, F.col(f"d.image.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in base.columns]
    )


def unchanged_delta(
    changes: DataFrame, columns: Sequence[str], keys: Sequence[str], order: Sequence[str] | None = None, unchanged: str = "unchanged"
) -> DataFrame:
    """One row per key touched: ``live`` and, per column of the table, the latest value really sent (``v_<column>``, NULL if none was).

    When the key itself changed, a value not resent is read from the before image.
    """
    cols = [c for c in columns if c not in keys]
    order = order_of(changes, order)
    at = F.struct(*[F.col(c) for c in order])
    after = F.col("after")
    gaps = F.coalesce(F.col(unchanged), F.array().cast("array<string>"))
    moved = F.col("before").isNotNull() & after.isNotNull() & reduce(
        lambda a, b: a | b, [~F.col(f"before.{k}").eqNullSafe(F.col(f"after.{k}")) for k in keys]
    )
    filled = after
    for c in cols:
        filled = filled.withField(
            c,
            F.when(moved & F.array_contains(gaps, c), F.col(f"before.{c}")).otherwise(F.col(f"after.{c}")),
        )
    rows = changes.withColumns(
        {"after": F.when(after.isNotNull(), filled), "_gaps": F.when(moved, F.array().cast("array<string>")).otherwise(gaps)}
    )
    old, new = _key("before", keys), _key("after", keys)
    none = F.lit(None).cast(changes.schema["after"].dataType)
    no_gaps = F.array().cast("array<string>")
    removal = F.struct(old.alias("key"), F.lit(False).alias("live"), none.alias("image"), no_gaps.alias("gaps"))
    arrival = F.struct(new.alias("key"), F.lit(True).alias("live"), F.col("after").alias("image"), F.col("_gaps").alias("gaps"))
    actions = (
        F.when(F.col("after").isNull(), F.array(removal))
        .when(moved, F.array(removal, arrival))
        .otherwise(F.array(arrival))
    )
    acts = rows.select(*order, F.explode(actions).alias("a")).select(
        *[F.col(f"a.key.{k}").alias(k) for k in keys], *order, "a.live", "a.image", "a.gaps"
    )
    sent = {c: ~F.array_contains("gaps", c) for c in cols}
    return acts.groupBy(*keys).agg(
        F.max_by("live", at).alias("live"),
        *[
            F.max_by(F.struct(F.col(f"image.{c}").alias("v")), F.when(sent[c], at)).alias(f"v_{c}")
            for c in cols
        ],
    )


def fold_unchanged(base: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``base`` after a stored ``unchanged_delta``; a small delta is broadcast and the base read in place, its keys twice."""
    cols = [c for c in base.columns if c not in keys]
    known = base.select(*keys).join(delta.select(*keys), list(keys), "left_semi").distinct()
    joined = base.alias("b").join(delta.alias("d"), _same_key(keys), "left")
    value = lambda c: F.when(F.col(f"d.v_{c}").isNotNull(), F.col(f"d.v_{c}.v")).otherwise(F.col(f"b.{c}"))
    kept = joined.where(F.coalesce(F.col("d.live"), F.lit(True))).select(*[F.col(f"b.{c}") if c in keys else value(c).alias(c) for c in base.columns])
    arrived = delta.where("live").join(known, list(keys), "left_anti")
    return kept.unionByName(arrived.select(*keys, *[F.col(f"v_{c}.v").alias(c) for c in cols]).select(*base.columns))


def apply_unchanged(
    base: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    unchanged: str = "unchanged",
) -> DataFrame:
    """``apply_changes`` for logs that leave out large values that did not change.

    Each column takes its latest value that was really sent, else the value already in ``base``.
    The delta is stored first, as in ``apply_changes``.
    """
    return fold_unchanged(base, materialize(unchanged_delta(changes, base.columns, keys, order, unchanged), "delta"), keys)


def change_counts(changes: DataFrame, by: Sequence[str] = ("schema", "table", "op")) -> DataFrame:
    """Changes per table and kind."""
    return changes.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
