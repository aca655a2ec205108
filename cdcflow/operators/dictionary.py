"""Catalog snapshots: column dictionary, replica identity, type names; and typed changes from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.functions.plan import once
from cdcflow.operators.dirty import ERROR_TYPE, ERRORS, problem, split_dirty

# Letters of the replica identity, and Oracle type families.
IDENTITY = {"n": "nothing", "d": "default", "i": "index", "f": "full"}
TEXT_TYPES = ("CHAR", "VARCHAR2", "NCHAR", "NVARCHAR2", "LONG", "CLOB", "NCLOB")
#: Databases allow a thousand or so columns; more rows than this for one table are no dictionary.
MAX_DICTIONARY_COLUMNS = 100_000


def column_dictionary(
    columns: DataFrame, constraints: DataFrame, constraint_columns: DataFrame,
    indexes: DataFrame, index_columns: DataFrame, multitenant: bool = False,
) -> DataFrame:
    """Visible columns with type facts and primary-key and unique-index flags.

    Every join is on the full (container,) owner, table, column key; key sets are made distinct
    first, so no join multiplies rows.
    """
    head = ["con_id"] if multitenant else []
    table, column = [*head, "owner", "table_name"], [*head, "owner", "table_name", "column_name"]
    pk = (
        constraint_columns.join(
            constraints.where("constraint_type = 'P'").select(*table, "constraint_name"), [*table, "constraint_name"], "left_semi"
        )
        .select(*column, F.lit(1).alias("pk_column"))
        .distinct()
    )
    uq = (
        index_columns.join(
            indexes.where("uniqueness = 'UNIQUE'").select(*table, "index_owner", "index_name"),
            [*table, "index_owner", "index_name"], "left_semi",
        )
        .select(*column, F.lit(1).alias("uq_column"))
        .distinct()
    )
    shown = columns.where("hidden_column = 'NO' and virtual_column = 'NO'")
    zero = F.lit(0)
    return (
        shown.join(pk, column, "left")
        .join(uq, column, "left")
        .select(
            *column, "column_id", "nullable", "data_type",
            F.coalesce("data_precision", "data_length").alias("data_length"),
            F.coalesce("data_scale", zero).alias("data_scale"),
            F.coalesce("data_precision", zero).alias("data_precision"),
            F.coalesce("pk_column", zero).alias("pk_column"),
            F.coalesce("uq_column", zero).alias("uq_column"),
        )
    )


def replica_identity(classes: DataFrame, namespaces: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """How much of the old row each table logs; ``needs_full`` marks tables that log less than all."""
    named = classes.join(
        namespaces.select(F.col("oid").alias("relnamespace"), "nspname"), "relnamespace", "left"
    )
    if tables is not None:
        named = named.join(tables.select(F.col("schema").alias("nspname"), F.col("table").alias("relname")).distinct(), ["nspname", "relname"], "left_semi")
    label = F.lit("unknown")
    for letter, name in IDENTITY.items():
        label = F.when(F.col("relreplident") == letter, name).otherwise(label)
    return named.select(
        F.col("nspname").alias("schema"), F.col("relname").alias("table"), label.alias("identity")
    ).withColumn("needs_full", F.col("identity") != "full")


def type_oids(types: DataFrame, namespaces: DataFrame) -> DataFrame:
    """oid -> type name, without array types and the toast namespace."""
    spaces = namespaces.where("nspname <> 'pg_toast'").select(F.col("oid").alias("typnamespace"))
    return types.where("typcategory <> 'A'").join(spaces, "typnamespace", "left_semi").select(
        "oid", F.col("typname").alias("type")
    )


def spark_type(data_type: str, precision: int, scale: int, compat: bool = False) -> str:
    """Spark type of a dictionary column.

    Numbers stay exact decimals; ``compat`` picks the machine type by precision instead.
    """
    kind = data_type.upper()
    if kind == "NUMBER":
        if compat:
            if scale > 0 or precision == 0:
                return "double"
            for limit, name in ((2, "tinyint"), (4, "smallint"), (9, "int")):
                if precision <= limit:
                    return name
            return "bigint"
        return f"decimal({min(precision or 38, 38)},{min(max(scale, 0), 38)})"
    if kind.startswith("TIMESTAMP") or kind == "DATE":
        return "timestamp_ntz"
    return "string"


def _typed(value: Column, kind: str) -> Column:
    if kind == "string":
        return value
    if kind == "timestamp_ntz":
        return F.regexp_replace(value, r"\s*\+.*$", "").try_cast(kind)
    return value.try_cast(kind)


def typed_changes(
    changes: DataFrame, dictionary: DataFrame, owner: str, table: str, compat: bool = False, container: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Changes of one table with ``before`` and ``after`` as typed structs, and the dirty ones.

    The dictionary of a single table is a handful of rows and becomes the schema on the driver; one
    that is impossibly long is refused, never cut.  A multitenant dictionary needs the ``container``.
    """
    if "con_id" in dictionary.columns:
        if container is None:
            raise ValueError("the dictionary spans containers: name one")
        dictionary = dictionary.where(F.col("con_id") == container)
        if "con_id" in changes.columns:
            changes = changes.where(F.col("con_id") == container)
    listed = dictionary.where((F.col("owner") == owner) & (F.col("table_name") == table))
    known = listed.orderBy("column_id").limit(MAX_DICTIONARY_COLUMNS + 1).collect()
    if not known:
        raise ValueError(f"no columns known for {owner}.{table}")
    if len(known) > MAX_DICTIONARY_COLUMNS:
        raise ValueError(f"more than {MAX_DICTIONARY_COLUMNS} columns listed for {owner}.{table}")
    kinds = {r["column_name"]: spark_type(r["data_type"], r["data_precision"], r["data_scale"], compat) for r in known}
    rows = changes.where((F.col("schema") == owner) & (F.col("table") == table))
    return typed_images(rows, kinds)


def typed_images(rows: DataFrame, kinds: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Text maps ``before`` and ``after`` as structs of the given types; (good, dirty)."""

    def struct(side: str) -> Column:
        cells = [_typed(F.try_element_at(side, F.lit(c)), k).alias(c) for c, k in kinds.items()]
        return F.when(F.col(side).isNotNull(), F.struct(*cells))

    typed = once(rows, {"_b": struct("before"), "_a": struct("after")})
    found = [
        problem(c, "conversion", F.concat(F.lit(f"can't read as {k}: "), F.try_element_at(side, F.lit(c))),
                F.try_element_at(side, F.lit(c)).isNotNull() & F.col(f"{made}.{c}").isNull())
        for c, k in kinds.items()
        if k != "string"
        for side, made in (("before", "_b"), ("after", "_a"))
    ]
    checked = once(typed, {ERRORS: F.array_compact(F.array(*found)).cast(ERROR_TYPE)})
    good, dirty = split_dirty(checked)
    return good.withColumns({"before": F.col("_b"), "after": F.col("_a")}).drop("_b", "_a"), dirty.drop("_b", "_a")
