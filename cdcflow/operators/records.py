"""Column specs, message records and rendered rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.functions.plan import once
from cdcflow.functions.text import decode_json, decode_plain, fill_template, map_text, render, render_row
from cdcflow.functions.times import format_time, to_timestamp_any
from cdcflow.functions.types import TIME_TYPES, text_error, text_to
from cdcflow.operators.dirty import ERROR_TYPE, ERRORS, problem
from cdcflow.session import materialize


@dataclass(frozen=True)
class ColumnSpec:
    """One entry of a job's column list."""

    name: str | None = None
    type: str | None = None
    index: int | None = None
    value: str | None = None
    format: str | None = None

    @property
    def output(self) -> str:
        if self.name:
            return self.name
        if self.index is not None:
            return str(self.index)
        if self.value:
            return f"val_{self.value}"
        raise ValueError("column needs a name, an index or a value")


def column_specs(columns: Sequence[str | Mapping]) -> list[ColumnSpec]:
    """Read a column list: ``["*"]``, names, or maps; other keys of a map are ignored."""
    if not columns:
        raise ValueError("column list is empty")
    specs = []
    for entry in columns:
        if isinstance(entry, str):
            specs.append(ColumnSpec(name=entry))
        elif isinstance(entry, Mapping):
            index = entry.get("index")
            fmt = str(entry["format"]) if str(entry.get("format") or "").strip() else None
            specs.append(
                ColumnSpec(
                    name=entry.get("name"),
                    type=entry.get("type"),
                    index=None if index is None else int(index),
                    value=None if entry.get("value") is None else str(entry["value"]),
                    format=fmt,
                )
            )
        else:
            raise TypeError(f"bad column entry {entry!r}")
    return specs


def project(df: DataFrame, columns: Sequence[str | Mapping], restore_column: str | None = None) -> DataFrame:
    """The columns a job asks for: by name, by position, or constant; typed and time-formatted."""
    specs = column_specs(columns)
    if [s.name for s in specs] == ["*"]:
        out = df
    else:
        fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        out = df.select(*[_spec_column(df, s, i, fields).alias(s.output) for i, s in enumerate(specs)])
    if restore_column is not None and restore_column not in out.columns:
        raise ValueError(f"restore column {restore_column!r} is not in the column list")
    return out


def project_checked(df: DataFrame, columns: Sequence[str | Mapping], restore_column: str | None = None) -> DataFrame:
    """``project``, with an error list where a declared type may not fit the text it is read from.

    Text that cannot be read as its column's type makes the row dirty, with the column, the type and
    the text; without such columns no list is added.
    """
    specs = column_specs(columns)
    out = project(df, columns, restore_column)
    if [s.name for s in specs] == ["*"]:
        return out
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    texts = {}
    for i, s in enumerate(specs):
        name = s.name if s.name in fields else df.columns[i if s.index is None else s.index] if s.value is None else None
        if name is not None and fields[name] == "string" and s.type is not None:
            texts[s.output] = (name, s.type)
    if not texts:
        return out
    kept = "_texts"
    held = df.select(*df.columns, F.struct(*[F.col(f"`{name}`").alias(f"t{i}") for i, (name, _) in enumerate(texts.values())]).alias(kept))
    typed = [_spec_column(df, s, i, fields).alias(s.output) for i, s in enumerate(specs)]
    rows = once(held.select(kept, F.struct(*typed).alias("_typed")), {"_typed": F.col("_typed")})
    found = [
        problem(output, "conversion", F.concat(F.lit(f"can't read as {kind}: "), F.col(f"{kept}.t{i}")), text_error(F.col(f"{kept}.t{i}"), F.col(f"_typed.`{output}`")))
        for i, (output, (_, kind)) in enumerate(texts.items())
    ]
    return rows.select("_typed.*", F.array_compact(F.array(*found)).cast(ERROR_TYPE).alias(ERRORS))


def _spec_column(df: DataFrame, spec: ColumnSpec, place: int, fields: Mapping[str, str]) -> Column:
    if spec.value is not None:
        col = F.lit(None).cast("string") if spec.value.lower() == "null" else F.lit(spec.value)
        have = "string"
    else:
        name = spec.name if spec.name in fields else df.columns[place if spec.index is None else spec.index]
        col, have = F.col(f"`{name}`"), fields[name]
    if have == "string":
        if spec.type is None and spec.format is None:
            return col
        return text_to(col, spec.type or "STRING", spec.format)
    kind = (spec.type or "").split("(")[0].upper()
    if spec.format and have.startswith(("timestamp", "date")):
        return format_time(col.cast("timestamp_ntz"), spec.format)
    if kind in TIME_TYPES and kind != "TIME":
        wall = to_timestamp_any(col, have, spec.format)
        return wall.cast("date") if kind == "DATE" else wall
    if kind in ("STRING", "VARCHAR", "CHAR", "TEXT"):
        return col.cast("string")
    return col


def result_types(df: DataFrame, columns: Sequence[str | Mapping]) -> list[str]:
    """Type per listed column; constants count as VARCHAR."""
    types = {f.name.lower(): f.dataType.simpleString() for f in df.schema.fields}
    return ["VARCHAR" if s.value is not None else types[(s.name or df.columns[s.index or 0]).lower()] for s in column_specs(columns)]


def decode_messages(df: DataFrame, codec: str = "plain", value: str = "value", decoders: Mapping | None = None) -> DataFrame:
    """Add ``event``: the message as map<string,string>, read by the named codec."""
    known = {"plain": decode_plain, "text": decode_plain, "json": decode_json, **(decoders or {})}
    return once(df, {"event": known[codec](F.col(value))})


def message_map(df: DataFrame, fields: Sequence[str] | None = None) -> Column:
    """The row as map<string,string>.

    With enough field names, values are printed under those names.  Otherwise a lone map column is
    taken as it is, a lone text column is read as JSON, and anything else goes under ``message``.
    """
    types = [f.dataType for f in df.schema.fields]
    if fields and len(fields) >= len(df.columns):
        pairs: list[Column] = []
        for name, col, kind in zip(fields, df.columns, types):
            pairs += [F.lit(name), render(F.col(col), kind)]
        return F.create_map(*pairs)
    if len(types) == 1 and isinstance(types[0], T.MapType):
        return F.col(df.columns[0])
    if len(types) == 1 and isinstance(types[0], T.StringType):
        return decode_json(F.col(df.columns[0]))
    return F.create_map(F.lit("message"), render_row(df, ","))


def to_message_records(
    df: DataFrame,
    topic: str,
    fields: Sequence[str] | None = None,
    tz: str = "UTC",
    key: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(topic, key, value) rows: topic from the template, value as JSON with its nulls kept.

    ``keep`` names columns carried beside the message instead of inside it.
    """
    body = df.drop(*keep)
    event = message_map(body, fields)
    mapped = df.withColumn("_event", event)
    message_key = (
        F.concat_ws("|", *[F.col(c).cast("string") for c in key]) if key else map_text(F.col("_event"))
    )
    return mapped.select(
        *keep,
        fill_template(F.col("_event"), topic, tz).alias("topic"),
        message_key.alias("key"),
        F.to_json("_event", {"ignoreNullFields": "false"}).alias("value"),
    )


LEAF = "kind, as_int, as_long, as_double, as_string, as_boolean".split(", ")


def _leaf(value: Column, schema: Column) -> dict[str, Column]:
    """Kind and typed value of a variant: whole numbers keep int or long, others are doubles."""
    whole = F.when(schema == "BIGINT", F.try_variant_get(value, "$", "bigint"))
    number = schema.rlike("^(DECIMAL|DOUBLE|FLOAT)")
    small = whole.between(-(2**31), 2**31 - 1)
    kind = (
        F.when(schema.startswith("ARRAY"), "array").when(schema.startswith("OBJECT"), "object").when(schema == "STRING", "string")
        .when(schema == "BOOLEAN", "boolean").when(schema == "VOID", "null").when(small, "int").when(whole.isNotNull(), "long").when(number, "double")
    )
    return {
        "kind": kind,
        "as_int": F.when(small, whole).cast("int"),
        "as_long": F.when(~small, whole),
        "as_double": F.when(number, F.try_variant_get(value, "$", "double")),
        "as_string": F.when(schema == "STRING", F.try_variant_get(value, "$", "string")),
        "as_boolean": F.when(schema == "BOOLEAN", F.try_variant_get(value, "$", "boolean")),
    }


def json_leaves(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """Every value inside a JSON text, however deep, with its type: one row per value that holds no others.

    Columns: ``keep``, ``path`` (``$['name'][0]``), ``kind`` and the value in the column of its kind: numbers
    with a point or an exponent are doubles, others int or, beyond its range, long (beyond that, double).
    An empty array or object is a row of its kind without a value.  Texts that are not JSON give no row.
    Arrays and objects are opened level by level; each level is stored, so rows are parsed once.
    """
    spark = df.sparkSession
    level = df.select(*keep, F.lit("$").alias("path"), F.try_parse_json(F.col(text)).alias("value")).where(F.col("value").isNotNull())
    found = None
    while True:
        level = materialize(level.withColumn("schema", F.schema_of_variant("value")), "json-level")
        opened = F.col("schema").rlike("^(ARRAY|OBJECT)") & ~F.col("schema").isin("ARRAY<VOID>", "OBJECT<>")
        empty = F.col("schema").isin("ARRAY<VOID>") & (F.to_json("value") != "[]")
        inner = opened | empty
        leaves = level.where(~inner).select(*keep, "path", *[c.alias(n) for n, c in _leaf(F.col("value"), F.col("schema")).items()])
        found = leaves if found is None else found.unionByName(leaves)
        deeper = level.where(inner).select(*keep, "path", F.col("value").alias("_parent"), "schema")
        if deeper.isEmpty():
            return found
        parts = deeper.lateralJoin(spark.tvf.variant_explode(F.col("_parent").outer()))
        step = F.when(F.col("schema").startswith("ARRAY"), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]"))).otherwise(F.concat(F.lit("['"), "key", F.lit("']")))
        level = parts.select(*keep, F.concat("path", step).alias("path"), "value")
