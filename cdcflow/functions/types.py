"""Type names, text to typed values and back, value coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cdcflow.functions.times import format_time, parse_time

# The type names a column list may use, and their classes.
TYPE_NAMES = (
    "STRING", "VARCHAR", "VARCHAR2", "CHAR", "NVARCHAR", "TEXT", "KEYWORD", "BINARY",
    "INT", "INT32", "MEDIUMINT", "TINYINT", "DATETIME", "SMALLINT", "BIGINT", "LONG", "INT64",
    "SHORT", "INTEGER", "NUMBER", "DOUBLE", "FLOAT", "BOOLEAN", "DATE", "TIMESTAMP", "TIME",
    "DECIMAL", "YEAR", "BIT",
)
TIME_TYPES = ("DATE", "DATETIME", "TIME", "TIMESTAMP")
NUMBER_TYPES = (
    "INT", "INTEGER", "MEDIUMINT", "TINYINT", "SMALLINT", "BIGINT", "LONG", "SHORT", "DOUBLE",
    "FLOAT", "DECIMAL", "NUMBER",
)
STRING_TYPES = ("STRING", "VARCHAR", "VARCHAR2", "CHAR", "NVARCHAR", "TEXT", "KEYWORD", "BINARY")

INTEGER_TEXT = r"^[+-]?[0-9]+$"
NUMBER_TEXT = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"

# Spark type a text column becomes, by normalized type name; other names keep the text.
PARSED_TYPES = {
    "TINYINT": "tinyint",
    "SMALLINT": "smallint",
    "INT": "int",
    "MEDIUMINT": "bigint",
    "BIGINT": "bigint",
    "FLOAT": "float",
    "DOUBLE": "double",
}


def normalize_type(col: Column, strict: bool = False) -> Column:
    """Canonical type name.  Unknown names give NULL when strict, else STRING."""
    name = F.upper(F.substring_index(col, "(", 1))
    name = F.when(name.contains("UNSIGNED"), F.trim(F.replace(name, F.lit("UNSIGNED"), F.lit("")))).otherwise(name)
    if strict:
        return F.when(name.isin(*TYPE_NAMES), name)
    return (
        F.when(col.isNull(), F.lit(None).cast("string"))
        .when(name.contains("TIMESTAMP"), F.lit("TIMESTAMP"))
        .when(name.isin(*TYPE_NAMES), name)
        .otherwise(F.lit("STRING"))
    )


def type_class(col: Column) -> Column:
    """time, number, string, or other."""
    name = normalize_type(col)
    return (
        F.when(name.isin(*TIME_TYPES), "time")
        .when(name.isin(*NUMBER_TYPES), "number")
        .when(name.isin(*STRING_TYPES), "string")
        .otherwise("other")
    )


def decimal_info(col: Column, default: tuple[int, int] = (38, 18)) -> Column:
    """struct(precision, scale) of a decimal type name; NULL for any other type."""
    inner = r"^[^(]*\(\s*([0-9]+)\s*,\s*([0-9]+)\s*\)"
    given = col.contains("(") & col.contains(")")
    part = [
        F.when(given, F.regexp_extract(col, inner, i).try_cast("int")).otherwise(F.lit(d))
        for i, d in ((1, default[0]), (2, default[1]))
    ]
    return F.when(
        F.lower(col).startswith("decimal"), F.struct(part[0].alias("precision"), part[1].alias("scale"))
    )


def text_to(col: Column, type_name: str, fmt: str | None = None, tz: str = "GMT+8") -> Column:
    """Text as a value of ``type_name``; NULL when empty or not readable (see :func:`text_error`)."""
    name = type_name.split("(")[0].upper()
    name = name.replace("UNSIGNED", "").strip() if "UNSIGNED" in name else name
    name = "TIMESTAMP" if "TIMESTAMP" in name else name
    text = F.trim(col)
    if name in ("TINYINT", "SMALLINT", "INT", "MEDIUMINT", "BIGINT"):
        return F.when(text.rlike(INTEGER_TEXT), text.try_cast(PARSED_TYPES[name]))
    if name in ("FLOAT", "DOUBLE"):
        return F.when(text.rlike(NUMBER_TEXT) | text.isin("NaN", "Infinity", "-Infinity"), text.try_cast(PARSED_TYPES[name]))
    if name == "BOOLEAN":
        return F.when(col != "", F.lower(text) == "true")
    if name in ("DATE", "TIMESTAMP", "DATETIME"):
        parsed = parse_time(col, fmt)
        return parsed.cast("date") if name == "DATE" else parsed
    if name in TYPE_NAMES and name not in ("STRING", "VARCHAR", "CHAR"):
        return col
    return format_time(parse_time(col, fmt), "datetime") if fmt else col


def text_error(col: Column, value: Column) -> Column:
    """True where there was text but no value came out of it."""
    return col.isNotNull() & (F.trim(col) != "") & value.isNull()


def value_to_text(col: Column, type_name: str, spark_type: str, tz: str = "GMT+8") -> Column:
    """Typed value as text; NULL gives the empty text.

    ``spark_type`` is the column's type; wall-clock timestamps are read in ``tz``.
    """
    name = type_name.split("(")[0].upper()
    is_time = spark_type.startswith("timestamp") or spark_type == "date"
    if name in ("BIGINT", "LONG") and is_time:
        out = wall_millis(col, tz).cast("string")
    elif name in ("TINYINT", "SMALLINT", "SHORT", "INT", "INTEGER", "BIGINT", "LONG"):
        width = {"TINYINT": "tinyint", "SMALLINT": "smallint", "SHORT": "smallint", "INT": "int", "INTEGER": "int"}
        out = F.trim(col.cast("string")).try_cast(width.get(name, "bigint")).cast("string")
    elif name in ("FLOAT", "DOUBLE"):
        out = col.cast(name.lower()).cast("string")
    elif name == "BOOLEAN":
        out = (F.lower(F.trim(col.cast("string"))) == "true").cast("string")
    elif name == "DATE":
        out = format_time(col.cast("timestamp_ntz"), "date")
    elif name in ("DATETIME", "TIMESTAMP") or (is_time and name in ("STRING", "VARCHAR", "CHAR", "TEXT")):
        out = format_time(col.cast("timestamp_ntz"), "datetime")
    else:
        out = col.cast("string")
    return F.coalesce(out, F.lit(""))


def wall_millis(col: Column, tz: str = "GMT+8") -> Column:
    """Epoch milliseconds of a wall-clock timestamp read in ``tz``."""
    utc = F.convert_timezone(F.lit(tz), F.lit("UTC"), col.cast("timestamp_ntz"))
    return F.timestamp_diff("MILLISECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), utc)


def coerce(col: Column, type_name: str, default: object = None) -> Column:
    """Value read as ``type_name``, or ``default`` when it is missing or not readable."""
    value = (F.lower(col.cast("string")) == "true") if type_name == "boolean" else col.try_cast(type_name)
    return value if default is None else F.coalesce(value, F.lit(default).cast(type_name))


def lenient_number(col: Column, type_name: str) -> Column:
    """Number in the text, 0 when it is not one; the rule of typed constants."""
    rule = INTEGER_TEXT if type_name in ("int", "bigint") else NUMBER_TEXT
    return F.coalesce(F.when(col.rlike(rule), col.try_cast(type_name)), F.lit(0).cast(type_name))
