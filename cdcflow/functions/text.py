"""Text helpers: identifiers, escapes, JSON and plain messages, topic templates, row rendering."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.functions.plan import let
from cdcflow.functions.times import wall_in


def unquote(col: Column) -> Column:
    """Identifier without its surrounding quotes; doubled inner quotes become single."""
    first, last = F.substring(col, 1, 1), F.substring(col, -1, 1)
    inner = F.substr(col, F.lit(2), F.length(col) - 2)
    quoted = (F.length(col) >= 2) & (first == last) & first.isin('"', "'", "`")
    return F.when(quoted, F.replace(inner, F.repeat(first, 2), first)).otherwise(col)


def unescape(col: Column) -> Column:
    """Octal escapes, then ``\\t``, ``\\r`` and ``\\n``, as the characters they name."""
    found = F.array_distinct(F.regexp_extract_all(col, F.lit(r"(\\[0-7]{3})"), 1))

    def put(text: Column, mark: Column) -> Column:
        return F.replace(text, mark, F.chr(F.conv(F.substring(mark, 2, 3), 8, 10).cast("int")))

    plain = F.when(F.size(found) > 0, F.aggregate(found, col, put)).otherwise(col)
    for mark, char in (("\\t", "\t"), ("\\r", "\r"), ("\\n", "\n")):
        plain = F.replace(plain, F.lit(mark), F.lit(char))
    return F.coalesce(plain, F.lit(""))


_JAVA_UNITS = r"((?:\\u+[0-9A-Fa-f]{4})++|\\[0-3]?[0-7]{1,2}|\\[\s\S]|[^\\]++|\\)"
_JAVA_MARKS = {"\\n": "\n", "\\t": "\t", "\\r": "\r", "\\b": "\b", "\\f": "\f"}


def java_unescaped(col: Column) -> Column:
    """Text with its Java escapes (named, octal, 16-bit) as the characters they stand for."""

    def read(unit: Column) -> Column:
        hexed = F.decode(F.unhex(F.regexp_replace(unit, r"\\u+", "")), "UTF-16BE")
        octal = F.chr(F.conv(F.substring(unit, 2, 3), 8, 10).cast("int"))
        out = F.when(F.rlike(unit, F.lit(r"^\\u+[0-9A-Fa-f]{4}")), hexed).when(F.rlike(unit, F.lit(r"^\\[0-7]")), octal)
        for mark, char in _JAVA_MARKS.items():
            out = out.when(unit == mark, char)
        return out.when(unit.startswith("\\") & (F.length(unit) == 2), F.substring(unit, 2, 1)).otherwise(unit)

    units = F.regexp_extract_all(col, F.lit(_JAVA_UNITS), 1)
    return F.when(F.contains(col, F.lit("\\")), F.array_join(F.transform(units, read), "")).otherwise(col)


def hex_bytes(col: Column) -> Column:
    """Bytes of a hex text; NULL if it is not hex."""
    return F.unhex(col)


def md5_key(*cols: Column) -> Column:
    """Hex MD5 of the UTF-8 text of the columns."""
    return F.md5(cols[0] if len(cols) == 1 else F.concat(*cols))


# Units of a dotted name: a quoted run (a backslash keeps the quote), a bracketed run, other text.
_NAME_UNITS = (
    r'("(?:[^"\\]++|\\.?)*+(?:"|$)'
    r"|'(?:[^'\\]++|\\.?)*+(?:'|$)"
    r"|\[[^\]]*+(?:\]|$)"
    r"|[^\"'\[]++)"
)
_HIDDEN = "\u0001"


def split_quoted(col: Column, sep: str = ".") -> Column:
    """Split at ``sep`` outside quotes and brackets; the marks themselves are dropped.

    Separators inside a marked unit are hidden, the units joined again, then split as usual.
    """

    def hide(unit: Column) -> Column:
        head = F.substring(unit, 1, 1)
        bare = (
            F.when(head == "[", F.regexp_replace(unit, r"[\[\]\"']", ""))
            .when(head == '"', F.regexp_replace(unit, r'^"|"$', ""))
            .when(head == "'", F.regexp_replace(unit, r"^'|'$", ""))
        )
        return F.coalesce(F.replace(bare, F.lit(sep), F.lit(_HIDDEN)), unit)

    joined = F.array_join(F.transform(F.regexp_extract_all(col, F.lit(_NAME_UNITS), 1), hide), "")
    parts = F.split(joined, re.escape(sep))
    return F.transform(parts, lambda part: F.replace(part, F.lit(_HIDDEN), F.lit(sep)))


def dotted_name(col: Column) -> Column:
    """A quoted table name with its parts joined by plain dots."""
    return F.array_join(split_quoted(col, "."), ".")


def decode_json(col: Column) -> Column:
    """JSON object text as map<string,string> with the raw text under ``message``.

    Text that is not a JSON object becomes ``{message: text}``.  Nested values stay JSON text.
    """
    alone = F.create_map(F.lit("message"), col)

    def event(parsed: Column) -> Column:
        whole = F.when(F.map_contains_key(parsed, "message"), parsed).otherwise(F.map_concat(parsed, alone))
        return F.when(parsed.isNull(), alone).otherwise(whole)

    return F.when(col.isNotNull(), let(F.from_json(col, "map<string,string>"), event))


def decode_plain(col: Column) -> Column:
    """Any text as ``{message: text}``."""
    return F.when(col.isNotNull(), F.create_map(F.lit("message"), col))


def json_value_type(col: Column) -> Column:
    """Kind of a JSON text: array, object, string, int, long, double, boolean or null; NULL if bad."""
    kind = F.schema_of_variant(F.try_parse_json(col))
    number = F.trim(col)
    as_long = number.try_cast("long")
    return (
        F.when(kind.isNull(), F.lit(None).cast("string"))
        .when(kind.startswith("ARRAY"), "array")
        .when(kind.startswith("OBJECT"), "object")
        .when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind == "VOID", "null")
        .when(number.contains(".") | as_long.isNull(), "double")
        .when(as_long.between(-(2**31), 2**31 - 1), "int")
        .otherwise("long")
    )


def render(col: Column, spark_type: T.DataType) -> Column:
    """Value as printed text; arrays in brackets, NULL as ``null``."""
    if isinstance(spark_type, T.ArrayType):
        items = F.transform(col, lambda x: F.coalesce(x.cast("string"), F.lit("null")))
        out = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    else:
        out = col.cast("string")
    return F.coalesce(out, F.lit("null"))


def render_row(df: DataFrame, delimiter: str = "|", cols: Sequence[str] | None = None) -> Column:
    """The row as printed text."""
    names = list(cols or df.columns)
    return F.concat_ws(delimiter, *[render(F.col(c), df.schema[c].dataType) for c in names])


def row_delimited(cols: Sequence[Column], delimiter: str) -> Column:
    """Texts joined by a delimiter; a missing one keeps its empty slot."""
    return F.concat_ws(delimiter, *[F.coalesce(c, F.lit("")) for c in cols])


def row_json(cols: Sequence[str], keep_nulls: bool = False) -> Column:
    """JSON of the columns in this order; null fields are left out unless asked for."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": str(not keep_nulls).lower()})


def map_text(col: Column) -> Column:
    """A map printed as ``{a=1, b=2}``."""
    pairs = F.transform(
        F.map_entries(col),
        lambda e: F.concat_ws("=", F.coalesce(e["key"], F.lit("null")), F.coalesce(e["value"], F.lit("null"))),
    )
    return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))


TEMPLATE = re.compile(r"%\{(.*?)\}")


def is_template(text: str) -> bool:
    return TEMPLATE.search(text) is not None


def fill_template(event: Column, template: str, tz: str = "UTC", now: Column | None = None) -> Column:
    """Fill ``%{field}``, ``%{+s}`` and ``%{+pattern}`` from a map<string,string> event.

    Times come from ``@timestamp`` (epoch milliseconds or ISO text, else now).  A field the event
    lacks stays as written.
    """
    stamp = F.try_element_at(event, F.lit("@timestamp"))
    at = F.coalesce(
        F.timestamp_millis(F.when(stamp.rlike(r"^-?\d+$"), stamp.try_cast("long"))),
        stamp.try_cast("timestamp"),
        now if now is not None else F.current_timestamp(),
    )
    parts: list[Column] = []
    end = 0
    for m in TEMPLATE.finditer(template):
        parts.append(F.lit(template[end : m.start()]))
        key = m.group(1)
        if key.lower() == "+s":
            parts.append(F.when(stamp.rlike(r"^-?\d+$"), stamp).otherwise(F.lit(m.group(0))))
        elif key.startswith("+"):
            parts.append(F.date_format(wall_in(at, tz), key[1:]))
        else:
            parts.append(F.coalesce(F.try_element_at(event, F.lit(key)), F.lit(m.group(0))))
        end = m.end()
    parts.append(F.lit(template[end:]))
    return F.concat(*parts)
