"""Time text, epoch numbers and formats.  Parsed times are wall clock (TIMESTAMP_NTZ)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Formats tried in this order, and digit counts of epoch units.
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyyMMddHHmmss", "yyyy-MM-dd", "HH:mm:ss", "yyyy")
OUTPUT_FORMATS = {"datetime": "yyyy-MM-dd HH:mm:ss", "date": "yyyy-MM-dd", "time": "HH:mm:ss", "year": "yyyy"}
SECOND_DIGITS, MILLI_DIGITS, MICRO_DIGITS, NANO_DIGITS = 10, 13, 16, 19

# What each format looks like, so that a value meets one parser instead of five.
_SHAPES = {
    "yyyy-MM-dd HH:mm:ss": r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$",
    "yyyyMMddHHmmss": r"^\d{14}$",
    "yyyy-MM-dd": r"^\d{4}-\d{1,2}-\d{1,2}$",
    "HH:mm:ss": r"^\d{1,2}:\d{1,2}:\d{1,2}$",
    "yyyy": r"^\d{4}$",
}


def _read(col: Column, fmt: str) -> Column:
    return F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")


def parse_time(col: Column, fmt: str | None = None, *, prefixes: bool = False) -> Column:
    """Time text as wall clock: the custom format first, then the standard ones; NULL if none fits.

    Fractions of a second and zone suffixes are cut.  ``prefixes`` also accepts trailing text after
    a readable start, and a bare year at the very least.
    """
    text = F.trim(col)
    cut = F.regexp_replace(text, r"(:\d{1,2})[.,]\d+.*$|(:\d{1,2}) ?(Z|[+-]\d{2}:?\d{2})$", "$1$2")
    out = None
    for shape, rule in _SHAPES.items():
        pattern = shape.replace("MM", "M").replace("dd", "d").replace("HH", "H").replace("mm", "m").replace("ss", "s")
        reader = _read(cut, shape if shape == "yyyyMMddHHmmss" else pattern)
        out = F.when(cut.rlike(rule), reader) if out is None else out.when(cut.rlike(rule), reader)
    if prefixes:
        full = F.regexp_extract(text, r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}", 0)
        day = F.regexp_extract(text, r"^\d{4}-\d{1,2}-\d{1,2}", 0)
        year = F.regexp_extract(text, r"^\d+", 0)
        out = F.coalesce(
            out,
            F.when(full != "", _read(full, "yyyy-M-d H:m:s")),
            F.when(day != "", _read(day, "yyyy-M-d")),
            F.when(year != "", _read(F.substring(year, 1, 4), "yyyy")),
        )
    return F.coalesce(_read(text, fmt), out) if fmt else out


def time_error(col: Column, value: Column) -> Column:
    """True where there was text but no time came out of it."""
    return col.isNotNull() & (F.trim(col) != "") & value.isNull()


def wall_in(col: Column, tz: str) -> Column:
    """Wall clock in ``tz`` of an instant, whatever the session zone."""
    return F.convert_timezone(F.current_timezone(), F.lit(tz), col.cast("timestamp_ntz"))


def millis_to_wall(millis: Column, tz: str = "GMT+8") -> Column:
    """Wall clock in ``tz`` of epoch milliseconds."""
    return wall_in(F.timestamp_millis(millis), tz)


def format_time(col: Column, kind: str = "datetime") -> Column:
    """Wall clock as text: datetime, date, time, year, or any other pattern."""
    return F.date_format(col, OUTPUT_FORMATS.get(kind, kind))


def epoch_millis(col: Column, tz_hours: int = 8) -> Column:
    """Epoch text to milliseconds by its digit count; short numbers count days from local midnight."""
    n, size = col.try_cast("long"), F.length(col)
    return (
        F.when(size == SECOND_DIGITS, n * 1000)
        .when(size == MICRO_DIGITS, F.call_function("div", n, F.lit(1000)))
        .when(size == NANO_DIGITS, F.call_function("div", n, F.lit(1_000_000)))
        .when(size < SECOND_DIGITS, n * 86_400_000 - tz_hours * 3_600_000)
        .otherwise(n)
    )


def to_timestamp_any(col: Column, spark_type: str, fmt: str | None = None, tz: str = "GMT+8") -> Column:
    """Wall clock of text, an epoch number, a date or a timestamp; the rule follows the column type."""
    if spark_type == "string":
        return parse_time(col, fmt)
    if spark_type in ("int", "bigint"):
        return millis_to_wall(epoch_millis(col.cast("string")), tz)
    if spark_type in ("date", "timestamp_ntz"):
        return col.cast("timestamp_ntz")
    if spark_type == "timestamp":
        return wall_in(col, tz)
    raise TypeError(f"can't read {spark_type} as a time")


def to_date_any(col: Column, spark_type: str, fmt: str | None = None, tz: str = "GMT+8") -> Column:
    """Date of the same inputs."""
    return to_timestamp_any(col, spark_type, fmt, tz).cast("date")


def epoch_parts(col: Column) -> Column:
    """struct(millis, nanos) of an epoch number by its digit count; NULL for any other length."""
    text = col.cast("string")
    n, size = col.cast("long"), F.length(text)

    def part(units: int, digits: int) -> Column:
        rest = F.substring(text, SECOND_DIGITS + 1, digits - SECOND_DIGITS).try_cast("long") * units
        return F.coalesce(rest, F.lit(0)).cast("long")

    def pair(millis: Column, nanos: Column) -> Column:
        return F.struct(millis.cast("long").alias("millis"), nanos.alias("nanos"))

    return (
        F.when(size == SECOND_DIGITS, pair(n * 1000, F.lit(0).cast("long")))
        .when(size == MILLI_DIGITS, pair(n, part(1_000_000, MILLI_DIGITS)))
        .when(size == MICRO_DIGITS, pair(F.call_function("div", n, F.lit(1000)), part(1000, MICRO_DIGITS)))
        .when(size == NANO_DIGITS, pair(F.call_function("div", n, F.lit(1_000_000)), part(1, NANO_DIGITS)))
    )


def nanos_text(col: Column, width: int = 29) -> Column:
    """Time text right-padded with zeros to nanosecond width."""
    return F.rpad(col, width, "0")


def location_millis(col: Column, type_name: str, tz: str = "GMT+8") -> Column:
    """Start location as epoch-millisecond text; blank or numeric text passes unchanged."""
    from cdcflow.functions.types import wall_millis

    plain = (F.trim(col) == "") | col.rlike(r"^[0-9]+$")
    if type_name.upper() not in ("TIMESTAMP", "DATE"):
        return col
    text = F.trim(col)
    if type_name.upper() == "TIMESTAMP":
        wall = text.try_cast("timestamp_ntz")
    else:
        wall = parse_time(F.regexp_replace(text, "/", "-"))
    return F.when(plain, col).otherwise(wall_millis(wall, tz).cast("string"))


def time_pattern(col: Column) -> Column:
    """Format pattern of a time text: each run of digits becomes the next letter of y M d H m s S."""
    letters = F.array(*[F.lit(c) for c in "yMdHmsS"])
    # Fixed value: a text whose first four characters are a number starts with a year.
    head_is_year = F.substring(col, 1, 4).rlike(r"^[-+]?\d*$")
    dated = col.rlike("[月/-]")
    skip = (
        F.when(head_is_year, 0).when(dated & col.rlike(r"^\d"), 1).when(dated, 0).otherwise(3)
    )
    runs = F.regexp_extract_all(col, F.lit(r"(\d+|\D+)"), 1)
    lead = F.when(col.rlike(r"^\d"), 0).otherwise(1)

    def letter(run: Column, i: Column) -> Column:
        nth = F.floor((i - lead) / 2) + skip
        return F.when(
            run.rlike(r"^\d"),
            F.when(nth < 7, F.repeat(F.get(letters, nth.cast("int")), F.length(run))).otherwise(F.lit("")),
        ).otherwise(run)

    out = F.array_join(F.transform(runs, letter), "")
    return F.when(F.trim(col) != "", out)


def infer_time_format(df: DataFrame, col: str) -> DataFrame:
    """How often each pattern occurs in a column; the one with the largest ``n`` is its format."""
    return df.groupBy(time_pattern(F.col(col)).alias("pattern")).agg(F.count(F.lit(1)).alias("n")).where(
        F.col("pattern").isNotNull()
    )
