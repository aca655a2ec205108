"""Queries over scalar functions, run on text derived from every event."""

from __future__ import annotations

from pyspark.sql import functions as F

from cdcflow.functions import text, times, types
from cdcflow.operators.dirty import split_dirty, to_typed
from cdcflow.operators.ids import snowflake_ids
from cdcflow.operators.positions import plan_slices
from cdcflow.operators.records import project
from cdcflow.workload import texts as X
from cdcflow.workload.registry import query, table

INT_RULE = "regexp_matches(trim(v), '^[+-]?[0-9]+$')"
NUM_RULE = "regexp_matches(trim(v), '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$')"


def _src(expr: str) -> str:
    return f"with e as (select *, {expr} v from events)"


@query(
    "column_spec_project",
    """select event_id id, cast(ts as date) "day", event_type kind, strftime(ts, '%Y%m%d %H') "hour", 'fixed' val_fixed,
       cast(7 as bigint) seven, cast(null as varchar) nothing, cast(user_id as varchar) "who" from events""",
)
def _column_spec(spark, sf_dir):
    events = X.events(spark, sf_dir)
    out = project(
        events,
        [
            {"name": "event_id"},
            {"name": "ts", "type": "DATE"},
            {"index": 3},
            {"name": "hour", "index": 1, "type": "STRING", "format": "yyyyMMdd HH"},
            {"value": "fixed", "splitter": ",", "isPart": False},
            {"name": "seven", "value": "7", "type": "BIGINT"},
            {"name": "nothing", "value": "null"},
            {"name": "user_id", "type": "STRING"},
        ],
        restore_column="event_id",
    )
    names = {"event_id": "id", "ts": "day", "3": "kind", "user_id": "who"}
    return out.withColumnsRenamed(names)


NORMAL = """case when upper(split_part(v,'(',1)) like '%TIMESTAMP%' then 'TIMESTAMP'
 when trim(replace(upper(split_part(v,'(',1)),'UNSIGNED','')) in ('INT','BIGINT','VARCHAR','DECIMAL','DATETIME','INT64')
 then trim(replace(upper(split_part(v,'(',1)),'UNSIGNED','')) end"""


@query(
    "normalize_types",
    f"{_src(X.TYPE_TEXT)} select event_id, {NORMAL} strict_name, coalesce({NORMAL},'STRING') name from e",
)
def _normalize(spark, sf_dir):
    return X.with_text(spark, sf_dir, X.TYPE_TEXT).select(
        "event_id",
        types.normalize_type(F.col("v"), strict=True).alias("strict_name"),
        types.normalize_type(F.col("v")).alias("name"),
    )


@query(
    "type_classes",
    f"""{_src(X.TYPE_TEXT)} select case when n in ('TIMESTAMP','DATETIME') then 'time' when n in ('INT','BIGINT','DECIMAL') then 'number'
        when n = 'INT64' then 'other' else 'string' end class, count(*) n
        from (select coalesce({NORMAL},'STRING') n from e) group by 1""",
)
def _classes(spark, sf_dir):
    return (
        X.with_text(spark, sf_dir, X.TYPE_TEXT)
        .groupBy(types.type_class(F.col("v")).alias("class"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "decimal_info",
    f"""{_src(X.TYPE_TEXT)} select event_id, case when v = 'decimal' then 38 when v like 'decimal(%' then cast(regexp_extract(v,'\\((\\d+)',1) as int) end "precision",
        case when v = 'decimal' then 18 when v like 'decimal(%' then cast(regexp_extract(v,', (\\d+)\\)',1) as int) end "scale" from e""",
)
def _decimal(spark, sf_dir):
    info = types.decimal_info(F.col("v"))
    return X.with_text(spark, sf_dir, X.TYPE_TEXT).select(
        "event_id", info["precision"].alias("precision"), info["scale"].alias("scale")
    )


@query(
    "string_to_typed",
    f"""{_src(X.NUMBER_TEXT)} select event_id,
        case when {INT_RULE} then try_cast(trim(v) as tinyint) end as_tinyint,
        case when {INT_RULE} then try_cast(trim(v) as smallint) end as_smallint,
        case when {INT_RULE} then try_cast(trim(v) as int) end as_int,
        case when {INT_RULE} then try_cast(trim(v) as bigint) end as_bigint,
        case when {NUM_RULE} then try_cast(trim(v) as double) end as_double,
        case when v <> '' then lower(trim(v)) = 'true' end as_boolean,
        v as_string from e""",
)
def _typed(spark, sf_dir):
    kinds = ("TINYINT", "SMALLINT", "INT", "BIGINT", "DOUBLE", "BOOLEAN", "STRING")
    return X.with_text(spark, sf_dir, X.NUMBER_TEXT).select(
        "event_id", *[types.text_to(F.col("v"), k).alias(f"as_{k.lower()}") for k in kinds]
    )


@query(
    "string_to_typed_dirty",
    f"""{_src(X.NUMBER_TEXT)}, p as (select event_id, v, case when {INT_RULE} then try_cast(trim(v) as tinyint) end a,
          case when {INT_RULE} then try_cast(trim(v) as bigint) end b, case when {NUM_RULE} then try_cast(trim(v) as double) end c from e),
        bad as (select event_id, 'a' col, v, a is null f from p union all select event_id, 'b', v, b is null from p
          union all select event_id, 'c', v, c is null from p)
        select event_id, col, 'conversion' "type", v from bad where f and v is not null and trim(v) <> ''""",
)
def _typed_dirty(spark, sf_dir):
    typed = to_typed(
        X.with_text(spark, sf_dir, X.NUMBER_TEXT),
        [("v", "a", "TINYINT", None), ("v", "b", "BIGINT", None), ("v", "c", "DOUBLE", None)],
    )
    _, dirty = split_dirty(typed)
    return dirty.select("event_id", "v", F.explode("_errors").alias("e")).select("event_id", "v", "e.col", "e.type")


@query(
    "typed_to_string",
    """select cast(event_id as varchar) id, cast(epoch_us(ts)//1000 - 28800000 as varchar) ts_long, strftime(ts,'%Y-%m-%d %H:%M:%S') ts_text,
       strftime(ts,'%Y-%m-%d') ts_date, cast(value as varchar) as_double, coalesce(cast(nullif(user_id, 7) as varchar),'') opt,
       cast(event_type = 'true' as varchar) flag from events""",
)
def _to_text(spark, sf_dir):
    ts = F.col("ts")
    return X.events(spark, sf_dir).select(
        types.value_to_text(F.col("event_id"), "BIGINT", "bigint").alias("id"),
        types.value_to_text(ts, "LONG", "timestamp_ntz").alias("ts_long"),
        types.value_to_text(ts, "STRING", "timestamp_ntz").alias("ts_text"),
        types.value_to_text(ts, "DATE", "timestamp_ntz").alias("ts_date"),
        types.value_to_text(F.col("value"), "DOUBLE", "double").alias("as_double"),
        types.value_to_text(F.nullif(F.col("user_id"), F.lit(7)), "INT", "bigint").alias("opt"),
        types.value_to_text(F.col("event_type"), "BOOLEAN", "string").alias("flag"),
    )


@query(
    "row_delimited",
    """select event_id, cast(event_id as varchar) || '|' || strftime(ts,'%Y-%m-%d %H:%M:%S') || '|' ||
       coalesce(cast(nullif(user_id,7) as varchar),'') || '|' || event_type line from events""",
)
def _row_delimited(spark, sf_dir):
    cols = [
        types.value_to_text(F.col("event_id"), "BIGINT", "bigint"),
        types.value_to_text(F.col("ts"), "DATETIME", "timestamp_ntz"),
        types.value_to_text(F.nullif(F.col("user_id"), F.lit(7)), "INT", "bigint"),
        types.value_to_text(F.col("event_type"), "STRING", "string"),
    ]
    return X.events(spark, sf_dir).select("event_id", text.row_delimited(cols, "|").alias("line"))


@query(
    "coerce_values",
    f"""{_src(X.NUMBER_TEXT)} select event_id, coalesce(try_cast(v as int) , -1) as_int, coalesce(case when regexp_matches(v,'[.]') then null else try_cast(v as bigint) end, 0) as_long,
        try_cast(v as double) as_double, coalesce(lower(v) = 'true', false) as_bool, cast(trunc(value) as int) from_double,
        coalesce(v, '') as_text, coalesce(try_cast(v as decimal(20,2)), 0.00) as_decimal from
        (select * exclude v, case when regexp_matches(trim(v), '^[+-]?[0-9]+$') or event_id % 8 <> 2 then v end v from e)""",
)
def _coerce(spark, sf_dir):
    src = X.with_text(spark, sf_dir, X.NUMBER_TEXT).withColumn(
        "v", F.when(F.trim(F.col("v")).rlike(types.INTEGER_TEXT) | F.expr("event_id % 8 <> 2"), F.col("v"))
    )
    return src.select(
        "event_id",
        types.coerce(F.col("v"), "int", -1).alias("as_int"),
        types.coerce(F.col("v"), "bigint", 0).alias("as_long"),
        types.coerce(F.col("v"), "double").alias("as_double"),
        types.coerce(F.col("v"), "boolean", False).alias("as_bool"),
        types.coerce(F.col("value"), "int").alias("from_double"),
        types.coerce(F.col("v"), "string", "").alias("as_text"),
        types.coerce(F.col("v"), "decimal(20,2)", 0).alias("as_decimal"),
    )


@query(
    "epoch_to_millis",
    """select event_id, case event_id % 5 when 0 then epoch_us(ts)//1000000*1000 when 4 then epoch_us(ts)//86400000000*86400000 - 28800000
       else epoch_us(ts)//1000 end millis from events""",
)
def _epoch(spark, sf_dir):
    return X.epoch_texts(spark, sf_dir).select("event_id", times.epoch_millis(F.col("v")).alias("millis"))


@query(
    "parse_times",
    f"""select event_id, {X.TIME_SQL} "at", event_id % 9 = 6 bad,
        case when event_id % 9 <> 7 then {X.TIME_SQL} end standard from events""",
)
def _parse(spark, sf_dir):
    custom = times.parse_time(F.col("v"), "yyyy/MM/dd HH:mm:ss")
    return X.time_texts(spark, sf_dir).select(
        "event_id",
        custom.alias("at"),
        times.time_error(F.col("v"), custom).alias("bad"),
        times.parse_time(F.col("v")).alias("standard"),
    )


@query(
    "to_timestamp_any",
    f"""select event_id, case when event_id % 9 <> 7 then {X.TIME_SQL} end from_text, date_trunc('milliseconds', ts) + interval 8 hour from_long,
        ts from_ts, cast(ts as date) to_date, cast(date_trunc('second', ts) + interval 8 hour as date) date_from_int from events""",
)
def _any(spark, sf_dir):
    src = X.time_texts(spark, sf_dir)
    instant = F.col("ts").cast("timestamp")
    return src.select(
        "event_id",
        times.to_timestamp_any(F.col("v"), "string").alias("from_text"),
        times.to_timestamp_any(F.unix_millis(instant), "bigint").alias("from_long"),
        times.to_timestamp_any(F.col("ts"), "timestamp_ntz").alias("from_ts"),
        times.to_date_any(F.col("ts"), "timestamp_ntz").alias("to_date"),
        times.to_date_any(F.unix_seconds(instant).cast("int"), "int").alias("date_from_int"),
    )


@query(
    "format_times",
    """select event_id, strftime(ts,'%Y-%m-%d') d, strftime(ts,'%Y-%m-%d %H:%M:%S') dt, strftime(ts,'%Y') y, strftime(ts,'%H:%M:%S') t,
       strftime(ts + interval 8 hour,'%Y%m%d%H') local_hour from events""",
)
def _format(spark, sf_dir):
    ts = F.col("ts")
    return X.events(spark, sf_dir).select(
        "event_id",
        times.format_time(ts, "date").alias("d"),
        times.format_time(ts, "datetime").alias("dt"),
        times.format_time(ts, "year").alias("y"),
        times.format_time(ts, "time").alias("t"),
        times.format_time(times.millis_to_wall(F.unix_millis(ts.cast("timestamp"))), "yyyyMMddHH").alias("local_hour"),
    )


@query(
    "infer_time_format",
    """with p as (select case event_id % 9 when 0 then 'yyyy-MM-dd HH:mm:ss' when 1 then 'yyyyyyyyyyyyyy' when 2 then 'yyyy-MM-dd'
         when 3 then 'HH:mm:ss' when 4 then 'yyyy' when 5 then 'yyyy-MM-dd HH:mm:ss.SSS'
         when 6 then 'x' || repeat('H', length(cast(event_id as varchar))) when 7 then 'yyyy/MM/dd HH:mm:ss' end pattern from events)
       select pattern, count(*) n from p where pattern is not null group by 1""",
)
def _infer(spark, sf_dir):
    return times.infer_time_format(X.time_texts(spark, sf_dir), "v")


@query(
    "location_to_millis",
    """select event_id, case when event_id % 9 in (0) then cast(epoch_ms(date_trunc('second',ts)) - 28800000 as varchar)
         when event_id % 9 = 2 then cast(epoch_ms(date_trunc('day',ts)) - 28800000 as varchar)
         when event_id % 9 = 5 then cast(epoch_ms(date_trunc('millisecond',ts)) - 28800000 as varchar)
         when event_id % 9 = 8 then '  ' when event_id % 9 = 1 then strftime(ts, '%Y%m%d%H%M%S') when event_id % 9 = 4 then strftime(ts,'%Y') end millis,
       case when event_id % 9 = 8 then '  ' when event_id % 9 = 1 then strftime(ts, '%Y%m%d%H%M%S') when event_id % 9 = 4 then strftime(ts,'%Y')
         when event_id % 9 in (0, 5, 7) then cast(epoch_ms(date_trunc('second',ts)) - 28800000 as varchar)
         when event_id % 9 = 2 then cast(epoch_ms(date_trunc('day',ts)) - 28800000 as varchar)
         when event_id % 9 = 3 then cast(epoch_ms(date_trunc('second',ts)) - epoch_ms(date_trunc('day',ts)) - 28800000 as varchar) end by_date
       from events""",
)
def _location(spark, sf_dir):
    return X.time_texts(spark, sf_dir).select(
        "event_id",
        times.location_millis(F.col("v"), "TIMESTAMP").alias("millis"),
        times.location_millis(F.col("v"), "DATE").alias("by_date"),
    )


@query(
    "epoch_nanos",
    """select event_id, case event_id % 5 when 0 then epoch_us(ts)//1000000*1000 when 1 then epoch_us(ts)//1000 when 2 then epoch_us(ts)//1000 when 3 then epoch_us(ts)//1000 end millis,
       case event_id % 5 when 0 then 0 when 1 then epoch_us(ts)//1000%1000*1000000 when 2 then epoch_us(ts)%1000000*1000 when 3 then epoch_us(ts)%1000000*1000 end nanos,
       rpad(strftime(ts,'%Y-%m-%d %H:%M:%S.') , 29, '0') padded from events""",
)
def _nanos(spark, sf_dir):
    parts = times.epoch_parts(F.col("v").cast("long"))
    padded = times.nanos_text(F.date_format("ts", "yyyy-MM-dd HH:mm:ss."))
    src = X.epoch_texts(spark, sf_dir).join(X.events(spark, sf_dir).select("event_id", "ts"), "event_id")
    return src.select("event_id", parts["millis"].alias("millis"), parts["nanos"].alias("nanos"), padded.alias("padded"))


@query(
    "row_json",
    """select event_id, '{"event_id":' || cast(event_id as varchar) || case when user_id = 7 then '' else ',"who":' || cast(user_id as varchar) end
       || ',"event_type":"' || event_type || '"}' line from events""",
)
def _row_json(spark, sf_dir):
    src = X.events(spark, sf_dir).withColumn("who", F.nullif(F.col("user_id"), F.lit(7)))
    return src.select("event_id", text.row_json(["event_id", "who", "event_type"]).alias("line"))


@query(
    "unquote_identifiers",
    f"""{_src(X.NAME_TEXT)} select event_id, case event_id % 5 when 0 then event_type || '"x' when 1 then event_type when 2 then 'a`' || event_type when 3 then event_type else '"' end name from e""",
)
def _unquote(spark, sf_dir):
    return X.with_text(spark, sf_dir, X.NAME_TEXT).select("event_id", text.unquote(F.col("v")).alias("name"))


@query(
    "unescape_text",
    f"""{_src(X.ESCAPE_TEXT)} select event_id, replace(replace(replace(v, '\\t', chr(9)), '\\r', chr(13)), '\\n', chr(10)) line from e""",
)
def _unescape(spark, sf_dir):
    return X.with_text(spark, sf_dir, X.ESCAPE_TEXT).select("event_id", text.unescape(F.col("v")).alias("line"))


@query(
    "split_quoted",
    f"""select event_id, case event_id % 4 when 0 then event_type || '.x~t' || cast(user_id as varchar) when 1 then 'db~' || event_type || '.y~t'
        when 2 then event_type || '~' || cast(user_id as varchar) else 'a.' || event_type || '~b' end parts from events""",
)
def _split(spark, sf_dir):
    parts = F.array_join(text.split_quoted(F.col("v"), "."), "~")
    return X.with_text(spark, sf_dir, X.QUOTED_NAME).select("event_id", parts.alias("parts"))


@query("hex_decode", "select doc_id, octet_length(encode(text)) n_bytes, md5(text) digest from documents")
def _hex(spark, sf_dir):
    raw = text.hex_bytes(F.hex(F.encode("text", "UTF-8")))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.octet_length(raw).cast("long").alias("n_bytes"), F.md5(raw).alias("digest")
    )


@query("md5_key", "select event_id, md5(event_type || cast(user_id as varchar)) job_key from events")
def _md5(spark, sf_dir):
    return X.events(spark, sf_dir).select(
        "event_id", text.md5_key(F.col("event_type"), F.col("user_id").cast("string")).alias("job_key")
    )


@query(
    "snowflake_ids",
    """with r as (select event_id, epoch_us(ts)//86400000000 ms, user_id % 4 worker,
         row_number() over (partition by user_id % 4 order by epoch_us(ts)//86400000000, event_id) i from events),
       q as (select *, i + max(ms*4096 - i) over (partition by worker order by ms, event_id rows unbounded preceding) tick from r)
       select event_id, (((tick//4096) << 22) | (3 << 17) | (worker << 12) | (tick % 4096)) id from q""",
)
def _snowflake(spark, sf_dir):
    # Whole days stand in for milliseconds, so that a tick really overflows its 4096 numbers.
    src = X.events(spark, sf_dir).select(
        "event_id",
        F.expr("unix_micros(cast(ts as timestamp)) div 86400000000").alias("ms"),
        F.expr("user_id % 4").alias("worker"),
    )
    return snowflake_ids(src, "ms", "worker", 3, "event_id", slices=plan_slices(src, "ms", ["worker"])).select("event_id", "id")
