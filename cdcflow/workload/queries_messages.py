"""Queries over messages, records, dirty rows and counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from cdcflow.functions import text
from cdcflow.operators.dirty import (
    dirty_lines, duplicate_keys, error_category, error_counts, error_limit_verdict, failure_runs, split_dirty, to_typed,
)
from cdcflow.operators.filters import filter_blank, filter_empty_events
from cdcflow.operators.metrics import channel_metrics, metrics_long, rate, rate_limit_plan, read_metrics, write_metrics
from cdcflow.operators.positions import plan_slices
from cdcflow.operators.records import json_leaves, decode_messages, to_message_records
from cdcflow.operators.redo import redo_from_message
from cdcflow.sources.messages import next_offsets, topic_scan
from cdcflow.sources.synthetic import constant, synthetic_rows
from cdcflow.workload import texts as X
from cdcflow.workload.queries_scalar import INT_RULE, NUM_RULE
from cdcflow.workload.registry import query, table

MSG = X.MESSAGE_SQL
ALL_TOPICS = ("view", "signup", "click", "error", "purchase")


@query(
    "message_scan",
    f"""with {MSG} select topic, cast(part as int) "partition", pos "offset", v "value" from msg
        where topic in ('view','click','error') and v is not null and trim(v) <> ''""",
)
def _scan(spark, sf_dir):
    out = topic_scan(X.messages(spark, sf_dir), ["view", "click", "error"], ignore_blank=True)
    return out.select("topic", "partition", "offset", "value")


@query(
    "next_offsets",
    f"""with {MSG} select topic, cast(part as int) "partition", max(pos) + 1 next_offset from msg group by all""",
)
def _offsets(spark, sf_dir):
    return next_offsets(X.messages(spark, sf_dir))


@query("filter_blank", f"""with {MSG} select pos "offset", v "value" from msg where v is not null and trim(v) <> ''""")
def _blank(spark, sf_dir):
    return filter_blank(X.messages(spark, sf_dir), "value", ignore_blank=True).select("offset", "value")


@query(
    "decode_json",
    f"""with {MSG} select pos "offset", case when v like '{{%' then cast(v::json->>'event_id' as bigint) end event_id, v::json->>'event_type' event_type,
        v::json->>'props' props, v message, case when v like '{{%' then 5 else 1 end n_fields
        from (select pos, v, case when v like '{{%' then v else '{{}}' end j from msg where v is not null) """.replace("v::json", "j::json"),
)
def _decode_json(spark, sf_dir):
    decoded = filter_empty_events(decode_messages(filter_blank(X.messages(spark, sf_dir)), "json"))
    e = F.col("event")
    return decoded.select(
        "offset",
        e["event_id"].cast("long").alias("event_id"),
        e["event_type"].alias("event_type"),
        e["props"].alias("props"),
        e["message"].alias("message"),
        F.size(e).alias("n_fields"),
    )


@query("decode_plain", f"""with {MSG} select pos "offset", '{{message=' || v || '}}' event from msg where v is not null""")
def _decode_plain(spark, sf_dir):
    decoded = decode_messages(filter_blank(X.messages(spark, sf_dir)), "plain")
    return decoded.select("offset", text.map_text(F.col("event")).alias("event"))


@query(
    "json_value_types",
    f"""with {MSG} select kind, count(*) n from (select unnest([
          case when v is null or v not like '{{%' then null else 'object' end,
          'int', 'object', 'string', case when cast(value as varchar) like '%.%' then 'double' else 'int' end,
          case when user_id + 3000000000 > 2147483647 then 'long' else 'int' end]) kind from msg join events on pos = event_id) group by 1""",
)
def _json_types(spark, sf_dir):
    rows = X.messages(spark, sf_dir).select(F.col("offset").alias("event_id"), "value").withColumnRenamed("value", "v")
    src = rows.join(X.events(spark, sf_dir), "event_id").select(
        F.explode(
            F.array(
                F.col("v"),
                F.col("user_id").cast("string"),
                F.col("props"),
                F.concat(F.lit('"'), F.col("event_type"), F.lit('"')),
                F.col("value").cast("string"),
                (F.col("user_id") + F.lit(3_000_000_000)).cast("string"),
            )
        ).alias("v")
    )
    return src.groupBy(text.json_value_type(F.col("v")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "topic_route",
    """select event_id, 'log-' || event_type || '-' || strftime(ts + interval 8 hour, '%Y.%m.%d') || '-' || cast(epoch_us(ts)//1000 as varchar) || '-%{none}' topic,
       event_type || '/' || strftime(date_trunc('milliseconds', ts), '%H%M') iso from events""",
)
def _route(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    event = F.create_map(
        F.lit("event_type"), F.col("event_type"), F.lit("@timestamp"), F.unix_millis(ts).cast("string")
    )
    iso = F.create_map(
        F.lit("event_type"), F.col("event_type"), F.lit("@timestamp"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    )
    return X.events(spark, sf_dir).select(
        "event_id",
        text.fill_template(event, "log-%{event_type}-%{+yyyy.MM.dd}-%{+s}-%{none}", "GMT+8").alias("topic"),
        text.fill_template(iso, "%{event_type}/%{+HHmm}", "UTC").alias("iso"),
    )


@query(
    "kafka_records",
    """select event_id, 'out-' || event_type topic, '{id=' || cast(event_id as varchar) || ', event_type=' || event_type || ', who=' || coalesce(cast(nullif(user_id,7) as varchar),'null') || '}' "key",
       '{"id":"' || cast(event_id as varchar) || '","event_type":"' || event_type || '","who":"' || coalesce(cast(nullif(user_id,7) as varchar),'null') || '"}' "value" from events""",
)
def _records(spark, sf_dir):
    src = X.events(spark, sf_dir).select(
        "event_id", F.col("event_id").alias("id"), "event_type", F.nullif(F.col("user_id"), F.lit(7)).alias("who")
    )
    return to_message_records(src, "out-%{event_type}", ["id", "event_type", "who"], keep=["event_id"]).select(
        "event_id", "topic", "key", "value"
    )


@query(
    "delimited_print",
    """select cast(event_id as varchar) || '|' || coalesce(cast(nullif(user_id,7) as varchar),'null') || '|[' || event_type || ', ' || props || ']' line from events""",
)
def _print(spark, sf_dir):
    src = X.events(spark, sf_dir).select(
        "event_id", F.nullif(F.col("user_id"), F.lit(7)).alias("who"), F.array("event_type", "props").alias("pair")
    )
    return src.select(text.render_row(src, "|").alias("line"))


@query(
    "redo_from_message",
    """select event_id, 'update "T" set "V" = ''' || event_type || ''' where "K" = ' || cast(user_id as varchar) sql_map,
       'update "T" set "V" = ''' || event_type || ''' where "K" = ' || cast(user_id as varchar) sql_json from events""",
)
def _redo_message(spark, sf_dir):
    sql = F.concat(
        F.lit('update "T" set "V" = \''), F.col("event_type"), F.lit("' where \"K\" = "), F.col("user_id").cast("string")
    )
    src = X.events(spark, sf_dir).select(
        "event_id",
        F.concat(F.lit("{SCN="), F.col("event_id"), F.lit(", SQL_REDO="), sql, F.lit(", OPERATION=UPDATE}")).alias("m"),
        F.to_json(F.struct(F.col("event_id").alias("SCN"), sql.alias("SQL_REDO"), F.lit("UPDATE").alias("OPERATION"))).alias("j"),
    )
    return src.select(
        "event_id",
        redo_from_message(F.col("m"), "map").alias("sql_map"),
        redo_from_message(F.col("j"), "json").alias("sql_json"),
    )


# ---- dirty rows -------------------------------------------------------------------------------

CHECKED = f"""with e as (select *, {X.NUMBER_TEXT} v from events), p as (select event_id, event_type, v,
  case when {INT_RULE} then try_cast(trim(v) as smallint) end a, case when {NUM_RULE} then try_cast(trim(v) as double) end b from e),
 c as (select *, v is not null and trim(v) <> '' and a is null bad_a, v is not null and trim(v) <> '' and b is null bad_b from p)"""


def _checked(spark, sf_dir):
    src = X.with_text(spark, sf_dir, X.NUMBER_TEXT).select("event_id", "event_type", "v")
    return to_typed(src, [("v", "a", "SMALLINT", None), ("v", "b", "DOUBLE", None)])


@query(
    "dirty_split",
    f"""{CHECKED} select event_id, case when bad_a or bad_b then 'dirty' else 'good' end side, a, b,
        cast(bad_a as int) + cast(bad_b as int) n_errors from c""",
)
def _dirty_split(spark, sf_dir):
    ok, dirty = split_dirty(_checked(spark, sf_dir))
    good = ok.select("event_id", F.lit("good").alias("side"), "a", "b", F.lit(0).alias("n_errors"))
    return good.unionByName(
        dirty.select("event_id", F.lit("dirty").alias("side"), "a", "b", F.size("_errors").alias("n_errors"))
    )


@query(
    "dirty_lines",
    f"""{CHECKED} select '{{"event_id":' || cast(event_id as varchar) || ',"v":"' || v || '"}}' row_text, 'conversion' kind,
        case when bad_a then '"can''t read as SMALLINT: ' || v || '"' else '"can''t read as DOUBLE: ' || v || '"' end message from c where bad_a or bad_b""",
)
def _dirty_lines(spark, sf_dir):
    _, dirty = split_dirty(_checked(spark, sf_dir))
    parts = F.split(F.col("value"), "\u0001")
    return dirty_lines(dirty, ["event_id", "v"]).select(
        parts[0].alias("row_text"), parts[1].alias("kind"), parts[2].alias("message")
    )


@query(
    "error_category",
    f"""with e as (select *, {X.ERROR_TEXT} v from events) select event_type, case event_type when 'error' then 'npe' when 'click' then 'duplicate'
        when 'view' then 'duplicate' else 'conversion' end category, count(*) n from e group by all""",
)
def _category(spark, sf_dir):
    src = X.events(spark, sf_dir)
    message = (
        F.when(F.col("event_type") == "error", F.lit("java.lang.NullPointerException"))
        .when(F.col("event_type") == "click", F.lit("ORA-00001: Unique Constraint violated"))
        .when(F.col("event_type") == "view", F.concat(F.lit("Duplicate entry '"), "user_id", F.lit("' for key")))
        .when(F.col("event_type") == "signup", F.concat(F.lit("bad value "), "props"))
    )
    return src.groupBy("event_type", error_category(message).alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "duplicate_keys",
    "select l_orderkey, l_linenumber, count(*) n from lineitem group by all having count(*) > 1",
)
def _duplicates(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "error_limit_verdict",
    f"""{CHECKED}, n as (select count(*) num_read, count(*) filter (bad_a or bad_b) errors from c)
        select num_read, errors, label, case label when 'records' then errors <= 100 when 'ratio' then errors / num_read <= 0.5 when 'default' then errors <= 0 else true end ok
        from n, (values ('records'),('ratio'),('default'),('off')) l(label)""",
)
def _limits(spark, sf_dir):
    counts = error_counts(_checked(spark, sf_dir))
    limits = {"records": (100, None), "ratio": (None, 50.0), "default": (0, 0.0), "off": (-1, -1)}
    out = None
    for label, (record, percentage) in limits.items():
        one = error_limit_verdict(counts, record, percentage).withColumn("label", F.lit(label))
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "write_metrics",
    f"""{CHECKED} select count(*) filter (not (bad_a or bad_b)) num_write, cast(sum(length(cast(event_id as varchar) || ',' || event_type)) filter (not (bad_a or bad_b)) as bigint) byte_write,
        count(*) filter (bad_a or bad_b) n_errors, 0 null_errors, 0 duplicate_errors, count(*) filter (bad_a or bad_b) conversion_errors, 0 other_errors from c""",
)
def _write_metrics(spark, sf_dir):
    return write_metrics(_checked(spark, sf_dir), ["event_id", "event_type"])


@query(
    "metrics_long",
    f"""{CHECKED}, m as (select count(*) filter (not (bad_a or bad_b)) num_write, cast(sum(length(cast(event_id as varchar) || ',' || event_type)) filter (not (bad_a or bad_b)) as bigint) byte_write,
        count(*) filter (bad_a or bad_b) n_errors from c)
        select 'num_write' "name", num_write "value" from m union all select 'byte_write', byte_write from m union all select 'n_errors', n_errors from m
        union all select 'conversion_errors', n_errors from m union all select unnest(['null_errors','duplicate_errors','other_errors']), 0""",
)
def _metrics_long(spark, sf_dir):
    return metrics_long(write_metrics(_checked(spark, sf_dir), ["event_id", "event_type"]))


@query(
    "read_metrics",
    "select count(*) num_read, cast(sum(length(cast(event_id as varchar)) + length(event_type) + length(props) + 2) as bigint) byte_read from events",
)
def _read_metrics(spark, sf_dir):
    return read_metrics(X.events(spark, sf_dir).select("event_id", "event_type", "props"))


@query(
    "channel_metrics",
    """select coalesce(cast(user_id % 4 as varchar), 'all') channel, count(*) num_read, cast(sum(length(props)) as bigint) byte_read, max(event_id) last_position
       from events group by rollup (user_id % 4)""",
)
def _channels(spark, sf_dir):
    src = X.events(spark, sf_dir).withColumn("channel", F.expr("user_id % 4"))
    return channel_metrics(src, "channel", F.length("props"), "event_id")


@query(
    "rate_20s",
    """with c as (select event_type channel, epoch_us(ts)//5000000*5 at0, count(*) n from events group by all),
       s as (select channel, at0 + lag*5 "at", n from c, (values (0),(1),(2),(3)) l(lag))
       select channel, "at", cast(sum(n) as bigint) rows_in_span, sum(n)/20.0 rate from s group by channel, "at\"""",
)
def _rate(spark, sf_dir):
    return rate(X.events(spark, sf_dir).withColumnRenamed("event_type", "channel"), "ts", "channel")


@query(
    "rate_limit_plan",
    """with s as (select cast(user_id % 4 as varchar) channel, count(*) num_read, cast(sum(length(props)) as bigint) byte_read from events group by 1)
       select channel, num_read, byte_read, case when sum(num_read) over () > 1000 then round(1000000.0 / (sum(byte_read) over () / sum(num_read) over ()) * (num_read / sum(num_read) over ()), 3) else 1000 end rows_per_second from s""",
)
def _limit_plan(spark, sf_dir):
    src = X.events(spark, sf_dir).select(F.expr("cast(user_id % 4 as string)").alias("channel"), "props")
    stats = read_metrics(src, ["props"], by=["channel"])
    plan = rate_limit_plan(stats, 1_000_000.0)
    return plan.withColumn("rows_per_second", F.round("rows_per_second", 3))


@query(
    "failure_runs",
    """with r as (select user_id % 4 channel, event_id, event_type in ('error','click','view') failed, sum(case when event_type in ('error','click','view') then 0 else 1 end) over (partition by user_id % 4 order by event_id rows unbounded preceding) run from events)
       select channel, min(event_id) "first", max(event_id) "last", count(*) length from r where failed group by channel, run having count(*) >= 3""",
)
def _failures(spark, sf_dir):
    src = X.events(spark, sf_dir).withColumn("channel", F.expr("user_id % 4"))
    failed = F.col("event_type").isin("error", "click", "view")
    return failure_runs(src, "channel", "event_id", failed, 3, slices=plan_slices(src, "event_id", ["channel"]))


# ---- generated rows ---------------------------------------------------------------------------


@query(
    "synthetic_rows",
    """with s as (select dense_rank() over (order by event_type) - 1 slice, count(*) n from events group by event_type)
       select cast(slice as int) slice, n rows_made, 'west' area, 0 bad_int, n distinct_ids, n in_range from s""",
)
def _synthetic(spark, sf_dir):
    # One slice per event type, as many rows as it has events: the row counts are job settings.
    counts = X.events(spark, sf_dir).groupBy("event_type").count().orderBy("event_type").collect()
    rows = synthetic_rows(
        spark,
        [{"name": "id", "type": "id"}, {"name": "area", "type": "string", "value": "west"},
         {"name": "bad", "type": "int", "value": "x1"}, {"name": "score", "type": "int"}],
        [r["count"] for r in counts],
        seed=7,
    )
    return rows.groupBy(F.col("_channel").alias("slice"), "area").agg(
        F.count(F.lit(1)).alias("rows_made"),
        F.max("bad").alias("bad_int"),
        F.count_distinct("id").alias("distinct_ids"),
        F.count(F.when(F.col("score").isNotNull(), 1)).alias("in_range"),
    )


@query(
    "synthetic_constants",
    f"""with e as (select *, {X.NUMBER_TEXT} v from events) select event_id, coalesce(case when regexp_matches(v,'^[+-]?[0-9]+$') then try_cast(v as int) end, 0) as_int,
        coalesce(case when regexp_matches(v,'^[+-]?[0-9]+$') then try_cast(v as bigint) end, 0) as_long,
        coalesce(case when regexp_matches(v, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$') then try_cast(v as double) end, 0) as_double, nullif(v, 'null') as_text from e""",
)
def _constants(spark, sf_dir):
    v = F.col("v")
    return X.with_text(spark, sf_dir, X.NUMBER_TEXT).select(
        "event_id",
        F.coalesce(constant(v, "int"), F.lit(0)).alias("as_int"),
        F.coalesce(constant(v, "long"), F.lit(0)).cast("long").alias("as_long"),
        F.coalesce(constant(v, "double"), F.lit(0.0)).alias("as_double"),
        constant(v, "string").alias("as_text"),
    )


LEAVES = "path, kind, as_int, as_long, as_double, as_string, as_boolean".split(", ")


@query(
    "json_typed_values",
    """with e as (select event_id, event_type, cast(user_id as bigint) * 1000003 big, event_id % 3 = 0 flag, event_id + 0.5 half from events),
       v as (select event_id, '$[''id'']' path, event_id n, cast(null as double) d, cast(null as varchar) s, cast(null as boolean) b, cast(null as varchar) k from e
        union all select event_id, '$[''deep''][0][''big'']', big, null, null, null, null from e
        union all select event_id, '$[''deep''][0][''half'']', null, cast(half as double), null, null, null from e
        union all select event_id, '$[''deep''][1]', null, null, event_type, null, null from e
        union all select event_id, '$[''deep''][2][0]', null, null, null, flag, null from e
        union all select event_id, '$[''deep''][2][1]', null, null, null, null, 'null' from e
        union all select event_id, '$[''none'']', null, null, null, null, 'array' from e)
       select event_id, path, coalesce(k, case when d is not null then 'double' when s is not null then 'string' when b is not null then 'boolean' when n between -2147483648 and 2147483647 then 'int' else 'long' end) kind,
        case when n between -2147483648 and 2147483647 then cast(n as int) end as_int, case when n not between -2147483648 and 2147483647 then n end as_long, d as_double, s as_string, b as_boolean from v""",
)
def _typed_values(spark, sf_dir):
    """Every value of nested JSON texts made from all events, with its type."""
    big, half = F.col("user_id").cast("long") * 1000003, F.concat(F.col("event_id").cast("string"), F.lit(".5"))
    text = F.concat(
        F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"deep":[{"big":'), big.cast("string"), F.lit(',"half":'), half, F.lit('},"'), F.col("event_type"),
        F.lit('",['), (F.col("event_id") % 3 == 0).cast("string"), F.lit(',null]],"none":[]}'),
    )
    return json_leaves(X.events(spark, sf_dir).withColumn("text", text), "text", ["event_id"]).select("event_id", *LEAVES)
