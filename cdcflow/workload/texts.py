"""Text inputs derived from every row of ``events``: numbers, type names, times, messages.

Each is one SQL expression both engines read; ``spark_sql`` turns the DuckDB text into Spark's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.workload.registry import table


def spark_sql(text: str) -> str:
    return text.replace(" as varchar)", " as string)").replace("//", " div ")


# Numbers as text, with every way to get them wrong.
NUMBER_TEXT = """case event_id % 8 when 0 then cast(user_id as varchar) when 1 then '-' || cast(user_id as varchar)
 when 2 then cast(user_id as varchar) || '.25' when 3 then ' ' || cast(user_id as varchar) || ' ' when 4 then ''
 when 5 then null when 6 then event_type else '99999999' || cast(10000000000 + event_id as varchar) || '999' end"""

TYPE_TEXT = """case event_id % 9 when 0 then 'int' when 1 then 'BIGINT unsigned' when 2 then 'varchar(' || cast(user_id as varchar) || ')'
 when 3 then 'timestamp(6) with time zone' when 4 then 'decimal(' || cast(10 + event_id % 20 as varchar) || ', ' || cast(user_id % 10 as varchar) || ')'
 when 5 then 'Datetime' when 6 then event_type when 7 then 'INT64' else 'decimal' end"""

NAME_TEXT = """case event_id % 5 when 0 then '"' || event_type || '""x"' when 1 then '''' || event_type || '''' when 2 then '`a``' || event_type || '`'
 when 3 then event_type else '"' end"""

ESCAPE_TEXT = """event_type || case event_id % 4 when 0 then '\\t' when 1 then '\\n' || cast(user_id as varchar) when 2 then '\\r\\n' else '-' end || props"""

QUOTED_NAME = """case event_id % 4 when 0 then '[' || event_type || '.x].[t' || cast(user_id as varchar) || ']' when 1 then 'db."' || event_type || '.y".t'
 when 2 then event_type || '.' || cast(user_id as varchar) else '''a.' || event_type || '''.b' end"""

ERROR_TEXT = """case event_type when 'error' then 'java.lang.NullPointerException' when 'click' then 'ORA-00001: Unique Constraint violated'
 when 'view' then 'Duplicate entry ''' || cast(user_id as varchar) || ''' for key' when 'signup' then 'bad value ' || props else null end"""

# The seconds of ``ts``, written in the ways a source may write them.
TIME_CASES = 9


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def with_text(spark: SparkSession, sf_dir: str, expr: str, name: str = "v") -> DataFrame:
    # Backslashes in the SQL text are literal in DuckDB; Spark's parser needs them doubled.
    return events(spark, sf_dir).withColumn(name, F.expr(spark_sql(expr).replace("\\", "\\\\").replace("''''", "\"'\"").replace("'''a.'", "\"'a.\"").replace("'''.b'", "\"'.b\"")))


def time_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, ts, v: one time text per event."""
    ts, form = F.col("ts"), F.col("event_id") % TIME_CASES
    text = (
        F.when(form == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(form == 1, F.date_format(ts, "yyyyMMddHHmmss"))
        .when(form == 2, F.date_format(ts, "yyyy-MM-dd"))
        .when(form == 3, F.date_format(ts, "HH:mm:ss"))
        .when(form == 4, F.date_format(ts, "yyyy"))
        .when(form == 5, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS"))
        .when(form == 6, F.concat(F.lit("x"), F.col("event_id")))
        .when(form == 7, F.date_format(ts, "yyyy/MM/dd HH:mm:ss"))
        .otherwise(F.lit("  "))
    )
    return events(spark, sf_dir).select("event_id", "event_type", "ts", text.alias("v"))


# The wall clock each text stands for.
TIME_SQL = """case event_id % 9 when 0 then date_trunc('second', ts) when 1 then date_trunc('second', ts)
 when 2 then date_trunc('day', ts) when 3 then timestamp '1970-01-01' + (date_trunc('second', ts) - date_trunc('day', ts))
 when 4 then date_trunc('year', ts) when 5 then date_trunc('second', ts) when 7 then date_trunc('second', ts) end"""


def epoch_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, v: the instant of ``ts`` (as UTC) in s, ms, us, ns, or days."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    form = F.col("event_id") % 5
    text = (
        F.when(form == 0, F.expr("unix_micros(cast(ts as timestamp)) div 1000000"))
        .when(form == 1, F.expr("unix_micros(cast(ts as timestamp)) div 1000"))
        .when(form == 2, us)
        .when(form == 3, us * 1000)
        .otherwise(F.expr("unix_micros(cast(ts as timestamp)) div 86400000000"))
    )
    return events(spark, sf_dir).select("event_id", text.cast("string").alias("v"))


# A log topic holding the events: bad JSON, blanks and nulls included.
MESSAGE_SQL = """msg as (select event_type topic, user_id % 4 part, event_id pos, ts,
 case when event_id % 31 = 0 then null when event_id % 29 = 0 then '   ' when event_id % 19 = 0 then 'oops' || cast(event_id as varchar)
 else '{"event_id":' || cast(event_id as varchar) || ',"event_type":"' || event_type || '","user_id":' || cast(user_id as varchar) || ',"props":' || props || '}' end as v
 from events)"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """topic, partition, offset, timestamp, key, value."""
    body = F.concat(
        F.lit('{"event_id":'), F.col("event_id").cast("string"),
        F.lit(',"event_type":"'), F.col("event_type"),
        F.lit('","user_id":'), F.col("user_id").cast("string"),
        F.lit(',"props":'), F.col("props"), F.lit("}"),
    )
    value = (
        F.when(F.expr("event_id % 31 = 0"), F.lit(None).cast("string"))
        .when(F.expr("event_id % 29 = 0"), F.lit("   "))
        .when(F.expr("event_id % 19 = 0"), F.concat(F.lit("oops"), F.col("event_id").cast("string")))
        .otherwise(body)
    )
    return events(spark, sf_dir).select(
        F.col("event_type").alias("topic"),
        F.expr("cast(user_id % 4 as int)").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("key"),
        value.alias("value"),
    )
