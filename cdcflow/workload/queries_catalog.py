"""Queries over log segments, catalogs, positions and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from cdcflow.operators import offsets as O
from cdcflow.operators import segments as S
from cdcflow.operators.dictionary import column_dictionary, replica_identity, type_oids
from cdcflow.operators.positions import plan_slices
from cdcflow.operators.splits import assign_split, even_segments
from cdcflow.workload import catalog as C
from cdcflow.workload import texts as X
from cdcflow.workload.catalog import COLUMNS_SQL, SEGMENT_SQL
from cdcflow.workload.registry import query, table

SEG = f"with {SEGMENT_SQL}"


def _since(spark, sf_dir):
    return S.segments_since(*[f(spark, sf_dir) for f in (C.archived, C.online, C.members, C.threads, C.positions)])


@query("segments_since", f"{SEG} select * from since")
def _segments(spark, sf_dir):
    return _since(spark, sf_dir)


@query(
    "segments_unregistered",
    f"""{SEG} select source, "name" from since except select source, "name" from seg join part on p_partkey = "sequence" where p_size < 25""",
)
def _unregistered(spark, sf_dir):
    part = table(spark, sf_dir, "part").where("p_size < 25").select(F.col("p_partkey").alias("sequence"))
    known = C.segments(spark, sf_dir).join(part, "sequence", "left_semi")
    return S.unregistered(_since(spark, sf_dir), known)


@query(
    "segments_listagg",
    f"""{SEG}, n as (select *, (row_number() over (partition by source, thread order by "sequence", "name") - 1) // 100 line from since)
        select source, thread, line, string_agg("name", ' ' order by "sequence", "name") "names" from n group by all""",
)
def _listagg(spark, sf_dir):
    found = _since(spark, sf_dir)
    return S.segment_list(found, slices=plan_slices(found, "sequence", ["source", "thread"]))


@query(
    "first_change_for_scn",
    f"""{SEG} select source, min(first_change) first_change from (select source, first_change, next_change from archived union select source, first_change, next_change from online) s
        join positions using (source) where scn between first_change and next_change group by 1""",
)
def _first_change(spark, sf_dir):
    return S.first_change_for(C.positions(spark, sf_dir), C.archived(spark, sf_dir), C.online(spark, sf_dir))


@query(
    "segments_of_changes",
    f"""{SEG}, c as (select l_orderkey, l_linenumber, p_brand source, cast(l_partkey*100 + l_linenumber*17 % 230 - 40 as bigint) scn from lineitem join part on p_partkey = l_suppkey),
        wide as (select source, 0 thread, -1 "sequence", min(first_change) first_change, min(first_change) + 5000 next_change, source || '/all' "name" from seg group by 1)
        select l_orderkey, l_linenumber, c.scn, s."sequence", s."name" from c join (select source, "sequence", first_change, next_change, "name" from archived
          union all select source, "sequence", first_change, next_change, "name" from wide) s on s.source = c.source and c.scn >= s.first_change and c.scn < s.next_change""",
)
def _segments_of_changes(spark, sf_dir):
    """The segments that hold each change: short archived ones, and a long one per source over the oldest."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_suppkey"), F.col("p_brand").alias("source"))
    scn = (F.col("l_partkey") * 100 + F.col("l_linenumber") * 17 % 230 - 40).cast("long")
    changes = table(spark, sf_dir, "lineitem").join(part, "l_suppkey").select("l_orderkey", "l_linenumber", "source", scn.alias("scn"))
    oldest = C.segments(spark, sf_dir).groupBy("source").agg(F.min("first_change").alias("first_change"))
    wide = oldest.select("source", F.lit(-1).cast("long").alias("sequence"), "first_change", (F.col("first_change") + 5000).alias("next_change"), F.concat("source", F.lit("/all")).alias("name"))
    spans = C.archived(spark, sf_dir).select("source", F.col("sequence").cast("long").alias("sequence"), "first_change", "next_change", "name").unionByName(wide)
    return S.locate(changes, spans, ["source"], "scn").select("l_orderkey", "l_linenumber", "scn", "sequence", "name")


@query("low_scn", "select 'Brand#' || cast(s_nationkey+1 as varchar) source, min(s_suppkey*1000+500) current_scn from supplier group by 1")
def _low(spark, sf_dir):
    return S.low_scn(C.instances(spark, sf_dir))


@query(
    "column_dictionary",
    f"""with {COLUMNS_SQL} select "owner", table_name, column_name, column_id, nullable, data_type, coalesce(data_precision, data_length) data_length,
        coalesce(data_scale,0) data_scale, coalesce(data_precision,0) data_precision, cast(column_name = 'ID' and p_type <> 'PROMO' as int) pk_column,
        cast(column_name = 'NAME' and p_type in ('SMALL','LARGE') as int) uq_column from cols where hidden_column = 'NO'""",
)
def _dictionary(spark, sf_dir):
    return column_dictionary(C.catalog_columns(spark, sf_dir), *C.constraints(spark, sf_dir), *C.indexes(spark, sf_dir))


@query(
    "replica_identity",
    """select case when p_brand = 'Brand#3' then 'pg_toast' else p_brand end "schema", 'T' || cast(p_partkey as varchar) "table",
       case p_type when 'SMALL' then 'nothing' when 'LARGE' then 'default' when 'MEDIUM' then 'index' when 'PROMO' then 'full' when 'ECONOMY' then 'full' else 'unknown' end "identity",
       p_type not in ('PROMO','ECONOMY') needs_full from part""",
)
def _identity(spark, sf_dir):
    return replica_identity(C.classes(spark, sf_dir), C.namespaces(spark, sf_dir))


@query(
    "type_oids",
    "select p_partkey + 16384 oid, 'ty_T' || cast(p_partkey as varchar) \"type\" from part where p_type <> 'PROMO' and p_brand <> 'Brand#3'",
)
def _types(spark, sf_dir):
    return type_oids(C.types(spark, sf_dir), C.namespaces(spark, sf_dir))


@query(
    "start_position",
    """with cur as (select s_nationkey+1 b, min(s_suppkey*1000+500) cur, min(s_suppkey)*1000 req from supplier group by 1),
       saved as (select cast(regexp_extract(p_brand, '(\\d+)', 1) as int) b, max(p_partkey) saved from part group by 1)
       select 'Brand#' || cast(b as varchar) source, coalesce(nullif(case when b % 2 = 0 then req else 0 end, 0), saved, cur) "start",
       case when nullif(case when b % 2 = 0 then req else 0 end, 0) is not null then 'requested' when saved is not null then 'saved' else 'current' end how from cur left join saved using (b)""",
)
def _start(spark, sf_dir):
    # Even sources ask for a position; every part saves one under its brand, which is the name of some sources.
    even = F.regexp_extract("source", r"(\d+)", 1).cast("int") % 2 == 0
    asked = C.positions(spark, sf_dir).select("source", F.when(even, F.col("scn")).otherwise(F.lit(0)).alias("requested"))
    saved = table(spark, sf_dir, "part").select(F.col("p_brand").alias("source"), F.col("p_partkey").alias("position"))
    return O.start_position(asked, saved, S.low_scn(C.instances(spark, sf_dir)))


@query(
    "range_split_counts",
    """with e as (select min(o_orderkey) lo, max(o_orderkey) hi from orders), p as (select n, lo, hi, (hi-lo)//n step, (hi-lo)%n rest from e, (values (1),(7),(16)) v(n)),
       b as (select n, i, lo + i*step + least(i, rest) a, lo + (i+1)*step + least(i+1, rest) z from p, range(16) r(i) where i < n)
       select n parts, i split_id, count(*) "rows", min(o_orderkey) lo, max(o_orderkey) hi from b join orders on o_orderkey >= a and (o_orderkey < z or (i = n-1 and o_orderkey = z)) group by 1, 2""",
)
def _splits(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    out = None
    for n in (1, 7, 16):
        part = (
            assign_split(orders, "o_orderkey", n)
            .groupBy(F.lit(n).alias("parts"), "split_id")
            .agg(F.count(F.lit(1)).alias("rows"), F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "even_segments",
    """with r as (select event_id, row_number() over (order by event_id) - 1 i, count(*) over () // 7 size from events)
       select least(i // size, 6) segment, count(*) "rows", min(event_id) lo, max(event_id) hi from r group by 1""",
)
def _even(spark, sf_dir):
    events = X.events(spark, sf_dir).select("event_id")
    out = even_segments(events, "event_id", 7, slices=plan_slices(events, "event_id"))
    return out.groupBy("segment").agg(F.count(F.lit(1)).alias("rows"), F.min("event_id").alias("lo"), F.max("event_id").alias("hi"))


@query(
    "incremental_scan",
    "select o_orderkey, o_totalprice from orders where o_orderdate > timestamp '1997-06-30 00:00:00'",
)
def _incremental(spark, sf_dir):
    import datetime as dt

    orders = table(spark, sf_dir, "orders")
    last = F.lit(dt.datetime(1997, 6, 30)).cast("timestamp_ntz")
    return O.incremental_scan(orders, "o_orderdate", last).select("o_orderkey", "o_totalprice")


@query(
    "restore_offsets",
    """select md5('job-' || event_type) job, user_id % 4 channel, max(event_id) "position", count(*) "rows" from events group by all""",
)
def _offsets(spark, sf_dir):
    events = X.events(spark, sf_dir).withColumn("channel", F.expr("user_id % 4"))
    job = F.md5(F.concat(F.lit("job-"), "event_type"))
    # Two batches, each leaving its own rows in the offsets table.
    half = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    first = O.offset_rows(events.where(half), job, "channel", "event_id")
    second = O.offset_rows(events.where(~half), job, "channel", "event_id")
    return O.load_offsets(first.unionByName(second))


@query(
    "restore_boundaries",
    """select event_id, coalesce(event_type <> lag(event_type) over (partition by user_id % 4 order by event_id), false) boundary from events""",
)
def _boundaries(spark, sf_dir):
    events = X.events(spark, sf_dir).withColumn("channel", F.expr("user_id % 4"))
    out = O.restore_boundaries(events, "event_type", "channel", "event_id", slices=plan_slices(events, "event_id", ["channel"]))
    return out.select("event_id", "boundary")
