"""Queries over captured replication messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from cdcflow.operators.envelope import envelope
from cdcflow.operators.filters import filter_category, filter_lists, filter_tables
from cdcflow.operators.pg9 import pg9_changes
from cdcflow.operators.pgoutput import (
    decode_tuples, messages_since, pg_changes, pg_events, relation_columns, relations, tag_messages, with_relation, with_txn_context,
)
from cdcflow.operators.positions import plan_slices
from cdcflow.workload.changelog import LOG_SQL, changelog
from cdcflow.workload.registry import query
from cdcflow.workload.wirelog import DECODED_SQL, pg9_messages, pg_messages

DEC = f"with {LOG_SQL}, {DECODED_SQL}"
NEW = "case when op <> 'delete' then"
BEFORE_SHOWN = "(sends_old or op = 'delete')"


def show_events(events, *head):
    """Events as plain columns."""
    cols = []
    for side, p in (("before", "b"), ("after", "a")):
        cols += [F.try_element_at(side, F.lit(c)).alias(f"{p}_{c}") for c in ("k", "st", "cents", "note")]
    return events.select(*head, *cols, F.array_join("unchanged", ",").alias("unchanged"), "ok")


def _decoded_sql(before_shown: str, where: str = "true") -> str:
    return f"""{DEC} select 'SALES' "schema", tbl "table", op, lsn, ts, xid, pos,
      case when {before_shown} then cast(bk as varchar) end b_k, case when {before_shown} then bst end b_st,
      case when {before_shown} then cast(bc as varchar) end b_cents, case when {before_shown} and wide then 'née ' || k end b_note,
      cast(ak as varchar) a_k, ast a_st, case when not kept and not absent then cast(ac as varchar) end a_cents,
      case when op <> 'delete' and wide then 'née ' || k end a_note,
      case when kept then 'cents' else '' end unchanged, true ok from dec where {where}"""


HEAD = ("schema", "table", "op", "lsn", "ts", "xid", "pos")


@query(
    "pg_message_kinds",
    f"""with {LOG_SQL} select op kind, count(*) n from dml group by 1 union all select 'begin', count(*) from tx union all select 'commit', count(*) from tx
        union all select 'relation', count(*) filter (t = 0) * 3 + count(*) filter (t = 100) * 3 from tx""",
)
def _kinds(spark, sf_dir):
    return tag_messages(pg_messages(spark, sf_dir)).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query(
    "pg_begin_context",
    f"""{DEC} select pos, op kind, lsn, ts, xid from dec""",
)
def _context(spark, sf_dir):
    tagged = tag_messages(pg_messages(spark, sf_dir))
    out = with_txn_context(tagged, slices=plan_slices(tagged, "pos", ["slot"]))
    return out.where(F.col("kind").isin("insert", "update", "delete")).select("pos", "kind", "lsn", "ts", "xid")


@query(
    "pg_relations",
    f"""with {LOG_SQL}, era as (select t from tx where t in (0, 100)), r as (select unnest([0,1,2]) i)
        select 101+i rel_id, t*1000-4+i rel_pos, 'SALES' "schema", 'ORDERS_' || substr('FOP', cast(i+1 as int), 1) "table", c.idx, c.name, c.oid, c.idx = 0 is_key, c.ty "type"
        from era, r, (values (0,'k',20,'bigint'),(1,'st',1043,'varchar'),(2,'cents',20,'bigint'),(3,'note',25,'text')) c(idx, name, oid, ty)
        where idx < 3 or t >= 100""",
)
def _relations(spark, sf_dir):
    from cdcflow.workload.catalog import type_names

    cols = relation_columns(relations(tag_messages(pg_messages(spark, sf_dir))), type_names(spark, sf_dir))
    return cols.select(
        "rel_id", "rel_pos", "schema", "table", "idx", "name", "oid", "is_key", "type"
    )


@query(
    "pg_relation_asof",
    f"""{DEC} select pos, 100 + strpos('FOP', tag) rel_id, tbl "table", case when wide then 100000 else 0 end - 5 + strpos('FOP', tag) rel_pos, case when wide then 4 else 3 end n_cols from dec""",
)
def _asof(spark, sf_dir):
    tagged = tag_messages(pg_messages(spark, sf_dir))
    out = with_relation(tagged, slices=plan_slices(tagged, "pos", ["slot"]))
    return out.select("pos", "rel_id", "table", "rel_pos", F.size("names").alias("n_cols"))


@query("pg_changes", _decoded_sql(BEFORE_SHOWN))
def _pg(spark, sf_dir):
    log = pg_messages(spark, sf_dir)
    return show_events(pg_changes(log, slices=plan_slices(log, "pos", ["slot"])), *HEAD)


@query("pg9_changes", _decoded_sql("(sends_old or (op = 'delete' and tag <> 'P'))"))
def _pg9(spark, sf_dir):
    log = pg9_messages(spark, sf_dir)
    return show_events(pg9_changes(log, slices=plan_slices(log, "pos", ["slot"])), *HEAD)


@query(
    "unchanged_columns",
    f"""{DEC} select pos, case when kept then 'cents' else '' end unchanged, not kept and not absent and op <> 'delete' has_cents from dec""",
)
def _unchanged(spark, sf_dir):
    tagged = tag_messages(pg_messages(spark, sf_dir))
    rows = decode_tuples(with_relation(tagged, slices=plan_slices(tagged, "pos", ["slot"])))
    return rows.select(
        "pos", F.array_join("unchanged", ",").alias("unchanged"),
        F.coalesce(F.get("new", F.lit(2)).isNotNull(), F.lit(False)).alias("has_cents"),
    )


@query(
    "envelope_nested",
    f"""{DEC} select op "type", 'SALES' "schema", tbl "table", lsn, ts, pos,
        case when {BEFORE_SHOWN} then '{{k=' || bk || ', st=' || bst || ', cents=' || bc || case when wide then ', note=née ' || k else '' end || '}}' end before,
        case when op <> 'delete' then '{{k=' || ak || ', st=' || ast || ', cents=' || case when kept or absent then 'null' else cast(ac as varchar) end || case when wide then ', note=née ' || k else '' end || '}}' end after from dec""",
)
def _nested(spark, sf_dir):
    from cdcflow.functions.text import map_text

    log = pg_messages(spark, sf_dir)
    out = envelope(pg_changes(log, slices=plan_slices(log, "pos", ["slot"])))
    return out.select("type", "schema", "table", "lsn", "ts", "pos", map_text(F.col("before")).alias("before"), map_text(F.col("after")).alias("after"))


@query(
    "envelope_flat",
    f"""{DEC} select op "type", tbl "table", pos, case when wide then 8 else 6 end n_fields, case when {BEFORE_SHOWN} then cast(bk as varchar) end before_k,
        cast(ak as varchar) after_k, case when not kept and not absent then cast(ac as varchar) end after_cents from dec""",
)
def _flat(spark, sf_dir):
    log = pg_messages(spark, sf_dir)
    out = envelope(pg_changes(log, slices=plan_slices(log, "pos", ["slot"])), flat=True)
    d = F.col("data")
    return out.select(
        "type", "table", "pos", F.size("data").alias("n_fields"), d["before_k"].alias("before_k"),
        d["after_k"].alias("after_k"), d["after_cents"].alias("after_cents"),
    )


@query(
    "filter_category",
    f"""with {LOG_SQL} select 'ORDERS_' || tag "table", op, case when t%2 = 0 then t*1000 else scn - scn%10 end scn from dml where op in ('update','delete')""",
)
def _category(spark, sf_dir):
    return filter_category(changelog(spark, sf_dir), "Update, DELETE").select("table", "op", "scn")


@query(
    "filter_tables",
    f"""with {LOG_SQL} select 'ORDERS_' || tag "table", op, case when t%2 = 0 then t*1000 else scn - scn%10 end scn from dml where tag in ('F','P')""",
)
def _tables(spark, sf_dir):
    return filter_tables(changelog(spark, sf_dir), ["SALES.ORDERS_F", "SALES.ORDERS_P"]).select("table", "op", "scn")


@query(
    "filter_whitelist",
    f"""with {LOG_SQL} select 'ORDERS_' || tag "table", op, case when t%2 = 0 then t*1000 else scn - scn%10 end scn from dml where tag <> 'O'""",
)
def _lists(spark, sf_dir):
    return filter_lists(changelog(spark, sf_dir), ["SALES.*"], ["SALES.ORDERS_O"]).where(
        F.col("table").isNotNull()
    ).select("table", "op", "scn")


@query("pg_resume", f"select * from ({_decoded_sql(BEFORE_SHOWN)}) where pos >= 120000")
def _pg_resume(spark, sf_dir):
    log = messages_since(pg_messages(spark, sf_dir), 120000)
    return show_events(pg_changes(log, slices=plan_slices(log, "pos", ["slot"])), *HEAD)


@query("pg9_resume", f"select * from ({_decoded_sql("(sends_old or (op = 'delete' and tag <> 'P'))")}) where pos >= 120000")
def _pg9_resume(spark, sf_dir):
    log = messages_since(pg9_messages(spark, sf_dir), 120000)
    return show_events(pg9_changes(log, slices=plan_slices(log, "pos", ["slot"])), *HEAD)


@query(
    "pg_dirty",
    f"""{DEC} select pos, case when op = 'insert' and pos % 70 = 1 then 'unknown message' when op = 'update' and pos % 70 = 2 then 'damaged message' else '' end problem from dec""",
)
def _dirty(spark, sf_dir):
    log = tag_messages(pg_messages(spark, sf_dir))
    msg = (
        F.when((F.col("kind") == "insert") & (F.col("pos") % 70 == 1), F.concat(F.lit(b"?"), F.expr("substring(msg, 2)")))
        .when((F.col("kind") == "update") & (F.col("pos") % 70 == 2), F.expr("substring(msg, 1, length(msg) - 3)"))
        .otherwise(F.col("msg"))
    )
    spoilt = log.select("slot", "pos", msg.alias("msg"))
    out = pg_events(spoilt, slices=plan_slices(spoilt, "pos", ["slot"]))
    return out.select("pos", F.coalesce(F.substring_index(F.get("_errors", F.lit(0))["msg"], ":", 1), F.lit("")).alias("problem"))
