"""A transactional change log derived from every row of ``orders``.

Ten neighbouring orders make one transaction.  Every order is inserted; some are then updated,
deleted or re-keyed, as their priority and status say.  Transaction ids are reused, some
transactions roll back, some lack a START, and the last one stays open.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.workload.registry import derived, table

IMAGE = "struct<k:bigint,st:string,cents:bigint>"

# DuckDB twin of changelog(): CTEs ``g`` (one row per order), ``dml``, ``ctl`` and ``live``.
LOG_SQL = """
o as (select o_orderkey k, o_orderkey // 10 t, o_orderstatus st, cast(round(o_totalprice*100) as bigint) cents,
             o_orderpriority pr from orders),
f as (select *, pr in ('1-URGENT','2-HIGH') or (pr = '5-LOW' and st = 'F') upd, pr = '5-LOW' del,
             (pr = '2-HIGH' and st = 'P') or (pr = '4-NOT SPECIFIED' and st = 'F') rekey from o),
g as (select *, case when upd then 'U' else st end cst, case when upd then cents+100 else cents end cc,
             t*1000+(k%10)*10 s from f),
dml as (
 select t, k, st tag, 'insert' op, s+1 scn, cast(null as bigint) bk, cast(null as varchar) bst, cast(null as bigint) bc,
        k ak, st ast, cents ac from g
 union all select t, k, st, 'update', s+2, k, st, cents, k, 'U', cents+100 from g where upd
 union all select t, k, st, 'delete', s+3, k, cst, cc, null, null, null from g where del
 union all select t, k, st, 'update', s+4, k, cst, cc, -k-1, cst, cc from g where rekey),
tx as (select t, t = max(t) over () is_last from (select distinct t from o)),
ctl as (select t, 'start' op, t*1000 scn from tx where t%13 <> 0
 union all select t, case when t%11 = 0 then 'rollback' else 'commit' end, t*1000+999 from tx where not is_last),
live as (select dml.* replace (case when t%2 = 0 then t*1000 else scn - scn%10 end as scn), case when t%2 = 0 then scn%1000 else scn%10 end seq,
                case when t%2 = 0 then t*1000 else t*1000+990 end commit_scn from dml join tx using (t) where t%11 <> 0 and not is_last)
"""


def shared_scn(rows: DataFrame) -> DataFrame:
    """Rows of one moment under one SCN, told apart by ``seq`` alone.

    All rows of an even transaction, START and COMMIT with them, and the changes of one order in an
    odd one.
    """
    even = F.expr("t % 2 = 0")
    return rows.withColumns(
        {"scn": F.when(even, F.expr("t * 1000")).otherwise(F.expr("scn - scn % 10")), "seq": F.when(even, F.expr("scn % 1000")).otherwise(F.expr("scn % 10"))}
    )


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with the rules that shape its part of the log."""
    pr, st, k = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_orderkey")
    # A small file is one scan task; spread its rows, since building the log takes longer than reading it.
    orders = table(spark, sf_dir, "orders").repartition(spark.sparkContext.defaultParallelism)
    facts = orders.select(
        k.alias("k"),
        F.expr("o_orderkey div 10").alias("t"),
        st.alias("st"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
        (pr.isin("1-URGENT", "2-HIGH") | ((pr == "5-LOW") & (st == "F"))).alias("upd"),
        (pr == "5-LOW").alias("del"),
        (((pr == "2-HIGH") & (st == "P")) | ((pr == "4-NOT SPECIFIED") & (st == "F"))).alias("rekey"),
    )
    return facts.withColumns(
        {
            "cst": F.when(F.col("upd"), F.lit("U")).otherwise(F.col("st")),
            "cc": F.when(F.col("upd"), F.col("cents") + 100).otherwise(F.col("cents")),
            "s": F.expr("t * 1000 + (k % 10) * 10"),
        }
    )


def _image(k: str, st: str, cents: str) -> str:
    return f"named_struct('k', {k}, 'st', {st}, 'cents', {cents})"


def dml_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """t, k, tag, op, scn, before, after: one scan, one explode."""
    none = f"cast(null as {IMAGE})"
    first, now = _image("k", "st", "cents"), _image("k", "cst", "cc")

    def act(cond: str, op: str, at: int, before: str, after: str) -> str:
        row = f"named_struct('op', '{op}', 'scn', s + {at}, 'before', {before}, 'after', {after})"
        return f"if({cond}, {row}, null)"

    acts = ", ".join(
        [
            act("true", "insert", 1, none, first),
            act("upd", "update", 2, first, _image("k", "'U'", "cents + 100")),
            act("del", "delete", 3, now, none),
            act("rekey", "update", 4, now, _image("-k - 1", "cst", "cc")),
        ]
    )
    return (
        order_facts(spark, sf_dir)
        .select("t", "k", F.col("st").alias("tag"), F.expr(f"explode(array_compact(array({acts})))").alias("a"))
        .select("t", "k", "tag", "a.*")
    )


def control_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """t, op, scn of START, COMMIT and ROLLBACK."""
    orders = table(spark, sf_dir, "orders").select(F.expr("o_orderkey div 10").alias("t"))
    tx = orders.distinct().withColumn("top", orders.agg(F.max("t")).scalar())
    marks = F.array_compact(
        F.array(
            F.when(F.expr("t % 13 <> 0"), F.expr("named_struct('op', 'start', 'scn', t * 1000)")),
            F.when(
                F.expr("t <> top"),
                F.expr("named_struct('op', if(t % 11 = 0, 'rollback', 'commit'), 'scn', t * 1000 + 999)"),
            ),
        )
    )
    return tx.select("t", F.explode(marks).alias("a")).select("t", "a.*")


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log as captured: source, schema, table, xid, t, op, scn, seq, before, after; in no order."""
    return derived(spark, sf_dir, "changelog", build_changelog)


def build_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast(IMAGE)
    dml = dml_rows(spark, sf_dir).select(
        F.concat(F.lit("ORDERS_"), "tag").alias("table"), "t", "op", "scn", "before", "after"
    )
    ctl = control_rows(spark, sf_dir).select(
        F.lit(None).cast("string").alias("table"), "t", "op", "scn", none.alias("before"), none.alias("after")
    )
    return shared_scn(dml.unionByName(ctl)).select(
        F.lit("db1").alias("source"),
        F.lit("SALES").alias("schema"),
        "table",
        F.concat(F.lit("7.3."), F.expr("t % 97")).alias("xid"),
        "t",
        "op",
        "scn",
        "seq",
        "before",
        "after",
    ).orderBy(F.xxhash64("t", "scn", "seq"))


def base_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target before the log: every order once, with status B."""
    return order_facts(spark, sf_dir).select("k", F.lit("B").alias("st"), "cents")


def flat(df: DataFrame, *head: str) -> DataFrame:
    """Head columns and both images as plain columns."""
    images = [
        F.col(f"{side}.{c}").alias(name)
        for side, names in (("before", ("bk", "bst", "bc")), ("after", ("ak", "ast", "ac")))
        for c, name in zip(("k", "st", "cents"), names)
    ]
    return df.select(*head, *images)
