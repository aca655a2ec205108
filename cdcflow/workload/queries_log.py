"""Queries over the change log: assembly, application, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from cdcflow.operators.apply import apply_changes, apply_unchanged, change_counts, compact_changes
from cdcflow.operators.positions import plan_slices
from cdcflow.operators.txn import TXN_KEYS, committed_changes
from cdcflow.workload.changelog import LOG_SQL, base_table, changelog, flat
from cdcflow.workload.registry import query


@query(
    "committed_changes",
    f"with {LOG_SQL} select '7.3.' || (t%97) xid, op, scn, seq, commit_scn, bk, bst, bc, ak, ast, ac from live",
)
def _committed(spark, sf_dir):
    log = changelog(spark, sf_dir)
    out = committed_changes(log, slices=plan_slices(log, "scn", TXN_KEYS))
    return flat(out, "xid", "op", "scn", "seq", "commit_scn")


@query(
    "apply_changes",
    f"""with {LOG_SQL},
    alive as (select g.* from g join tx using (t) where t%11 <> 0 and not is_last),
    fin as (select case when rekey then -k-1 else k end k, cst st, cc cents from alive where not del)
    select k, st, cents from fin
    union all select k, 'B', cents from o where k not in (select k from alive)""",
)
def _apply(spark, sf_dir):
    log = changelog(spark, sf_dir)
    changes = committed_changes(log, slices=plan_slices(log, "scn", TXN_KEYS))
    return apply_changes(base_table(spark, sf_dir), changes, ["k"])


@query(
    "compact_changes",
    f"""with {LOG_SQL},
    acts as (select bk k, false live, cast(null as varchar) st, cast(null as bigint) cents, commit_scn, scn, seq
             from live where bk is not null and (ak is null or ak <> bk)
             union all select ak, true, ast, ac, commit_scn, scn, seq from live where ak is not null)
    select k, live, st, cents, commit_scn, scn, seq from acts
    qualify row_number() over (partition by k order by commit_scn desc, scn desc, seq desc) = 1""",
)
def _compact(spark, sf_dir):
    log = changelog(spark, sf_dir)
    out = compact_changes(committed_changes(log, slices=plan_slices(log, "scn", TXN_KEYS)), ["k"])
    return out.select("k", "live", "image.st", "image.cents", "commit_scn", "scn", "seq")


@query(
    "change_counts",
    f"with {LOG_SQL} select 'SALES' \"schema\", 'ORDERS_' || tag \"table\", op, count(*) n from dml group by all",
)
def _counts(spark, sf_dir):
    return change_counts(changelog(spark, sf_dir).where(F.col("table").isNotNull()))


@query(
    "apply_unchanged",
    f"""with {LOG_SQL},
    alive as (select g.* from g join tx using (t) where t%11 <> 0 and not is_last),
    fin as (select case when rekey then -k-1 else k end k, cst st,
                   case when del then null else cents end cents from alive where not del)
    select k, st, cents from fin
    union all select k, 'B', cents from o where k not in (select k from alive)""",
)
def _apply_unchanged(spark, sf_dir):
    # Updates leave out ``cents``: the value sent by the insert must survive them.
    log = changelog(spark, sf_dir)
    changes = committed_changes(log, slices=plan_slices(log, "scn", TXN_KEYS))
    lean = changes.withColumns(
        {
            "unchanged": F.when(F.col("op") == "update", F.array(F.lit("cents"))),
            "before": F.when(
                F.col("op") == "update",
                F.col("before").withField("cents", F.col("before.cents") - F.when(F.col("before.st") == "U", 100).otherwise(0)),
            ).otherwise(F.col("before")),
            "after": F.when(
                F.col("op") == "update", F.col("after").withField("cents", F.lit(None).cast("long"))
            ).otherwise(F.col("after")),
        }
    )
    return apply_unchanged(base_table(spark, sf_dir), lean, ["k"])
