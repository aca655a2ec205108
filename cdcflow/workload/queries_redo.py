"""Queries over mined redo rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from cdcflow.operators.dictionary import typed_changes
from cdcflow.operators.positions import plan_slices
from cdcflow.operators.redo import drop_internal, mined_rows, redo_images, redo_since, redo_statements
from cdcflow.operators.txn import committed_changes, log_gaps, remove_rollback_pairs, resume_after
from cdcflow.session import materialize
from cdcflow.workload.changelog import LOG_SQL
from cdcflow.workload.redolog import REDO_SQL, redo_log, redo_pieces
from cdcflow.workload.registry import query

REDO = f"with {LOG_SQL}, {REDO_SQL}"

ALL_ROWS = """
rows_ as (select t, scn, upper(op) operation, tbl table_name, 'APP' username, sql_redo, xid from redo
 union all select t, scn, upper(op), null, case when t%7=0 then 'SYS' else 'APP' end, null, '7.3.' || cast(t%97 as varchar) from ctl
 union all select t, t*1000+d, o, 'ORDERS_F', 'APP', s, '7.3.' || cast(t%97 as varchar) from tx, (values (990,'DDL','drop x'),(991,'DDL','create table y'),(992,'INSERT','insert into temporary tables z')) v(d, o, s))"""


@query(
    "mined_rows",
    f"""{REDO}, {ALL_ROWS} select scn, operation, table_name, xid from rows_ where scn > 5000 and ((operation in ('START','COMMIT','ROLLBACK') and username <> 'SYS')
        or (operation in ('INSERT','UPDATE','DELETE','DDL') and table_name <> 'ORDERS_P'))""",
)
def _mined(spark, sf_dir):
    out = mined_rows(redo_log(spark, sf_dir), 5000, ["SALES.*"], ["SALES.ORDERS_P"])
    return out.select("scn", "operation", "table_name", "xid")


@query(
    "redo_scan_since",
    f"""{REDO}, {ALL_ROWS} select scn, operation, sql_redo from rows_ where scn > 40000""",
)
def _since(spark, sf_dir):
    return redo_since(redo_log(spark, sf_dir), 40000).select("scn", "operation", "sql_redo")


@query(
    "redo_filtered",
    f"""{REDO}, {ALL_ROWS} select scn, operation, sql_redo from rows_ where coalesce(sql_redo, '') <> 'drop x' and not contains(coalesce(sql_redo, ''), 'temporary tables')""",
)
def _filtered(spark, sf_dir):
    return drop_internal(redo_log(spark, sf_dir)).select("scn", "operation", "sql_redo")


def _statements(spark, sf_dir):
    """Whole statements of the pieces in the log."""
    rows = mined_rows(redo_pieces(spark, sf_dir), -1, ["SALES.*"])
    pieces = redo_pieces(spark, sf_dir)
    return redo_statements(rows, slices=plan_slices(pieces, "pos", ["source", "rs_id"]))


@query(
    "redo_stitched",
    f"""{REDO} select scn, upper(op) operation, sql_redo from redo union all select t*1000+991, 'DDL', 'create table y' from tx""",
)
def _stitched(spark, sf_dir):
    return _statements(spark, sf_dir).where(F.col("operation").isin("INSERT", "UPDATE", "DELETE", "DDL")).select(
        "scn", "operation", "sql_redo"
    )


IMAGES = """select scn, op, cast(bk as varchar) b_k, bst b_st, cast(bc as varchar) b_cents, case when op <> 'insert' then note end b_note,
 cast(ak as varchar) a_k, ast a_st, cast(ac as varchar) a_cents, case when op <> 'delete' then note end a_note"""


def _images(df, *head):
    cols = []
    for side, p in (("before", "b"), ("after", "a")):
        cols += [F.try_element_at(side, F.lit(c)).alias(f"{p}_{c.lower()}") for c in ("K", "ST", "CENTS", "NOTE")]
    return df.select(*head, *cols)


@query("redo_images", f"{REDO} {IMAGES} from redo")
def _redo_images(spark, sf_dir):
    rows = _statements(spark, sf_dir).where(F.col("operation").isin("INSERT", "UPDATE", "DELETE"))
    return _images(redo_images(rows), "scn", F.lower("operation").alias("op"))


def _changes(spark, sf_dir):
    """Committed changes as stitched from the log, with what tells undone ones apart."""
    slices = plan_slices(redo_log(spark, sf_dir), "scn", ["source", "xidsqn"])
    rows = _statements(spark, sf_dir).withColumn("op", F.lower("operation")).select("source", "xid", "scn", "op", "table_name", "row_id", "rollback")
    if not slices.single:
        # Sliced assembly reads its input twice; store it rather than stitch twice.
        rows = materialize(rows, "redo-statements")
    return committed_changes(rows, slices=slices).where(F.col("op") != "ddl")


# Boundaries of SYS sessions are not mined, so their work joins the next boundary of the same xid.
OUTCOME = """bounds as (select t, op outcome, scn bscn, '7.3.' || cast(t%97 as varchar) xid from ctl where t%7 <> 0),
done as (select r.*, b.outcome, b.bscn from redo r asof join bounds b on r.xid = b.xid and r.scn <= b.bscn)"""


@query(
    "rollback_pairs",
    f"""{REDO}, {OUTCOME} select scn, op, bscn commit_scn, tbl "table" from done where outcome = 'commit' and not (scn % 10 in (6, 7))""",
)
def _pairs(spark, sf_dir):
    rows = _changes(spark, sf_dir)
    out = remove_rollback_pairs(rows, slices=plan_slices(redo_log(spark, sf_dir), "scn", ["source", "xidsqn", "row_id"]))
    return out.select("scn", "op", "commit_scn", F.col("table_name").alias("table"))


@query(
    "typed_changes",
    f"""{REDO} select scn, op, bk, bst, bc, ak, ast, ac, case when op <> 'delete' then note end note from redo where tag = 'F'""",
)
def _typed(spark, sf_dir):
    rows = _statements(spark, sf_dir).where(F.col("operation").isin("INSERT", "UPDATE", "DELETE"))
    changes = redo_images(rows).withColumnsRenamed({"seg_owner": "schema", "table_name": "table"})
    cells = "inline(array(struct('K', 1, 'NUMBER', 18), struct('ST', 2, 'VARCHAR2', 0), struct('CENTS', 3, 'NUMBER', 18), struct('NOTE', 4, 'CLOB', 0))) as (column_name, column_id, data_type, data_precision)"
    dictionary = (
        redo_log(spark, sf_dir).where("table_name is not null").select("seg_owner", "table_name").distinct()
        .selectExpr("seg_owner as owner", "table_name", "0 as data_scale", cells)
    )
    good, _ = typed_changes(changes, dictionary, "SALES", "ORDERS_F", compat=True)
    return good.select(
        "scn", F.lower("operation").alias("op"),
        F.col("before.K").alias("bk"), F.col("before.ST").alias("bst"), F.col("before.CENTS").alias("bc"),
        F.col("after.K").alias("ak"), F.col("after.ST").alias("ast"), F.col("after.CENTS").alias("ac"), F.col("after.NOTE").alias("note"),
    )


@query(
    "resume_after",
    f"""{REDO} select scn, 'AAA' || cast(k as varchar) row_id, op from redo where scn > 30011 or (scn = 30011 and 'AAA' || cast(k as varchar) > 'AAA300')""",
)
def _resume(spark, sf_dir):
    rows = redo_log(spark, sf_dir).where(F.col("operation").isin("INSERT", "UPDATE", "DELETE") & (F.col("row_id") != "AAA"))
    return resume_after(rows, (30011, "AAA300"), ("scn", "row_id")).select("scn", "row_id", F.lower("operation").alias("op"))


@query(
    "log_gaps",
    f"""with {LOG_SQL}, s as (select distinct 'db1' source, t%2+1 thread, t//20 + t//200 "sequence" from tx),
        l as (select *, lag("sequence") over (partition by source, thread order by "sequence") prev_sequence from s)
        select source, thread, "sequence", prev_sequence, "sequence" - prev_sequence - 1 missing from l where "sequence" - prev_sequence > 1""",
)
def _gaps(spark, sf_dir):
    return log_gaps(redo_log(spark, sf_dir).select("source", "thread", "sequence"))
