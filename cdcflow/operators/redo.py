"""Redo rows of a mined log: scan, stitch, clean, and read their SQL into row images."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cdcflow.functions.plan import once
from cdcflow.functions.text import java_unescaped
from cdcflow.operators.filters import list_predicate
from cdcflow.operators.positions import WHOLE, Slices, carry, running
from cdcflow.session import materialize

# Operations, users whose transactions are ignored, and the marker of internal DDL.
TXN_OPERATIONS = ("COMMIT", "ROLLBACK", "START")
ROW_OPERATIONS = ("INSERT", "UPDATE", "DELETE", "DDL")
OPERATION_CODES = (1, 2, 3, 5)
IGNORED_USERS = ("UNKNOWNX", "SYS", "KMINER")
INTERNAL_DDL = "INTERNAL DDL"
TEMPORARY_TABLES = "temporary tables"
#: Pieces of a statement that are joined in a first step.
PIECES_AT_ONCE = 64
# The marks around the statement in a printed map.
MAP_BEGIN, MAP_END = "SQL_REDO=", ", OPERATION"


def mined_rows(
    log: DataFrame, since_scn: int, white: Sequence[str], black: Sequence[str] = (), committed_view: bool = False
) -> DataFrame:
    """Rows to read after ``since_scn``: boundaries of real users, changes of the listed tables.

    Plain predicates on plain columns, so that file and JDBC scans skip what is not wanted.
    """
    listed = list_predicate(white, black, "seg_owner", "table_name")
    xid = F.concat_ws(".", "xidusn", "xidslt", "xidsqn")
    if committed_view:
        commit_scn = F.coalesce("commit_scn", "scn")
        keep = F.col("operation_code").isin(*OPERATION_CODES) & (commit_scn >= since_scn) & listed
        return log.where(keep).withColumns({"commit_scn": commit_scn, "xid": xid})
    real = F.col("operation").isin(*TXN_OPERATIONS) & ~F.col("username").isin(*IGNORED_USERS)
    changes = F.col("operation").isin(*ROW_OPERATIONS) & listed
    return log.where((F.col("scn") > since_scn) & (real | changes)).withColumn("xid", xid)


def _internal() -> Column:
    temporary = F.coalesce(F.col("sql_redo").contains(TEMPORARY_TABLES), F.lit(False))
    return temporary | ((F.col("operation") == "DDL") & F.coalesce(F.col("info").startswith(INTERNAL_DDL), F.lit(False)))


def drop_internal(rows: DataFrame) -> DataFrame:
    """Whole rows without statements on temporary tables and internal DDL; for pieces see ``redo_statements``."""
    return rows.where(~_internal())


def redo_statements(rows: DataFrame, *, keys: Sequence[str] = ("source", "xid", "rs_id"), pos: str = "pos", slices: Slices = WHOLE) -> DataFrame:
    """Whole statements without internal ones.

    A statement is judged by its first piece, and the verdict holds for all of it: later pieces may
    hold the marker as a value, and a first piece never goes without those that follow it.
    """
    whole = stitch_redo(rows.withColumn("_internal", _internal()), keys=keys, pos=pos, slices=slices)
    return whole.where(~F.col("_internal")).drop("_internal")


def stitch_redo(
    rows: DataFrame, *, keys: Sequence[str] = ("source", "xid", "rs_id"), pos: str = "pos", slices: Slices = WHOLE
) -> DataFrame:
    """Join the pieces of a statement: a row with CSF=1 goes on in the next row of its record.

    Only the pieces of one statement are gathered, ``PIECES_AT_ONCE`` and then those texts, so a
    statement of very many pieces is not copied once per piece.  Columns stay columns: what nobody reads
    is neither shuffled nor sorted.  A record is normally a few rows; slices keep a log whose rows
    mostly share one record from ending on one task.
    """
    finest = [*reversed(keys)]
    if slices.single:
        w = Window.partitionBy(*finest).orderBy(pos)
        first = F.when(F.lag("csf", 1, 0).over(w) == 1, 0).otherwise(1)
        numbered = rows.withColumn("_starts", first).withColumn("_stmt", F.sum("_starts").over(w))
    else:
        piece_before = carry(rows, keys, pos, F.coalesce("csf", F.lit(0)), F.lit(True), "_before", strict=True, slices=slices)
        first = F.when(F.col("_before") == 1, 0).otherwise(1)
        # The running count reads its input twice; store it rather than run the first pass twice.
        marked = materialize(piece_before.withColumn("_starts", first).drop("_before"), "redo-pieces")
        numbered = running(marked, keys, pos, {"_stmt": F.col("_starts")}, slices=slices)
    rest = [c for c in rows.columns if c not in (*keys, pos, "sql_redo", "csf")]
    inside = Window.partitionBy(*finest, "_stmt").orderBy(pos, "sql_redo", "_starts")
    some = inside.rowsBetween(0, PIECES_AT_ONCE - 1)
    heads = numbered.withColumns(
        {
            "_place": F.row_number().over(inside) - 1,
            "_ahead": F.count(F.lit(1)).over(some),
            "_text": F.array_join(F.collect_list("sql_redo").over(some), ""),
        }
    ).where(F.col("_place") % PIECES_AT_ONCE == 0)
    every = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = heads.withColumn("_text", F.array_join(F.collect_list("_text").over(every), "")).where("_place = 0")
    text = F.when(F.col("_ahead") == 1, F.col("sql_redo")).otherwise(F.col("_text"))
    # Only the piece that starts the statement brings the other columns along.
    facts = [F.when(F.col("_starts") == 1, F.col(c)).alias(c) for c in rest]
    return firsts.select(*keys, pos, text.alias("sql_redo"), *facts)


# The log writes one fixed form of SQL.  A value is a quoted text (quotes doubled inside), a call,
# or a bare word; a pair is "COLUMN" = value or "COLUMN" IS NULL.  Groups: quoted body, bare value.
_BODY = r"[^']*+(?:''[^']*+)*+"
_QUOTED = rf"'{_BODY}'"
_VALUE = rf"(?:TIMESTAMP\s*+|DATE\s*+)?+'({_BODY})'|(\w+\((?:{_QUOTED}|[^()'])*+\)|[^\s,;()'\"]++)"
_ANY_VALUE = rf"(?:(?:TIMESTAMP\s*+|DATE\s*+)?+{_QUOTED}|\w+\((?:{_QUOTED}|[^()'])*+\)|[^\s,;()'\"]++)"
_NAME = r"(?:\"[^\"]++\"|[^\s\".(]++)"
_TABLE = rf"{_NAME}(?:\.{_NAME})*+"
_PAIR = rf"\"([^\"]++)\"\s*+(?:=|IS)\s*+(?:{_VALUE})"
_SETS = rf"\"[^\"]++\"\s*+=\s*+{_ANY_VALUE}"
_INSERT_HEAD = rf"(?i)^\s*+insert\s++into\s++{_TABLE}\s*+\(([^)]*+)\)\s*+values\s*+\("
_UPDATE_HEAD = rf"(?i)^\s*+update\s++{_TABLE}\s++set\s++{_SETS}(?:\s*+,\s*+{_SETS})*+(?:\s++where\s++)?+"
_DELETE_HEAD = rf"(?i)^\s*+delete\s++from\s++{_TABLE}(?:\s++where\s++)?+"


def _values(part: Column, pattern: str, body: int) -> Column:
    """The values a pattern finds: quoted bodies with their quotes made single, or bare words."""

    def pick(quoted: Column, bare: Column) -> Column:
        text = F.replace(quoted, F.lit("''"), F.lit("'"))
        return F.when(bare == "", text).when(~bare.isin("NULL", "null"), bare)

    found = [F.regexp_extract_all(part, F.lit(pattern), group) for group in (body, body + 1)]
    return F.zip_with(*found, pick)


def _pairs(part: Column) -> Column:
    return F.map_from_arrays(F.regexp_extract_all(part, F.lit(_PAIR), 1), _values(part, _PAIR, 2))


def _boxed_pairs(part: Column) -> Column:
    """The same with each value in a struct, so that a column set to NULL differs from one not set."""
    boxed = F.transform(_values(part, _PAIR, 2), lambda v: F.struct(v.alias("v")))
    return F.map_from_arrays(F.regexp_extract_all(part, F.lit(_PAIR), 1), boxed)


def redo_images(rows: DataFrame, sql: str = "sql_redo", operation: str = "operation") -> DataFrame:
    """Add ``before`` and ``after`` maps read from the statement.

    INSERT gives after; DELETE gives before; UPDATE gives before from WHERE and after as before
    overlaid with SET.  Patterns read the text in the JVM; a statement they do not fit gives NULL.
    """
    text, op, head = F.col(sql), F.lower(operation), F.col("_head")
    opening = (
        F.when(op == "insert", F.regexp_extract(text, _INSERT_HEAD, 0))
        .when(op == "update", F.regexp_extract(text, _UPDATE_HEAD, 0))
        .when(op == "delete", F.regexp_extract(text, _DELETE_HEAD, 0))
    )
    headed = once(rows, {"_head": F.when(opening != "", opening)})
    rest = F.substr(text, F.length(head) + 1)
    names = F.regexp_extract_all(F.regexp_extract(head, _INSERT_HEAD, 1), F.lit(r'"([^"]+)"'), 1)
    is_insert = head.isNotNull() & (op == "insert")
    read = once(
        headed,
        {
            "before": F.when(head.isNotNull() & (op != "insert"), _pairs(rest)),
            "_set": F.when(head.isNotNull() & (op == "update"), _boxed_pairs(head)),
            "_names": F.when(is_insert, names),
            "_found": F.when(is_insert, _values(rest, _VALUE, 1)),
        },
    )
    fits = (F.size("_names") > 0) & (F.size("_found") == F.size("_names"))
    inserted = F.when(fits, F.map_from_arrays(F.when(fits, F.col("_names")), F.col("_found")))
    overlaid = F.map_zip_with("before", "_set", lambda _, old, new: F.when(new.isNotNull(), new["v"]).otherwise(old))
    after = F.when(op == "insert", inserted).when(op == "update", overlaid)
    return once(read, {"after": after}).drop("_head", "_set", "_names", "_found")


def redo_from_message(message: Column, form: str = "json") -> Column:
    """The statement carried by an event message, in JSON or in printed-map form."""
    if form == "json":
        return F.get_json_object(message, "$.SQL_REDO")
    if form == "map":
        # between the first of one mark and the last of the other, in text that was printed with escapes
        text = java_unescaped(message)
        tail = F.substring(text, F.locate(MAP_BEGIN, text) + len(MAP_BEGIN), F.length(text))
        rest = F.length(F.substring_index(tail, MAP_END, -1)) + len(MAP_END)
        both = (F.locate(MAP_BEGIN, text) > 0) & F.contains(tail, F.lit(MAP_END))
        return F.when(both, F.substring(tail, F.lit(1), F.length(tail) - rest)).otherwise("")
    raise ValueError(f"unknown message form {form!r}")


def redo_since(rows: DataFrame, since_scn: int) -> DataFrame:
    """Rows newer than the last handled position."""
    return rows.where(F.col("scn") > since_scn)
