"""Decode captured logical-replication messages (relation, begin, row changes) into change events.

Input rows are ``slot, pos, msg``: the message bytes at a unique log position of a slot.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.functions.text import unquote
from cdcflow.functions.wire import Batch, read_tuple, tuple_lists
from cdcflow.operators.dirty import ERROR_TYPE, ERRORS, problem
from cdcflow.operators.envelope import images
from cdcflow.operators.filters import filter_category, filter_tables
from cdcflow.operators.positions import WHOLE, Mark, Slices, carry, carry_all
from cdcflow.session import materialize

# Message tags, and the epoch of the log clock (2000-01-01 UTC) in milliseconds.
KINDS = {
    "R": "relation", "B": "begin", "C": "commit", "I": "insert", "U": "update", "D": "delete",
    "Y": "type", "O": "origin",
}
LOG_EPOCH_MILLIS = 946_684_800_000
ROW_KINDS = ("insert", "update", "delete")
#: Definitions that every task may hold; more are joined by a shuffle.
HELD_DEFINITIONS = 20_000


def big_endian(col: Column, start: int, width: int) -> Column:
    """Unsigned big-endian number inside a binary column (1-based start); 8 bytes wrap to signed."""
    return F.conv(F.hex(F.substring(col, start, width)), 16, -10).cast("long")


def tag_messages(messages: DataFrame) -> DataFrame:
    """Add ``kind`` from the first byte; unknown tags get ``unknown``."""
    tag = F.substring("msg", 1, 1)
    kind = F.lit("unknown")
    for letter, name in reversed(KINDS.items()):
        kind = F.when(tag == F.lit(letter.encode()), name).otherwise(kind)
    return messages.withColumn("kind", kind)


def _begin() -> Column:
    m = F.col("msg")
    return F.struct(
        big_endian(m, 2, 8).alias("lsn"),
        (F.floor(big_endian(m, 10, 8) / 1000) + LOG_EPOCH_MILLIS).cast("long").alias("ts"),
        big_endian(m, 18, 4).alias("xid"),
    )


def with_txn_context(tagged: DataFrame, *, slices: Slices = WHOLE) -> DataFrame:
    """Add ``lsn, ts, xid`` of the last BEGIN at or before each row of its slot."""
    out = carry(tagged, ["slot"], "pos", _begin(), F.col("kind") == "begin", "_txn", slices=slices)
    return out.select(*tagged.columns, "_txn.lsn", "_txn.ts", "_txn.xid")


_RELATION = T.StructType(
    [
        T.StructField("schema", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("identity", T.StringType()),
        T.StructField("names", T.ArrayType(T.StringType())),
        T.StructField("oids", T.ArrayType(T.LongType())),
        T.StructField("keys", T.ArrayType(T.BooleanType())),
    ]
)


def _parse_relation(raw: bytes) -> dict | None:
    """Fields of a relation message, or None when it is damaged."""
    try:
        schema, table, rest = raw[5:].split(b"\0", 2)
        row = {"schema": schema.decode(), "table": table.decode(), "identity": chr(rest[0]), "names": [], "oids": [], "keys": []}
        count, rest = int.from_bytes(rest[1:3], "big"), rest[3:]
        for _ in range(count):
            name, after = rest[1:].split(b"\0", 1)
            row["names"].append(name.decode())
            row["oids"].append(int.from_bytes(after[:4], "big"))
            row["keys"].append(rest[0] == 1)
            rest = after[8:]
        return row
    except (ValueError, IndexError):
        return None


@F.arrow_udf(_RELATION)
def _read_relation(msgs: pa.Array) -> pa.Array:
    kinds = [("schema", pa.string()), ("table", pa.string()), ("identity", pa.string()),
             ("names", pa.list_(pa.string())), ("oids", pa.list_(pa.int64())), ("keys", pa.list_(pa.bool_()))]
    return pa.array([_parse_relation(raw) for raw in msgs.to_pylist()], pa.struct(kinds))


def relations(tagged: DataFrame) -> DataFrame:
    """Table definitions in the log: slot, rel_id, rel_pos (valid from), schema, table, names, oids, keys."""
    found = tagged.where(F.col("kind") == "relation").select(
        "slot",
        big_endian(F.col("msg"), 2, 4).alias("rel_id"),
        F.col("pos").alias("rel_pos"),
        _read_relation("msg").alias("r"),
    )
    return found.where(F.col("r.table").isNotNull()).select(
        "slot", "rel_id", "rel_pos", "r.schema", "r.table", "r.identity",
        F.transform("r.names", unquote).alias("names"), "r.oids", "r.keys",
    )


def relation_columns(rels: DataFrame, type_names: DataFrame | None = None) -> DataFrame:
    """One row per column of a definition, with its type name where ``type_names`` (oid, type) knows it."""
    cols = rels.select(
        "slot", "rel_id", "rel_pos", "schema", "table", F.posexplode(F.arrays_zip("names", "oids", "keys")).alias("idx", "c")
    ).select("slot", "rel_id", "rel_pos", "schema", "table", "idx", F.col("c.names").alias("name"),
             F.col("c.oids").alias("oid"), F.col("c.keys").alias("is_key"))
    return cols if type_names is None else cols.join(type_names.select("oid", "type"), "oid", "left")


def _defined(placed: DataFrame, rels: DataFrame) -> DataFrame:
    """Rows with the definition at their ``rel_pos``.

    A log has few definitions, so a shuffle by them would end on as many tasks.  They are stored and
    counted first, and held by every task unless they are very many.
    """
    stored = materialize(rels, "definitions")
    few = stored.count() <= HELD_DEFINITIONS
    return placed.join(F.broadcast(stored) if few else stored, ["slot", "rel_id", "rel_pos"], "left")


def with_relation(tagged: DataFrame, rels: DataFrame | None = None, *, slices: Slices = WHOLE) -> DataFrame:
    """Add to each row change the table definition in force at its position.

    The log itself carries the position of the last definition forward; the definition is then
    fetched by equality, so later definitions of a table are honoured.
    """
    rels = relations(tagged) if rels is None else rels
    keyed = tagged.where(F.col("kind").isin("relation", *ROW_KINDS)).withColumn("rel_id", big_endian(F.col("msg"), 2, 4))
    placed = carry(
        keyed, ["slot", "rel_id"], "pos", F.col("pos"), F.col("kind") == "relation", "rel_pos", slices=slices
    ).where(F.col("kind").isin(*ROW_KINDS))
    return _defined(placed, rels)


_TUPLES = T.StructType(
    [
        T.StructField("old", T.ArrayType(T.StringType())),
        T.StructField("new", T.ArrayType(T.StringType())),
        T.StructField("kept", T.ArrayType(T.BooleanType())),
        T.StructField("ok", T.BooleanType()),
    ]
)


@F.arrow_udf(_TUPLES)
def _read_tuples(msgs: pa.Array) -> pa.Array:
    batch = Batch.of(msgs)
    head = batch.uint(batch.start, 1)
    mark = batch.uint(batch.start + 5, 1)
    pos = batch.start + 6
    old_rows = np.flatnonzero((mark == ord("O")) | (mark == ord("K")))
    old, after = read_tuple(batch, old_rows, pos[old_rows], count_width=2, nul=0)
    pos[old_rows] = after
    follows = old_rows[head[old_rows] == ord("U")]
    good = np.ones(len(batch), bool)
    good[follows] = batch.uint(pos[follows], 1) == ord("N")
    pos[follows] += 1
    new_rows = np.flatnonzero(head != ord("D"))
    new, after = read_tuple(batch, new_rows, pos[new_rows], count_width=2, nul=0)
    pos[new_rows] = after
    old_values, _ = tuple_lists(batch, old_rows, old)
    new_values, kept = tuple_lists(batch, new_rows, new)
    good &= pos == batch.end
    good[old_rows] &= old.whole
    good[new_rows] &= new.whole
    return pa.StructArray.from_arrays([old_values, new_values, kept, pa.array(good)], ["old", "new", "kept", "ok"])


def decode_tuples(dml: DataFrame, compat: bool = False) -> DataFrame:
    """Add ``old, new`` (text arrays), ``unchanged`` (column names not resent) and ``ok`` (well-formed).

    ``compat`` leaves ``unchanged`` empty, so a value not resent reads as a plain NULL.
    """
    out = dml.withColumn("_t", _read_tuples("msg"))
    names = F.filter(F.transform("names", lambda n, i: F.when(F.get("_t.kept", i), n)), lambda n: n.isNotNull())
    unchanged = F.array().cast("array<string>") if compat else F.coalesce(names, F.array().cast("array<string>"))
    fits = F.lit(True)
    for side in ("_t.old", "_t.new"):
        fits = fits & (F.col(side).isNull() | (F.size(side) == F.size("names")))
    return out.select(*dml.columns, "_t.old", "_t.new", unchanged.alias("unchanged"), (F.col("_t.ok") & fits).alias("ok"))


def context_messages(messages: DataFrame) -> DataFrame:
    """The last BEGIN per slot and the last definition per table: what later messages need of earlier ones."""
    tagged = tag_messages(messages).where(F.col("kind").isin("begin", "relation"))
    rel = F.when(F.col("kind") == "relation", big_endian(F.col("msg"), 2, 4))
    return (
        tagged.groupBy("slot", "kind", rel.alias("rel_id"))
        .agg(F.max_by("msg", "pos").alias("msg"), F.max("pos").alias("pos"))
        .select("slot", "pos", "msg")
    )


def messages_since(messages: DataFrame, pos: int) -> DataFrame:
    """Messages from a position on, behind the context they need; context gives no events itself."""
    rows = messages.select("slot", "pos", "msg")
    return context_messages(rows.where(F.col("pos") < pos)).unionByName(rows.where(F.col("pos") >= pos))


def _placed_rows(tagged: DataFrame, cat: str, slices: Slices) -> DataFrame:
    """Row changes of the wanted kinds with transaction context and table definition (null where none is known)."""
    wanted = {c.strip().lower() for c in cat.split(",")}
    useful = [k for k in ROW_KINDS if k in wanted]
    kind = F.col("kind")
    slim = tagged.where(kind.isin("relation", "begin", *useful)).withColumn(
        "rel_id", F.when(kind != "begin", big_endian(F.col("msg"), 2, 4))
    )
    # Transaction context and table definition travel in one shuffle by slot and slice.
    placed = carry_all(
        slim,
        ["slot"],
        "pos",
        {
            "_txn": Mark((), _begin(), kind == "begin"),
            "rel_pos": Mark(("rel_id",), F.col("pos"), kind == "relation"),
        },
        slices=slices,
    ).select(*slim.columns, "_txn.lsn", "_txn.ts", "_txn.xid", "rel_pos")
    return _defined(placed.where(kind.isin(*useful)), relations(tagged))


def pg_changes(
    messages: DataFrame,
    cat: str = "insert,update,delete",
    tables: Sequence[str] | None = None,
    *,
    compat: bool = False,
    slices: Slices = WHOLE,
) -> DataFrame:
    """Change events of a captured log.  Kinds and tables are filtered before any tuple is read.

    Damaged changes have ``ok`` false and no images; messages that give no event at all are left out,
    see ``pg_events``.
    """
    rows = filter_category(_placed_rows(tag_messages(messages), cat, slices), cat, "kind")
    if tables:
        rows = filter_tables(rows, tables)
    return images(decode_tuples(rows, compat))


def with_problems(decoded: DataFrame) -> DataFrame:
    """Add the error list of a decoded message; the text holds the whole message in hex, so nothing is lost."""
    what = (
        F.when(F.col("kind") == "unknown", "unknown message").when(F.col("table").isNull() & F.col("names").isNull(), "no table definition")
        .when(~F.coalesce(F.col("ok"), F.lit(False)), "damaged message")
    )
    found = problem("msg", "conversion", F.concat(what, F.lit(": "), F.hex("msg")), what.isNotNull())
    return decoded.withColumn(ERRORS, F.array_compact(F.array(found)).cast(ERROR_TYPE))


def pg_events(
    messages: DataFrame, cat: str = "insert,update,delete", tables: Sequence[str] | None = None, *, compat: bool = False, slices: Slices = WHOLE
) -> DataFrame:
    """``pg_changes`` that loses nothing: unknown, damaged and undefined messages come along with errors.

    ``dirty.split_dirty`` tells them apart.  Without a definition a change belongs to no table, so the
    table list does not apply to it.
    """
    tagged = tag_messages(messages)
    rows = _placed_rows(tagged, cat, slices)
    if tables:
        rows = filter_tables(rows, tables).unionByName(rows.where(F.col("table").isNull()))
    unknown = tagged.where(F.col("kind") == "unknown").select("slot", "pos", "msg", "kind")
    decoded = decode_tuples(rows, compat).unionByName(unknown, allowMissingColumns=True)
    return images(with_problems(decoded))
