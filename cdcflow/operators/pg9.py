"""Decode the self-describing message form: each row change carries its own table and columns."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcflow.functions.wire import Batch, Texts, no_rows, read_strings, read_tuple, spread, text_array, tuple_lists
from cdcflow.operators.envelope import images
from cdcflow.operators.filters import filter_category, filter_tables
from cdcflow.operators.pgoutput import LOG_EPOCH_MILLIS, ROW_KINDS, big_endian, tag_messages, with_problems
from cdcflow.operators.positions import WHOLE, Slices, carry

# Section letters of a row change.
COLUMNS, NO_KEY, KEY_LIST, NEW_TUPLE, OLD_TUPLE, NO_OLD, TUPLE = (ord(c) for c in "CPMNKET")

_CHANGE = T.StructType(
    [
        T.StructField("schema", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("names", T.ArrayType(T.StringType())),
        T.StructField("types", T.ArrayType(T.StringType())),
        T.StructField("old", T.ArrayType(T.StringType())),
        T.StructField("new", T.ArrayType(T.StringType())),
        T.StructField("kept", T.ArrayType(T.BooleanType())),
        T.StructField("ok", T.BooleanType()),
    ]
)


class _Rounds:
    """A section may sit anywhere in a message: gather each row's first one over the rounds."""

    def __init__(self) -> None:
        self.rows: list[np.ndarray] = []
        self.texts: list[list[Texts]] = []

    def add(self, rows: np.ndarray, *texts: Texts) -> None:
        self.rows.append(rows)
        self.texts.append(list(texts))

    def merged(self, n_lists: int) -> tuple[np.ndarray, list[Texts]]:
        if not self.rows:
            empty = np.zeros((0, 0), np.int64)
            return no_rows(), [Texts(no_rows(), empty.astype(np.uint8), empty, empty, no_rows() == 0) for _ in range(n_lists)]
        rows = np.concatenate(self.rows)
        _, order = np.unique(rows, return_index=True)
        out = []
        for i in range(n_lists):
            parts = [t[i] for t in self.texts]
            width = max(p.kind.shape[1] for p in parts)

            def grow(a: np.ndarray) -> np.ndarray:
                return np.pad(a, ((0, 0), (0, width - a.shape[1])))

            out.append(
                Texts(
                    np.concatenate([p.count for p in parts])[order],
                    np.concatenate([grow(p.kind) for p in parts])[order],
                    np.concatenate([grow(p.start) for p in parts])[order],
                    np.concatenate([grow(p.size) for p in parts])[order],
                    np.concatenate([p.whole for p in parts])[order],
                )
            )
        return rows[order], out


@F.arrow_udf(_CHANGE)
def _read_change(msgs: pa.Array) -> pa.Array:
    batch = Batch.of(msgs)
    everyone = np.arange(len(batch))
    one = np.ones(len(batch), np.int64)
    (schema,), pos = read_strings(batch, everyone, batch.start + 1, one, pairs=False)
    (table,), pos = read_strings(batch, everyone, pos, one, pairs=False)
    columns, new, old = _Rounds(), _Rounds(), _Rounds()
    good = np.ones(len(batch), bool)
    live = everyone[pos < batch.end]
    while len(live):
        letter = batch.uint(pos[live], 1)
        pos[live] += 1
        for section in np.unique(letter):
            rows = live[letter == section]
            if section == COLUMNS:
                count = batch.room(rows, pos[rows], batch.uint(pos[rows], 2))
                (names, types), pos[rows] = read_strings(batch, rows, pos[rows] + 2, count, pairs=True)
                good[rows] &= names.whole
                columns.add(rows, names, types)
            elif section == KEY_LIST:
                count = batch.room(rows, pos[rows], batch.uint(pos[rows], 2))
                _, pos[rows] = read_strings(batch, rows, pos[rows] + 2, count, pairs=False)
            elif section in (NEW_TUPLE, OLD_TUPLE):
                given = batch.uint(pos[rows], 1) == TUPLE
                pos[rows] += 1
                rows = rows[given]
                texts, pos[rows] = read_tuple(batch, rows, pos[rows], count_width=4, nul=1)
                good[rows] &= texts.whole
                (new if section == NEW_TUPLE else old).add(rows, texts)
            elif section not in (NO_KEY, NO_OLD):
                good[rows] = False
                pos[rows] = batch.end[rows]
        live = live[pos[live] < batch.end[live]]
    good &= pos == batch.end

    col_rows, (names, types) = columns.merged(2)
    lists = [spread(len(batch), col_rows, t, text_array(batch, *t.flat())) for t in (names, types)]
    new_rows, (new_texts,) = new.merged(1)
    old_rows, (old_texts,) = old.merged(1)
    new_values, kept = tuple_lists(batch, new_rows, new_texts)
    old_values, _ = tuple_lists(batch, old_rows, old_texts)
    heads = [text_array(batch, *t.flat()) for t in (schema, table)]
    return pa.StructArray.from_arrays(
        [*heads, *lists, old_values, new_values, kept, pa.array(good)],
        ["schema", "table", "names", "types", "old", "new", "kept", "ok"],
    )


def decode_pg9(messages: DataFrame, cat: str = "insert,update,delete", *, slices: Slices = WHOLE) -> DataFrame:
    """Row changes with names, types and tuples; the last BEGIN gives lsn, ts and xid."""
    tagged = tag_messages(messages)
    wanted = {c.strip().lower() for c in cat.split(",")}
    useful = [k for k in ROW_KINDS if k in wanted]
    m = F.col("msg")
    begin = F.struct(
        big_endian(m, 6, 8).alias("lsn"),
        (F.floor(big_endian(m, 14, 8) / 1000) + LOG_EPOCH_MILLIS).cast("long").alias("ts"),
        big_endian(m, 22, 4).alias("xid"),
    )
    slim = tagged.where(F.col("kind").isin("begin", *useful))
    placed = carry(slim, ["slot"], "pos", begin, F.col("kind") == "begin", "_txn", slices=slices)
    rows = placed.where(F.col("kind") != "begin").withColumn("_c", _read_change("msg"))
    names = F.filter(F.transform("_c.names", lambda n, i: F.when(F.get("_c.kept", i), n)), lambda n: n.isNotNull())
    return rows.select(
        "slot", "pos", "kind", "_txn.lsn", "_txn.ts", "_txn.xid", "_c.schema", "_c.table", "_c.names", "_c.types",
        "_c.old", "_c.new", F.coalesce(names, F.array().cast("array<string>")).alias("unchanged"), "_c.ok", "msg",
    )


def pg9_changes(
    messages: DataFrame, cat: str = "insert,update,delete", tables: Sequence[str] | None = None, *, slices: Slices = WHOLE
) -> DataFrame:
    """Change events of the self-describing form."""
    rows = filter_category(decode_pg9(messages, cat, slices=slices), cat, "kind")
    return images(filter_tables(rows, tables) if tables else rows)


def pg9_events(
    messages: DataFrame, cat: str = "insert,update,delete", tables: Sequence[str] | None = None, *, slices: Slices = WHOLE
) -> DataFrame:
    """``pg9_changes`` that loses nothing: unknown and damaged messages come along with errors."""
    rows = decode_pg9(messages, cat, slices=slices)
    if tables:
        rows = filter_tables(rows, tables).unionByName(rows.where(F.col("table").isNull() | ~F.col("ok")))
    unknown = tag_messages(messages).where(F.col("kind") == "unknown").select("slot", "pos", "msg", "kind")
    return images(with_problems(rows.unionByName(unknown, allowMissingColumns=True)))
