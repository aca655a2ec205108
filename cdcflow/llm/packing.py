"""Packing of documents into sequences by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.common import byte_chunks, small_batches
from cdcflow.llm.encoder import Tokenizer
from cdcflow.session import materialize

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
#: Pieces placed by one task; each such shard leaves a few sequences not full.
SHARD_PIECES = 100_000


def cut_pieces(documents: DataFrame, tokenizer: Tokenizer, capacity: int = 4096, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Token ids of each text and the end id, cut at every ``capacity`` tokens.

    Null texts are empty: one piece that holds the end id.  ``with_ids`` adds the ids themselves.
    """
    names = [c.split()[0] for c in PIECES.split(", ")] + ["ids"] * with_ids
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer.open()
        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("content").to_pylist()
            for a, b in byte_chunks(texts, len):
                rows = []
                for doc_id, ids in zip(doc_ids[a:b], encoder.ids(texts[a:b]), strict=True):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)) + ((np.frombuffer(part, "<u4").tolist(),) if with_ids else ()))
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names=names)

    content = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return small_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), content.alias("content")).mapInArrow(
        cut, PIECES + ", ids array<bigint>" * with_ids
    )


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length, in the given order.

    ``open_bins[h]`` counts sequences filled to h.  A length goes where the sum of the squared counts
    becomes smallest: the count of the level it leaves falls by one and that of the level it makes
    rises by one, a full sequence leaves the sum, and a new sequence only adds.  Of equal choices
    the fullest is taken.
    """
    open_bins = np.zeros(capacity + 1, np.int64)
    members: dict[int, list[int]] = defaultdict(list)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for i, size in enumerate(lengths.tolist()):
        room = capacity - size
        level, least = 0, (2 * open_bins[size] + 1 if room else -1)
        if room:
            here = open_bins[1 : room + 1]
            change = 2 * (open_bins[1 + size :] - here) + 2
            change[-1] = 1 - 2 * here[-1]
            change[here == 0] = np.iinfo(np.int64).max
            best = room - 1 - int(np.argmin(change[::-1]))
            if change[best] <= least:
                level = best + 1
        if level:
            number = members[level].pop()
            open_bins[level] -= 1
        else:
            number, made = made, made + 1
        if level + size < capacity:
            members[level + size].append(number)
            open_bins[level + size] += 1
        sequence[i], offset[i] = number, level
    return sequence, offset


def pack_pieces(pieces: DataFrame, capacity: int = 4096, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Adds sequence_id and offset to stored pieces.

    Pieces are dealt over shards by a hash of their content and id; a shard is one group of about
    ``shard_pieces`` small rows whatever the size of the corpus, and each is packed by itself.  Within
    a shard pieces above a sixteenth of a sequence come first, in hash order, then the small ones,
    which fill the gaps that are left.  Ids, texts and counts never meet in one task.
    """
    shards = max(1, -(-pieces.count() // shard_pieces))
    code = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = pieces.withColumns({"_code": code, "_shard": F.pmod(code, F.lit(shards))})
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id bigint, offset bigint"

    def pack(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.assign(_small=shard["length"] <= capacity // 16).sort_values(["_small", "_code", "length", "start"], kind="stable")
        sequence, offset = place(shard["length"].to_numpy(), capacity)
        at = int(shard["_shard"].iloc[0])
        return shard.drop(columns=["_small", "_code", "_shard"]).assign(sequence_id=(at << 32) + sequence, offset=offset)

    return dealt.groupBy("_shard").applyInPandas(pack, schema)


def pack_documents(documents: DataFrame, tokenizer: Tokenizer, capacity: int = 4096, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Every token is in exactly one place and offsets of a sequence have no gaps.  Null ids and repeated
    rows are packed like any other row; null and empty texts are one end id; extra columns are not
    read; an empty table gives no rows.  Pieces are written once to the shared folder, because their
    number decides the number of shards.
    """
    return pack_pieces(materialize(cut_pieces(documents, tokenizer, capacity, end_id, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces packed ``with_ids``; a sequence holds at most its capacity."""
    part = F.struct("offset", "ids")
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(part)), lambda p: p["ids"])).alias("ids"))
