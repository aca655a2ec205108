"""Column-wise readers of binary log messages: one NumPy step per field, not per row.

A batch of messages is one byte buffer.  A cursor per message moves over it, so the loops below
run over fields (columns of a tuple, sections of a message) while every row advances at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_PAD = 16


@dataclass
class Batch:
    """Byte buffer of a batch and the bounds of each message in it."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @classmethod
    def of(cls, msgs: pa.Array) -> "Batch":
        msgs = msgs.combine_chunks() if isinstance(msgs, pa.ChunkedArray) else msgs
        msgs = msgs.cast(pa.large_binary())
        offsets = np.frombuffer(msgs.buffers()[1], dtype=np.int64)[msgs.offset : msgs.offset + len(msgs) + 1]
        raw = msgs.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
        data = np.concatenate([data, np.zeros(_PAD, np.uint8)])
        return cls(data, offsets[:-1].copy(), offsets[1:].copy())

    def __len__(self) -> int:
        return len(self.start)

    def room(self, rows: np.ndarray, pos: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Counts cut to the bytes left, so that a damaged count cannot run on."""
        return np.minimum(count, np.maximum(self.end[rows] - pos, 0))

    def uint(self, pos: np.ndarray, width: int) -> np.ndarray:
        """Big-endian numbers; a cursor past the buffer reads the zero padding."""
        pos = np.minimum(pos, len(self.data) - _PAD)
        out = np.zeros(len(pos), np.int64)
        for i in range(width):
            out = (out << 8) | self.data[pos + i]
        return out


@dataclass
class Texts:
    """Slots laid out per row: where each text lies, what kind of slot it is, and no length cut."""

    count: np.ndarray
    kind: np.ndarray
    start: np.ndarray
    size: np.ndarray
    whole: np.ndarray

    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        width = self.kind.shape[1]
        used = np.arange(width)[None, :] < self.count[:, None]
        return self.kind[used], self.start[used], self.size[used]


def _bound(batch: Batch, rows: np.ndarray, pos: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sizes cut so that a damaged length cannot read past its message."""
    return np.clip(size, 0, np.maximum(batch.end[rows] - pos, 0))


def read_tuple(batch: Batch, rows: np.ndarray, pos: np.ndarray, *, count_width: int, nul: int) -> tuple[Texts, np.ndarray]:
    """Tuples at ``pos`` of the given rows: per column t (length, text), n (null) or u (not resent).

    ``nul`` is the number of end bytes a text carries inside its length.
    """
    n = len(rows)
    told = batch.uint(pos, count_width)
    count = np.minimum(told, np.maximum(batch.end[rows] - pos - count_width, 0))
    whole = count == told
    pos = pos + count_width
    width = int(count.max()) if n else 0
    kind = np.zeros((n, width), np.uint8)
    start = np.zeros((n, width), np.int64)
    size = np.zeros((n, width), np.int64)
    for c in range(width):
        live = np.flatnonzero(count > c)
        p = pos[live]
        k = batch.uint(p, 1).astype(np.uint8)
        is_text = k == ord("t")
        told = np.where(is_text, batch.uint(p + 1, 4), 0)
        length = _bound(batch, rows[live], p + 5, told)
        whole[live] &= (length == told) & (is_text | (k == ord("n")) | (k == ord("u")))
        kind[live, c], start[live, c] = k, np.minimum(p + 1 + 4 * is_text, batch.end[rows[live]])
        size[live, c] = np.where(is_text, np.maximum(length - nul, 0), 0)
        pos[live] = p + 1 + np.where(is_text, 4 + length, 0)
    return Texts(count, kind, start, size, whole), pos


def read_strings(batch: Batch, rows: np.ndarray, pos: np.ndarray, count: np.ndarray, pairs: bool) -> tuple[list[Texts], np.ndarray]:
    """Lists of short length-prefixed, NUL-ended texts; with ``pairs`` a second text follows a non-empty first."""
    n = len(rows)
    width = int(count.max()) if n else 0
    shape = (n, width)
    whole = np.ones(n, bool)
    out = [
        Texts(count, np.zeros(shape, np.uint8), np.zeros(shape, np.int64), np.zeros(shape, np.int64), whole)
        for _ in range(1 + pairs)
    ]
    for c in range(width):
        live = np.flatnonzero(count > c)
        present = np.ones(len(live), bool)
        for texts in out:
            p = pos[live]
            told = np.where(present, batch.uint(p, 2), 0)
            told = np.where(told >= 32768, 0, told)
            length = _bound(batch, rows[live], p + 2, told)
            whole[live] &= length == told
            given = length > 0
            texts.kind[live, c] = np.where(given, ord("t"), ord("n"))
            texts.start[live, c] = np.minimum(p + 2, batch.end[rows[live]])
            texts.size[live, c] = np.maximum(length - 1, 0)
            pos[live] = p + np.where(present, 2 + length, 0)
            present = present & given
    return out, pos


def text_array(batch: Batch, kind: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """Arrow strings of the texts; every kind but ``t`` is null.

    Texts lie in the buffer in row order, so texts and the gaps between them are one string array
    over the same bytes; taking every other element copies just the texts.
    """
    n = len(kind)
    if n == 0:
        return pa.array([], pa.string())
    valid = kind == ord("t")
    offsets = np.empty(2 * n + 1, np.int64)
    offsets[0:-1:2] = start
    offsets[1::2] = start + np.where(valid, size, 0)
    offsets[-1] = offsets[-2]
    pieces = pa.Array.from_buffers(
        pa.large_string(), 2 * n, [None, pa.py_buffer(offsets), pa.py_buffer(batch.data)]
    )
    return pieces.take(pa.array(np.arange(n) * 2, mask=~valid)).cast(pa.string())


def spread(n: int, rows: np.ndarray, texts: Texts, values: pa.Array) -> pa.Array:
    """Per-row lists for the whole batch: null for rows that hold no such tuple."""
    counts = np.zeros(n, np.int64)
    counts[rows] = texts.count
    has = np.zeros(n, bool)
    has[rows] = True
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=pa.array(~has))


def tuple_lists(batch: Batch, rows: np.ndarray, texts: Texts) -> tuple[pa.Array, pa.Array]:
    """(values, not resent) lists of the tuples of some rows, aligned with the whole batch."""
    kind, start, size = texts.flat()
    values = spread(len(batch), rows, texts, text_array(batch, kind, start, size))
    marks = spread(len(batch), rows, texts, pa.array(kind == ord("u")))
    return values, marks


def no_rows() -> np.ndarray:
    return np.zeros(0, np.int64)
