"""Helpers shared by the operators: inputs, stored tables, word arrays."""

from __future__ import annotations

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The bytes between words, as a Java and as a DuckDB pattern.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, or an empty one when nothing has been written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
            raise
        return spark.createDataFrame([], schema)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character left as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (multiply and shift, three rounds)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _byte_codes() -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_CODES = _byte_codes()
_BASE = 0xA0761D6478BD642F  # odd, so it has an inverse modulo 2**64


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.empty(n, np.uint64)
    out[:1] = 1
    done = 1
    with np.errstate(over="ignore"):
        while done < n:
            more = min(done, n - done)
            out[done : done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
            done += more
    return out


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes one after the other, start and end of every word in them, and the number of words of each text."""
    joined = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    firsts = np.concatenate([[0], np.cumsum(lengths + 1)])
    space = _IS_SPACE[joined]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return joined, start, end, np.diff(np.searchsorted(start, firsts))


def span_hashes(letters: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings between starts and ends.

    A string's hash is a polynomial in its bytes, taken from running sums, so the whole batch needs a
    few vector operations and no loop over words.
    """
    with np.errstate(over="ignore"):
        value = _CODES[letters]
        value *= _powers(_BASE, len(letters))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
        back = _powers(pow(_BASE, -1, 1 << 64), len(letters))[start] if len(start) else np.zeros(0, np.uint64)
        return mix64((sums[end] - sums[start]) * back + (end - start).astype(np.uint64))


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts, in order (lower-cased, unless told otherwise), and the number of words of each text."""
    joined, start, end, counts = word_spans(texts)
    return span_hashes(_LOWER[joined] if lower else joined, start, end), counts


def byte_chunks(items: list, size, limit: int = 2 << 20):
    """Consecutive slices of about ``limit`` bytes, at least one item each."""
    at = total = 0
    for i, item in enumerate(items):
        if i > at and total + size(item) > limit:
            yield at, i
            at, total = i, 0
        total += size(item)
    if at < len(items):
        yield at, len(items)


#: Bytes that a Python worker is given at once, where the session does not ask for fewer.
BATCH_BYTES = 4 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that hands Python workers batches of ``BATCH_BYTES`` instead of ten thousand whole texts."""
    conf = df.sparkSession.conf
    now = conf.get(_BATCH_KEY).removesuffix("b")
    if now.isdigit() and int(now) > BATCH_BYTES:
        conf.set(_BATCH_KEY, str(BATCH_BYTES))
    return df


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it was counted to hold ``rows`` rows at most; as it is otherwise."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
