"""Periodic runs of words: seeds of guaranteed overlap find them, exact comparison along a lag extends them."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.functions.plan import once
from cdcflow.llm.common import SPACE, byte_chunks, small_batches

Run = tuple[int, int, int]
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def seed_classes(n: int, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """(low, high, seed): lags low..high are found through ``seed``-word seeds, for all lags a text of ``n`` words allows.

    A run of period q has max(least, times * q) words, so it agrees with itself moved by q over that
    less q words; the smallest such overlap over all lags from ``low`` on is the seed.  Lags up to the
    seed belong to the class: a window as long as the period comes back after one period and not before.
    """
    low = 1
    while max(least, times * low) <= n:
        seed = min(max(least, times * q) - q for q in range(low, max(low, -(-least // times)) + 1))
        yield low, seed, seed
        low = seed + 1


def _ranked(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dense ranks of codes, positions ordered by (code, position), and whether each of these equals the next."""
    order = np.argsort(code, kind="stable")
    same = np.diff(code[order]) == 0
    rank = np.empty(len(code), np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(~same)])
    return rank, order, same


def _alike(x: np.ndarray, y: np.ndarray) -> int:
    """How many leading elements of two arrays of one length agree."""
    at, step = 0, 64
    while at < len(x):
        differ = x[at : at + step] != y[at : at + step]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, 2 * step
    return len(x)


def find_runs(words: np.ndarray, least: int = 6, times: int = 4) -> list[Run]:
    """All maximal runs (start, length, smallest period) of a sequence of word numbers, by start, then period.

    A seed's occurrences are taken with their next one only, so there are no more pairs than words.
    Ranks of seeds are built from ranks of shorter ones and are exact.  The table ``reached`` holds, for
    each lag, how far runs of that lag have been followed: later seeds inside are passed over.
    """
    n, found = len(words), []
    rank, order, same = _ranked(words)
    width = 1
    for low, high, seed in seed_classes(n, least, times):
        while width < seed and same.any():
            more = min(width, seed - width)
            code = rank[: n - width - more + 1] * (n + 1) + rank[more : n - width + 1]
            width += more
            rank, order, same = _ranked(code)
        if not same.any():
            break
        at, lag = order[:-1][same], np.diff(order)[same]
        wanted = (lag >= low) & (lag <= high)
        at, lag = at[wanted], lag[wanted]
        by = np.lexsort((at, lag))
        at, lag = at[by], lag[by]
        first = np.ones(len(at), bool)
        first[1:] = (np.diff(at) != 1) | (np.diff(lag) != 0)
        reached: dict[int, int] = {}
        for i, q in zip(at[first].tolist(), lag[first].tolist(), strict=True):
            if i < reached.get(q, 0):
                continue
            end = i + _alike(words[i : n - q], words[i + q :])
            start = i - _alike(words[:i][::-1], words[q : i + q][::-1])
            reached[q] = end
            if end - start + q >= max(least, times * q):
                found.append((start, end - start + q, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _numbered(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def _listed(runs: list[list[Run]]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
    flat = np.array([x for r in runs for x in r], np.int64).reshape(-1, 3)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(_RUN)))


def periodic_runs(documents: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per input row.

    ``runs`` lists start, length and period of every stretch of consecutive words with smallest period
    q and at least max(``least``, ``times`` * q) words that no neighbouring word extends; by start, then
    period.  ``collapsed`` keeps, of each run, its first q words, joined by one space; a word that any
    run covers after its first q words goes.

    Words are what white space (tab to carriage return, space) separates, unchanged.  Null and empty
    texts and texts of white space have no words, no runs and an empty result.  Ids may be null or
    repeated: every row is looked at by itself.  Extra columns are not read; an empty table gives no
    rows.  Texts never leave their task, so nothing is shuffled and no key can be hot.
    """
    if times < 3 or least < 1:
        raise ValueError("runs need three periods or more")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("content").to_pylist()
            for a, b in byte_chunks(texts, len):
                counts, runs, collapsed = [], [], []
                for text in texts[a:b]:
                    words = text.split()
                    here = find_runs(_numbered(words), least, times) if len(words) >= least else []
                    counts.append(len(words))
                    runs.append(here)
                    if here:
                        kept = np.ones(len(words), bool)
                        for start, length, period in here:
                            kept[start + period : start + length] = False
                        words = compress(words, kept.tolist())
                    collapsed.append(b" ".join(words))
                columns = [batch.column("doc_id").slice(a, b - a), pa.array(counts, pa.int64()), _listed(runs), pa.array(collapsed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    content = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    found = small_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), content.alias("content")).mapInArrow(
        search, "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary"
    )
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def run_digests(found: DataFrame) -> DataFrame:
    """Per row of ``periodic_runs``: number of runs, the run of greatest length / period, digests of runs and collapsed text.

    Quotients are compared exactly, crosswise; of equal ones the smallest start, then period, counts.
    """
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    best = F.aggregate("runs", none, lambda best, r: F.when(better(best, r), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    return found.select("doc_id", "runs", "collapsed", best.alias("best"), lines.alias("lines")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("lines", lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """(doc_id, text) with periodic ends in a tenth of the texts, chosen by the CRC of the decimal id.

    With h the CRC, g = h div 10, n words and h mod 10 = 0, the words from a = g mod n on repeat with
    period 1 + (n - a) div (3 + g mod 8).  Other texts, and rows without id, stay as they are.
    """
    code = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    rows = once(documents.select("doc_id", "text"), {"g": F.expr("crc32(cast(doc_id as string)) div 10"), "words": F.when(code % 10 == 0, words)})
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    moved = lambda i: F.when(i >= F.col("a"), F.col("a") + (i - F.col("a")) % F.col("p")).otherwise(i).cast("int")
    planted = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1), lambda i: F.get("words", moved(i))), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))
