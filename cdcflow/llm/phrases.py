"""Phrase collocations: the longest windows are counted, ROLLUP sums their shorter beginnings."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcflow.llm.common import byte_chunks, mix64, small, small_batches, span_hashes, word_spans
from cdcflow.session import materialize

#: Bytes of text that a task counts together before it hands on what it found.
CHUNK = 4 << 20
#: Words of the corpus whose windows make one bucket; a bucket is sorted in one task.
BUCKET_WORDS = 800_000
#: Windows that a chunk has for a bucket, on average, at least; in a large corpus both grow with its root.
ROW_WINDOWS = 20
#: Frequent words that may be broadcast, to spell phrases and to end windows at others; beyond, the joins shuffle and windows go on.
BROADCAST_WORDS = 500_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: A-Z in lower case, and all that ends a piece as a line feed.
_FOLD = bytes(10 if chr(b) in ".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))


@dataclass(frozen=True)
class Params:
    """Phrases of 2 to ``longest`` words that occur ``least`` times; ``top`` of each language.

    A beginning of a window that makes up more than ``share`` of all windows is cut into parts by its
    following words, so that no bucket holds all of it.  There are 2 / ``share`` such at most.
    """

    longest: int = 4
    least: int = 30
    top: int = 2000
    inside: int = 80
    share: float = 0.001

    @property
    def columns(self) -> list[str]:
        return [f"w{i + 1}" for i in range(self.longest)]


def _language_codes(langs: list[str]) -> np.ndarray:
    known = {x: np.uint64(int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little")) for x in set(langs)}
    return np.array([known[x] for x in langs], np.uint64)


def _chunk_words(langs: list[str], texts: list[bytes], places: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of language and word, piece numbers and text numbers of all words of a chunk; ``places`` is told where the words are."""
    codes, pieces, owners, last = [], [], [], 0
    own = _language_codes(langs)
    for a, b in byte_chunks(texts, len):
        joined, start, end, counts = word_spans([t.translate(_FOLD) for t in texts[a:b]])
        owner = np.repeat(np.arange(a, b, dtype=np.int32), counts)
        with np.errstate(over="ignore"):
            codes.append(np.maximum(mix64(span_hashes(joined, start, end) + own[owner]), np.uint64(1)))
        piece = np.cumsum(joined == 10, dtype=np.int32)[start] + owner + np.int32(last)
        last = int(piece[-1]) + 1 - a if len(piece) else last
        pieces.append(piece)
        owners.append(owner)
        if places is not None:
            places.append((joined, start.astype(np.int32), end.astype(np.int32)))
    return np.concatenate(codes), np.concatenate(pieces), np.concatenate(owners)


def _chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list[str], list[bytes]]]:
    langs: list[str] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        more, words = batch.column("lang").to_pylist(), batch.column("content").to_pylist()
        for a, b in byte_chunks(words, len):
            langs += more[a:b]
            texts += words[a:b]
            size += sum(map(len, words[a:b]))
            if size >= limit:
                yield langs, texts
                langs, texts, size = [], [], 0
    if texts:
        yield langs, texts


def _leads(codes: np.ndarray, pieces: np.ndarray, longest: int) -> list[np.ndarray]:
    """Lead columns: the word at every place and its followers in the piece; zero pads what lies behind its end or a word of code zero."""
    out = [codes]
    for k in range(1, longest):
        lead = np.zeros(len(codes), codes.dtype)
        inside = (pieces[k:] == pieces[: len(codes) - k]) & (out[-1][: len(codes) - k] > 0)
        lead[: len(codes) - k] = np.where(inside, codes[k:], codes.dtype.type(0))
        out.append(lead)
    return out


def _prefix_codes(leads: list[np.ndarray]) -> list[np.ndarray]:
    """A code for the first two, three, ... columns."""
    with np.errstate(over="ignore"):
        out = [leads[0]]
        for w in leads[1:]:
            out.append(mix64(out[-1] * _STEP + w))
    return out[1:]


def _content(documents: DataFrame) -> DataFrame:
    return small_batches(documents).select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("content"))


def vocabulary(documents: DataFrame, p: Params) -> DataFrame:
    """Stored rows (kind, code, lang, word, n, of): words with their counts (kind 0), and beginnings of two or more words
    (kind 2, ...) that make up ``share`` / 2 of a chunk, with their counts in such chunks.

    What makes up ``share`` of all windows has half of its windows in chunks where it makes up ``share`` / 2.
    """
    schema = pa.schema([("kind", pa.int32()), ("code", pa.int64()), ("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])
    chunk = CHUNK

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in _chunks(batches, chunk):
            places: list = []
            codes, pieces, owners = _chunk_words(langs, texts, places)
            if not len(codes):
                continue
            found, at, back, n = np.unique(codes, return_index=True, return_inverse=True, return_counts=True)
            firsts = np.concatenate([[0], np.cumsum([len(start) for _, start, _ in places])])
            part = np.searchsorted(firsts, at, "right") - 1
            words = []
            for i, k in zip((at - firsts[part]).tolist(), part.tolist(), strict=True):
                joined, start, end = places[k]
                words.append(joined[start[i] : end[i]].tobytes())
            spoken = pa.array([langs[i] for i in owners[at].tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(found), np.int32)), pa.array(found.view(np.int64)), spoken, pa.array(words, pa.binary()), pa.array(n)], schema=schema)
            often = max(p.share / 2 * len(codes), 1)
            able = np.concatenate([n[back] >= often, np.zeros(p.longest, bool)])
            leads = _leads(codes, pieces, p.longest)
            for k, code in enumerate(_prefix_codes(leads)[:-1], 2):
                able = able[:-1] & able[1:]
                heavy, m = np.unique(code[able[: len(code)] & (leads[k - 1] > 0)], return_counts=True)
                heavy, m = heavy[m >= often], m[m >= often]
                nothing = pa.nulls(len(heavy))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(heavy), k, np.int32)), pa.array(heavy.view(np.int64)), nothing.cast(pa.string()), nothing.cast(pa.binary()), pa.array(m)], schema=schema)

    counted = _content(documents).mapInArrow(count, "kind int, code bigint, lang string, word binary, n bigint")
    counted = counted.withColumn("word", F.col("word").cast("string"))
    return materialize(counted.groupBy("kind", "code", "lang", "word").agg(F.sum("n").alias("n")), "vocabulary")


def _window_schema(p: Params) -> pa.Schema:
    lists = [(f"{c}_{part}", pa.list_(kind)) for c in p.columns for part, kind in (("low", pa.int16()), ("high", pa.int8()))]
    return pa.schema([("bucket", pa.int64()), ("words", pa.list_(pa.int64())), *lists, ("n", pa.list_(pa.int32()))])


def _numbered(leads: list[np.ndarray], ends: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The columns as numbers in the list of the codes that each row, up to its end, uses; and these lists."""
    known, numbers = np.unique(np.concatenate(leads), return_inverse=True)
    numbers = numbers.reshape(len(leads), -1)
    here, words = np.zeros(len(known), bool), []
    for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
        part = numbers[:, a:b]
        here[:] = False
        here[part] = True
        words.append(known[here].view(np.int64))
        numbers[:, a:b] = (np.cumsum(here) - 1)[part]
    return list(numbers), words


def windows(documents: DataFrame, heavy: list[np.ndarray], buckets: int, chunk: int, p: Params, common: Broadcast | None = None) -> DataFrame:
    """(bucket, words, w1_low, w1_high, ..., n): distinct windows of two words or more and their counts, of one chunk and bucket each.

    The windows hold numbers of words, as two parts of which the higher is mostly zero and so takes no
    room.  With the frequent words at hand (``common``: their codes in order, their places by
    falling frequency) these are places, counted from one, and other words end a window like the end of a
    piece; without them, places in ``words``, the codes that the row uses.  Windows with one beginning of
    two words share a bucket; those of a heavy beginning are dealt by one more word.
    """
    schema = _window_schema(p)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in _chunks(batches, chunk):
            codes, pieces, _ = _chunk_words(langs, texts)
            ids = None
            if common is not None:
                known, places = common.value
                near = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
                found = known[near] == codes if len(known) else np.zeros(len(codes), bool)
                codes, ids = np.where(found, codes, np.uint64(0)), np.where(found, places[near] if len(known) else 0, 0).astype(np.int32)
            leads = _leads(codes, pieces, p.longest)
            pairs = leads[1] > 0
            leads = [w[pairs] for w in leads]
            if not len(leads[0]):
                continue
            prefixes = _prefix_codes(leads)
            deal = prefixes[0]
            for k, known in enumerate(heavy):
                deal = np.where(np.isin(prefixes[k], known) & (deal == prefixes[k]), prefixes[k + 1], deal)
            bucket = (deal >> np.uint64(33)).astype(np.int64) % buckets
            order = np.lexsort((prefixes[-1], leads[0], bucket))
            numbers = None if ids is None else [w[pairs][order] for w in _leads(ids, pieces, p.longest)]
            del prefixes, deal, codes, pieces, pairs
            leads, bucket = [w[order] for w in leads], bucket[order]
            first = np.ones(len(order), bool)
            first[1:] = np.logical_or.reduce([w[1:] != w[:-1] for w in leads])
            at = np.flatnonzero(first)
            n, bucket = np.diff(np.append(at, len(order))).astype(np.int32), bucket[at]
            ends = np.append(np.flatnonzero(np.diff(bucket)) + 1, len(bucket))
            words = [np.zeros(0, np.int64)] * len(ends)
            if numbers is None:
                numbers, words = _numbered([w[at] for w in leads], ends)
            else:
                numbers = [x[at] for x in numbers]
            edges = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            sizes = pa.array(np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(sizes, pa.array(np.concatenate(words)))]
            for x in numbers:
                lists += [pa.ListArray.from_arrays(edges, pa.array(half)) for half in ((x & 0x7FFF).astype(np.int16), (x >> 15).astype(np.int8))]
            lists.append(pa.ListArray.from_arrays(edges, pa.array(n)))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[ends - 1]), *lists], schema=schema)

    halves = ", ".join(f"{c}_low array<smallint>, {c}_high array<tinyint>" for c in p.columns)
    return _content(documents).mapInArrow(count, f"bucket bigint, words array<bigint>, {halves}, n array<int>")


def _groups(columns: list[np.ndarray]) -> np.ndarray:
    """Starts of the groups of equal rows in sorted columns."""
    first = np.ones(len(columns[0]), bool)
    first[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(first)


def frequent_windows(found: DataFrame, heavy: list[np.ndarray], p: Params, common: Broadcast | None = None) -> DataFrame:
    """(w1, ..., n): windows cut to their longest beginning that occurs ``least`` times, with the counts of those cut alike.

    A bucket holds all windows of its beginnings, so the counts decide.  A heavy beginning lies in many
    buckets; it is frequent anyway, and windows are never cut shorter than it.  Windows whose first two
    words are rarer are of no use to any phrase.
    """
    schema = pa.schema([*((c, pa.int64()) for c in p.columns), ("n", pa.int64())])

    def cut(table: pa.Table) -> pa.Table:
        flat = lambda c: table.column(c).combine_chunks().flatten().to_numpy()
        sizes = lambda c: table.column(c).combine_chunks().value_lengths().to_numpy()
        n = flat("n").astype(np.int64)
        if common is None:
            codes, base = flat("words"), np.repeat(np.concatenate([[0], np.cumsum(sizes("words"))[:-1]]), sizes("n"))
        else:
            known, places = common.value
            codes, base = np.zeros(len(known) + 1, np.int64), 0
            codes[places] = known.view(np.int64)
        words = [codes[base + flat(f"{c}_low") + (flat(f"{c}_high").astype(np.int64) << 15)] for c in p.columns]
        order = np.lexsort(words[::-1])
        words, n = [w[order] for w in words], n[order]
        at = _groups(words)
        words, n = [w[at] for w in words], np.add.reduceat(n, at)
        codes = _prefix_codes([w.view(np.uint64) for w in words])
        depth = np.zeros(len(n), np.int64)
        groups = {}
        for k in range(2, p.longest + 1):
            groups[k] = at = _groups(words[:k])
            enough = np.repeat(np.add.reduceat(n, at), np.diff(np.append(at, len(n)))) >= p.least
            if k - 2 < len(heavy):
                enough |= np.isin(codes[k - 2], heavy[k - 2])
            depth[enough & (words[k - 1] != 0)] = k
        rows = []
        for k, at in groups.items():
            total = np.add.reduceat(np.where(depth == k, n, 0), at)
            wanted = at[total > 0]
            rows.append([*(w[wanted] if i < k else np.zeros(len(wanted), np.int64) for i, w in enumerate(words)), total[total > 0]])
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)], schema=schema)

    names = ", ".join(f"{c} bigint" for c in p.columns)
    return found.groupBy("bucket").applyInArrow(cut, f"{names}, n bigint")


def phrase_counts(documents: DataFrame, words: DataFrame, p: Params) -> DataFrame:
    """Stored (w1, ..., f): all phrases of two words or more that occur ``least`` times; zero pads shorter ones."""
    total = words.where("kind = 0").agg(F.sum("n")).first()[0] or 0
    rows = words.where(F.col("kind") > 0).where(F.col("n") >= p.share / 2 * total).select("kind", "code").collect()
    heavy = [np.array([r["code"] for r in rows if r["kind"] == k], np.int64).view(np.uint64) for k in range(2, p.longest)]
    together = (ROW_WINDOWS * total) ** 0.5
    buckets, chunk = max(1, int(total / max(BUCKET_WORDS, together))), max(CHUNK, int(6 * together))
    often = words.where(F.col("kind") == 0).where(F.col("n") >= p.least).select("code", "n")
    known = [(r["code"], r["n"]) for r in often.limit(BROADCAST_WORDS + 1).collect()]
    common = None
    if len(known) <= BROADCAST_WORDS:
        codes = np.array([c for c, _ in known], np.int64).view(np.uint64)
        order = np.argsort(codes)
        places = np.empty(len(codes), np.int64)
        places[np.argsort([-n for _, n in known], kind="stable")] = np.arange(1, len(codes) + 1)
        common = documents.sparkSession.sparkContext.broadcast((codes[order], places[order]))
    found = windows(documents, heavy, buckets, chunk, p, common)
    summed = frequent_windows(found, heavy, p, common).rollup(*p.columns).agg(F.sum("n").alias("f")).where(F.col("f") >= p.least)
    whole = F.col("w2").isNotNull()
    for c in p.columns[1:]:
        whole &= F.col(c).isNull() | (F.col(c) != 0)
    return materialize(summed.where(whole).select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in p.columns], "f"), "phrases")


def _part(p: Params, first: int, last: int, names: str) -> list[Column]:
    """Words ``first`` to ``last`` - 1 of a phrase as columns of their own, padded."""
    inside = [F.col(p.columns[i]) if first <= i < last else F.lit(0).cast("long") for i in (*range(first, last), *[-1] * (p.longest - last + first))]
    return [c.alias(f"{names}{i + 1}") for i, c in enumerate(inside)]


def _explained(table: DataFrame, p: Params, parts) -> DataFrame:
    """One row for each part that ``parts(length)`` lists of a phrase, by its length."""
    length = sum((F.col(c) != 0).cast("int") for c in p.columns)
    listed = F.lit(None)
    for m in range(p.longest, 1, -1):
        if made := [F.struct(*x) for x in parts(m)]:
            listed = F.when(length == m, F.array(*made)).otherwise(listed)
    return table.withColumn("part", F.explode(listed))


def collocations(documents: DataFrame, p: Params = Params()) -> DataFrame:  # noqa: B008
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of every language.

    Texts are lower-cased (A-Z) and cut at ``.,;:!?`` and line ends into pieces, pieces at spaces and
    tabs into words; phrases lie inside pieces, occurrences may overlap.  Of a phrase with ``a``
    occurrences, the cut into two parts with counts l and r counts that scores lowest by
    floor(2000000 a / (l + r)), of equal ones the earliest.  A phrase inside a longer one that has
    ``inside`` percent of its occurrences is dropped.  Order: score, a (both falling), phrase in byte
    order.  Scores are divided as decimals of 38 digits.

    Null language: ``und``; null and empty texts have no words; ids are not read, so repeated rows count
    each; extra columns are not read; an empty table gives no rows.  Words are compared by 64-bit codes.
    """
    words = vocabulary(documents, p)
    spelled = words.where("kind = 0")
    common = spelled.where(F.col("n") >= p.least).select("code", "lang", "word", "n")
    phrases = phrase_counts(documents, words, p)
    zero = F.lit(0).cast("long")
    counts = phrases.union(common.select("code", *[zero] * (p.longest - 1), "n"))
    cuts = _explained(phrases, p, lambda m: [[F.lit(k).alias("k"), *_part(p, 0, k, "l"), *_part(p, k, m, "r")] for k in range(1, m)])
    cuts = cuts.select(*p.columns, F.col("f").alias("a"), "part.*")
    for side in ("l", "r"):
        keys = [f"{side}{i + 1}" for i in range(p.longest)]
        cuts = cuts.join(counts.toDF(*keys, side), keys).drop(*keys)
    score = F.expr("cast(2000000 as decimal(38,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(38,0)) + cast(r as decimal(38,0)))")
    best = cuts.withColumn("score", score).groupBy(*p.columns, "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    if p.longest > 2:
        longer = _explained(phrases, p, lambda m: [_part(p, i, j, "s") for i in range(m) for j in range(i + 2, m + 1) if j - i < m])
        longer = longer.groupBy(*[F.col(f"part.s{i + 1}").alias(c) for i, c in enumerate(p.columns)]).agg(F.max("f").alias("longer"))
        best = best.join(longer, p.columns, "left").where(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < p.inside * F.col("a")))
    read = small(common, BROADCAST_WORDS)
    for c in p.columns:
        best = best.join(read.select(F.col("code").alias(c), F.col("word").alias(f"{c}_word"), *([F.col("lang")] if c == "w1" else [])), c, "inner" if c in ("w1", "w2") else "left")
    spoken = best.select("lang", F.concat_ws(" ", *[f"{c}_word" for c in p.columns]).alias("phrase"), "a", "best.l", "best.r", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    top = spoken.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= p.top)
    sums = spelled.groupBy("lang").agg(F.sum("n").alias("n"))
    return top.join(sums, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
