"""Language-model scores: context-tree weighting over bytes, and a smoothed word unigram as the base."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.common import byte_chunks, small_batches, word_hashes
from cdcflow.session import materialize

#: Bytes of context, and the depth at whose contexts the tree is cut: all below one of them lies in one partition.
DEPTH, CUT = 5, 3
#: Words that make up 1 / HEAVY of all tokens or more are broadcast: there are at most HEAVY of them, 16 bytes each.
#: Grams (a byte and its context) are from 1 / (4 * HEAVY) of all positions on: at most 64 MB.
HEAVY = 1 << 20
_HELD = 2_000_000
_CHUNK = 200_000
#: What a byte is as context: itself.
_CLASS = np.arange(256)
#: Stands before the first byte of a text.
_START = b"\x1a"


def positions(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the texts, in order, its gram; and the length of each text.

    A gram holds the byte before in its highest place, then the one before that, and so on, and the
    byte itself last, so grams in order are the leaves of the context tree in order.
    """
    gap = _START * DEPTH
    joined = np.frombuffer(gap + gap.join(texts), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    real = np.ones(len(joined), bool)
    for k in range(DEPTH):
        real[(np.cumsum(lengths + DEPTH) - lengths - DEPTH + k)] = False
    code = np.zeros(len(joined) - DEPTH, np.int64)
    for k in range(1, DEPTH + 1):
        code = code << 8 | joined[DEPTH - k : len(joined) - k]
    return (code << 8 | joined[DEPTH:])[real[DEPTH:]], lengths


def _lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 1/2: eight steps up, then Stirling's series."""
    steps = np.ones_like(x)
    for k in range(8):
        steps *= x + k
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(steps)


def _kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability of any sequence with these counts under the Krichevsky-Trofimov estimate."""
    return _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - _lgamma(zeros + ones + 1.0) - np.log(np.pi)


def _weighted(zeros: np.ndarray, ones: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log of the weighted probability, and the share of the node's own estimate in it."""
    own = _kt(zeros, ones)
    total = np.logaddexp(own, children) - np.log(2)
    return total, np.exp(own - np.log(2) - total)


def _sums(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys, the place of each key among them, and the sums of the values for each."""
    kinds, at = np.unique(key, return_inverse=True)
    return kinds, at, *[np.bincount(at, weights=v, minlength=len(kinds)) for v in values]


def _subtrees(grams: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each of the 8 bits of a byte: (nodes, zeros, ones, weighted log probability) at depth CUT, and the
    probability of a one that depths CUT to DEPTH together give for each gram.

    ``grams`` are in order and hold all that follow their contexts of CUT bytes; a node is such a context
    and the bits before in a byte.  Grams that were not learnt have n = 0 and find the estimates of the
    deepest contexts that were.
    """
    layers = []
    for d in range(DEPTH, CUT - 1, -1):
        key = (grams >> 8 * (DEPTH - d) + 8) << 8 | grams & 255
        kinds, first, at = np.unique(key, return_index=True, return_inverse=True)
        layers.append((kinds, first, at, np.bincount(at, weights=n)))
    for k in range(8):
        below = None
        for kinds, first, at, counts in layers:
            run = kinds >> 8 - k
            start = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
            node = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(run))))
            ones = np.add.reduceat(counts * (kinds >> 7 - k & 1), start)
            zeros = np.add.reduceat(counts, start) - ones
            own, of = (ones + 0.5) / (zeros + ones + 1), node[at]
            if below is None:
                total, mixed = _kt(zeros, ones), own[of]
            else:
                total, share = _weighted(zeros, ones, np.bincount(of[below[0]], weights=below[1], minlength=len(start)))
                mixed = share[of] * own[of] + (1 - share[of]) * mixed
            below = first[start], total
        yield run[start], zeros, ones, total, mixed


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted (gram, n) in pieces that part no context of CUT bytes."""
    held, rows = [], 0

    def taken(last: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        nonlocal held, rows
        grams, n = (np.concatenate(x) for x in zip(*held, strict=True))
        top = grams >> 8 * (DEPTH + 1 - CUT)
        end = len(grams) if last else int(np.searchsorted(top, top[-1]))
        held, rows = [(grams[end:], n[end:])], 0
        if end:
            yield grams[:end], n[:end]

    for batch in batches:
        if batch.num_rows:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.float64)))
            rows += batch.num_rows
            if rows >= _CHUNK:
                yield from taken(False)
    if held:
        yield from taken(True)


def gram_logs(grams: DataFrame) -> DataFrame:
    """(gram, logs): log10 of a gram's last byte after its context, mixed over depths 0 to DEPTH, from (gram, n).

    Below depth CUT the tree is weighted in the partitions; the rest of it, at most 65,536 contexts of two
    bytes with 255 nodes each, on the driver, which sends back what the upper depths add to each node.
    """
    cut = F.shiftright("gram", 8 * (DEPTH + 1 - CUT))
    dealt = grams.select("gram", "n").repartition(cut).sortWithinPartitions("gram")

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, n in _whole(batches):
            for k, (nodes, zeros, ones, total, _) in enumerate(_subtrees(codes, n)):
                key, _, *sums = _sums((nodes >> k + 8) << 8 | 1 << k | nodes & (1 << k) - 1, zeros, ones, total)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, *sums)], names=["key", "zeros", "ones", "total"])

    made = dealt.mapInArrow(tops, "key bigint, zeros double, ones double, total double")
    upper = made.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "total")]).toPandas().sort_values("key")
    keys = upper["key"].to_numpy(np.int64)
    zeros, ones, children = (upper[c].to_numpy(np.float64) for c in ("zeros", "ones", "total"))
    add, times, place, key = np.zeros(len(keys)), np.ones(len(keys)), np.arange(len(keys)), keys
    for d in range(CUT - 1, -1, -1):
        total, share = _weighted(zeros, ones, children)
        own = (ones + 0.5) / (zeros + ones + 1)
        add, times = share[place] * own[place] + (1 - share[place]) * add, (1 - share[place]) * times
        if d:
            key, at, zeros, ones, children = _sums((key >> 16) << 8 | key & 255, zeros, ones, total)
            place = at[place]
    sent = grams.sparkSession.sparkContext.broadcast((keys, add, times))

    def logs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, add, times = sent.value
        for codes, n in _whole(batches):
            out = np.zeros(len(codes))
            for k, (*_, mixed) in enumerate(_subtrees(codes, n)):
                at = np.searchsorted(keys, (codes >> 8 * (DEPTH + 2 - CUT)) << 8 | 1 << k | (codes & 255) >> 8 - k)
                p = add[at] + times[at] * mixed
                out += np.log10(np.where(codes >> 7 - k & 1, p, 1 - p))
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(out)], names=["gram", "logs"])

    return dealt.mapInArrow(logs, "gram bigint, logs double")


def _gram_counts(rows: DataFrame) -> DataFrame:
    """(gram, n, met): how often each gram of the texts was learnt, and how often it is met at all; tasks add up their own."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def merged() -> tuple[np.ndarray, ...]:
            grams, _, n, met = _sums(*(np.concatenate(x) for x in zip(*held, strict=True)))
            return grams, n, met

        def out(grams: np.ndarray, n: np.ndarray, met: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(grams), pa.array(n.astype(np.int64)), pa.array(met.astype(np.int64))], names=["gram", "n", "met"])

        for batch in batches:
            items, unseen = batch.column("content").to_pylist(), batch.column("held_out").to_pylist()
            for a, b in byte_chunks(items, len):
                for learnt in (True, False):
                    grams, met = np.unique(positions([x for x, h in zip(items[a:b], unseen[a:b], strict=True) if h != learnt])[0], return_counts=True)
                    held.append((grams, met * learnt, met))
                if sum(len(x[0]) for x in held) > _HELD:
                    held = [merged()]
                    if len(held[0][0]) > _HELD // 2:
                        yield out(*held.pop())
        if held:
            yield out(*merged())

    counted = rows.select("content", "held_out").mapInArrow(count, "gram bigint, n bigint, met bigint")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("met").alias("met"))


def _word_counts(texts: DataFrame) -> DataFrame:
    """(word, n): tokens of the texts by 64-bit code of the lower-cased word; tasks add up their own."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            words, at = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
            return words, np.bincount(at, weights=np.concatenate([n for _, n in held]), minlength=len(words)).astype(np.int64)

        def out(words: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])

        for batch in batches:
            items = batch.column(0).to_pylist()
            for a, b in byte_chunks(items, len):
                held.append(np.unique(word_hashes(items[a:b])[0], return_counts=True))
                if sum(len(w) for w, _ in held) > _HELD:
                    held = [merged()]
                    if len(held[0][0]) > _HELD // 2:
                        yield out(*held.pop())
        if held:
            yield out(*merged())

    return texts.select("content").mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def held_out(doc_id: Column) -> Column:
    """Every tenth id by checksum; rows without id are learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 10 == 0, F.lit(False))


def lm_scores(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte; one row per input row.

    ``score`` is the log10 probability of the whole text under the context tree, ``bits_per_byte`` its
    code length; ``base_score`` that of its words under a unigram.  Both learn from the texts that
    are not held out.  Numbers of frequent words and grams reach the texts by broadcast (a bounded number,
    see ``HEAVY``), those of all others by a join, so neither words nor contexts are ever sent whole.

    Null and empty texts hold the end token only: score 0, no bits per byte.  Null ids count as learnt
    from; repeated rows keep one row each.  Extra columns are not read.  An empty table gives no rows.
    """
    rows = small_batches(documents).select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("content")
    )
    learnt = rows.where("not held_out").select("content")
    words = materialize(_word_counts(learnt), "words")
    texts = learnt.count()
    total, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, kinds = total + texts, kinds + bool(texts)
    log_p = lambda n: np.log10((n + 0.1) / (total + 0.1 * (kinds + 1)))
    heavy = words.where(F.col("n") * HEAVY >= total).toPandas().sort_values("word") if total else pd.DataFrame({"word": [], "n": []})
    sc = documents.sparkSession.sparkContext
    sent = sc.broadcast((heavy["word"].to_numpy(np.int64), log_p(heavy["n"].to_numpy(np.float64))))
    counted = materialize(_gram_counts(rows), "grams")
    grams = materialize(gram_logs(counted), "gram-logs")
    least = (counted.agg(F.sum("met")).first()[0] or 0) / (4 * HEAVY)
    often = counted.where(F.col("met") >= least).select("gram").join(grams, "gram").toPandas().sort_values("gram")
    tree = sc.broadcast((often["gram"].to_numpy(np.int64), often["logs"].to_numpy(np.float64)))
    end, end_known = float(log_p(texts)), int(texts > 0)

    def found(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
        return at, known[at] == keys if len(known) else np.zeros(len(keys), bool)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, logs = sent.value
        leaves, leaf_logs = tree.value
        for batch in batches:
            items, ids, held = batch.column("content").to_pylist(), batch.column("doc_id"), batch.column("held_out")
            codes = batch.column("code")
            for a, b in byte_chunks(items, len):
                part = items[a:b]
                hashes, counts = word_hashes(part)
                hashes = hashes.view(np.int64)
                at, hit = found(known, hashes)
                doc = np.repeat(np.arange(b - a), counts)
                weight = np.bincount(doc[hit], weights=logs[at[hit]], minlength=b - a) + end
                met, size = positions(part)
                kinds, at = np.unique(met, return_inverse=True)
                leaf, heavy = found(leaves, kinds)
                of_kind = np.where(heavy, leaf_logs[leaf] if len(leaves) else 0.0, 0.0)
                of_doc = np.repeat(np.arange(b - a), size)
                points = np.bincount(of_doc, weights=of_kind[at], minlength=b - a)
                own = [held.slice(a, b - a), pa.array(counts + 1), pa.array(np.bincount(doc[hit], minlength=b - a) + end_known), pa.array(weight), pa.array(points), pa.array(size)]
                own = pa.StructArray.from_arrays(own, names=["held_out", "n_tokens", "n_known", "base", "score", "bytes"])
                ones, none = np.ones(b - a, np.int64), np.zeros(b - a, np.int64)
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), codes.slice(a, b - a), pa.array(none), codes.slice(a, b - a), pa.array(ones), own], names=names)
                rare = ~heavy[at]
                for kind, keys, doc in ((1, hashes[~hit], doc[~hit]), (2, met[rare], of_doc[rare])):  # noqa: B020
                    order = np.lexsort((keys, doc))
                    keys, doc = keys[order], doc[order]
                    first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])])) if len(keys) else np.zeros(0, np.int64)
                    n, to = np.diff(np.concatenate([first, [len(keys)]])), pa.array(a + doc[first])
                    rest = [ids.take(to), codes.take(to), pa.array(np.full(len(first), kind)), pa.array(keys[first]), pa.array(n), pa.nulls(len(first), own.type)]
                    yield pa.RecordBatch.from_arrays(rest, names=names)

    schema = "doc_id bigint, code bigint, kind bigint, key bigint, n bigint, own struct<held_out:boolean,n_tokens:bigint,n_known:bigint,base:double,score:double,bytes:bigint>"
    names = ["doc_id", "code", "kind", "key", "n", "own"]
    made = rows.withColumn("code", F.xxhash64("content")).mapInArrow(score, schema)
    of_words = words.select(F.lit(1).cast("long").alias("kind"), F.col("word").alias("key"), F.col("n").alias("c"), F.lit(None).cast("double").alias("logs"))
    of_grams = grams.select(F.lit(2).cast("long").alias("kind"), F.col("gram").alias("key"), F.lit(None).cast("long").alias("c"), "logs")
    c, times = F.coalesce("c", F.lit(0)), F.col("n")
    is_word = F.col("kind") == 1
    part = made.join(of_words.unionByName(of_grams), ["kind", "key"], "left").select(
        "doc_id", "code", "own",
        F.when(is_word, times * F.log10((c + 0.1) / F.lit(total + 0.1 * (kinds + 1)))).otherwise(F.coalesce("own.base", F.lit(0.0))).alias("base"),
        F.when(is_word, F.when(c > 0, times).otherwise(0)).otherwise(F.coalesce("own.n_known", F.lit(0))).alias("n_known"),
        F.when(F.col("kind") == 2, times * F.col("logs")).otherwise(F.coalesce("own.score", F.lit(0.0))).alias("score"),
        F.when(F.col("kind") == 0, 1).otherwise(0).alias("copies"),
    )
    both = part.groupBy("doc_id", "code").agg(
        F.max("own.held_out").alias("held_out"), F.max("own.n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base"),
        F.sum("score").alias("scores"), F.max("own.bytes").alias("bytes"), F.sum("copies").alias("copies"),
    ).withColumn("score", F.col("scores") / F.col("copies"))
    bits = F.when(F.col("bytes") > 0, -F.col("score") * float(np.log2(10)) / F.col("bytes"))
    return both.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") / F.col("copies")).cast("long").alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("copies")).alias("base_score"), "score", bits.alias("bits_per_byte"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"),
    ).drop("_copy")
