"""Repeated passages: fixed blocks are the anchors, every rolling window probes them, hits are extended exactly."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.common import byte_chunks, mix64, word_hashes

_STEP = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)
_LOW = np.uint64(0xFFFFFFFF)
_NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Params:
    """Passages of ``words`` words or more.

    Blocks have half as many words, so every passage holds a whole one.  A slot of documents, and what
    meets in one bucket, stand for ``slot_bytes`` of text, or for more in a large corpus: a slot sends
    one row to every bucket, and both grow with the root of the corpus, so that a row has ``row_codes``
    codes or more and rows grow as the corpus does.  Neither number changes the result.
    """

    words: int = 20
    slot_bytes: int = 4 << 20
    row_codes: int = 100

    @property
    def block(self) -> int:
        return self.words // 2

    def slots(self, total: int) -> int:
        """How many slots, and buckets, ``total`` bytes of text are dealt over (a word has six bytes or more)."""
        return max(1, int(total // max(self.slot_bytes, (6 * self.row_codes * total) ** 0.5, 1)))


class _Slot:
    """The documents of one slot in the order (doc_id, digest of the text), rolling codes of their words and where they lie."""

    def __init__(self, documents: pa.Table, p: Params):
        ids, ties = documents.column("doc_id"), documents.column("tie").to_numpy()
        ids = ids.combine_chunks().fill_null(_NO_ID).to_numpy()
        order = np.lexsort((ties, ids))
        self.documents = documents.take(pa.array(order))
        self.ids, self.ties = ids[order], ties[order]
        first = np.ones(len(order), bool)
        first[1:] = (np.diff(self.ids) != 0) | (np.diff(self.ties) != 0)
        self.rank = np.cumsum(first) - 1  # rows that repeat id and text are one document
        self.texts = self.documents.column("content").to_pylist()
        parts = [word_hashes(self.texts[a:b], lower=False) for a, b in byte_chunks(self.texts, len)]
        hashes = np.concatenate([h for h, _ in parts]) if parts else np.zeros(0, np.uint64)
        self.counts = np.concatenate([n for _, n in parts]) if parts else np.zeros(0, np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.owner = np.repeat(np.arange(len(self.counts)), self.counts)
        self.place = np.arange(len(hashes)) - self.first[self.owner]
        self.left = self.counts[self.owner] - self.place  # words from here to the end of the document
        self.code = np.zeros(len(hashes), np.uint64)
        roll = np.concatenate([hashes, np.zeros(p.block, np.uint64)])
        with np.errstate(over="ignore"):
            for j in range(p.block):
                self.code = self.code * _STEP + roll[j : j + len(hashes)]
        self.code = mix64(self.code)

    def keys(self, buckets: int) -> np.ndarray:
        """Bucket in the high, 32 bits of the block's code in the low half."""
        return ((self.code >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (self.code & _LOW)


def _listed(bucket: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[pa.Array]]:
    """Buckets and lists of what lies in each; the rows are sorted by bucket."""
    ends = np.append(np.flatnonzero(np.diff(bucket)) + 1, len(bucket)) if len(bucket) else np.zeros(0, np.int64)
    edges = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    return bucket[ends - 1] if len(bucket) else bucket, [pa.ListArray.from_arrays(edges, pa.array(c)) for c in columns]


_ASKED = pa.schema([("bucket", pa.int64()), ("slot", pa.int64()), ("kind", pa.int32()), ("codes", pa.list_(pa.int32()))])
_HITS = pa.schema([("slot", pa.int64()), ("bucket", pa.int64()), ("codes", pa.list_(pa.int32()))])
_PASSAGES = pa.schema([("bucket", pa.int64()), ("slot", pa.int64()), ("code", pa.list_(pa.int64())), *((c, pa.list_(pa.int64())) for c in ("doc_id", "tie")), *((c, pa.list_(pa.int32())) for c in ("rank", "place"))])
_MARKS = pa.schema([("slot", pa.int64()), ("rank", pa.list_(pa.int32())), ("place", pa.list_(pa.int32()))])
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), ("kept", pa.binary())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "bigint", pa.int32(): "int", pa.binary(): "binary", pa.list_(pa.int32()): "array<int>", pa.list_(pa.int64()): "array<bigint>"}
    return ", ".join(f"{f.name} {names.get(f.type, 'array<struct<start: bigint, length: bigint>>')}" for f in schema)


def _ask(documents: pa.Table, p: Params, buckets: int) -> pa.Table:
    """Distinct block codes of a slot: at block places once (kind 0) and more often (1), at all other places (2)."""
    slot, at = _Slot(documents, p), documents.column("slot")[0].as_py()
    keys, whole, aligned = slot.keys(buckets), slot.left >= p.block, slot.place % p.block == 0
    blocks, n = np.unique(keys[whole & aligned], return_counts=True)
    out = []
    for kind, found in enumerate((blocks[n == 1], blocks[n > 1], np.unique(keys[whole & ~aligned]))):
        bucket, (codes,) = _listed((found >> np.uint64(32)).astype(np.int64), [(found & _LOW).astype(np.uint32).view(np.int32)])
        out.append(pa.table([pa.array(bucket), pa.array(np.full(len(bucket), at)), pa.array(np.full(len(bucket), kind, np.int32)), codes], schema=_ASKED))
    return pa.concat_tables(out)


def _answer(asked: pa.Table) -> pa.Table:
    """Of each slot's codes in a bucket, those that a block at another place has too."""
    kinds, lists = asked.column("kind").to_numpy(), asked.column("codes").combine_chunks()
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    flat = lists.flatten().to_numpy()
    kind = np.repeat(kinds, np.diff(ends))
    known, back = np.unique(flat[kind < 2], return_inverse=True)
    many = np.bincount(back, kind[kind < 2] + 1, len(known)) >= 2
    hit = np.zeros(len(flat), bool)
    if len(known):
        hit[kind < 2] = many[back]
        probe = flat[kind == 2]
        near = np.minimum(np.searchsorted(known, probe), len(known) - 1)
        hit[kind == 2] = known[near] == probe
    counts = np.add.reduceat(np.append(hit, False).astype(np.int64), ends[:-1]) if len(flat) else np.zeros(len(kinds), np.int64)
    some = np.flatnonzero(counts)
    edges = pa.array(np.concatenate([[0], np.cumsum(counts[some])]).astype(np.int32))
    bucket = asked.column("bucket").combine_chunks().take(pa.array(some))
    return pa.table([asked.column("slot").combine_chunks().take(pa.array(some)), bucket, pa.ListArray.from_arrays(edges, pa.array(flat[hit]))], schema=_HITS)


def _extend(documents: pa.Table, hits: pa.Table, p: Params, buckets: int) -> pa.Table:
    """Codes and places of all windows of a slot around a hit, the first of equal ones only; places of the others in a row without codes."""
    if not documents.num_rows or not hits.num_rows:
        return _PASSAGES.empty_table()
    slot, at = _Slot(documents, p), documents.column("slot")[0].as_py()
    lists = hits.column("codes").combine_chunks()
    high = np.repeat(hits.column("bucket").to_numpy().astype(np.uint64), lists.value_lengths().to_numpy())
    wanted = np.unique((high << np.uint64(32)) | lists.flatten().to_numpy().view(np.uint32).astype(np.uint64))
    hit = (slot.left >= p.block) & np.isin(slot.keys(buckets), wanted)
    sums = np.concatenate([[0], np.cumsum(hit), np.full(p.block, hit.sum())])
    n = len(hit)
    window = np.flatnonzero((slot.left >= p.words) & (sums[p.block : p.block + n] > sums[:n]))
    with np.errstate(over="ignore"):
        a, b = slot.code[window], slot.code[window + p.words - p.block]
        code = mix64(a * _STEP + b).view(np.int64)
        bucket = (mix64(a + b * _OTHER) % np.uint64(buckets)).astype(np.int64)
    rank, place = slot.rank[slot.owner[window]].astype(np.int32), slot.place[window].astype(np.int32)
    order = np.lexsort((code, bucket))  # stable: the first of equal windows is the earliest
    first = np.ones(len(order), bool)
    first[1:] = (np.diff(code[order]) != 0) | (np.diff(bucket[order]) != 0)
    lead = order[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(order) else order
    later = np.sort(order[(rank[order] != rank[lead]) | (place[order] != place[lead])])
    sent = np.sort(order[first])
    sent = sent[np.argsort(bucket[sent], kind="stable")]
    owner = slot.owner[window[sent]]
    held, lists = _listed(bucket[sent], [code[sent], slot.ids[owner], slot.ties[owner], rank[sent], place[sent]])
    out = [pa.table([pa.array(held), pa.array(np.full(len(held), at)), *lists], schema=_PASSAGES)]
    if len(later):
        none = pa.array([[]], pa.list_(pa.int64()))
        out.append(pa.table([pa.array([at % buckets]), pa.array([at]), none, none, none, pa.array([rank[later]]), pa.array([place[later]])], schema=_PASSAGES))
    return pa.concat_tables(out)


def _judge(passages: pa.Table) -> pa.Table:
    """Places of windows that are not the first with their words, by slot."""
    codes = passages.column("code").combine_chunks().value_lengths().to_numpy()
    known, ready = passages.filter(pa.array(codes > 0)), passages.filter(pa.array(codes == 0)).select(["slot", "rank", "place"])
    if not known.num_rows:
        return ready.cast(_MARKS)
    flat = {c: known.column(c).combine_chunks().flatten().to_numpy() for c in ("code", "doc_id", "tie", "rank", "place")}
    order = np.lexsort((flat["place"], flat["tie"], flat["doc_id"], flat["code"]))
    sort = {c: v[order] for c, v in flat.items()}
    first = np.ones(len(order), bool)
    first[1:] = np.diff(sort["code"]) != 0
    lead = np.flatnonzero(first)[np.cumsum(first) - 1]
    later = np.logical_or.reduce([sort[c] != sort[c][lead] for c in ("doc_id", "tie", "place")])
    marked = np.zeros(len(order), bool)
    marked[order[later]] = True
    lengths = known.column("code").combine_chunks().value_lengths().to_numpy()
    counts = np.add.reduceat(marked.astype(np.int64), np.concatenate([[0], np.cumsum(lengths)[:-1]]))
    some = np.flatnonzero(counts)
    edges = pa.array(np.concatenate([[0], np.cumsum(counts[some])]).astype(np.int32))
    lists = [pa.ListArray.from_arrays(edges, pa.array(flat[c][marked])) for c in ("rank", "place")]
    found = pa.table([known.column("slot").combine_chunks().take(pa.array(some)), *lists], schema=_MARKS)
    return pa.concat_tables([found, ready.cast(_MARKS)])


def _remove(documents: pa.Table, marks: pa.Table, p: Params) -> pa.Table:
    """Every document of a slot without the words that marked windows cover."""
    if not documents.num_rows:
        return _KEPT.empty_table()
    ids, ties = documents.column("doc_id").combine_chunks().fill_null(_NO_ID).to_numpy(), documents.column("tie").to_numpy()
    order = np.lexsort((ties, ids))
    first = np.ones(len(order), bool)
    first[1:] = (np.diff(ids[order]) != 0) | (np.diff(ties[order]) != 0)
    rank = np.cumsum(first) - 1
    documents = documents.take(pa.array(order))
    ranks, places = (marks.column(c).combine_chunks().flatten().to_numpy() for c in ("rank", "place"))
    by = np.argsort(ranks, kind="stable")
    ranks, places = ranks[by], places[by]
    bounds = np.searchsorted(ranks, np.arange(len(order) + 1))
    counts, removed, kept = [], [], []
    for at, text in zip(rank.tolist(), documents.column("content").to_pylist(), strict=True):
        words = text.split()
        counts.append(len(words))
        spans = []
        if bounds[at] < bounds[at + 1]:
            edge = np.zeros(len(words) + 1, np.int64)
            here = np.unique(places[bounds[at] : bounds[at + 1]])
            edge[here] += 1
            edge[here + p.words] -= 1
            gone = np.cumsum(edge)[:-1] > 0
            turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            spans = [{"start": a, "length": b - a} for a, b in turn.reshape(-1, 2).tolist()]
            words = [words[i] for i in np.flatnonzero(~gone).tolist()]
        removed.append(spans)
        kept.append(b" ".join(words))
    return pa.table([documents.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, _KEPT.field("removed").type), pa.array(kept, pa.binary())], schema=_KEPT)


def without_repeats(documents: DataFrame, p: Params = Params()) -> DataFrame:  # noqa: B008
    """(doc_id, n_words, removed, kept): each text without the words of passages that start earlier elsewhere.

    A word goes if a window of ``words`` consecutive words covers it whose sequence also starts earlier:
    in a document of smaller id, or before it in the same one.  ``removed`` lists the maximal spans that
    go (start, length in words), ``kept`` joins what is left by one space.  Windows are judged on the input.

    1. Blocks at every ``words`` / 2-th word are the index; all rolling windows of that length probe it.
       Each slot of documents asks for its distinct codes, each bucket says which of them a block at
       another place has.  A window that has been before holds such a block, wherever that one lies.
    2. All windows around a hit are compared by their whole word sequence; the earliest stays.  Equal
       windows of a slot are joined before they are sent, so no passage makes a hot bucket.
    3. Marked windows of a document merge into maximal spans.

    Words are unchanged and are what white space (tab to carriage return, space) separates; null, empty
    and shorter texts keep all their words.  Null ids come last.  Rows with equal ids are ordered by a
    digest of their texts; rows that repeat id and text are one document and get the same result each.
    Extra columns are not read; an empty table gives no rows.  Windows are compared by codes of 64 bits
    and those of the bucket.
    """
    if p.words < 2 or p.words % 2:
        raise ValueError("an even number of words is needed")
    content = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), content.alias("content"))
    total = rows.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    slots = p.slots(total)
    rows = rows.withColumn("tie", F.xxhash64("content"))
    rows = rows.withColumn("slot", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(slots)))
    held = rows.groupBy("slot")
    ask = lambda documents: _ask(documents, p, slots)
    asked = held.applyInArrow(ask, _ddl(_ASKED))
    hits = asked.groupBy("bucket").applyInArrow(_answer, _ddl(_HITS))
    extend = lambda documents, hits: _extend(documents, hits, p, slots)
    passages = held.cogroup(hits.groupBy("slot")).applyInArrow(extend, _ddl(_PASSAGES))
    marks = passages.groupBy("bucket").applyInArrow(_judge, _ddl(_MARKS))
    remove = lambda documents, marks: _remove(documents, marks, p)
    return held.cogroup(marks.groupBy("slot")).applyInArrow(remove, _ddl(_KEPT)).withColumn("kept", F.col("kept").cast("string"))


def repeat_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the kept words."""
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["length"])
    return found.select("doc_id", "n_words", n_removed.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
