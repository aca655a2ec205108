"""Near-duplicate groups: MinHash bands find candidates, odd sketches estimate them, full sets confirm."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.common import byte_chunks, mix64, small, small_batches, word_hashes
from cdcflow.llm.components import components
from cdcflow.session import materialize

#: Ids that may be broadcast to pick rows; beyond, the same join shuffles.
BROADCAST_IDS = 1_000_000
#: Members of a bucket, and codes of their sets, in one block that a task compares.
CELL, CELL_CODES = 512, 1_000_000


@dataclass(frozen=True)
class Params:
    """``bands`` x ``rows`` MinHash samples; a pair at the threshold shares a band with 1 - (1 - 0.8**5)**30 > 0.99999.

    ``margin`` is five standard errors of the similarity read from the samples: a pair is dropped
    unseen only when its sketches put it that far below the threshold.
    """

    width: int = 5
    percent: int = 80
    bands: int = 30
    rows: int = 5
    bits: int = 1024
    margin: float = 0.17

    @property
    def samples(self) -> int:
        return self.bands * self.rows


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit codes of the ``width``-word shingles; a shorter text is one shingle, no words none."""
    words, counts = word_hashes(texts)
    first = np.concatenate([[0], np.cumsum(counts)])
    with np.errstate(over="ignore"):
        code = np.zeros(max(len(words) - width + 1, 0), np.uint64)
        for j in range(width):
            code = code * np.uint64(0x9E3779B97F4A7C15) + words[j : j + len(code)]
        code = mix64(code)
        out = []
        for i, n in enumerate(counts.tolist()):
            at = first[i]
            if n >= width:
                out.append(np.unique(code[at : at + n - width + 1]))
            else:
                whole = np.zeros(min(n, 1), np.uint64)
                for j in range(n):
                    whole = whole * np.uint64(0x9E3779B97F4A7C15) + words[at + j : at + j + 1]
                out.append(mix64(whole + np.uint64(n)))
    return out


def signatures(sets: list[np.ndarray], p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Band codes (documents x bands) and odd sketches (documents x bits / 64) of non-empty sets."""
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    codes = np.concatenate(sets)
    seeds = mix64(np.arange(1, p.samples + 1, dtype=np.uint64)) | np.uint64(1)
    with np.errstate(over="ignore"):
        samples = np.stack([np.minimum.reduceat(codes * seed, starts) for seed in seeds], 1)
        bands = np.zeros((len(sets), p.bands), np.uint64)
        for r in range(p.rows):
            bands = mix64(bands * np.uint64(3) + samples[:, r :: p.rows])
        bands = mix64(bands + np.arange(p.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        bit = (mix64(samples + seeds) % np.uint64(p.bits)).astype(np.int64)
    cell = bit + np.arange(len(sets), dtype=np.int64)[:, None] * p.bits
    odd = (np.bincount(cell.ravel(), minlength=len(sets) * p.bits) & 1).astype(np.uint8)
    return bands.view(np.int64), np.packbits(odd.reshape(len(sets), p.bits), axis=1).view(np.int64)


def _listed(rows: np.ndarray) -> pa.Array:
    ends = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(rows).ravel()))


def sketched(documents: DataFrame, p: Params) -> DataFrame:
    """doc_id, n_shingles, set_a, set_b (a 128-bit code of the set), bands, sketch; the last two empty for empty sets."""
    names = ["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch"]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("content").to_pylist()
            for a, b in byte_chunks(texts, len):
                sets = shingle_sets(texts[a:b], p.width)
                size = np.array([len(s) for s in sets], np.int64)
                with np.errstate(over="ignore"):
                    sums = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                    xors = np.array([np.bitwise_xor.reduce(mix64(s + np.uint64(1))) for s in sets], np.uint64).view(np.int64)
                bands, sketches = np.zeros((len(sets), p.bands), np.int64), np.zeros((len(sets), p.bits // 64), np.int64)
                if (full := np.flatnonzero(size)).size:
                    bands[full], sketches[full] = signatures([sets[i] for i in full], p)
                columns = [batch.column("doc_id").slice(a, b - a), pa.array(size), pa.array(sums), pa.array(xors), _listed(bands), _listed(sketches)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return _contents(documents).mapInArrow(
        sketch, "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, sketch array<bigint>"
    )


def _contents(documents: DataFrame) -> DataFrame:
    return small_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("content"))


def full_sets(documents: DataFrame, ids: DataFrame, p: Params) -> DataFrame:
    """(doc_id, n_shingles, shingles) of the wanted documents."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("content").to_pylist()
            for a, b in byte_chunks(texts, len):
                found = shingle_sets(texts[a:b], p.width)
                size = np.array([len(s) for s in found], np.int64)
                ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                codes = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(size), codes], names=["doc_id", "n_shingles", "shingles"])

    picked = _contents(documents).join(small(ids, BROADCAST_IDS), "doc_id", "left_semi")
    return picked.mapInArrow(sets, "doc_id bigint, n_shingles bigint, shingles array<bigint>")


def buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node, n_shingles, size) for the buckets with two members or more.

    Sizes are counted map-side and joined back, so a bucket with a third of all rows is never one group.
    """
    members = nodes.select("node", "n_shingles", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    return members.join(sizes, "bucket")


def hub_pairs(members: DataFrame) -> DataFrame:
    """Each member with the hub of its largest bucket: the member whose buckets hold the most rows.

    The text that all near copies were made from keeps most of its bands and so sits in the large
    buckets; paired with it, a group of copies becomes one star of one pair per member.
    """
    own = members.groupBy("node").agg(F.sum("size").alias("weight"), F.max(F.struct("size", "bucket"))["bucket"].alias("bucket"))
    hubs = members.join(own.select("node", "weight"), "node").groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("node")).alias("minus"))).alias("top"))
    paired = own.join(hubs.select("bucket", (-F.col("top.minus")).alias("hub")), "bucket").where("hub <> node")
    return paired.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()


def _similarity(odd: Column, p: Params) -> Column:
    """Similarity of two sample sets whose sketches differ in ``odd`` bits."""
    share = F.least(odd / p.bits, F.lit(0.4999))
    return 1 + p.bits / 2 * F.log(1 - 2 * share) / (2 * p.samples)


def likely(pairs: DataFrame, nodes: DataFrame, p: Params) -> DataFrame:
    """Pairs (a, b) that sizes and odd sketches leave possible."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(100 * F.least("n_a", "n_b") >= p.percent * F.greatest("n_a", "n_b"))
    odd = F.aggregate(F.zip_with("s_a", "s_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    return both.where(_similarity(odd, p) >= p.percent / 100 - p.margin).select("a", "b").distinct()


def _sets_of(documents: DataFrame, ids: DataFrame, p: Params) -> DataFrame:
    """Stored sets of the wanted documents, one row per id and set."""
    sets = full_sets(documents, ids, p).withColumn("code", F.xxhash64("shingles")).dropDuplicates(["doc_id", "code"])
    return materialize(sets.drop("code"), "sets")


def confirmed(pairs: DataFrame, documents: DataFrame, p: Params) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    pairs = materialize(pairs, "pairs")
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = _sets_of(documents, ids, p)
    side = lambda x: sets.select(F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("shingles").alias(f"s_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    shared = both.select("a", "b", (F.col("n_a") + F.col("n_b")).alias("total"), F.size(F.array_intersect("s_a", "s_b")).alias("shared"))
    return materialize(shared.where(F.lit(100) * F.col("shared") >= p.percent * (F.col("total") - F.col("shared"))).select("a", "b").distinct(), "confirmed")


def rest_links(members: DataFrame, classes: DataFrame, known: DataFrame, documents: DataFrame, p: Params) -> DataFrame:
    """Links between members of a bucket that the first pass left in different components.

    Every pair in question has a member outside the bucket's most frequent component.  These probe all
    members: members are cut into blocks, probes too, and a cell holds one block of each with their full
    sets.  A task goes through the pairs of a cell whose sketches may reach the threshold, nearest first,
    confirms them on the full sets, and passes over pairs that links of the cell have joined
    meanwhile; so it emits fewer links than a cell has members, however alike these are.  A pair that
    shares several bands is looked at in the first of them only.
    """
    labelled = members.join(known.select("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    parts = labelled.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("codes"))
    split = parts.groupBy("bucket").agg(F.max(F.struct("n", "component", "codes")).alias("top"), F.sum("n").alias("n"), F.sum("codes").alias("codes"))
    blocks = lambda n, codes: F.greatest(F.ceil(n / CELL), F.ceil(codes / CELL_CODES))
    split = split.where("top.n < n").select(
        "bucket", F.col("top.component").alias("main"), blocks(F.col("n"), F.col("codes")).alias("blocks"),
        blocks(F.col("n") - F.col("top.n"), F.col("codes") - F.col("top.codes")).alias("probe_blocks"),
    )
    open_ = materialize(labelled.join(split, "bucket").withColumn("code", F.xxhash64("node")), "open-buckets")
    held = open_.select("bucket", F.explode(F.sequence(F.lit(0), F.col("probe_blocks") - 1)).alias("i"), F.pmod("code", "blocks").alias("j"), F.lit(False).alias("probe"), "node", "component")
    probes = open_.where("component <> main").select(
        "bucket", F.pmod("code", "probe_blocks").alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), F.lit(True).alias("probe"), "node", "component"
    )
    sets = _sets_of(documents, open_.select(F.col("node").alias("doc_id")).distinct(), p).withColumnRenamed("doc_id", "node")
    details = classes.select("node", "n_shingles", "bands", "sketch").join(sets, ["node", "n_shingles"])
    rows = held.union(probes).join(details, "node").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    percent, cut = p.percent, p.percent / 100 - p.margin
    most = int(p.bits / 2 * (1 - np.exp((cut - 1) * 4 * p.samples / p.bits)))  # bits that may differ at the cut

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            t = pa.Table.from_batches([*waiting, batch])
            keys = np.stack([t.column(c).to_numpy() for c in ("bucket", "i", "j")], 1)
            ends = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            if ends.size:
                yield from _cells(t.slice(0, ends[-1]), ends, percent, most)
            waiting = t.slice(ends[-1] if ends.size else 0).combine_chunks().to_batches()
        if waiting:
            t = pa.Table.from_batches(waiting)
            yield from _cells(t, np.array([t.num_rows]), percent, most)

    return rows.mapInArrow(compare, "a bigint, b bigint").distinct()


def _cells(t: pa.Table, ends: np.ndarray, percent: int, most: int) -> Iterator[pa.RecordBatch]:
    """The confirmed links of each cell that join components not joined before."""
    bucket, node, size, comp = (t.column(c).to_numpy() for c in ("bucket", "node", "n_shingles", "component"))
    probe = t.column("probe").to_numpy()
    table = lambda c: np.ascontiguousarray(t.column(c).combine_chunks().flatten().to_numpy()).reshape(t.num_rows, -1)
    sketch, bands = table("sketch").view(np.uint64), table("bands")
    codes = t.column("shingles").combine_chunks()
    flat, first = codes.flatten().to_numpy().view(np.uint64), np.concatenate([[0], np.cumsum(size)])
    at = 0
    for end in ends.tolist():
        inside = np.arange(at, end)
        left, right, here, at = inside[probe[at:end]], inside[~probe[at:end]], bucket[at], end
        joined: dict[int, int] = {}

        def root(c: int, joined: dict[int, int] = joined) -> int:
            while c in joined:
                c = joined[c]
            return c

        found = []
        for x in left.tolist():
            y = right[(comp[right] != comp[x]) & (100 * np.minimum(size[right], size[x]) >= percent * np.maximum(size[right], size[x]))]
            if not y.size:
                continue
            odd = np.bitwise_count(sketch[y] ^ sketch[x]).sum(1, dtype=np.int64)
            y, odd = y[odd <= most], odd[odd <= most]
            shared = (bands[y] == bands[x]).argmax(1)
            y = y[np.argsort(odd, kind="stable")][(bands[x][shared] == here)[np.argsort(odd, kind="stable")]]
            own = flat[first[x] : first[x + 1]]
            for v in y.tolist():
                a, b = root(int(comp[x])), root(int(comp[v]))
                if a == b:
                    continue
                other = flat[first[v] : first[v + 1]]
                hits = int(np.count_nonzero(own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other))
                if 100 * hits >= percent * (len(own) + len(other) - hits):
                    joined[max(a, b)] = min(a, b)
                    found.append((min(node[x], node[v]), max(node[x], node[v])))
        if found:
            a, b = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def near_duplicates(documents: DataFrame, p: Params = Params()) -> DataFrame:  # noqa: B008
    """(doc_id, n_shingles, class_id, component_id, kept), one row per input row.

    Documents are linked when 100 x shared shingles >= ``percent`` x all shingles of the two, on full
    sets of 64-bit codes.  Equal sets are one class and take part once, under their smallest id, so
    copies are never expanded into pairs.  Two passes find the links between classes: members of a
    bucket against a hub, then what the first pass left in different components.

    Null or empty texts and texts without words have no shingles and stand alone.  A row without id
    is linked with nothing and kept, with a null component.  Rows that repeat an id are one node
    in the links.  Extra columns are not read; an empty table gives no rows.
    """
    rows = materialize(sketched(documents, p), "sketched")
    key = ["set_a", "set_b", "n_shingles"]
    classes = materialize(
        rows.where("n_shingles > 0 and doc_id is not null").groupBy(*key)
        .agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "classes",
    )
    nodes = classes.select("node", "n_shingles", "sketch")
    members = materialize(buckets(classes), "buckets")
    links = confirmed(likely(hub_pairs(members), nodes, p), documents, p)
    known = materialize(components(links), "components")
    more = materialize(rest_links(members, classes, known, documents, p), "rest-links")
    if not more.isEmpty():
        known = components(links.union(more))
    found = rows.join(classes.select(*key, "node"), key, "left").join(known, "node", "left")
    class_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("node", "doc_id"))
    return found.select("doc_id", "n_shingles", class_id.alias("class_id"), F.coalesce("component", class_id).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
