import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from cdcflow.llm import encoder
from cdcflow.llm.common import word_hashes
from cdcflow.llm.encoder import Tokenizer
from cdcflow.llm.packing import pack_documents, pack_pieces, place, sequences
from cdcflow.llm.token_counts import CACHE_SCHEMA, token_counts

ODD = ["a<|endoftext|>b c", "\x01 x\x01y \x01", "it's 12 a,b.c.. ", "é é ́x H̱ ΑΣ ΑΣ. İ", "x" * 300 + " " + "1" * 70, "\x1c a\x1db \x85  z 　", "a\x00b", "…—''s 'll", " \n\t ",
       "<|ENDOFTEXT|> <|startoftext|>", "漢字 かな 한글", "😀😀 a😀", "", "don't WON'T"]


def texts():
    rng = random.Random(8)
    words = [w for t in ODD for w in t.split(" ")] + ["the", "The", "unbelievable", "xq"]
    made = [rng.choice([" ", "\n", "  "]).join(rng.choice(words) for _ in range(rng.randrange(0, 400))) for _ in range(60)]
    rows = list(enumerate([*ODD, *made, "word " * 30_000]))
    return rows + [(500, None), (None, "the the"), (0, ODD[0]), (0, ODD[0]), (None, None)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_equal_the_library(spark, docs, tmp_path, name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = lambda t: library.encode(t)
    else:
        one = Library.from_file(path)
        ids = lambda t: one.encode(t, add_special_tokens=False).ids
    rows = [(i, (t or "").replace("\x00", "") if name.endswith(".model") else t) for i, t in texts()]
    got = sorted((tuple(r) for r in token_counts(docs(rows), Tokenizer(spark, path), str(tmp_path / "c"), limit=300).collect()), key=str)
    want = sorted(((i, len((t or "").encode()), len(ids(t or "")), len(ids(t or "")) > 300) for i, t in rows), key=str)
    assert got == want


def test_only_misses_are_encoded_and_appended(spark, docs, tmp_path):
    tokenizer, cache = Tokenizer(spark, public_tokenizers.path("word_bpe_49k.json")), str(tmp_path / "cache")
    size = lambda: spark.read.schema(CACHE_SCHEMA).parquet(cache).count()
    token_counts(docs([(1, "a b"), (2, "a  b "), (3, "a b"), (4, "c")]), tokenizer, cache).collect()
    assert size() == 2
    token_counts(docs([(1, "a b"), (9, "new")]), tokenizer, cache).collect()
    assert size() == 3
    spark.createDataFrame([(tokenizer.digest, r.digest, 77) for r in spark.read.parquet(cache).collect()], CACHE_SCHEMA).write.mode("append").parquet(cache)
    spark.createDataFrame([("another", b"x", 99)], CACHE_SCHEMA).write.mode("append").parquet(cache)
    spark.catalog.refreshByPath(cache)
    assert [r.n_tokens for r in token_counts(docs([(1, "a\nb")]), tokenizer, cache).collect()] == [77]
    assert token_counts(docs([]), tokenizer, cache).collect() == []


def test_packing_equals_the_library_and_has_no_gaps(spark, docs):
    library = Library.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = [(i, t) for i, t in texts() if i is not None]
    packed = pack_documents(docs(rows), Tokenizer(spark, public_tokenizers.path("word_bpe_49k.json")), capacity=64, with_ids=True).persist()
    want = []
    for i, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(i, k // 64, k, len(ids[k : k + 64]), zlib.crc32(ids[k : k + 64].tobytes())) for k in range(0, len(ids), 64)]
    assert sorted(tuple(r)[:5] for r in packed.drop("ids").collect()) == sorted(want)
    whole = {r.sequence_id: r.ids for r in sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids
    assert sum(map(len, whole.values())) == sum(w[3] for w in want) and max(map(len, whole.values())) <= 64
    packed.unpersist()
    assert pack_documents(docs([]), Tokenizer(spark, public_tokenizers.path("word_bpe_49k.json"))).collect() == []
    assert pack_documents(docs([(None, None)] * 3), Tokenizer(spark, public_tokenizers.path("word_bpe_49k.json"))).select("sequence_id").distinct().count() == 1


def test_several_shards_pack_every_piece_once_and_cost_less_than_a_sequence_each(spark):
    rng = np.random.default_rng(4)
    sizes = np.minimum(rng.geometric(0.05, 3000), 64)
    pieces = spark.createDataFrame([(i, 0, 0, int(n), i) for i, n in enumerate(sizes)], "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    made = {}
    for shard in (100_000, 300):
        rows = pack_pieces(pieces, 64, shard).collect()
        assert sorted((r.doc_id, r.length) for r in rows) == [(i, int(n)) for i, n in enumerate(sizes)]
        by = {}
        for r in rows:
            by.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for places in by.values():
            places.sort()
            assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:], strict=False)) and sum(places[-1]) <= 64
        made[shard] = len(by)
    least = -(-int(sizes.sum()) // 64)
    assert least <= made[100_000] <= least + 1 and made[300] <= made[100_000] + 10


def test_each_place_makes_the_sum_of_squares_least():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 41, 400)
    sequence, offset = place(sizes, 40)
    level, counts = {}, np.zeros(41, np.int64)
    for size, s, o in zip(sizes.tolist(), sequence.tolist(), offset.tolist(), strict=True):
        assert level.get(s, 0) == o

        def after(h, size=size):
            n = counts.copy()
            if h:
                n[h] -= 1
            if h + size < 40:
                n[h + size] += 1
            return int((n**2).sum())

        choices = [after(h) for h in range(0, 41 - size) if h == 0 or counts[h]]
        assert after(o) == min(choices)
        if o:
            counts[o] -= 1
        if o + size < 40:
            counts[o + size] += 1
        level[s] = o + size
    assert max(level.values()) <= 40


def test_word_hashes_know_words_alone():
    hashes, counts = word_hashes([b"", b"Ab cd\tAB", b"  x ", b"ab", "é É".encode(), b"a\x85b"])
    assert counts.tolist() == [0, 3, 1, 1, 2, 1] and len(hashes) == 8
    assert hashes[0] == hashes[2] == hashes[4] and len({*hashes.tolist()}) == 6
    rng = random.Random(1)
    words = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 14))).encode() for _ in range(5000)]
    hashes, _ = word_hashes([b" ".join(words)])
    assert len(set(hashes.tolist())) == len(set(words))


def test_words_that_go_straight_to_the_model_equal_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, "rb") as f:
        data = f.read()
    model = json.loads(data)
    assert encoder.takes_letters(model)
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice(rnd.choice(["abcdefghijklmnopqrstuvwxyz", "etaoin", "etaoin", "ABCXYZ", "0129", ".,;:!?", "'", "-()", "éüß", "é"])) for _ in range(rnd.randrange(1, 9)))
    plain = lambda: "".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randrange(1, 14))) + rnd.choice(["", "", ".", ",", "...", "?!", ";:", ".)", "'s", "'s."])
    texts = [rnd.choice([" ", "\n", "\t "]).join(rnd.choice([word, plain])() for _ in range(rnd.randrange(60))) for _ in range(400)]
    texts += ["x" * 500, ("y" * 300 + ". ") * 3, "<|endoftext|> don't. can't, we'll; they're: I'd! it's?", ".,;:!?", "a", ""]
    library = Library.from_file(path)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for bound in (encoder.REMEMBERED_BYTES, 2000):
        before, encoder.REMEMBERED_BYTES = encoder.REMEMBERED_BYTES, bound
        try:
            made = encoder.Encoder(data, "json", True, True, True)
            got = [np.frombuffer(x, "<u4").tolist() for a in range(0, len(texts), 37) for x in made.ids([t.encode() for t in texts[a : a + 37]])]
        finally:
            encoder.REMEMBERED_BYTES = before
        assert got == want
        assert made.held <= bound // 2 + 1
