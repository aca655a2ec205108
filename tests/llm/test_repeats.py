import hashlib
import random

import duckdb
import pytest

from cdcflow.llm.queries import ORACLES, op11_substring_dedup
from cdcflow.llm.repeats import Params, repeat_digests, without_repeats

SMALL = Params(slot_bytes=300, row_codes=0)


def brute(rows, words=20):
    """(doc_id, n_words, removed words, kept text) of documents in the order of their ids."""
    seen, out = set(), []
    order = sorted({(i is None, i or 0, t or "") for i, t in rows})
    for missing, i, text in order:
        w, gone = text.split(), set()
        for at in range(len(w) - words + 1):
            key = tuple(w[at : at + words])
            if key in seen:
                gone.update(range(at, at + words))
            seen.add(key)
        out.append((None if missing else i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_words, sum(x.length for x in r.removed), r.kept) for r in df.collect()), key=str)


def prose(rnd, n, vocabulary=2000):
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed, n=60):
    rnd = random.Random(seed)
    passages = [prose(rnd, rnd.choice([15, 19, 20, 21, 25, 60, 200])) for _ in range(12)]
    rows = []
    for i in rnd.sample(range(1000), n):
        w = prose(rnd, rnd.randrange(30))
        for _ in range(rnd.randrange(4)):
            w += rnd.choice(passages) + prose(rnd, rnd.randrange(25))
        if rows and rnd.random() < 0.2:
            w = rnd.choice(rows)[1].split() + prose(rnd, rnd.randrange(3))
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(docs, seed):
    rows = corpus(seed)
    expected = brute(rows)
    assert sum(n > 0 for _, _, n, _ in expected) > 10
    assert found(without_repeats(docs(rows), SMALL)) == expected


def test_few_words_and_much_overlap(docs):
    rnd = random.Random(9)
    rows = [(i, " ".join(prose(rnd, rnd.randrange(120), 2))) for i in range(40)] + [(50, "a " * 200), (51, "a " * 19), (52, "a " * 20), (53, "b a " * 60)]
    assert found(without_repeats(docs(rows), SMALL)) == brute(rows)


@pytest.mark.parametrize("words", [2, 6, 12])
def test_other_lengths(docs, words):
    rnd = random.Random(words)
    rows = [(i, " ".join(prose(rnd, rnd.randrange(60), 9))) for i in range(30)]
    assert found(without_repeats(docs(rows), Params(words, 300, 0))) == brute(rows, words)


def test_every_block_offset(docs):
    rnd = random.Random(4)
    passage = prose(rnd, 20)
    rows = [(i, " ".join(prose(rnd, i % 13) + passage + prose(rnd, i % 7))) for i in range(26)]
    result = found(without_repeats(docs(rows)))
    assert result == brute(rows) and [n for _, _, n, _ in sorted(result)] == [0] + [20] * 25


def test_edge_rows(docs):
    rnd = random.Random(2)
    text, other = " ".join(prose(rnd, 30)), " ".join(prose(rnd, 40))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, text), (9, text.replace(" ", "\x0b\n")), (None, other + " é"), (None, text + " x"), (7, "short text"), (8, text.upper())]
    got = found(without_repeats(docs(rows)))
    assert got == brute(rows)
    assert ("short text" in [k for *_, k in got]) and (9, 30, 30, "") in got and (None, 31, 30, "x") in got
    assert without_repeats(docs([])).count() == 0


def test_rows_that_repeat(docs):
    """Rows that repeat id and text are one document; equal ids with other texts are ordered by digest."""
    rnd = random.Random(3)
    a, b, c = (" ".join(prose(rnd, 30)) for _ in range(3))
    got = found(without_repeats(docs([(5, a + " " + b), (5, a + " " + b), (6, b + " tail"), (7, a + " z " + a)])))
    assert [r for r in got if r[0] == 5] == [(5, 60, 0, a + " " + b)] * 2
    assert [r for r in got if r[0] != 5] == [(6, 31, 30, "tail"), (7, 61, 60, "z")]
    got = found(without_repeats(docs([(1, a + " x"), (1, a + " y"), (2, c)])))
    assert sorted(n for i, _, n, _ in got if i == 1) == [0, 30]


def test_one_passage_in_all_documents(docs):
    rnd = random.Random(8)
    passage = " ".join(prose(rnd, 300))
    rows = [(i, f"{passage} own{i}") for i in range(400)]
    got = found(without_repeats(docs(rows), SMALL))
    assert sorted(n for _, _, n, _ in got) == [0] + [300] * 399


def test_very_long_text(docs):
    rnd = random.Random(6)
    words = prose(rnd, 60_000, 100_000)
    rows = [(1, " ".join(words)), (2, " ".join(words[31_007:31_107]))]
    assert found(without_repeats(docs(rows))) == brute(rows)


def test_maximal_spans(docs):
    rnd = random.Random(7)
    a, b = prose(rnd, 50), prose(rnd, 33)
    rows = [(1, " ".join(a + ["u"] + b)), (2, " ".join(["p", "q", *b, "r", *a, "s"]))]
    removed = {r.doc_id: [tuple(x) for x in r.removed] for r in without_repeats(docs(rows)).collect()}
    assert removed == {1: [], 2: [(2, 33), (36, 50)]}


def test_texts_are_shuffled_once(docs):
    plan = without_repeats(docs(corpus(1)))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_query_and_twin(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = [(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in brute([(r.doc_id, r.text) for r in rows])]
    assert sorted(tuple(r) for r in op11_substring_dedup(spark, sf_dir).collect()) == sorted(expected)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    assert sorted(con.execute(ORACLES["op11_substring_dedup"]).fetchall()) == sorted(expected)


def test_rows_grow_with_the_corpus():
    sizes = [10**k for k in range(6, 16)]
    assert all(Params().slots(n) ** 2 * 3 <= 3 + n / 200 for n in sizes)
    assert Params().slots(0) == 1 and Params().slots(10**9) == 238 and 10**14 / Params().slots(10**14) < 300 << 20


def test_digests(docs):
    (row,) = repeat_digests(without_repeats(docs([(1, "a  b")]))).collect()
    assert tuple(row) == (1, 2, 0, hashlib.sha256(b"a b").hexdigest())
