import random
import re
from collections import Counter

import duckdb
import pytest

from cdcflow.llm import phrases
from cdcflow.llm.phrases import Params, collocations, phrase_counts, vocabulary
from cdcflow.llm.queries import ORACLES

_SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(rows, longest=4):
    f = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_SMALL)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    f[lang or "und", tuple(w[i : i + m])] += 1
    return f


def brute(rows, p):
    f = counts(rows, p.longest)
    candidates = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= p.least}
    hidden = set()
    for (lang, w), a in candidates.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w) and 100 * a >= p.inside * candidates[lang, w[i:j]]:
                    hidden.add((lang, w[i:j]))
    out, n = [], Counter()
    for (lang, w), a in f.items():
        n[lang] += a * (len(w) == 1)
    for (lang, w), a in candidates.items():
        if (lang, w) not in hidden:
            score, _, l, r = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            out.append((lang, -score, -a, " ".join(w).encode(), l, r))
    result, rank = [], Counter()
    for lang, score, a, phrase, l, r in sorted(out):
        rank[lang] += 1
        if rank[lang] <= p.top:
            result.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return result


@pytest.fixture(scope="module")
def texts(spark):
    def make(rows):
        return spark.createDataFrame([(i, lang, text, "x", "x", 1) for i, (lang, text) in enumerate(rows)], "doc_id long, lang string, text string, n string, phrase string, w1 int")

    return make


def corpus(seed, n=120, vocabulary=12):
    rnd = random.Random(seed)
    words = ["A", "é", "Été", "x-y", "10%", *"bcdefghijk"][:vocabulary]
    fixed = [" ".join(rnd.choice(words) for _ in range(rnd.choice([2, 3, 4, 6]))) for _ in range(6)]
    rows = []
    for _ in range(n):
        parts = [rnd.choice(fixed) if rnd.random() < 0.5 else rnd.choice(words) for _ in range(rnd.randrange(40))]
        rows.append((rnd.choice(["en", "de", None]), "".join(x + rnd.choice([" ", " ", " \t ", ". ", ",", "\n", "\x0b"]) for x in parts)))
    return rows


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("p", [Params(), Params(least=3, top=25), Params(longest=3, least=2, inside=100), Params(longest=2, least=1, top=10)])
def test_against_brute_force(texts, seed, p):
    rows = corpus(seed)
    assert sorted(tuple(r) for r in collocations(texts(rows), p).collect()) == sorted(brute(rows, p))


def test_heavy_beginnings_are_cut_into_parts(texts, monkeypatch):
    """With a share that many pairs and triples reach, and small chunks, the counts are the same."""
    monkeypatch.setattr(phrases, "CHUNK", 500)
    rows = corpus(5, 300, 5)
    p = Params(share=0.02, least=8)
    words = vocabulary(texts(rows), p)
    total = words.where("kind = 0").groupBy().sum("n").first()[0]
    heavy = words.where(f"kind > 0 and n >= {0.01 * total}").groupBy("kind").count().collect()
    assert {r["kind"] for r in heavy} == {2, 3} and all(r["count"] <= 100 for r in heavy)
    found = phrase_counts(texts(rows), words, p)
    expected = Counter(a for (_, w), a in counts(rows).items() if len(w) > 1 and a >= p.least)
    assert Counter(r.f for r in found.collect()) == expected
    assert sorted(tuple(r) for r in collocations(texts(rows), p).collect()) == sorted(brute(rows, p))


def test_more_frequent_words_than_may_be_broadcast(texts, monkeypatch):
    monkeypatch.setattr(phrases, "BROADCAST_WORDS", 3)
    rows, p = corpus(7), Params(least=4)
    assert sorted(tuple(r) for r in collocations(texts(rows), p).collect()) == sorted(brute(rows, p))


def test_edge_rows(texts):
    p = Params(least=2)
    rows = [("en", None), ("en", ""), (None, " \t\n.,;"), ("und", "Ab ab AB ab"), (None, "ab ab"), ("en", "É é é é"), ("en", "one two; two one"), ("fr", "seul")]
    assert sorted(tuple(r) for r in collocations(texts(rows), p).collect()) == sorted(brute(rows, p))
    assert collocations(texts([]), p).count() == 0
    assert collocations(texts([("en", "")]), p).count() == 0


def test_ties_are_ordered_by_bytes(texts):
    rows = [("en", f"{a}q {a}r.") for a in ("z", "é", "a", "\U0001f600", "｡") for _ in range(3)]
    p = Params(least=3)
    found = collocations(texts(rows), p).orderBy("rank").collect()
    assert [r.phrase for r in found] == sorted((r.phrase for r in found), key=str.encode) and len(found) == 5


def test_very_long_text_and_hot_pair(texts):
    rnd = random.Random(1)
    rows = [("en", " ".join(f"hot pair v{rnd.randrange(500)}" for _ in range(20_000))), ("en", "hot pair " * 5000)]
    p = Params(top=300)
    assert sorted(tuple(r) for r in collocations(texts(rows), p).collect()) == sorted(brute(rows, p))


def test_twin(spark, sf_dir, texts):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] + corpus(2)
    con = duckdb.connect()
    con.execute("create table documents (lang varchar, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    expected = brute(rows, Params())
    assert len(expected) > 20
    assert sorted(con.execute(ORACLES["op13_collocations"]).fetchall()) == sorted(expected)
    assert sorted(tuple(r) for r in collocations(texts(rows)).collect()) == sorted(expected)
