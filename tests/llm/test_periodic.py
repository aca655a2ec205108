import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cdcflow.llm.periodic import find_runs, periodic_runs, run_digests, seed_classes, with_planted_runs
from cdcflow.llm.queries import op12_periodic_runs


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if all(words[i] == words[i + q] for i in range(len(words) - q)))


def brute_runs(words, least=6, times=4):
    """Every stretch that agrees with itself moved by q, as far as it goes, if q is its smallest period."""
    n, found = len(words), []
    for q in range(1, n // times + 1):
        at = 0
        while at < n - q:
            end = at
            while end < n - q and words[end] == words[end + q]:
                end += 1
            if end > at and end - at + q >= max(least, times * q) and smallest_period(words[at : end + q]) == q:
                found.append((at, end - at + q, q))
            at = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = planted(doc_id, (text or "").split())
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, sha(lines), sha(" ".join(collapsed(words, runs))))


def digests(df):
    return [tuple(r) for r in run_digests(df).collect()]


def thue_morse(n):
    return [bin(i).count("1") % 2 for i in range(n)]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("seed", range(30))
def test_runs_match_brute_force(seed):
    rnd = random.Random(seed)
    words = []
    while len(words) < 400:
        unit = [rnd.randrange(rnd.choice([1, 2, 3, 50])) for _ in range(rnd.choice([1, 2, 3, 5, 6, 7, 18, 19, 40, 58, 60]))]
        words += unit * rnd.choice([1, 1, 3, 4, 5, 8]) + unit[: rnd.randrange(len(unit) + 1)]
    assert find_runs(np.array(words)) == brute_runs(words)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70), st.integers(1, 8), st.integers(3, 5))
def test_small_alphabets(words, least, times):
    assert find_runs(np.array(words, np.int64), least, times) == brute_runs(words, least, times)


@pytest.mark.parametrize("words", [[], [1], [7] * 500, thue_morse(600), fibonacci(600), [*thue_morse(64), *thue_morse(64)] * 3, [0, 1] * 3, [0, 0, 0, 0, 0]])
def test_structured_words(words):
    assert find_runs(np.array(words, np.int64)) == brute_runs(words)


def test_classes_leave_no_lag_out():
    for least, times in ((6, 4), (1, 3), (20, 5)):
        classes = list(seed_classes(10_000, least, times))
        lags = [q for low, high, _ in classes for q in range(low, high + 1)]
        assert lags == list(range(1, len(lags) + 1)) and len(lags) >= 10_000 // times
        assert all(seed >= q and seed <= max(least, times * q) - q for low, high, seed in classes for q in range(low, high + 1))


def test_long_text_with_long_period(spark, docs):
    rnd = random.Random(5)
    unit = [f"w{rnd.randrange(5000)}" for _ in range(20_000)]
    text = " ".join(unit * 5 + unit[:7])
    (row,) = periodic_runs(docs([(1, text)])).collect()
    assert [tuple(r) for r in row.runs] == [(0, 100_007, 20_000)] and row.collapsed == " ".join(unit)


def test_edge_rows(docs):
    rows = [(1, None), (2, ""), (3, " \t\n "), (None, "a a a a a a"), (5, "a a a a a a"), (5, "a a a a a a"), (6, "a a a a a"), (7, "x\ta\x0bb a\fb\ra b a b\na b y"), (8, "A a A a A a A a")]
    found = {}
    for r in periodic_runs(docs(rows)).collect():
        found.setdefault(r.doc_id, []).append(([tuple(x) for x in r.runs], r.collapsed, r.n_words))
    assert found[1] == found[2] == found[3] == [([], "", 0)]
    assert found[None] == [([(0, 6, 1)], "a", 6)] and found[5] == [([(0, 6, 1)], "a", 6)] * 2
    assert found[6] == [([], "a a a a a", 5)]
    assert found[7] == [([(1, 10, 2)], "x a b y", 12)]
    assert found[8] == [([(0, 8, 2)], "A a", 8)]
    assert periodic_runs(docs([])).count() == 0


def test_digests_and_planted_texts(spark, docs):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice(["a", "b", "c é", "d\n"]) for _ in range(rnd.randrange(90)))) for i in range(300)] + [(301, None), (302, "a b a b a b a b c c c c c c c")]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 10
    assert sorted(digests(periodic_runs(with_planted_runs(docs(rows))))) == sorted(expected(i, t) for i, t in rows)


def test_query_over_the_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in rows if len(r.text or "") < 4000]
    found = {r.doc_id: tuple(r) for r in op12_periodic_runs(spark, sf_dir).collect()}
    assert len(found) == len(rows)
    assert all(found[r.doc_id] == expected(r.doc_id, r.text) for r in short)
    assert sum(x[1] > 0 for x in found.values()) > 5
