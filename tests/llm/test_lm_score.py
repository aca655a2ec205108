import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from cdcflow.llm.lm_score import _CLASS, DEPTH, lm_scores


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


class Brute:
    """The same tree, node by node, over dictionaries."""

    def __init__(self, texts):
        self.n = defaultdict(lambda: [0, 0])
        self.below = defaultdict(set)
        for t in texts:
            for path, node, bit in self.bits(t):
                for d in range(DEPTH + 1):
                    self.n[path[:d], node][bit] += 1
                    if d:
                        self.below[path[: d - 1], node].add(path[:d])
        self.w = {}

    @staticmethod
    def bits(text):
        past = [26] * DEPTH
        for byte in text:
            node = 1
            for k in range(7, -1, -1):
                bit = byte >> k & 1
                yield tuple(past), node, bit
                node = node * 2 + bit
            past = [int(_CLASS[byte]), *past[:-1]]

    def weighted(self, path, node):
        if (path, node) not in self.w:
            own = kt(*self.n.get((path, node), (0, 0)))
            if len(path) < DEPTH:
                kids = sum(self.weighted(x, node) for x in self.below.get((path, node), ()))
                top = max(own, kids)
                own = top + math.log(math.exp(own - top) + math.exp(kids - top)) - math.log(2)
            self.w[path, node] = own
        return self.w[path, node]

    def p(self, path, node, bit, d=0):
        a = self.n.get((path[:d], node), (0, 0))
        own = (a[bit] + 0.5) / (sum(a) + 1)
        if d == DEPTH:
            return own
        share = math.exp(kt(*a) - math.log(2) - self.weighted(path[:d], node))
        return share * own + (1 - share) * self.p(path, node, bit, d + 1)

    def score(self, text):
        return sum(math.log10(self.p(*x)) for x in self.bits(text))


def expected(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    learnt = [t for i, t in texts if not held(i)]
    tree, words = Brute(learnt), Counter()
    for t in learnt:
        words.update([*re.findall(rb"[^\x20\x09-\x0D]+", t.lower()), None])
    n, v = sum(words.values()), len(words)
    out = []
    for i, t in texts:
        tokens = [*re.findall(rb"[^\x20\x09-\x0D]+", t.lower()), None]
        base = sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        out.append((i, held(i), len(tokens), sum(words[w] > 0 for w in tokens), n, round(base, 6), round(tree.score(t), 2)))
    return sorted(out, key=str)


def found(df):
    rows = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 2)) for r in df.collect()]
    return sorted(rows, key=str)


def close(got, want):
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5:] == pytest.approx(w[5:], abs=0.02)


def test_equals_brute_force(docs):
    rng = random.Random(5)
    words = ["the", "The", "and", "é", "straße", "x1", "漢字", "a.b", "42"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 25)))) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "the and"), (7, rows[7][1]), (200, "Zed\n\tqux  "), (300, " x y")]
    close(found(lm_scores(docs(rows))), expected(rows))


def test_rare_words_come_by_join(docs, monkeypatch):
    monkeypatch.setattr("cdcflow.llm.lm_score.HEAVY", 5)
    rows = [(i, f"the the and w{i % 7} w{i}") for i in range(40)] + [(3, "the the and w3 w3")]
    close(found(lm_scores(docs(rows))), expected(rows))


def test_empty_table_and_long_text(docs):
    assert lm_scores(docs([])).collect() == []
    row = lm_scores(docs([(1, "ab " * 200_000)])).first()
    assert row.n_tokens == 200_001 and row.bits_per_byte < 0.05


def test_held_out_code_length_beats_single_bytes(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = b"".join(r.text.encode() for r in df.collect() if held(r.doc_id))
    single = -sum(n * math.log2(n / len(text)) for n in Counter(text).values())
    assert 0 < -sum(r.score for r in lm_scores(df).collect() if r.held_out) * math.log2(10) < 0.85 * single


def test_contexts_beyond_three_bytes_and_digits_count(docs):
    rng = random.Random(3)
    ends = {"17abc": "x", "28abc": "y", "漢1": "p", "漢2": "q"}
    rows = [(i, "".join(k + ends[k] for k in rng.choices(sorted(ends), k=60))) for i in range(200)]
    rows += [(1000, "17abcx28abcy漢1p漢2q" * 5), (1001, "17abcy28abcx漢1q漢2p" * 5)]
    score = {r.doc_id: r.score for r in lm_scores(docs(rows)).collect()}
    assert score[1000] > score[1001] + 20
