import random
import re

import pytest

from cdcflow.llm.components import components
from cdcflow.llm.near_dup import Params, buckets, near_duplicates, rest_links, sketched


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, width):
    w = words_of(text)
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute(rows, width, percent=80):
    sets = {i: shingles(t, width) for i, t in rows}
    label = {i: i for i in sets}
    ids = sorted(sets)

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
                r, s = sorted((find(a), find(b)))
                label[s] = r
    return {i: (len(sets[i]), find(i)) for i in ids}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("width", [5])
def test_equals_brute_force_on_given_documents(spark, sf_dir, width):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert result(near_duplicates(df, Params(width=width))) == brute(rows, width)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**9)}"
    return " ".join(words)


def test_edited_copies_and_chains_equal_brute_force(docs):
    rng = random.Random(7)
    rows, at = [], 0
    for _ in range(6):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([30, 80, 300]))]
        for _ in range(25):
            rows.append((at, edited(rng, base, rng.randrange(0, 5))))
            at += 1
        step = base
        for _ in range(8):
            step = edited(rng, step, 1).split()
            rows.append((at, " ".join(step)))
            at += 1
    rng.shuffle(rows)
    assert result(near_duplicates(docs(rows), Params(width=4))) == brute(rows, 4)


def test_the_rest_alone_finds_every_component(spark, docs, monkeypatch):
    monkeypatch.setattr("cdcflow.llm.near_dup.CELL", 8)
    rng = random.Random(3)
    rows = []
    for g in range(3):
        base = [f"w{g}x{i}" for i in range(150)]
        rows += [(g * 100 + i, edited(rng, base, rng.randrange(1, 9))) for i in range(40)]
    df, p = docs(rows), Params(width=4)
    classes = sketched(df, p).withColumnRenamed("doc_id", "node")
    none = spark.createDataFrame([], "node long, component long")
    links = rest_links(buckets(classes), classes, none, df, p)
    found = {r.node: r.component for r in components(links).collect()}
    want = {i: c for i, (_, c) in brute(rows, 4).items()}
    assert len(set(want.values())) > 3 and {i: found.get(i, i) for i in want} == want


def test_defined_results_for_odd_rows(docs):
    long = "Word " * 20000
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a b"), (5, "A\tb"), (6, "b a"), (None, "a b"), (8, long), (8, long), (9, "word word word word"), (None, None)]
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs(rows), Params(width=4)).collect()))
    assert got == [
        (False, 1, 0, 1, True), (False, 2, 0, 2, True), (False, 3, 0, 3, True), (False, 4, 1, 4, True), (False, 5, 1, 4, False), (False, 6, 1, 6, True),
        (False, 8, 1, 8, True), (False, 8, 1, 8, True), (False, 9, 1, 8, False), (True, 0, 0, None, True), (True, 0, 1, None, True),
    ]
    assert near_duplicates(docs([])).collect() == []


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(300, 200), (200, 300), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)} | {200: 200, 300: 200}


def test_registered_query_equals_sql_twin(spark, sf_dir):
    import duckdb

    from cdcflow.llm.queries import ORACLES, op9_near_duplicates

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    cols = ["doc_id", "n_shingles", "component_id", "kept", "class_id"]
    got = sorted(tuple(r) for r in op9_near_duplicates(spark, sf_dir).select(*cols).collect())
    assert got == sorted(con.execute(f"select {', '.join(cols)} from ({ORACLES['op9_near_duplicates']})").fetchall())
