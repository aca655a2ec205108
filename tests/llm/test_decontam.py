import random

import pytest

from cdcflow.llm import decontam
from cdcflow.llm.decontam import _places, budget, contaminated, decontaminated, myers, normal, pieces, stands_alone


def best(item, text):
    """Least edits of the item in any part of the text, by the whole matrix."""
    row = list(range(len(item) + 1))
    least = row[-1]
    for c in text:
        new = [0]
        for i, d in enumerate(item, 1):
            new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (c != d)))
        row = new
        least = min(least, row[-1])
    return least


def edit(rng, text, n):
    chars = list(text)
    for _ in range(n):
        i = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[i] = rng.choice("xyz")
        elif kind == 1:
            del chars[i]
        else:
            chars.insert(i, rng.choice("xyz"))
    return "".join(chars)


def test_myers_equals_the_matrix():
    rng = random.Random(1)
    for _ in range(300):
        item = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 90)))
        text = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 60))) + edit(rng, item + "a", rng.randrange(6))
        want = best(item, text)
        got = myers(_places(item), len(item), text, len(item))
        assert (got[0] if got else len(item)) == want


def test_pieces_cover_the_item():
    for n in range(1, 200):
        item = "".join(chr(97 + i % 26) for i in range(n))
        for k in range(0, min(n, 12)):
            cut = pieces(item, k)
            assert len(cut) == k + 1 and "".join(p for _, p in cut) == item and all(item[a:].startswith(p) and p for a, p in cut)


def rows_of(df):
    return {(r.doc_id, r.item_id): r.distance for r in df.collect()}


def brute(docs, items):
    out = {}
    for i, t in docs:
        for k, item in items:
            x, y = normal(item or ""), normal(t or "")
            if 0 < len(x) < decontam.LEAST_CHARS:
                if any(y.startswith(x, a) and stands_alone(y, a, a + len(x)) for a in range(len(y))):
                    out[i, k] = 0
            elif x and (d := best(x, y)) <= budget(len(x)):
                out[i, k] = d
    return out


@pytest.mark.parametrize("block", [500_000, 300])
def test_equals_brute_force(spark, docs, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_CHARS", block)
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("aeinrst") for _ in range(rng.randrange(2, 7)))
    items = [(k, " ".join(word() for _ in range(rng.randrange(6, 40)))) for k in range(12)] + [(50, "short"), (51, None), (None, "a passage that nobody can name at all"), (52, "É" * 30)]
    rows = [(-1, None), (-2, ""), (-3, "é" * 30), (-4, " É" * 30)]
    for i in range(60):
        k, item = rng.choice(items[:12])
        held = edit(rng, item, rng.randrange(0, budget(len(item)) + 3)) if rng.random() < 0.8 else " ".join(word() for _ in range(20))
        rows.append((i, " ".join(word() for _ in range(rng.randrange(10))) + "\n " + held.upper().replace(" ", " \t") + " " + word()))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, items)
    assert len(want) > 20
    assert rows_of(contaminated(docs(rows), bench)) == want
    assert {r.doc_id for r in decontaminated(docs(rows), bench).collect()} == {i for i, _ in rows} - {i for i, _ in want}


def test_spans_lie_in_the_text_as_it_is(spark, docs):
    item = "Was  it the butler\nor the gardener who did it?"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    text = "İ 😀 \n so:\t" + "WAS it   the butler or the gardener who did it?" + "  end"
    got = contaminated(docs([(1, text), (1, text), (2, "x" * 200_000 + " " + text)]), bench).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == [1, 1, 2]
    assert all(text[r.start : r.end] == "WAS it   the butler or the gardener who did it?" and r.distance == 0 for r in got[:2])


def test_short_items_items_without_id_and_repeated_texts(spark, docs):
    long = "a passage that nobody can name at all"
    items = [(1, "what is 17 times 23"), (2, "Ab"), (None, long), (7, long), (8, long), (9, ""), (10, None), (11, "42?")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, "so What is 17  times\n23?"), (2, "what is 17 times 234"), (3, "xwhat is 17 times 23"), (4, "cab abc ab, b"), (5, f"see {long}s!"), (6, "answer: 42?"), (7, "1 42?"), (8, "142?"), (None, "AB"), (10, "clean")]
    got = {(r.doc_id, r.item_id) for r in contaminated(docs(rows), bench).collect()}
    assert got == {(1, 1), (4, 2), (5, None), (5, 7), (5, 8), (6, 11), (7, 11), (None, 2)}
    assert sorted(r.doc_id for r in decontaminated(docs(rows), bench).collect()) == [2, 3, 8, 10]


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a passage of more than enough characters")], "item_id long, text string")
    assert contaminated(docs([(1, "x")]), none).collect() == []
    assert contaminated(docs([]), some).collect() == [] and decontaminated(docs([(1, "x")]), some).columns == docs([]).columns
