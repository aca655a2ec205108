import re
from collections import Counter

import duckdb

from cdcflow.llm.queries import ORACLES, op4_quality_rules
from cdcflow.llm.quality import cutoffs, quality_filter, quality_verdicts, with_counts


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len({i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}))


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", "y") for r in rows], "doc_id long, lang string, source string, text string, n_words int, kept string, quality_counts string")


def found(df):
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in df.collect()), key=str)


def test_equals_sql_twin(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = sorted(tuple(r) for r in op4_quality_rules(spark, sf_dir).select(*cols).collect())
    assert got == sorted(con.execute(f"select {', '.join(cols)} from ({ORACLES['op4_quality_rules']})").fetchall())
    good = {i for (i,) in con.execute(f"select doc_id from '{sf_dir}/labels.parquet' where quality = 1").fetchall()}
    bad = {i for (i,) in con.execute(f"select doc_id from '{sf_dir}/labels.parquet' where quality = 0").fetchall()}
    kept = {r[0] for r in got if r[-1]}
    failed = {r[0] for r in got if r[-2]}
    assert not kept & bad and good - failed <= kept


def test_counts_and_odd_rows(spark):
    texts = [None, "", " \n\t", "a b c a b c", "a a a a", "x\ny\nx\n\n\n x", "é 😀 #*$%&|<>", "a b c d\x0ba b c\x0c\r", "one two", "a\x85b c", ("la " * 40_000).strip(), "a b a b a b x y z a b a"]
    rows = [(i, [None, "en", "de"][i % 3], [None, "s"][i % 2], t) for i, t in enumerate(texts)] + [(None, None, None, "k k k k"), (3, "en", "s", "z")]
    got = found(quality_verdicts(frame(spark, rows)))
    assert got == sorted(((i, *counts(t)) for i, _, _, t in rows), key=str)
    assert all(not r.kept and r.base_failed for r in quality_verdicts(frame(spark, rows)).collect())


def test_cutoffs_follow_the_group(spark):
    table = lambda i: " ".join(f"cell{i}{k} |" if k % 4 == 0 else f"cell{i}{k}" for k in range(80))
    prose = lambda i: " ".join(f"word{i}{k}" for k in range(80))
    rows = [(i, "en", "tables", table(i)) for i in range(300)] + [(1000 + i, "en", "prose", prose(i)) for i in range(300)] + [(5000, "en", "prose", table(1))]
    df = frame(spark, rows)
    limits = {r.source: r.symbols_high for r in cutoffs(with_counts(df)).collect()}
    assert limits["tables"] > limits["prose"] and limits["prose"] < 250
    kept = quality_filter(df).collect()
    assert {r.doc_id for r in kept} == {r[0] for r in rows} - {5000}
    assert all((r.n_words, r.kept, r.quality_counts) == (7, "x", "y") for r in kept)  # the table's own columns of these names
    assert quality_filter(df).columns == df.columns and quality_verdicts(frame(spark, [])).collect() == []


def prose(i, n=100, word="word"):
    return " ".join(f"{word}{i:04d}{k:03d}" for k in range(n))


def test_ordinary_texts_of_a_group_are_kept_whatever_their_ratios(spark):
    cells = lambda i: " ".join("|" if k % 2 == 0 else f"{i:03d}{k:02d}" for k in range(80))
    long = lambda i: prose(i, 80, "w" * 20)
    lines = lambda i: "\n".join([f"row{i:03d} one{i:03d}"] + ["end"] * 60 + [f"k{i:03d}x{k:02d}" for k in range(60)])
    rows = [(1000 * g + i, "en", f"s{g}", f(i)) for g, f in enumerate((cells, long, lines)) for i in range(800)]
    rows += [(9000, "en", "s1", cells(1)), (9001, "en", "s2", long(1))]
    df = frame(spark, rows)
    base = {r.doc_id for r in quality_verdicts(df).collect() if r.base_failed}
    assert {r.doc_id for r in quality_filter(df).collect()} == {r[0] for r in rows} - base - {9000, 9001}
    assert base.isdisjoint(range(0, 2000))


def test_a_clean_source_is_judged_more_strictly_than_a_mixed_one(spark):
    """No fixed number decides: the same text goes from a source of plain prose and stays in one of marked-up texts."""
    marked = lambda i, m: " ".join(f"word{i:04d}{k:03d}" + ("*" if k < m else "") for k in range(100))
    rows = [(i, "en", "plain", prose(i)) for i in range(600)] + [(1000 + i, "en", "wiki", marked(i, i % 9)) for i in range(600)]
    rows += [(5000, "en", "plain", marked(2000, 8)), (5001, "en", "wiki", marked(2001, 8))]
    kept = {r.doc_id for r in quality_filter(frame(spark, rows)).collect()}
    assert 5000 not in kept and kept >= {r[0] for r in rows} - {5000}


def test_verdicts_do_not_hang_on_the_size_of_a_group(spark):
    """Cutoffs move from the language's to the source's own as texts come in, without a jump at any number."""
    marked = lambda i: " ".join(f"word{i:04d}{k:03d}" + ("|" if k < 30 + i % 3 else "") for k in range(100))
    base = [(i, "en", "plain", prose(i)) for i in range(400)]
    highs = {}
    for n in (1, 49, 50, 51, 199, 200, 201, 800):
        rows = base + [(1000 + i, "en", "tables", marked(i)) for i in range(n)]
        highs[n] = next(r.symbols_high for r in cutoffs(with_counts(frame(spark, rows))).collect() if r.source == "tables")
    assert highs[1] < 10 and 100 < highs[50] < 250 and highs[800] > 250
    assert all(abs(highs[n] - highs[n - 1]) <= 10 for n in (50, 51, 200, 201))


def test_twin_on_a_table_where_cutoffs_differ(spark):
    import random

    rnd = random.Random(3)
    rows = []
    for i in range(900):
        source = rnd.choice(["a", "a", "a", "b", "c", None])
        words = [rnd.choice(["alpha", "be", "gammadelta", f"x{i}", f"y{rnd.randrange(50)}"]) + ("|" if source == "b" and rnd.random() < 0.4 else "") for _ in range(rnd.randrange(40, 160))]
        text = "".join(w + rnd.choice([" ", " ", " ", "\n"]) for w in words) + ("\nend" * rnd.randrange(9) if source == "c" else "")
        rows.append((i, rnd.choice(["en", "de", None]), source, text if i % 50 else None))
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, lang varchar, source varchar, text varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?)", rows)
    got = sorted((r.doc_id, r.kept) for r in quality_verdicts(frame(spark, rows)).collect())
    assert got == sorted(con.execute(f"select doc_id, kept from ({ORACLES['op4_quality_rules']})").fetchall())
    assert 0 < sum(k for _, k in got) < 850
