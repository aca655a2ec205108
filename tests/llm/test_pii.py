import hashlib
import random
import re

from cdcflow.llm.pii import KINDS, Disclosure, _contexts, disclosing_terms, pii_report, sanitise

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def valid(kind, v):
    d = re.sub("[^0-9]", "", v)
    return {"email": True, "ip": all(int(p) <= 255 for p in v.split(".")) if kind == "ip" else None, "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]


def spans(text):
    found = [(m.start(), n, m.end(), k) for n, k in enumerate(KINDS) for m in re.finditer(PLAIN[k], text or "") if valid(k, m[0])]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]


def expected(rows):
    out = []
    for i, t in rows:
        s = spans(t)
        out.append((i, *[sum(x.startswith(k + ":") for x in s) for k in KINDS], hashlib.sha256(",".join(s).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii_report(df).collect()), key=str)


def test_equals_plain_patterns_on_given_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = expected([(r.doc_id, r.text) for r in df.collect()])
    assert sum(sum(w[1:5]) for w in want) > 10 and found(df) == want


def test_equals_plain_patterns_on_random_texts(docs):
    rng = random.Random(9)
    bits = ["a@b.c", "+", "@", ".", "-", " ", "\n", "1", "4111 1111 1111 1111", "12345678901234", "256.1.2.3", "1.2.3.4", "(030)", "é", "😀", "x.y%", "_", "0000255", "5", "a@b", "00.00.00.255", "37-8282-2463-10005"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(1, 30)))) for i in range(1500)]
    rows += [(-1, None), (-2, ""), (None, "a@b.co"), (None, None), (3, rows[3][1]), (-3, "a" * 60_000), (-4, "1 " * 30_000), (-5, "1.2.3.4 a@b.c " * 2500), (-6, "a@b" + ".c" * 30_000), (-7, "+1" + " " * 50_000)]
    assert found(docs(rows)) == expected(rows)


def test_terms_that_give_a_value_away_are_added_and_replaced(docs):
    rng = random.Random(1)
    word = lambda: f"w{'abcdefgh'[rng.randrange(8)]}{'abcdefgh'[rng.randrange(8)]}"
    say = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, f"{say(30)}\n{say(4)} Zorblatt, writes from z@corp.example {say(3)}.\n{say(5)}") for i in range(6)]
    rows += [(100 + i, say(60)) for i in range(200)] + [(500, f"only ZORBLATT here {say(5)}"), (500, f"only ZORBLATT here {say(5)}"), (501, f"zorblatts {say(3)}"), (None, "zorblatt"), (502, None)]
    df = docs(rows)
    terms = {r.term: r.tag for r in disclosing_terms(df.select("doc_id", "text"), df).collect()}
    assert terms == {"zorblatt": "[WORD]", "writes": "[WORD]", "from": "[WORD]"}
    got = {}
    for r in pii_report(df).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, t in rows[:6]:
        at = t.index("Zorblatt")
        assert f"term:{at}:{at + 8}" in got[i][0].spans and got[i][0].n_terms == 3 and got[i][0].n_email == 1
    assert [r.spans for r in got[500]] == ["term:5:13"] * 2 and got[501][0].spans == "" and got[None][0].spans == "term:0:8" and got[100][0].n_terms == 0
    texts = [r.text for r in sanitise(df).orderBy("doc_id").collect()]
    assert sum("[WORD], [WORD] [WORD] [EMAIL] " in (t or "") for t in texts) == 6 and not any("orblatt," in (t or "") or "z@" in (t or "") for t in texts)
    assert sanitise(df).columns == df.columns and sum(t is None for t in texts) == 1


def test_copies_of_one_context_are_no_evidence(docs):
    df = docs([(i, "meet Quux at q@corp.example today") for i in range(50)] + [(100 + i, "plain words here") for i in range(100)])
    assert disclosing_terms(df.select("doc_id", "text"), df).collect() == []
    assert disclosing_terms(df.select("doc_id", "text"), df, Disclosure(support=1)).count() > 0


def test_sanitised_text_covers_overlaps_and_empty_tables(docs):
    df = docs([(1, "call +49 30 1234567890 or 4111111111111111@x.de\nend"), (2, "none")])
    assert [r.text for r in sanitise(df).orderBy("doc_id").collect()] == ["call [PHONE] or [EMAIL]\nend", "none"]
    assert pii_report(docs([])).collect() == [] and sanitise(docs([])).collect() == []


def test_names_on_a_neighbouring_line_are_found(docs):
    say = lambda n, i: " ".join(f"w{'abcdefgh'[(i * 7 + k * 3) % 8]}{'abcdefgh'[(i + k) % 8]}" for k in range(n))
    rows = [(i, f"{say(20, i)}\nName: Zorblatt\nMail: z@corp.example\n{say(6, i + 1)}") for i in range(6)]
    rows += [(100 + i, f"mail name {say(60, i)}") for i in range(200)]
    assert {r.term: r.tag for r in disclosing_terms(docs(rows).select("doc_id", "text"), docs(rows)).collect()} == {"zorblatt": "[WORD]"}
    assert not any("Zorblatt" in r.text for r in sanitise(docs(rows)).collect())


def test_contexts_hold_the_words_around_and_none_of_a_value(docs):
    text = "a b\n4111111111111111@x.de, c\n1.2.3.4 999.1.1.1 +49 30 1234567890\nd"
    got = {r.entity: list(r.terms) for r in _contexts(docs([(1, text)]), Disclosure(window=3)).collect()}
    assert got == {
        "0:4111111111111111@x.de": ["a", "b", "c", "999", "1"], "2:4111111111111111": ["a", "b", "c", "999", "1"],
        "1:1.2.3.4": ["a", "b", "c", "999", "1", "1"], "3:+49 30 1234567890": ["1", "1", "1", "d"],
    }


def test_numbers_that_give_a_value_away_are_replaced(docs):
    say = lambda n, i: " ".join(f"w{'abcdefgh'[(i * 7 + k * 3) % 8]}{'abcdefgh'[(i + k) % 8]}" for k in range(n))
    rows = [(i, f"{say(20, i)}\ncustomer 7730915\nmail z@corp.example or +49 30 1234567890 {say(6, i + 1)}") for i in range(6)]
    rows += [(100 + i, f"customer mail or {say(60, i)}") for i in range(200)]
    assert {r.term for r in disclosing_terms(docs(rows).select("doc_id", "text"), docs(rows)).collect()} == {"7730915"}
    assert not any("7730915" in r.text for r in sanitise(docs(rows)).collect())
