import duckdb
import public_tokenizers
import pytest
from test_decontam import best
from test_near_dup import brute
from test_pii import spans
from tokenizers import Tokenizer

import corpus_pipeline
from cdcflow.llm.decontam import LEAST_CHARS, budget, normal
from cdcflow.llm.queries import ORACLES
from cdcflow.session import materialize


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], sf_dir), name.replace(" ", "-")))
    return out


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns_of_documents(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns and [f.dataType for f in df.schema] == [f.dataType for f in stages[0].schema]


def test_quality_stage_equals_the_sql_twin(stages, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    assert set(rows(stages[1])) == {i for (i,) in con.execute(f"select doc_id from ({ORACLES['op4_quality_rules']}) where kept").fetchall()}


def test_near_duplicate_stage_equals_brute_force(stages):
    before = rows(stages[1])
    assert set(rows(stages[2])) == {i for i, (_, c) in brute(list(before.items()), 5).items() if i == c}


def test_decontamination_stage_equals_brute_force(spark, stages, sf_dir):
    items = [normal(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert min(map(len, items)) >= LEAST_CHARS  # shorter ones are in test_decontam
    probe = items

    def held(text):
        text = normal(text or "")
        # a match leaves one of the budget + 1 parts whole: the full matrix is only needed where one is
        near = [t for t in probe if any(t[len(t) * k // (budget(len(t)) + 1) : len(t) * (k + 1) // (budget(len(t)) + 1)] in text for k in range(budget(len(t)) + 1))]
        return any(best(t, text) <= budget(len(t)) for t in near)

    assert set(rows(stages[3])) == {i for i, t in rows(stages[2]).items() if not held(t)}


def test_personal_data_is_gone_and_other_texts_are_untouched(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(before) == set(after) and not any(spans(t) for t in after.values())
    assert sum(bool(spans(t)) for t in before.values()) > 0
    assert all(after[i] == t for i, t in before.items() if not spans(t))


def test_packing_holds_every_token_once(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in rows(stages[4]).items()}
    got, by = {}, {}
    for r in stages[5].collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    for places in by.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:], strict=False)) and sum(places[-1]) <= 4096
    assert len(by) <= sum(want.values()) / 4096 * 1.1 + 1


def test_run_gives_the_last_stage(spark, stages, sf_dir):
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).select(*cols).collect())) == sorted(map(tuple, stages[5].select(*cols).collect()))


def test_rows_are_told_apart_by_id_and_text(spark, sf_dir, docs):
    words = lambda n, k: " ".join(f"wo{k}{i:x}" for i in range(n))
    rows = [(3, words(80, 1)), (5, words(80, 2)), (5, words(80, 1)), (None, words(80, 3)), (None, words(80, 3)), (None, words(80, 3)), (None, words(80, 1)), (9, words(80, 2) + " tail"), (8, None), (8, None), (8, "")]
    left = corpus_pipeline.near_duplicate_removal(spark, docs(rows), sf_dir).collect()
    assert sorted((r.doc_id or 0, (r.text or "")[:9]) for r in left) == [(0, "wo30 wo31"), (3, "wo10 wo11"), (5, "wo20 wo21"), (8, ""), (8, "")]
    assert corpus_pipeline.near_duplicate_removal(spark, docs([]), sf_dir).collect() == []


def test_odd_rows_pass_all_stages(spark, sf_dir, docs):
    words = lambda n, k: " ".join(f"wo{k}{i:x}" for i in range(n))
    texts = [(1, None), (2, ""), (3, words(80, 1)), (3, words(80, 1)), (4, words(80, 1)), (None, words(80, 2)), (None, words(80, 2)), (5, words(30_000, 3)), (6, "a@b.example " + words(60, 4))]
    df = docs(texts).selectExpr("*", "cast(null as string) as lang", "cast(null as string) as source")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        df = materialize(stage(spark, df, sf_dir), "odd")
    assert sorted((r.doc_id or 0, (r.text or "")[:9]) for r in df.collect()) == [(0, "wo20 wo21"), (3, "wo10 wo11"), (5, "wo30 wo31"), (6, "[EMAIL] w")]
    empty = docs([]).selectExpr("*", "cast(null as string) as lang", "cast(null as string) as source")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf_dir)
    assert empty.collect() == []
