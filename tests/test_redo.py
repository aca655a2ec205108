import random

import pytest
from pyspark.sql import functions as F

from cdcflow.operators.dictionary import spark_type, typed_changes, typed_images
from cdcflow.operators.positions import WHOLE, Slices
from cdcflow.operators.redo import drop_internal, mined_rows, redo_from_message, redo_images, redo_statements, stitch_redo


def images(spark, sql, op):
    df = spark.createDataFrame([(sql, op)], "sql_redo string, operation string")
    return redo_images(df).select("before", "after").first()


def quote(v):
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


VALUES = [None, "1", "it's", "a, b", "x) values (", '" where "K" = ', "''", "two\nlines", " set ", "(", "é", "NULL", "end'"]


@pytest.mark.parametrize("seed", range(4))
def test_images_of_written_sql(spark, seed):
    rng = random.Random(seed)
    rows, want = [], []
    for i in range(60):
        cols = [f"C{j}" for j in range(rng.randint(1, 5))]
        old = {c: rng.choice(VALUES) for c in cols}
        new = {c: rng.choice(VALUES) for c in rng.sample(cols, rng.randint(1, len(cols)))}
        cond = " and ".join(f'"{c}" IS NULL' if v is None else f'"{c}" = {quote(v)}' for c, v in old.items())
        op = rng.choice(["INSERT", "UPDATE", "DELETE"])
        if op == "INSERT":
            sql = f'insert into "O"."T"({",".join(chr(34) + c + chr(34) for c in cols)}) values ({",".join(map(quote, old.values()))});'
            want.append((None, old))
        elif op == "UPDATE":
            sets = ", ".join(f'"{c}" = {quote(v)}' for c, v in new.items())
            sql = f'update "O"."T" set {sets} where {cond};'
            want.append((old, {**old, **new}))
        else:
            sql = f'delete from "O"."T" where {cond}'
            want.append((old, None))
        rows.append((i, sql, op))
    df = spark.createDataFrame(rows, "i int, sql_redo string, operation string")
    got = {r.i: (r.before, r.after) for r in redo_images(df).collect()}
    assert [got[i] for i in range(len(rows))] == want


def test_special_values(spark):
    r = images(spark, "update \"O\".\"T\" set \"A\" = TIMESTAMP ' 2020-01-02 03:04:05', \"B\" = HEXTORAW('c1)03'), \"C\" = 5 where \"A\" IS NULL and \"N\" = -1.5", "update")
    assert r.before == {"A": None, "N": "-1.5"}
    assert r.after == {"A": " 2020-01-02 03:04:05", "B": "HEXTORAW('c1)03')", "C": "5", "N": "-1.5"}
    assert images(spark, "create table x (a int)", "DDL") == (None, None)
    assert images(spark, "not sql at all", "INSERT") == (None, None)


def test_long_text_with_many_quotes(spark):
    body = "o''k " * 30_000
    r = images(spark, f'insert into "O"."T"("A","B") values (\'{body}\',\'2\')', "INSERT")
    assert r.after == {"A": body.replace("''", "'"), "B": "2"}


@pytest.mark.parametrize("layout", [WHOLE, Slices((0, 100, 101, 5_000), 3)])
def test_stitching_keeps_every_piece(spark, layout):
    rng = random.Random(1)
    rows, want, pos = [], {}, 0
    for rec in [0] * 30 + list(range(1, 50)):
        for stmt in range(rng.randint(1, 3)):
            sql = "".join(rng.choice("ab  '\n") for _ in range(rng.randint(1, 60)))
            first = pos
            pieces = [sql[i : i + 7] for i in range(0, len(sql), 7)]
            for i, piece in enumerate(pieces):
                rows.append(("s", "x", rec, pos, piece, int(i < len(pieces) - 1), f"t{rec}"))
                pos += 1
            want[first] = (sql, f"t{rec}")
    df = spark.createDataFrame(rows, "source string, xid string, rs_id int, pos long, sql_redo string, csf int, tbl string")
    got = {r.pos: (r.sql_redo, r.tbl) for r in stitch_redo(df.repartition(5), slices=layout).collect()}
    assert got == want


def test_scan_rules(spark):
    schema = "scn long, commit_scn long, operation string, operation_code int, username string, seg_owner string, table_name string, info string, sql_redo string, xidusn string, xidslt string, xidsqn string"
    def row(scn, op, user="APP", owner=None, table=None, info=None, sql="x", code=1, commit=None):
        return (scn, commit, op, code, user, owner, table, info, sql, "1", "2", "3")
    df = spark.createDataFrame(
        [row(1, "START"), row(2, "COMMIT", "SYS"), row(3, "INSERT", "SYS", "A", "T"), row(4, "INSERT", owner="A", table="U"),
         row(5, "DDL", owner="A", table="T", info="INTERNAL DDL x"), row(6, "INSERT", owner="B", table="T"),
         row(7, "UPDATE", owner="A", table="T", sql="on temporary tables"), row(8, "DELETE", owner="A", table="T", code=2, commit=20)],
        schema,
    )
    got = mined_rows(df, 0, ["A.*"], ["A.U"])
    assert {r.scn for r in got.collect()} == {1, 3, 5, 7, 8}
    assert {r.xid for r in got.collect()} == {"1.2.3"}
    assert {r.scn for r in drop_internal(got).collect()} == {1, 3, 8}
    assert {(r.scn, r.commit_scn) for r in mined_rows(df, 6, ["A.T"], committed_view=True).collect()} == {(7, 7), (8, 20)}


def test_statement_from_messages(spark):
    sql = 'update "T" set "A" = \'x, OPERATION=y\''
    df = spark.createDataFrame([(f"{{SCN=1, SQL_REDO={sql}, OPERATION=UPDATE}}",)], "m string")
    assert df.select(redo_from_message(F.col("m"), "map").alias("s")).first().s == sql


def test_printed_messages_are_unescaped(spark):
    text = r"{SQL_REDO=insert \"T\" values ('\u4f60\ud83d\ude00\101\t\\'), OPERATION=INSERT}"
    assert spark.createDataFrame([(text,)], "m string").select(redo_from_message(F.col("m"), "map").alias("s")).first().s == "insert \"T\" values ('你😀A\t\\')"


def test_a_statement_is_judged_by_its_first_piece(spark):
    rows = [("s", "x", "a", 1, "INSERT", None, "insert into T values ('on ", 1), ("s", "x", "a", 2, "INSERT", None, "temporary tables", 1), ("s", "x", "a", 3, "INSERT", None, " end')", 0),
            ("s", "x", "b", 4, "INSERT", None, "insert into temporary tables", 1), ("s", "x", "b", 5, "INSERT", None, " values (1)", 0),
            ("s", "x", "c", 6, "DDL", "INTERNAL DDL x", "drop", 1), ("s", "x", "c", 7, "DDL", "INTERNAL DDL x", " y", 0)]
    df = spark.createDataFrame(rows, "source string, xid string, rs_id string, pos long, operation string, info string, sql_redo string, csf int")
    assert [(r.pos, r.sql_redo) for r in redo_statements(df).collect()] == [(1, "insert into T values ('on temporary tables end')")]


def test_dictionaries_are_whole_and_by_container(spark, monkeypatch):
    cells = [(c, "A", "T", f"C{i}", i, "NUMBER", 5 if c == 1 else 7, 0) for c in (1, 2) for i in range(30)]
    d = spark.createDataFrame(cells, "con_id int, owner string, table_name string, column_name string, column_id int, data_type string, data_precision int, data_scale int")
    rows = spark.createDataFrame([("A", "T", {"C3": "12"})], "schema string, table string, after map<string,string>").withColumn("before", F.lit(None).cast("map<string,string>"))
    good, _ = typed_changes(rows, d, "A", "T", container=2)
    assert len(good.first().after) == 30 and str(good.schema["after"].dataType["C3"].dataType) == "DecimalType(7,0)"
    with pytest.raises(ValueError):
        typed_changes(rows, d, "A", "T")
    monkeypatch.setattr("cdcflow.operators.dictionary.MAX_DICTIONARY_COLUMNS", 20)
    with pytest.raises(ValueError):
        typed_changes(rows, d, "A", "T", container=1)


def test_typed_images_split_bad_values(spark):
    df = spark.createDataFrame(
        [(1, {"K": "5", "D": "2020-01-02 03:04:05+08:00", "S": "t"}), (2, {"K": "no", "D": None, "S": None}), (3, None)],
        "i int, after map<string,string>",
    ).withColumn("before", F.lit(None).cast("map<string,string>"))
    good, dirty = typed_images(df, {"K": "decimal(10,0)", "D": "timestamp_ntz", "S": "string"})
    rows = {r.i: r.after for r in good.collect()}
    assert int(rows[1].K) == 5 and rows[1].D.hour == 3 and rows[3] is None
    assert [(r.i, r._errors[0].col) for r in dirty.collect()] == [(2, "K")]


@pytest.mark.parametrize(
    "args, want",
    [(("NUMBER", 2, 0, True), "tinyint"), (("NUMBER", 4, 0, True), "smallint"), (("NUMBER", 9, 0, True), "int"),
     (("NUMBER", 18, 0, True), "bigint"), (("NUMBER", 10, 2, True), "double"), (("NUMBER", 0, 0, True), "double"),
     (("NUMBER", 10, 2, False), "decimal(10,2)"), (("DATE", 0, 0, False), "timestamp_ntz"), (("CLOB", 0, 0, False), "string")],
)
def test_spark_types_of_dictionary(args, want):
    assert spark_type(*args) == want


def test_statements_of_many_pieces_and_only_the_columns_asked_for(spark):
    rows = [("s", "x", "long", i, f"{i},", int(i < 199), f"t{i}") for i in range(200)] + [("s", "x", "none", 500, None, 0, "n"), ("s", "x", "two", 501, None, 1, "a"), ("s", "x", "two", 502, "b", 0, "c")]
    df = spark.createDataFrame(rows, "source string, xid string, rs_id string, pos long, sql_redo string, csf int, tbl string").repartition(3)
    whole = stitch_redo(df)
    got = {r.pos: (r.sql_redo, r.tbl) for r in whole.collect()}
    assert got == {0: ("".join(f"{i}," for i in range(200)), "t0"), 500: (None, "n"), 501: ("b", "a")}
    plan = whole.select("pos", "tbl")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Aggregate" not in plan
