import random

import pytest

from cdcflow.operators.apply import apply_changes, apply_unchanged, compact_changes
from cdcflow.sinks.tables import numbered_folders, read_version, write_table
from cdcflow.streaming.txn_stream import delta_batch, fold_deltas, merged_table

ROW = "struct<k:long,a:string,b:long>"
SCHEMA = f"commit_scn long, scn long, before {ROW}, after {ROW}, unchanged array<string>"


def _random_log(seed, n=500, gaps=False):
    """Changes that a real table could have made, with the table they lead to."""
    rng = random.Random(seed)
    table = {k: (k, f"s{k}", k) for k in range(0, 40, 2)}
    base = list(table.values())
    log = []
    for i in range(n):
        commit, scn = i // 7, i
        # a third of the work hits one key
        k = 0 if rng.random() < 0.35 else rng.randrange(60)
        if k not in table:
            new = (k, rng.choice(["x", None, "y"]), rng.randint(0, 99))
            log.append((commit, scn, None, new, None))
            table[k] = new
        elif rng.random() < 0.3:
            log.append((commit, scn, table.pop(k), None, None))
        else:
            old = table.pop(k)
            key = rng.choice([k, k, k, k + 1000])
            key = k if key in table else key
            keep = gaps and rng.random() < 0.5
            new = (key, rng.choice(["u", None]), old[2] if keep else rng.randint(0, 99))
            shown = (new[0], new[1], None) if keep else new
            log.append((commit, scn, old, shown, ["b"] if keep else None))
            table[key] = new
    return base, log, set(table.values())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_apply_equals_replay(spark, seed):
    base, log, want = _random_log(seed)
    b = spark.createDataFrame(base, "k long, a string, b long")
    c = spark.createDataFrame(log, SCHEMA).repartition(6)
    assert {tuple(r) for r in apply_changes(b, c, ["k"]).collect()} == want
    assert {tuple(r) for r in apply_changes(b, c, ["k"], store_delta=True).collect()} == want


@pytest.mark.parametrize("seed", [4, 5])
def test_apply_with_values_not_resent(spark, seed):
    base, log, want = _random_log(seed, gaps=True)
    b = spark.createDataFrame(base, "k long, a string, b long")
    c = spark.createDataFrame(log, SCHEMA).repartition(6)
    assert {tuple(r) for r in apply_unchanged(b, c, ["k"]).collect()} == want


def test_deltas_in_any_grouping_merge_to_the_same_table(spark):
    base, log, want = _random_log(6)
    b = spark.createDataFrame(base, "k long, a string, b long")
    c = spark.createDataFrame(log, SCHEMA)
    deltas = compact_changes(c.where("scn < 100"), ["k"]).unionByName(compact_changes(c.where("scn >= 100"), ["k"]))
    assert {tuple(r) for r in merged_table(b, deltas, ["k"]).collect()} == want


def test_deltas_are_folded_and_dropped(spark, tmp_path):
    base, log, want = _random_log(7)
    b = spark.createDataFrame(base, "k long, a string, b long")
    c = spark.createDataFrame(log, SCHEMA)
    deltas, table = str(tmp_path / "deltas"), str(tmp_path / "table")
    run = delta_batch(deltas, ["k"])
    for n, part in enumerate(("scn < 100", "scn >= 100 and scn < 300")):
        run(c.where(part), n)
    assert fold_deltas(spark, deltas, table, ["k"], b) == 0 and numbered_folders(spark, deltas, "batch") == []
    assert fold_deltas(spark, deltas, table, ["k"]) is None
    run(c.where("scn >= 300"), 2)
    assert fold_deltas(spark, deltas, table, ["k"]) == 1
    assert {tuple(r) for r in read_version(spark, table).collect()} == want


def test_equal_scns_are_told_apart_by_seq(spark):
    rows = [(5, 7, i, None if i == 0 else (1, f"v{i - 1}", i), (1, f"v{i}", i + 1), None) for i in range(9)]
    base = spark.createDataFrame([], "k long, a string, b long")
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, SCHEMA.replace("scn long, before", "scn long, seq long, before"))
        assert [tuple(r) for r in apply_changes(base, df, ["k"]).collect()] == [(1, "v8", 9)]
        assert [tuple(r) for r in apply_unchanged(base, df, ["k"]).collect()] == [(1, "v8", 9)]
        assert [tuple(r) for r in merged_table(base, compact_changes(df, ["k"]), ["k"]).collect()] == [(1, "v8", 9)]
    with pytest.raises(ValueError):
        compact_changes(df, ["k"], order=())


def test_insert_refuses_taken_keys(spark):
    target = spark.createDataFrame([(1, "t")], "id long, v string")
    batch = spark.createDataFrame([(1, "x", 1), (2, "first", 2), (2, "second", 3), (3, "y", 4)], "id long, v string, n long")
    result, refused = write_table(batch, target, "insert", ["id"], ["n"])
    assert {tuple(r) for r in result.collect()} == {(1, "t"), (2, "first"), (3, "y")}
    assert {r.n for r in refused.collect()} == {1, 3}
    with pytest.raises(ValueError):
        write_table(batch, target, "merge")
