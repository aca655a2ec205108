import random

import pytest
from pyspark.sql import functions as F

from cdcflow.operators.positions import WHOLE, Slices
from cdcflow.operators.txn import committed_changes, log_gaps, open_changes, remove_rollback_pairs, repeated_positions, resume_after

SCHEMA = "source string, xid string, op string, scn long, v long"
LAYOUTS = [WHOLE, Slices((0, 150, 151, 700, 2000), 1), Slices((0, 2000), 8)]


def _log(seed, n=600):
    rng = random.Random(seed)
    xids = ["h"] * 6 + ["a", "b", "c"]
    ops = ["insert"] * 4 + ["update"] * 3 + ["delete", "ddl", "start", "commit", "commit", "rollback"]
    return [("s", rng.choice(xids), rng.choice(ops), scn, scn * 7) for scn in range(n)]


def _replay(log):
    buffers, out = {}, set()
    for _, xid, op, scn, _ in log:
        if op in ("start", "rollback"):
            buffers[xid] = []
        elif op == "commit":
            out |= {(xid, s, scn) for s in buffers.pop(xid, [])}
        else:
            buffers.setdefault(xid, []).append(scn)
    return out, {s for b in buffers.values() for s in b}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("layout", LAYOUTS)
def test_committed_equals_replay(spark, seed, layout):
    log = _log(seed)
    df = spark.createDataFrame(log, SCHEMA).repartition(5)
    want, still_open = _replay(log)
    got = {(r.xid, r.scn, r.commit_scn) for r in committed_changes(df, slices=layout).collect()}
    assert got == want
    assert {r.scn for r in open_changes(df, slices=layout).collect()} == still_open


@pytest.mark.parametrize("layout", LAYOUTS)
def test_rows_that_share_an_scn_follow_seq(spark, layout):
    log = _log(5)
    tied = [(*r[:3], r[3] // 40 * 40, r[3] % 40, r[4]) for r in log]
    random.Random(1).shuffle(tied)
    df = spark.createDataFrame(tied, "source string, xid string, op string, scn long, seq long, v long").repartition(5)
    want, still_open = _replay(log)
    got = {(r.xid, r.scn + r.seq) for r in committed_changes(df, slices=layout).collect()}
    assert got == {(x, s) for x, s, _ in want}
    assert {r.scn + r.seq for r in open_changes(df, slices=layout).collect()} == still_open
    assert repeated_positions(df, ["source"], ["scn", "seq"]).count() == 0 < repeated_positions(df, ["source"], ["scn"]).count()


def test_start_and_commit_frame_their_scn_without_seq(spark):
    for rows in ([("start", 10), ("insert", 10), ("update", 20), ("commit", 20)],) * 2:
        for order in (rows, rows[::-1]):
            df = spark.createDataFrame([("s", "x", op, scn, 0) for op, scn in order], SCHEMA)
            assert {(r.op, r.scn, r.commit_scn) for r in committed_changes(df).collect()} == {("insert", 10, 20), ("update", 20, 20)}


def test_raw_mode_passes_everything(spark):
    log = _log(3, 100)
    df = spark.createDataFrame(log, SCHEMA)
    want = {l[3] for l in log if l[2] in ("insert", "update", "delete", "ddl")}
    assert {r.scn for r in committed_changes(df, mode="raw").collect()} == want
    with pytest.raises(ValueError):
        committed_changes(df, mode="other")


@pytest.mark.parametrize("layout", LAYOUTS)
def test_rollback_pairs_undo_the_last_change(spark, layout):
    rng = random.Random(4)
    rows, stack, scn = [], {}, 0
    for _ in range(700):
        row = rng.choice(["r", "r", "r", "q"])
        scn += 1
        live = stack.setdefault(row, [])
        if live and rng.random() < 0.45:
            live.pop()
            rows.append(("s", "x", 1, row, scn, 1))
        else:
            live.append(scn)
            rows.append(("s", "x", 1, row, scn, 0))
    df = spark.createDataFrame(rows, "source string, xid string, commit_scn long, row_id string, scn long, rollback int")
    got = {r.scn for r in remove_rollback_pairs(df, slices=layout).collect()}
    assert got == {s for live in stack.values() for s in live}


def test_resume_is_strictly_after(spark):
    df = spark.createDataFrame([(1, 5, "a"), (2, 5, "a"), (2, 5, "b"), (2, 6, "a"), (3, 1, "a")], "scn long, commit_scn long, row_id string")
    got = {tuple(r) for r in resume_after(df, (2, 5, "a")).collect()}
    assert got == {(2, 5, "b"), (2, 6, "a"), (3, 1, "a")}


def test_log_gaps(spark):
    rows = [("a", 1, s) for s in (1, 2, 2, 3, 6, 7)] + [("a", 2, 5), ("a", 2, 6), ("b", 1, 13), ("b", 1, 14)]
    df = spark.createDataFrame(rows, "source string, thread int, sequence long")
    assert [tuple(r) for r in log_gaps(df).select("source", "thread", "sequence", "missing").collect()] == [("a", 1, 6, 2)]


def test_sliced_assembly_does_not_stitch_twice(spark, monkeypatch):
    from cdcflow.operators import positions
    from cdcflow.workload import queries_redo

    stored = []
    monkeypatch.setattr(queries_redo, "materialize", lambda df, label: stored.append((label, df.columns)) or df)
    sf = "/root/testdata/sf0.001"
    whole = queries_redo._changes(spark, sf).count()
    assert not stored
    monkeypatch.setattr(positions, "GROUP_LIMIT", 0)
    monkeypatch.setattr(positions, "ROWS_PER_SLICE", 500)
    assert queries_redo._changes(spark, sf).count() == whole > 0
    assert [label for label, _ in stored] == ["redo-statements"] and "sql_redo" not in stored[0][1]
