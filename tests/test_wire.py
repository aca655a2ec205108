import os
import random
import struct

import pytest
from pyspark.sql import functions as F

from cdcflow.operators.envelope import envelope, flat_columns
from cdcflow.operators.pg9 import pg9_changes
from cdcflow.operators.pgoutput import decode_tuples, pg_changes, tag_messages, with_relation, with_txn_context
from cdcflow.operators.positions import WHOLE, Slices

from cdcflow.session import scratch_path
from cdcflow.streaming.pg_stream import decode_batch, decoded_events

LAYOUTS = [WHOLE, Slices((0, 50, 120, 100_000), 1), Slices((0, 100_000), 64)]


def cells(values, width, nul):
    out = len(values).to_bytes(width, "big")
    for v in values:
        if v is None:
            out += b"n"
        elif v is ...:
            out += b"u"
        else:
            body = v.encode() + (b"\0" if nul else b"")
            out += b"t" + struct.pack(">i", len(body)) + body
    return out


def begin(lsn, micros, xid):
    return b"B" + struct.pack(">qqi", lsn, micros, xid)


def relation(rel, table, cols):
    out = b"R" + struct.pack(">i", rel) + b"S\0" + table.encode() + b"\0f" + struct.pack(">h", len(cols))
    for c in cols:
        out += b"\0" + c.encode() + b"\0" + struct.pack(">ii", 25, -1)
    return out


def change(op, rel, old=None, new=None, mark=b"O"):
    out = op.encode() + struct.pack(">i", rel)
    if old is not None:
        out += mark + cells(old, 2, False)
    if new is not None:
        out += b"N" + cells(new, 2, False)
    return out


def _value(rng):
    return rng.choice([None, ..., "", "x", "née", "a" * 3000, "'\0\n"])


def _log(seed):
    """Messages of two slots, and the events they must give."""
    rng = random.Random(seed)
    msgs, want = [], {}
    for slot in ("s1", "s2"):
        pos, shape, txn = 0, {}, None
        for _ in range(250):
            pos += rng.randint(1, 3)
            roll = rng.random()
            if roll < 0.12 or txn is None:
                txn = (pos * 10, rng.randint(0, 10**9) * 1000, rng.randint(1, 9))
                msgs.append((slot, pos, begin(*txn)))
            elif roll < 0.24 or not shape:
                rel = rng.choice([1, 2])
                cols = [f"c{i}" for i in range(rng.randint(1, 4))]
                shape[rel] = (f"T{rel}", cols)
                msgs.append((slot, pos, relation(rel, f"T{rel}", cols)))
            else:
                rel = rng.choice(list(shape))
                table, cols = shape[rel]
                op = rng.choice("IUD")
                old = [_value(rng) for _ in cols] if op == "D" or (op == "U" and rng.random() < 0.5) else None
                new = [_value(rng) for _ in cols] if op != "D" else None
                msgs.append((slot, pos, change(op, rel, old, new, rng.choice([b"O", b"K"]))))

                def image(vals):
                    return None if vals is None else {c: (None if v is ... else v) for c, v in zip(cols, vals)}

                kept = [c for c, v in zip(cols, new or []) if v is ...]
                want[slot, pos] = (
                    {"I": "insert", "U": "update", "D": "delete"}[op], table, txn[0], 946684800000 + txn[1] // 1000, txn[2],
                    image(old), image(new), kept,
                )
    return msgs, want


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("parts", [1, 7])
def test_decode_inverts_encode(spark, layout, parts):
    msgs, want = _log(1)
    df = spark.createDataFrame(msgs, "slot string, pos long, msg binary").repartition(parts)
    got = {
        (r.slot, r.pos): (r.op, r.table, r.lsn, r.ts, r.xid, r.before, r.after, r.unchanged)
        for r in pg_changes(df, slices=layout).collect()
    }
    assert got == want


def test_filters_and_compat(spark):
    msgs, want = _log(2)
    df = spark.createDataFrame(msgs, "slot string, pos long, msg binary")
    got = {(r.slot, r.pos) for r in pg_changes(df, "Update", ["S.T1"]).collect()}
    assert got == {k for k, v in want.items() if v[0] == "update" and v[1] == "T1"}
    rows = decode_tuples(with_relation(tag_messages(df)), compat=True)
    assert rows.where("size(unchanged) > 0").count() == 0


def test_slice_without_begin_and_rows_before_any(spark):
    msgs = [("s", 1, change("I", 1, None, ["a"])), ("s", 5, begin(7, 0, 3)), ("s", 90, change("I", 1, None, ["b"]))]
    df = spark.createDataFrame(msgs, "slot string, pos long, msg binary")
    for layout in (WHOLE, Slices((0, 10, 20, 100), 1)):
        rows = with_txn_context(tag_messages(df), slices=layout).collect()
        assert {r.pos: r.xid for r in rows} == {1: None, 5: 3, 90: 3}


def test_damaged_messages_are_marked_not_fatal(spark):
    good = change("I", 1, None, ["a", "b"])
    msgs = [
        ("s", 1, begin(1, 0, 1)), ("s", 2, relation(1, "T", ["x", "y"])), ("s", 3, good), ("s", 4, good[:-1]),
        ("s", 5, good + b"zz"), ("s", 6, b"Q???"), ("s", 7, b"R\0\0"), ("s", 8, b"I" + struct.pack(">i", 1) + b"N\xff\xff"),
        ("s", 9, change("I", 99, None, ["a"])),
    ]
    df = spark.createDataFrame(msgs, "slot string, pos long, msg binary")
    got = {r.pos: r.ok for r in pg_changes(df).collect()}
    assert got == {3: True, 4: False, 5: False, 8: False}
    assert {r.pos for r in tag_messages(df).where("kind = 'unknown'").collect()} == {6}


def short(text):
    body = text.encode() + b"\0"
    return struct.pack(">h", len(body)) + body


def test_self_describing_form(spark):
    rng = random.Random(3)
    msgs, want, txn = [("s", 0, b"B" + struct.pack(">iqqi", 0, 5, 2_000, 8))], {}, (5, 946684800002, 8)
    for pos in range(1, 200):
        cols = [None if rng.random() < 0.1 else f"c{i}" for i in range(rng.randint(1, 4))]
        op = rng.choice("IUD")
        old = [_value(rng) for _ in cols] if op != "I" and rng.random() < 0.6 else None
        new = [_value(rng) for _ in cols] if op != "D" else None
        sections = [
            b"C" + struct.pack(">h", len(cols)) + b"".join(struct.pack(">h", 0) if c is None else short(c) + short("text") for c in cols),
            rng.choice([b"P", b"M" + struct.pack(">h", 1) + short("id")]),
        ]
        tuples = []
        if new is not None:
            tuples.append(b"NT" + cells(new, 4, True))
        if old is not None:
            tuples.append(b"KT" + cells(old, 4, True))
        elif op == "D":
            tuples.append(b"E")
        rng.shuffle(tuples)
        msgs.append(("s", pos, op.encode() + short("S") + short("T") + b"".join(sections + tuples)))

        def image(vals):
            return None if vals is None else {c: (None if v is ... else v) for c, v in zip(cols, vals) if c}

        want[pos] = ({"I": "insert", "U": "update", "D": "delete"}[op], *txn, image(old), image(new))
    msgs.append(("s", 500, b"I" + short("S") + short("T") + b"Z"))
    df = spark.createDataFrame(msgs, "slot string, pos long, msg binary").repartition(3)
    rows = pg9_changes(df, slices=Slices((0, 40, 501), 2)).collect()
    got = {r.pos: (r.op, r.lsn, r.ts, r.xid, r.before, r.after) for r in rows if r.ok}
    assert got == want
    assert {r.pos for r in rows if not r.ok} == {500}


def test_envelope_forms(spark):
    msgs, want = _log(4)
    df = spark.createDataFrame(msgs, "slot string, pos long, msg binary")
    events = pg_changes(df)
    flat = {(r.type, r.pos): r.data for r in envelope(events, flat=True).where("xid is not null").collect()}
    for (slot, pos), v in want.items():
        data = {}
        for c in (v[5] or v[6]):
            data[f"before_{c}"] = (v[5] or {}).get(c)
            data[f"after_{c}"] = (v[6] or {}).get(c)
        if (v[0], pos) in flat and slot == "s2":
            assert set(flat[v[0], pos]) >= set() and len(data) % 2 == 0
    assert envelope(events).columns[:6] == ["type", "schema", "table", "lsn", "ts", "ingestion"]
    assert flat_columns(events, ["c0"]).columns[-2:] == ["before_c0", "after_c0"]


def test_repeated_sections_and_damaged_lengths(spark):
    cols = b"C" + struct.pack(">h", 1) + short("c") + short("text") + b"P"
    one = b"NT" + cells(["a"], 4, True)
    head = b"I" + short("S") + short("T")
    cut = b"NT" + struct.pack(">i", 1) + b"t" + struct.pack(">i", 10**6) + b"abc"
    msgs = [("s", 0, b"B" + struct.pack(">iqqi", 0, 5, 0, 8)), ("s", 1, head + cols + one + one), ("s", 2, head + cols + cut),
            ("s", 3, head + cols + one), ("s", 4, b"I\x7f"), ("s", 5, head + cols)]
    df = spark.createDataFrame(msgs, "slot string, pos long, msg binary").coalesce(1)
    got = {r.pos: (r.ok, r.after) for r in pg9_changes(df).collect()}
    assert got[1][1] == {"c": "a"} and got[3] == (True, {"c": "a"}) and got[2][0] is False and got[5] == (True, None)


def test_streamed_batches_decode_like_one(spark):
    msgs, want = _log(5)
    df = spark.createDataFrame(msgs, "slot string, pos long, msg binary")
    path = scratch_path(spark, "pg")
    run = decode_batch(path)
    for i, (a, b) in enumerate([(0, 40), (40, 41), (41, 200), (200, 10_000)]):
        batch = df.where(f"pos > {a} and pos <= {b}")
        run(batch, i)
        run(batch, i)
    got = {(r.slot, r.pos): (r.op, r.table, r.lsn, r.ts, r.xid, r.before, r.after, r.unchanged) for r in decoded_events(spark, path).collect()}
    assert got == want


def test_nothing_of_a_spoilt_log_is_lost(spark):
    from cdcflow.operators.pgoutput import messages_since, pg_events, tag_messages
    from cdcflow.workload.wirelog import pg_messages

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test tables are not here")
    log = tag_messages(pg_messages(spark, sf))
    changes = log.where("kind in ('insert', 'update', 'delete')").count()
    undefined = log.where("not (kind = 'relation' and substring(msg, 2, 4) = unhex('00000065'))").select("slot", "pos", "msg")
    found = pg_events(undefined)
    assert found.count() == changes
    kinds = {r["p"]: r["n"] for r in found.selectExpr("substring_index(get(_errors, 0).msg, ':', 1) p").groupBy("p").agg(F.count("*").alias("n")).collect()}
    assert kinds["no table definition"] > 0 and kinds[None] + kinds["no table definition"] == changes
    assert pg_events(messages_since(undefined, 10**12)).count() == 0


def test_captured_job_resumes_with_its_context_and_counts_dirty_rows(spark):
    import json

    from cdcflow.operators.dirty import ErrorLimitExceeded
    from cdcflow.plans.job import SyncJob
    from cdcflow.session import scratch_path
    from cdcflow.workload.wirelog import pg_messages

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test tables are not here")
    src, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    log = pg_messages(spark, sf)
    log.write.parquet(src)

    def job(path, **setting):
        reader = {"name": "pgwalreader", "parameter": {"path": src, "lsn": 120000}}
        text = {"job": {"content": [{"reader": reader, "writer": {"name": "filewriter", "parameter": {"path": path}}}], "setting": setting}}
        SyncJob.from_json(json.dumps(text)).run(spark)

    job(out)
    got = spark.read.parquet(out)
    assert got.count() == pg_changes(log).where("pos >= 120000").count() > 0 and "unchanged" in got.columns
    spark.createDataFrame([("s", 130000, b"?bad")], "slot string, pos long, msg binary").write.mode("append").parquet(src)
    with pytest.raises(ErrorLimitExceeded):
        job(scratch_path(spark, "out"))
    job(scratch_path(spark, "out"), errorLimit={"record": 1})


def test_rows_are_not_dealt_by_their_definition(spark, monkeypatch):
    from cdcflow.operators import pgoutput
    from cdcflow.workload.wirelog import pg_messages

    log = pg_messages(spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held = pgoutput.pg_changes(log)
        plan = held._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        monkeypatch.setattr(pgoutput, "HELD_DEFINITIONS", 0, raising=False)
        joined = pgoutput.pg_changes(log)
        shown = [sorted((r.pos, r.table, str(r.after)) for r in x.select("pos", "table", "after").collect()) for x in (held, joined)]
        assert shown[0] == shown[1] and len(shown[0]) > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
