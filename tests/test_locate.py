"""Rows located in spans, and typed values of nested JSON, against brute force."""

import json
import random

import pytest

from cdcflow.operators.records import json_leaves
from cdcflow.operators.segments import locate


@pytest.mark.parametrize("seed", range(3))
def test_rows_meet_every_span_that_holds_them(spark, seed):
    rnd = random.Random(seed)
    spans = [("ab"[rnd.randrange(2)], i, lo := rnd.randrange(-300, 3000), lo + rnd.choice([0, 1, 2, 3, 7, 64, 65, 1000, 5000])) for i in range(120)]
    rows = [("abc"[rnd.randrange(3)], i, rnd.randrange(-400, 4000)) for i in range(400)] + [("a", 1000, None), (None, 1001, 5)]
    got = locate(
        spark.createDataFrame(rows, "source string, id long, scn long"), spark.createDataFrame(spans, "source string, n long, first_change long, next_change long"), ["source"], "scn"
    )
    want = sorted((i, n) for s, i, p in rows if p is not None for t, n, lo, hi in spans if s == t and lo <= p < hi)
    assert sorted((r.id, r.n) for r in got.collect()) == want and len(want) > 500
    assert got.columns == ["source", "id", "scn", "n", "first_change", "next_change"]


def test_spans_far_apart_are_not_compared(spark):
    rows = spark.range(2000).selectExpr("'s' source", "id * 10 scn")
    spans = spark.range(2000).selectExpr("'s' source", "id n", "id * 10 first_change", "id * 10 + 10 next_change")
    found = locate(rows, spans, ["source"], "scn")
    plan = found._jdf.queryExecution().toString()
    assert found.count() == 2000 and "NestedLoop" not in plan and "Cartesian" not in plan
    assert locate(rows, spans.where("n < 0"), ["source"], "scn").count() == 0 and locate(rows.where("scn < 0"), spans, ["source"], "scn").count() == 0


def leaves(value, path="$"):
    if isinstance(value, dict) and value:
        return [x for k, v in value.items() for x in leaves(v, f"{path}['{k}']")]
    if isinstance(value, list) and value:
        return [x for i, v in enumerate(value) for x in leaves(v, f"{path}[{i}]")]
    if isinstance(value, bool):
        return [(path, "boolean", value)]
    if isinstance(value, int):
        return [(path, "int" if -(2**31) <= value < 2**31 else "long", value)]
    kind = {dict: "object", list: "array", float: "double", str: "string", type(None): "null"}[type(value)]
    return [(path, kind, value if kind in ("double", "string") else None)]


def made(rnd, depth):
    kind = rnd.randrange(9 if depth else 7)
    if kind > 6:
        inner = [made(rnd, depth - 1) for _ in range(rnd.randrange(4))]
        return inner if kind == 7 else {f"k{i}.é": v for i, v in enumerate(inner)}
    return [rnd.randrange(-5, 5), rnd.randrange(2**31, 2**62), -(2**31), rnd.randrange(100) + 0.25, rnd.choice(["", "x y", "7", "null"]), rnd.random() < 0.5, None][kind]


def test_typed_values_keep_their_kinds_at_any_depth(spark):
    rnd = random.Random(4)
    values = [made(rnd, 5) for _ in range(150)] + [[], {}, [[]], [None], {"a": [{}]}, 1.0, [1.0, 1, 2**31 - 1, 2**31]]
    rows = [(i, json.dumps(v)) for i, v in enumerate(values)] + [(900, "{bad"), (901, None), (902, "")]
    rows = [(*r, "x") for r in rows]
    got = json_leaves(spark.createDataFrame(rows, "id long, j string, path string"), "j", ["id"]).collect()
    pick = lambda r: next((v for v in (r.as_int, r.as_long, r.as_double, r.as_string, r.as_boolean) if v is not None), None)
    want = sorted((i, p, k, repr(v)) for i, value in enumerate(values) for p, k, v in leaves(value))
    assert sorted((r.id, r.path, r.kind, repr(pick(r))) for r in got) == want
    assert {r.kind for r in got} == {"int", "long", "double", "string", "boolean", "null", "array", "object"}
