import random

import pytest
from pyspark.sql import functions as F

from cdcflow.operators.ids import snowflake_ids
from cdcflow.operators.positions import WHOLE, Slices, carry, plan_slices, row_index, running

LAYOUTS = [WHOLE, Slices((0, 300, 301, 900, 1001), 1), Slices((0, 1001), 16), Slices((0, 10, 500, 1001), 7)]


def _rows(seed):
    rng = random.Random(seed)
    # one key holds most rows; None is a key like any other
    keys = ["hot"] * 8 + ["a", "b", None]
    return [(rng.choice(keys), p, rng.random() < 0.1, rng.randint(-5, 5)) for p in rng.sample(range(1001), 400)]


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("backward", [False, True])
@pytest.mark.parametrize("strict", [False, True])
def test_carry_equals_replay(spark, layout, backward, strict):
    rows = _rows(1)
    df = spark.createDataFrame(rows, "key string, pos long, mark boolean, v long").repartition(3)
    out = carry(
        df, ["key"], "pos", F.col("v"), F.col("mark"), "got", backward=backward, strict=strict, slices=layout
    )
    assert out.columns == ["key", "pos", "mark", "v", "got"]
    seen, want = {}, set()
    for key, pos, mark, v in sorted(rows, key=lambda r: r[1], reverse=backward):
        if strict:
            want.add((key, pos, seen.get(key)))
        if mark:
            seen[key] = v
        if not strict:
            want.add((key, pos, seen.get(key)))
    assert {(r.key, r.pos, r.got) for r in out.collect()} == want
    assert out.count() == len(rows)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_running_equals_replay(spark, layout):
    rows = _rows(2)
    df = spark.createDataFrame(rows, "key string, pos long, mark boolean, v long")
    out = running(df, ["key"], "pos", {"s": F.col("v"), "n": F.lit(1)}, slices=layout)
    top = running(df, ["key"], "pos", {"m": F.col("v")}, how="max", slices=layout)
    sums, counts, best, want, want_top = {}, {}, {}, set(), set()
    for key, pos, _, v in sorted(rows, key=lambda r: r[1]):
        sums[key] = sums.get(key, 0) + v
        counts[key] = counts.get(key, 0) + 1
        best[key] = max(best.get(key, v), v)
        want.add((key, pos, sums[key], counts[key]))
        want_top.add((key, pos, best[key]))
    assert {(r.key, r.pos, r.s, r.n) for r in out.collect()} == want
    assert {(r.key, r.pos, r.m) for r in top.collect()} == want_top


@pytest.mark.parametrize("layout", LAYOUTS)
def test_row_index_is_dense(spark, layout):
    rows = sorted(r[1] for r in _rows(3))
    df = spark.createDataFrame([(p,) for p in rows], "pos long").repartition(5)
    got = {r.pos: r.i for r in row_index(df, "pos", "i", slices=layout).collect()}
    assert got == {p: i for i, p in enumerate(rows)}


def test_ties_stay_in_one_slice(spark):
    rows = [("k", p // 10, p) for p in range(1000)]
    df = spark.createDataFrame(rows, "key string, pos long, t long")
    out = running(df, ["key"], "pos", {"n": F.lit(1)}, ties=["t"], slices=Slices((0, 30, 60, 101), 4))
    assert {r.t: r.n for r in out.collect()} == {p: p + 1 for p in range(1000)}


def test_slices_follow_density_and_order(spark):
    # one far outlier, nearly all rows close together
    values = [0] + [10**15 + i for i in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "pos long")
    cut = plan_slices(df, "pos", rows_per_slice=500, group_limit=5_000)
    got = df.select("pos", cut.of(F.col("pos")).alias("s")).orderBy("pos").collect()
    numbers = [r.s for r in got]
    assert numbers == sorted(numbers)
    sizes = df.groupBy(cut.of(F.col("pos"))).count().agg(F.max("count")).first()[0]
    assert sizes < 2_000


def test_small_input_is_one_slice(spark):
    assert plan_slices(spark.range(10), "id").single
    assert plan_slices(spark.range(0), "id").single
    keyed = spark.range(1000).withColumn("k", F.col("id") % 100)
    assert plan_slices(keyed, "id", ["k"], group_limit=10).single
    hot = keyed.withColumn("k", F.when(F.col("id") < 400, 0).otherwise(F.col("k")))
    assert not plan_slices(hot, "id", ["k"], rows_per_slice=50, group_limit=100).single


def test_snowflake_matches_sequential_worker(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([0, 0, 0, 1, 2, 9]), rng.randint(0, 2)) for i in range(9000)]
    df = spark.createDataFrame(rows, "event long, ms long, worker long")
    got = {}
    for layout in (WHOLE, Slices((0, 1, 3, 10), 1)):
        got = {r.event: r.id for r in snowflake_ids(df, "ms", "worker", 3, "event", slices=layout).collect()}
        last, want = {}, {}
        for event, ms, worker in sorted(rows, key=lambda r: (r[1], r[0])):
            at, seq = last.get(worker, (-1, 0))
            if ms > at:
                at, seq = ms, 0
            else:
                seq += 1
                if seq == 4096:
                    at, seq = at + 1, 0
            last[worker] = (at, seq)
            want[event] = at << 22 | 3 << 17 | worker << 12 | seq
        assert got == want
    assert len(set(got.values())) == len(rows)


def test_tasks_of_a_sliced_log_grow_with_it(spark):
    df = spark.range(100).select(F.lit("k").alias("key"), F.col("id").alias("pos"))
    for fine in (40, 400):
        cut = Slices((0, 50, 100), fine)
        for out in (running(df, ["key"], "pos", {"n": F.lit(1)}, slices=cut), carry(df, ["key"], "pos", F.col("pos"), F.col("pos") % 7 == 0, "last", slices=cut)):
            assert f", {fine}), REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
