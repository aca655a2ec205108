"""Bad rows of a refused batch are found by halving; good ones land once."""

import math

import pytest
from pyspark.sql import functions as F

from cdcflow.operators.dirty import ERRORS, ErrorLimitExceeded
from cdcflow.session import scratch_path
from cdcflow.sinks.isolate import write_isolating
from cdcflow.sinks.manifest import BucketTable


def _sink(refuse):
    """All or nothing: refuses a batch that holds a bad row; counts tries per row."""
    landed, tries = [], {}

    def write(df):
        ids = [r.id for r in df.collect()]
        for i in ids:
            tries[i] = tries.get(i, 0) + 1
        if any(refuse(i) for i in ids):
            raise RuntimeError("Duplicate entry")
        landed.extend(ids)

    return write, landed, tries


@pytest.mark.parametrize("bad", [set(), {15}, {5, 6, 11}])
def test_good_rows_land_once_and_bad_ones_come_back(spark, bad):
    write, landed, tries = _sink(lambda i: i in bad)
    found = write_isolating(spark.range(16).repartition(3), write)
    assert sorted(landed) == [i for i in range(16) if i not in bad]
    if not bad:
        assert found is None and set(tries.values()) == {1}
        return
    rows = found.collect()
    assert {r.id for r in rows} == bad and all(r[ERRORS][0]["type"] == "duplicate" and "Duplicate" in r[ERRORS][0]["msg"] for r in rows)
    assert max(tries.values()) <= math.log2(16) + 3


def test_repeated_rows_and_limits(spark):
    write, landed, _ = _sink(lambda i: i == 7)
    rows = spark.createDataFrame([(7,), (7,), (1,), (1,), (2,)], "id long").coalesce(1)
    assert [r.id for r in write_isolating(rows, write).collect()] == [7, 7] and sorted(landed) == [1, 1, 2]
    with pytest.raises(ErrorLimitExceeded):
        write_isolating(spark.range(20), _sink(lambda i: i % 2 == 0)[0], max_errors=3)
    assert write_isolating(spark.range(0), lambda df: None) is None


def test_a_table_takes_the_good_rows(spark):
    table = BucketTable(spark, scratch_path(spark, "t"), spark.range(0).withColumn("v", F.lit("x")), ["id"], buckets=2)
    table.commit()

    def write(df):
        def check():
            if df.where("id % 10 = 3").count():
                raise ValueError("violates a rule")

        table.commit(added=df, check=check)

    bad = write_isolating(spark.range(12).withColumn("v", F.lit("y")), write)
    assert sorted(r.id for r in bad.collect()) == [3]
    assert sorted(r.id for r in table.read().collect()) == [i for i in range(12) if i != 3]
