"""Bucketed tables: folds rewrite touched buckets only; data, ledger and positions are committed together, once."""

import os

import pytest
from pyspark.sql import functions as F

from cdcflow.operators.apply import apply_changes, apply_unchanged
from cdcflow.session import materialize, scratch_path
from cdcflow.sinks.manifest import BucketTable, CommitConflict, Manifest
from cdcflow.sinks.tables import read_version, table_versions, write_table


def _base(spark, n=1000):
    return spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("v"), F.col("id")).alias("v"), F.col("id").alias("n"))


def _changes(spark, rows):
    image = "struct<k: bigint, v: string, n: bigint>"
    return spark.createDataFrame(rows, f"scn bigint, commit_scn bigint, before {image}, after {image}")


def _store(df):
    return materialize(df, "delta")


def _rows(df):
    return sorted(map(tuple, df.collect()))


def _folders(manifest):
    return {f for files in manifest.files.values() for f in files}


def test_fold_rewrites_only_touched_buckets(spark):
    base = _base(spark)
    table = BucketTable(spark, scratch_path(spark, "t"), base, ["k"], buckets=50)
    first = table.commit()
    assert first.version == 0 and len(first.files) == 50 and _rows(table.read()) == _rows(base)
    changes = _changes(spark, [(i, i, (i, f"v{i}", i), (i, "new", -i)) for i in range(5)] + [(9, 9, (9, "v9", 9), None), (10, 10, None, (5000, "x", 1)), (11, 11, (7, "v7", 7), (7000, "m", 2))])
    want = _rows(apply_changes(base, changes, ["k"]))
    second = table.fold_changes(changes, store=_store, writer="w", batch=0)
    assert _rows(table.read()) == want
    fresh = _folders(second) - _folders(first)
    assert 0 < len(fresh) <= 9 and len(_folders(second) & _folders(first)) >= 41
    written = table.spark.read.parquet(*[f"{table.path}/{f}" for f in fresh]).count()
    assert written < 9 * 60


def test_a_batch_lands_once_and_the_newest_ledger_entry_counts(spark):
    table = BucketTable(spark, scratch_path(spark, "t"), _base(spark, 10), ["k"], buckets=4)
    more = _base(spark, 3).withColumn("v", F.lit("added"))
    for _ in range(3):
        table.commit(added=more, writer="job", batch=0)
    assert table.read().count() == 13
    table.commit(added=more, writer="other", batch=0)
    table.commit(added=more, writer="job", batch=1)
    again = table.commit(added=more, writer="job", batch=0)
    assert table.read().count() == 19 and again.ledger == {"job": 1, "other": 0}


def test_a_refused_or_killed_commit_leaves_no_trace(spark):
    table = BucketTable(spark, scratch_path(spark, "t"), _base(spark, 10), ["k"], buckets=4)
    table.commit()

    def refuse():
        raise RuntimeError("too many errors")

    with pytest.raises(RuntimeError):
        table.commit(added=_base(spark, 5), writer="job", batch=0, positions={"s": 5}, check=refuse)
    held = table.manifest()
    assert held.version == 0 and table.read().count() == 10 and not held.ledger and not held.positions
    table.commit(added=_base(spark, 5), writer="job", batch=0, positions=lambda: {"s": 5})
    assert table.read().count() == 15 and table.manifest().positions == {"s": 5}
    table.commit(writer="job", batch=1, positions={"s": 3, "t": 1})
    assert table.manifest().positions == {"s": 5, "t": 1}


def test_of_two_commits_of_a_version_one_wins(spark):
    path = scratch_path(spark, "t")
    table = BucketTable(spark, path, _base(spark, 10), ["k"], buckets=4)
    table.commit()

    def meanwhile():
        BucketTable(spark, path).commit(added=_base(spark, 1))

    with pytest.raises(CommitConflict):
        table.commit(added=_base(spark, 5), check=meanwhile)
    assert table.read().count() == 11 and table.versions() == [0, 1]
    table._publish(Manifest(7, "k bigint", ("k",), 1))
    with pytest.raises(CommitConflict):
        table._publish(Manifest(7, "k bigint", ("k",), 1))


@pytest.mark.parametrize("mode", ["insert", "update", "upsert", "replace"])
def test_write_modes_on_buckets_equal_those_on_whole_tables(spark, mode):
    base = _base(spark, 100)
    batch = spark.createDataFrame([(5, "a", 1), (5, "b", 2), (500, "c", 3), (500, "d", 4), (501, "e", 5)], "k int, v string, n bigint")
    table = BucketTable(spark, scratch_path(spark, "t"), base, ["k"], buckets=20)
    first = table.commit()
    second = table.commit(lambda held, _: write_table(batch, held, mode, ["k"], ["n"])[0], touched=batch)
    assert _rows(table.read()) == _rows(write_table(batch, base, mode, ["k"], ["n"])[0])
    assert len(_folders(second) - _folders(first)) <= 3


def test_values_not_resent_are_kept(spark):
    image = "struct<k: bigint, v: string, n: bigint>"
    rows = [(1, 1, (1, None, 1), (1, None, 10), ["v"]), (2, 2, None, (50, "new", 5), []), (3, 3, (2, "v2", 2), (60, None, 6), ["v"]), (4, 4, (3, "v3", 3), None, []), (5, 5, (1, None, 10), (1, None, 11), ["v"])]
    changes = spark.createDataFrame(rows, f"scn bigint, commit_scn bigint, before {image}, after {image}, unchanged array<string>")
    base = _base(spark, 10)
    table = BucketTable(spark, scratch_path(spark, "t"), base, ["k"], buckets=8)
    table.commit()
    table.fold_changes(changes, store=_store)
    got = _rows(table.read())
    assert got == _rows(apply_unchanged(base, changes, ["k"]))
    assert (1, "v1", 11) in got and (60, "v2", 6) in got and (50, "new", 5) in got and not {2, 3} & {r[0] for r in got}


def test_empty_deltas_buckets_and_tables(spark):
    base = _base(spark, 3)
    table = BucketTable(spark, scratch_path(spark, "t"), base, ["k"], buckets=2)
    table.commit()
    table.fold_changes(_changes(spark, []), store=_store)
    assert _rows(table.read()) == _rows(base)
    table.fold_changes(_changes(spark, [(i, i, (i, f"v{i}", i), None) for i in range(3)]), store=_store)
    assert table.read().count() == 0 and table.read().columns == base.columns and not table.manifest().files
    table.fold_changes(_changes(spark, [(9, 9, None, (1, "back", 1))]), store=_store)
    assert _rows(table.read()) == [(1, "back", 1)]
    with pytest.raises(ValueError):
        BucketTable(spark, scratch_path(spark, "none")).commit()
    assert BucketTable(spark, scratch_path(spark, "none")).read() is None


def test_vacuum_keeps_what_the_last_versions_list(spark):
    path = scratch_path(spark, "t")
    table = BucketTable(spark, path, _base(spark, 200), ["k"], buckets=10)
    table.commit()
    for i in range(3):
        table.fold_changes(_changes(spark, [(i, i, (i, f"v{i}", i), (i, f"new{i}", i))]), store=_store)
    before = _rows(table.read(2)), _rows(table.read(3))
    assert table.vacuum(2) > 0 and table_versions(spark, path) == [2, 3]
    assert (_rows(table.read(2)), _rows(table.read(3))) == before and _rows(read_version(spark, path)) == before[1]
    listed = _folders(table.manifest(2)) | _folders(table.manifest(3))
    on_disk = {f"data/{c}/{b}" for c in os.listdir(f"{path}/data") for b in os.listdir(f"{path}/data/{c}") if b.startswith("_bucket")}
    assert on_disk == listed and table.vacuum(2) == 0


def test_null_and_text_keys(spark):
    base = spark.createDataFrame([("a", None, 1), (None, None, 2), ("b", 1, 3)], "s string, i bigint, n int")
    table = BucketTable(spark, scratch_path(spark, "t"), base, ["s", "i"], buckets=3)
    table.commit()
    assert sorted(map(str, table.read().collect())) == sorted(map(str, base.collect()))
    whole = BucketTable(spark, scratch_path(spark, "t"), base, buckets=3)
    whole.commit(added=base)
    assert whole.read().count() == 6
