"""Parts that few jobs use: scan marks, result types, the discard sink and the read speed test."""

import json

from pyspark.sql import functions as F

from cdcflow.operators.offsets import high_water, incremental_scan
from cdcflow.operators.records import result_types
from cdcflow.plans.job import SyncJob, register_sink
from cdcflow.session import scratch_path
from cdcflow.sinks.files import discard
from cdcflow.sources.captured import redo_source


def test_a_scan_goes_on_behind_its_mark(spark):
    rows = spark.range(20).withColumn("v", F.col("id") % 3)
    mark = high_water(rows.where("id < 12"), "id").first()["high_water"]
    assert mark == 11 and [r.id for r in incremental_scan(rows, "id", mark).collect()] == list(range(12, 20))
    assert [r.id for r in incremental_scan(rows, "id", mark, 14).collect()] == [12, 13, 14]
    assert high_water(rows.where("id < 0"), "id").first()["high_water"] is None


def test_result_types_of_a_column_list(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "id long, Name string, d double")
    assert result_types(df, ["id", {"name": "name", "type": "INT"}, {"index": 2}, {"name": "k", "value": "x"}]) == ["bigint", "string", "double", "VARCHAR"]


def test_mined_rows_are_read_behind_an_scn(spark):
    path = scratch_path(spark, "redo")
    spark.range(10).select(F.col("id").alias("scn")).write.parquet(path)
    found = redo_source(spark, path, 6)
    assert sorted(r.scn for r in found.collect()) == [7, 8, 9] and "PushedFilters: [IsNotNull(scn), GreaterThan(scn,6)]" in found._jdf.queryExecution().toString()


def test_discard_reads_everything_and_a_speed_test_writes_nothing(spark):
    read, taken = spark.sparkContext.accumulator(0), []

    def touch(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    discard(spark.range(50).mapInArrow(touch, "id long"))
    assert read.value == 50
    register_sink("never", lambda df, p, job: taken.append(1))
    src = scratch_path(spark, "in")
    spark.range(30).write.parquet(src)
    job = {"content": [{"reader": {"name": "filereader", "parameter": {"path": src}}, "writer": {"name": "never", "parameter": {}}}], "setting": {"test": {"speedTest": "reader"}}}
    SyncJob.from_json(json.dumps({"job": job})).run(spark)
    assert not taken
