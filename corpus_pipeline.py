"""A corpus from raw documents to packed sequences: five stages, each on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.llm.common import small, table
from cdcflow.llm.decontam import decontaminated
from cdcflow.llm.near_dup import BROADCAST_IDS, Params, near_duplicates
from cdcflow.llm.packing import pack_documents
from cdcflow.llm.pii import sanitise
from cdcflow.llm.quality import quality_filter
from cdcflow.llm.queries import word_tokenizer
from cdcflow.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive rules reject go."""
    return quality_filter(docs)


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) one row stays: the smallest id, rows without id last.

    Rows are told apart by id and text together, so a text whose id is also that of a copy stays, and
    copies without id go.  Rows that repeat both leave one.
    """
    columns = [f"`{c}`" for c in docs.columns]
    key = F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("long"), "text"), 1)
    rows = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("id"), "text")
    groups = materialize(near_duplicates(rows.select(F.col("key").alias("doc_id"), "text"), Params(width=5)).select(F.col("doc_id").alias("key"), "component_id"), "groups")
    known = rows.select("key", "id").distinct().join(groups.distinct(), "key")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))["key"]
    best = known.groupBy("component_id").agg(first.alias("best"), F.count("*").alias("n")).where("n > 1")
    best = materialize(best.drop("n"), "first-of-group")  # so that the join may split a group of very many rows
    gone = known.join(best, "component_id").where("key <> best").select(F.col("key").alias("_gone"))
    kept = docs.withColumn("_key", key).join(small(materialize(gone, "gone"), BROADCAST_IDS), F.col("_key") == F.col("_gone"), "left_anti")
    if groups.groupBy("key").count().where("count > 1").isEmpty():
        return kept.select(*columns)
    return kept.dropDuplicates(["_key"]).select(*columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its error budget go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced in the text."""
    return sanitise(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token ids in sequences of at most 4096 tokens."""
    return pack_documents(docs, word_tokenizer(spark))


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicate removal", near_duplicate_removal),
    ("benchmark decontamination", benchmark_decontamination),
    ("personal data", personal_data),
    ("best-fit packing", best_fit_packing),
]

#: Shingle similarity, edit distance and byte-pair encoding have no plain SQL form; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents; each but the last is stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
