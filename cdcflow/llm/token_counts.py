"""Token counts through a digest cache."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.common import SPACE, byte_chunks, stored
from cdcflow.llm.encoder import Tokenizer
from cdcflow.session import materialize

CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens bigint"


def digested(documents: DataFrame, tokenizer: Tokenizer, text: str = "text"):
    """The digest of the normalised content.

    Normalising only removes what the tokenizer ignores: runs of ASCII white space become one space
    and the ends are trimmed, for tokenizers that drop white space; nothing for others.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    if tokenizer.by_word:
        content = F.trim(F.regexp_replace(content, SPACE, " "))
    return F.unhex(F.sha2(content.cast("binary"), 256))


def fill_cache(documents: DataFrame, tokenizer: Tokenizer, cache: str, text: str = "text") -> None:
    """Encode each distinct content that the cache lacks, and append its count.

    Copies meet map-side first, so a content that fills a third of the table is shuffled once per
    task.  A run that is repeated, or two runs at once, may append a digest twice: readers of the
    cache take one row per digest.
    """
    spark = documents.sparkSession
    have = known_counts(documents, tokenizer, cache).select("digest")
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    distinct = documents.select(digested(documents, tokenizer, text).alias("digest"), content.alias("content")).dropDuplicates(["digest"])
    misses = distinct.join(have, "digest", "left_anti")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer.open()
        for batch in batches:
            texts = batch.column("content").to_pylist()
            counts: list[int] = []
            for a, b in byte_chunks(texts, len):
                counts += [len(x) // 4 for x in encoder.ids(texts[a:b])]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    made = misses.mapInArrow(count, "digest binary, n_tokens bigint")
    made.select(F.lit(tokenizer.digest).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache)
    spark.catalog.refreshByPath(cache)


def known_counts(documents: DataFrame, tokenizer: Tokenizer, cache: str) -> DataFrame:
    rows = stored(documents.sparkSession, cache, CACHE_SCHEMA).where(F.col("tokenizer") == tokenizer.digest)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(documents: DataFrame, tokenizer: Tokenizer, cache: str, limit: int = 2048) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per input row.

    ``cache`` is a folder in shared storage that outlives the run; contents counted earlier with the
    same tokenizer are not encoded again.  Null texts count as empty (0 bytes, 0 tokens); null and
    repeated ids keep their own rows; columns other than doc_id and text are not read; an empty table
    gives an empty result.  Encoding runs in Arrow batches of bounded bytes on distinct texts only.
    """
    fill_cache(documents, tokenizer, cache)
    rows = documents.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), digested(documents, tokenizer).alias("digest")
    )
    # one stored row per digest, so that a digest shared by very many texts is split over tasks by the join
    counted = rows.join(materialize(known_counts(documents, tokenizer, cache), "token-counts"), "digest", "left")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
