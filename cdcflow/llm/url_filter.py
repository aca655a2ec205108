"""URL filter: rules first, then the likelihood ratio of two character models."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from cdcflow.functions.plan import let
from cdcflow.llm.common import ascii_lower, byte_chunks
from cdcflow.session import materialize

#: Characters before the predicted one, and kinds of characters; together they bound the model: KINDS ** (ORDER + 1) numbers.
ORDER, KINDS = 3, 40
CELLS = KINDS ** (ORDER + 1)
MAX_RULES = 1000
_FOLDS, _STEPS, _EDGE = 5, 100, 20


@dataclass(frozen=True)
class Rule:
    """``host`` and all its subdomains, below ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as (rule, verdict); null if none does.  Of equally long ones the first stated."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are tested one by one")
    found = F.lit(None).cast("struct<rule string, verdict string>")
    for r in sorted(reversed(rules), key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def _kinds() -> np.ndarray:
    """The kind of a byte: 26 letters without case, digits, ten marks, other ASCII, others; 39 is the edge of a URL."""
    k = np.full(256, 37, np.int32)
    k[128:] = 38
    k[65:91] = k[97:123] = np.arange(26)
    k[48:58] = 26
    for i, mark in enumerate(b"/.-_?=&%:#"):
        k[mark] = 27 + i
    return k


_KIND = _kinds()


def grams(urls: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of (characters before, character) for each byte and the end of each URL; and how many each has."""
    lengths = np.fromiter(map(len, urls), np.int64, len(urls))
    kinds = _KIND[np.frombuffer(b"\0" * ORDER + (b"\0" * ORDER).join([*urls, b""]), np.uint8)]
    first = ORDER + np.cumsum(lengths + ORDER) - lengths - ORDER
    for k in range(1, ORDER + 1):
        kinds[first - k] = 39
    kinds[len(kinds) - ORDER :] = 39
    code = np.zeros(len(kinds) - ORDER, np.int64)
    for k in range(ORDER + 1):
        code = code * KINDS + kinds[k : len(kinds) - ORDER + k]
    wanted = np.repeat(first - np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]), lengths + 1) + np.arange((lengths + 1).sum())
    return code[wanted - ORDER], lengths + 1


def smoothed(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of a character after its context, all orders mixed by Witten-Bell's rule.

    A context trusts its own counts the more, the more it was seen and the fewer different characters
    followed it; the rest goes to the context one character shorter, down to equal shares.
    """
    p = np.full((1, KINDS), 1 / KINDS)
    for order in range(ORDER + 1):
        n = counts.reshape(KINDS ** (ORDER - order), KINDS**order, KINDS).sum(0)
        seen, kinds = n.sum(1, keepdims=True), (n > 0).sum(1, keepdims=True)
        lower = np.tile(p, (KINDS if order else 1, 1))
        p = np.where(seen > 0, (n + kinds * lower) / np.maximum(seen + kinds, 1), lower)
    return np.log(p).reshape(-1)


class UrlModel:
    """Log likelihood ratio per character context (10 MB) and the cutoff for its mean over a URL."""

    def __init__(self, ratio: Broadcast, cutoff: float):
        self.ratio, self.cutoff = ratio, cutoff

    def scores(self, urls: list[bytes]) -> np.ndarray:
        code, n = grams(urls)
        ends = np.cumsum(n)
        run = np.concatenate([[0.0], np.cumsum(self.ratio.value[code], dtype=np.float64)])
        return (run[ends] - run[ends - n]) / n

    @staticmethod
    def train(labelled: DataFrame) -> UrlModel:
        """From (url, accepted).  Four fifths of the URLs, by checksum, give the counts; the others, the cutoff.

        Only sums reach the driver: counts per character context, and of held-out URLs per hundredth of score.
        """
        rows = labelled.where("url is not null").select(F.col("url").cast("binary").alias("url"), "accepted")
        fold = F.crc32("url") % _FOLDS == 0

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, CELLS), np.int64)
            for batch in batches:
                urls, yes = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
                for a, b in byte_chunks(urls, len):
                    code, n = grams(urls[a:b])
                    np.add.at(total.reshape(-1), code + CELLS * np.repeat(yes[a:b].astype(np.int64), n), 1)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.reshape(-1)[at])], names=["at", "n"])

        counts = np.zeros(2 * CELLS)
        for r in rows.where(~fold).mapInArrow(count, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toLocalIterator():
            counts[r["at"]] = r["n"]
        ratio = smoothed(counts[CELLS:]) - smoothed(counts[:CELLS])
        sc = labelled.sparkSession.sparkContext
        model = UrlModel(sc.broadcast(ratio.astype(np.float32)), 0.0)
        step = F.least(F.greatest(F.floor(F.col("url_score") * _STEPS), F.lit(-_EDGE * _STEPS)), F.lit(_EDGE * _STEPS))
        held = model.score(rows.where(fold)).groupBy(step.alias("step"), "accepted").agg(F.count("*").alias("n")).collect()
        model.cutoff = calibrated([(r["step"], r["accepted"], r["n"]) for r in held])
        return model

    def score(self, rows: DataFrame) -> DataFrame:
        """Adds ``url_score`` to rows with a column ``url``; a null URL scores like an empty one."""
        kept = rows.withColumn("url", F.col("url").cast("binary"))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                urls = [u or b"" for u in batch.column("url").to_pylist()]
                found = [self.scores(urls[a:b]) for a, b in byte_chunks(urls, len)]
                scored = np.concatenate(found) if found else np.zeros(0)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scored)], names=[*batch.schema.names, "url_score"])

        return kept.mapInArrow(score, StructType(kept.schema.fields[:]).add("url_score", DoubleType()))


def calibrated(held: list[tuple[int, bool, int]]) -> float:
    """The cutoff with the best mean of both classes' recalls; of equal ones that in the middle; 0 without both classes."""
    yes, no = sum(n for _, a, n in held if a), sum(n for _, a, n in held if not a)
    if not yes or not no:
        return 0.0
    best, at = -1.0, []
    for cut in range(-_EDGE * _STEPS, _EDGE * _STEPS + 1):
        right = sum(n for s, a, n in held if a and s >= cut) / yes + sum(n for s, a, n in held if not a and s < cut) / no
        if right > best + 1e-12:
            best, at = right, []
        if right >= best - 1e-12:
            at.append(cut)
    return at[len(at) // 2] / _STEPS


def url_verdicts(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, url, host, path, rule, verdict ("allow" or "block"), url_score; one row per input row.

    A URL that fits a rule gets the verdict of the longest; these URLs train the models, and all
    others are judged by the mean log likelihood ratio of their characters against the cutoff.  Null
    URLs and URLs without ``://`` have empty host and path, fit no rule and are judged as they are, a
    null one like an empty one.  Null and repeated ids keep their rows; columns other than page_id
    and url are not read; an empty table gives no rows.  With no rule that fits, all ratios are 0 and
    everything is allowed.
    """
    parts = let(
        F.struct(url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")),
        lambda p: F.struct(p["host"].alias("host"), p["path"].alias("path"), best_rule(p["host"], p["path"], rules).alias("best")),
    )
    split = materialize(pages.select("page_id", "url", parts.alias("p")).select("page_id", "url", "p.host", "p.path", "p.best.rule", F.col("p.best.verdict").alias("ruled")), "urls")
    model = UrlModel.train(split.where("ruled is not null").select("url", (F.col("ruled") == "allow").alias("accepted")))
    own = F.when(F.col("url_score") >= model.cutoff, "allow").otherwise("block")
    scored = model.score(split)
    return scored.select("page_id", F.col("url").cast("string").alias("url"), "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "url_score")
