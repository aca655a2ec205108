"""Quality rules whose cutoffs follow each language and source."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cdcflow.functions.plan import let, once
from cdcflow.llm.common import SPACE, small
from cdcflow.session import materialize

WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
#: A group of so many texts has cutoffs halfway between its own and its language's (a language: all texts'); few texts say little.
PRIOR_TEXTS = 50
#: Groups whose cutoffs may be broadcast to the texts; beyond, the same join shuffles.
BROADCAST_GROUPS = 100_000


@dataclass(frozen=True)
class Rule:
    """A ratio ``1000 * top / below`` whose cutoffs are its group's quartiles and ``reach`` quartile distances beyond.

    Ordinary texts of a group set its cutoffs, so a source full of tables or code is measured against
    itself, and a clean source strictly.  Counts of a single text are coarse: ``spare`` events and
    ``slack`` thousandths beyond the cutoff are no verdict.  Only with ``low`` is there a lower cutoff.
    """

    top: str
    below: str
    slack: int
    spare: int = 0
    low: bool = False
    reach: int = 4


RULES: dict[str, Rule] = {
    "word_length": Rule("word_chars", "n_words", 100, 30, low=True),
    "symbols": Rule("n_symbols", "n_words", 10, 3),
    "dup_lines": Rule("n_dup_lines", "n_lines", 50, 3),
    "repeats": Rule("n_repeat_words", "n_words", 60, 30),
}


def _repeated(words: Column) -> Column:
    """Words inside 3-word windows that the text holds twice or more, in time n log n.

    Windows are sorted by hash and position; neighbours of equal hash and words are marked; each
    marked window, in order of position, covers min(3, distance to the next) words.
    """

    def windows(w: Column) -> Column:
        made = F.transform(w, lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p")))
        return F.sort_array(F.slice(made, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))))

    def marked(w: Column, s: Column) -> Column:
        def equal(x: Column, y: Column) -> Column:
            words_equal = [F.get(w, x["p"] + k) == F.get(w, y["p"] + k) for k in range(3)]
            return F.coalesce((x["h"] == y["h"]) & words_equal[0] & words_equal[1] & words_equal[2], F.lit(False))

        kept = F.filter(s, lambda x, i: equal(x, F.get(s, i - 1)) | equal(x, F.get(s, i + 1)))
        return F.sort_array(F.transform(kept, lambda x: x["p"]))

    def covered(p: Column) -> Column:
        each = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
        return F.aggregate(each, F.lit(0), lambda t, x: t + x)

    return let(words, lambda w: let(windows(w), lambda s: let(marked(w, s), covered)))


def with_counts(documents: DataFrame, name: str = "quality_counts") -> DataFrame:
    """Adds a struct of the text's counts; a null text has no words.

    ``n_lines`` are lines with a word; ``n_dup_lines`` those equal to an earlier one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(WHITE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    of_words = let(words, lambda w: F.struct(F.size(w).alias("n"), _repeated(w).alias("r")))
    of_lines = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d")))
    made = let(
        F.struct(of_words.alias("w"), of_lines.alias("l")),
        lambda c: F.struct(
            c["w"]["n"].cast("long").alias("n_words"),
            F.length(F.translate(text, WHITE, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            c["l"]["n"].cast("long").alias("n_lines"),
            c["l"]["d"].cast("long").alias("n_dup_lines"),
            c["w"]["r"].cast("long").alias("n_repeat_words"),
        ),
    )
    return once(documents, {name: made})


def _ratio(rule: Rule, counts: Mapping[str, Column]) -> Column:
    """Thousandths, rounded down; null without a divisor."""
    top, below = 1000 * counts[rule.top], counts[rule.below]
    return F.when(below > 0, F.floor((top - F.pmod(top, below)) / below + 0.5))


def _spare(value: Column) -> Column:
    return F.greatest(F.length(F.bin(value)) - 7, F.lit(0))


def _bucket(value: Column) -> Column:
    """The value with all but its seven leading bits cleared: a sketch of relative error 1/64."""
    spare = _spare(value)
    return F.call_function("shiftleft", F.call_function("shiftright", value, spare), spare)


def _last(bucket: Column) -> Column:
    """The largest value of a bucket, so that a group of equal texts does not lie above its own quartile."""
    return bucket + F.call_function("shiftleft", F.lit(1).cast("long"), _spare(bucket)) - 1


def cutoffs(counted: DataFrame, rules: Mapping[str, Rule] = RULES, prior: int = PRIOR_TEXTS) -> DataFrame:
    """(lang, source, <rule>_high, <rule>_low) for each language and source, null ones included.

    A group's sketch is the count of texts per bucket of a ratio, over texts that pass the base rule.
    Sketches merge by adding counts: map tasks add up their own rows, and the sketches of a language and
    of all texts are sums of their groups'.  Quartiles of n texts are mixed with the parent's, n squared to
    ``prior`` squared, so that no verdict hangs on one text more or less; a table of few texts, which has no
    parent, gets cutoffs wider by the same measure of their size.  Results do not depend on the order of merging.
    """
    counts = {c: F.col(f"quality_counts.{c}") for c in COUNTS}
    values = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), _bucket(_ratio(r, counts).cast("long")).alias("bucket")) for n, r in rules.items()]))
    passed = counted.where(~base_failed(counts)).select("lang", "source", values.alias("v")).where("v.bucket is not null")
    own = passed.groupBy("lang", "source", "v.rule", "v.bucket").agg(F.count("*").alias("n"))
    level = lambda k, lang, source: F.struct(F.lit(k).alias("level"), lang.alias("lang"), source.alias("source"))
    none = F.lit(None).cast("string")
    levels = F.array(level(2, F.col("lang"), F.col("source")), level(1, F.col("lang"), none), level(0, none, none))
    key = ["level", "lang", "source", "rule"]
    sketch = own.select(F.explode(levels).alias("g"), "rule", "bucket", "n").groupBy("g.level", "g.lang", "g.source", "rule", "bucket").agg(F.sum("n").alias("n"))
    by = W.partitionBy(*key)
    run = sketch.withColumns({"upto": F.sum("n").over(by.orderBy("bucket")), "total": F.sum("n").over(by)})
    quartile = lambda q: F.min(F.when(4 * F.col("upto") >= q * F.col("total"), F.col("bucket")))
    quartiles = run.groupBy(*key).agg(F.max("total").alias("total"), quartile(1).alias("q1"), quartile(3).alias("q3"))
    marks = {"q1": F.col("q1"), "q3": F.col("q3"), "end": _last(F.col("q3"))}
    at = lambda k, keys: quartiles.where(F.col("level") == k).select(*keys, F.struct("total", *[v.cast("double").alias(n) for n, v in marks.items()]).alias(f"s{k}"))
    same = lambda x, y, *names: [F.col(f"{x}.{n}").eqNullSafe(F.col(f"{y}.{n}")) for n in names]
    joined = at(2, ["lang", "source", "rule"]).alias("g").join(at(1, ["lang", "rule"]).alias("a"), same("g", "a", "lang", "rule")).select("g.*", "s1").join(at(0, ["rule"]), "rule")

    def mixed(name: str) -> Column:
        value = F.col(f"s0.{name}")
        for k in (1, 2):
            square = F.col(f"s{k}.total").cast("double") * F.col(f"s{k}.total").cast("double")
            weight = square / (square + F.lit(float(prior * prior)))
            value = weight * F.col(f"s{k}.{name}") + (F.lit(1.0) - weight) * value
        return value

    whole = F.col("s0.total").cast("double") * F.col("s0.total").cast("double")
    chosen = joined.select("lang", "source", "rule", *[mixed(n).alias(n) for n in marks], (F.lit(float(prior * prior)) / whole).alias("unsure"))
    columns = []
    for name, r in rules.items():
        reach = F.lit(float(r.reach)) * (F.col("q3") - F.col("q1"))
        high, low = F.col("end") + reach + F.col("q3") * F.col("unsure"), F.col("q1") - reach - F.col("q1") * F.col("unsure")
        columns.append(F.max(F.when(F.col("rule") == name, F.floor(high))).alias(f"{name}_high"))
        if r.low:
            columns.append(F.max(F.when(F.col("rule") == name, F.floor(low))).alias(f"{name}_low"))
    return chosen.groupBy("lang", "source").agg(*columns)


def base_failed(counts: Mapping[str, Column]) -> Column:
    """The fixed part: fewer than 50 words, or more than half of the words in repeated windows."""
    return (counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])


def judged(counted: DataFrame, limits: DataFrame, rules: Mapping[str, Rule] = RULES) -> DataFrame:
    """Adds ``quality_base_failed`` and ``quality_kept`` by joining each text to its group's cutoffs."""
    names = [c for c in limits.columns if c not in ("lang", "source")]
    right = limits.select(F.struct("lang", "source").alias("_quality_group"), F.struct(*names).alias("_quality_limits"))
    left = counted.withColumn("_quality_own", F.struct(F.col("lang").alias("lang"), F.col("source").alias("source")))
    joined = left.join(small(right, BROADCAST_GROUPS), F.col("_quality_own").eqNullSafe(F.col("_quality_group")), "left")
    counts = {c: F.col(f"quality_counts.{c}") for c in COUNTS}
    bad = F.lit(False)
    for name, r in rules.items():
        top, below = F.lit(1000) * counts[r.top], counts[r.below]
        high, low = F.col(f"_quality_limits.{name}_high"), F.col(f"_quality_limits.{name}_low") if r.low else None
        bad = bad | F.coalesce(top > (high + r.slack) * below + 1000 * r.spare, F.lit(False))
        if r.low:
            bad = bad | F.coalesce(top < (low - r.slack) * below - 1000 * r.spare, F.lit(False))
    failed = base_failed(counts)
    return joined.withColumns({"quality_base_failed": failed, "quality_kept": ~(failed | bad)}).drop("_quality_own", "_quality_group", "_quality_limits")


def quality_verdicts(documents: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """One row per input row: doc_id, the counts, base_failed, kept.

    Null texts, empty texts and texts without words have zero counts and fail the base rule.  Null
    languages and sources are groups of their own; null and repeated ids keep their rows; other
    columns are not read; an empty table gives no rows.
    """
    counted = stats if stats is not None else with_counts(documents.select("doc_id", "lang", "source", "text")).drop("text")
    rows = judged(counted, cutoffs(counted))
    return rows.select("doc_id", "quality_counts.*", F.col("quality_base_failed").alias("base_failed"), F.col("quality_kept").alias("kept"))


def quality_filter(documents: DataFrame, limits: DataFrame | None = None) -> DataFrame:
    """The rows of ``documents`` that are kept, with all their columns.

    Without given ``limits`` the table is stored once beside its counts: counting costs far more than
    writing, and both the cutoffs and the filter need the counts.
    """
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"), "lang", "source", "text")
    counted = with_counts(rows).drop("text")
    if limits is None:
        counted = materialize(counted, "counted")
        limits = cutoffs(counted)
    return judged(counted, limits).where("quality_kept").select("_row.*")
