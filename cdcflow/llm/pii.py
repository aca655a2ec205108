"""Personal data and the terms that give it away, on DataFrame functions alone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcflow.functions.plan import let, once
from cdcflow.llm.common import small
from cdcflow.session import materialize

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<start:int,kind_no:int,end:int,value:string>>"
#: Disclosing terms that may be broadcast to the texts; beyond, the same join shuffles.
BROADCAST_TERMS = 200_000
_CHUNK = 512

#: Runs are matched once, from their first character, so that no text takes quadratic time.  A card is
#: a whole chain of digits of the right length; all shorter and longer chains would be dropped anyway.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_HINT = {"email": "@", "phone": "+"}
_TERM = r"\p{L}\p{M}\p{N}"


@dataclass(frozen=True)
class Disclosure:
    """``share`` of a protected value's information from which a term counts as disclosing it; ``support``
    different contexts it must be seen in with it; ``window`` words on either side make a context."""

    share: float = 0.9
    support: int = 3
    window: int = 8


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    def add(total: Column, i: Column, s: Column) -> Column:
        d = F.substring(s, i, 1).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return let(F.reverse(_digits(value)), lambda s: F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), lambda t, i: add(t, i, s)) % 10 == 0)


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.regexp_like(p, F.lit(r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")))
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _matches(text: Column, pattern: Column, kind_no: int, valid) -> Column:
    """Spans of all matches, in order.

    The text between matches and the matches give running places; they are added up in chunks, so a
    text with very many matches costs little more per match than one with few.
    """

    def placed(gaps: Column, hits: Column) -> Column:
        sized = F.transform(hits, lambda h, i: F.struct(F.length(F.get(gaps, i)).alias("g"), F.length(h).alias("n"), h.alias("value")))
        total = lambda part: F.aggregate(part, F.lit(0), lambda t, x: t + x["g"] + x["n"])

        def within(part: Column, offset: Column) -> Column:
            empty = F.struct(offset.alias("at"), F.array().cast(SPANS).alias("out"))

            def step(s: Column, x: Column) -> Column:
                start = s["at"] + x["g"]
                span = F.struct(start.alias("start"), F.lit(kind_no).alias("kind_no"), (start + x["n"]).alias("end"), x["value"].alias("value"))
                return F.struct((start + x["n"]).alias("at"), F.concat(s["out"], F.array(span)).alias("out"))

            return F.aggregate(part, empty, step)["out"]

        def chunked(z: Column) -> Column:
            parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(z) - 1) / _CHUNK).cast("int")), lambda c: F.slice(z, c * _CHUNK + 1, F.lit(_CHUNK)))
            sums = lambda p: F.aggregate(
                p, F.array(F.lit(0)), lambda t, x: F.concat(t, F.array(F.element_at(t, -1) + total(x)))
            )
            return let(parts, lambda p: let(sums(p), lambda at: F.flatten(F.transform(p, lambda x, i: within(x, F.get(at, i))))))

        return F.when(F.size(hits) > 0, let(sized, chunked)).otherwise(F.array().cast(SPANS))

    found = let(F.split(text, pattern, -1), lambda gaps: let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda hits: placed(gaps, hits)))
    return F.filter(found, lambda s: valid(s["value"]))


def base_spans(text: Column) -> Column:
    """All valid emails, addresses, cards and phone numbers of a text, by place, then kind."""
    none = F.array().cast(SPANS)
    found = []
    for n, kind in enumerate(KINDS):
        hint = F.contains(text, F.lit(_HINT[kind])) if kind in _HINT else F.rlike(text, F.lit(r"[0-9]\.[0-9]" if kind == "ip" else r"[0-9][\x20-]?[0-9]"))
        found.append(F.when(hint, _matches(text, F.lit(PATTERNS[kind]), n, lambda v, k=kind: _valid(k, v))).otherwise(none))
    return F.sort_array(F.concat(*found))


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), f"[^{_TERM}]+"), lambda w: w != "")


def _class(term: Column) -> Column:
    """What a term is generalised to."""
    return F.when(F.rlike(term, F.lit(r"\p{N}")), "CODE").otherwise("WORD")


def _contexts(found: DataFrame, d: Disclosure) -> DataFrame:
    """(entity, terms): the words near each protected value; equal contexts count once.

    ``window`` words before and after are taken, across line ends and other values, so a context has a
    bounded size and copies of a text add nothing.  Words inside a protected value are in no context.
    """
    spans = once(found.select("text"), {"spans": base_spans(F.col("text"))}).where(F.size("spans") > 0)
    near = spans.select(F.explode(_near(F.col("text"), F.col("spans"), d.window)).alias("c")).select("c.entity", "c.terms")
    return near.groupBy("entity", "terms").agg(F.count("*").alias("times"))


def _near(text: Column, spans: Column, window: int) -> Column:
    """(entity, terms) of each span of a text.

    Each span becomes a mark of its own among the words, so the words before the i-th mark are as many
    as its place less i.
    """
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        piece = F.when(x["start"] > s["at"], F.substring(text, s["at"] + 1, x["start"] - s["at"])).otherwise(F.lit(""))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.concat(s["out"], F.array(piece)).alias("out"))

    pieces = F.aggregate(spans, zero, step, lambda s: F.concat(s["out"], F.array(F.substring(text, s["at"] + 1, F.length(text)))))
    marked = F.flatten(F.transform(pieces, lambda x, i: F.when(i > 0, F.concat(F.array(F.lit("")), _terms(x))).otherwise(_terms(x))))

    def around(words: Column) -> Column:
        places = F.filter(F.transform(words, lambda w, i: F.when(w == "", i)), lambda i: i.isNotNull())
        return let(F.filter(words, lambda w: w != ""), lambda plain: let(places, lambda at: F.transform(spans, lambda s, i: one(plain, s, F.get(at, i) - i))))

    def one(plain: Column, s: Column, n: Column) -> Column:
        first = F.greatest(n - window, F.lit(0))
        return F.struct(F.concat(s["kind_no"].cast("string"), F.lit(":"), F.lower(s["value"])).alias("entity"), F.slice(plain, first + 1, n - first + window).alias("terms"))

    return let(marked, around)


def disclosing_terms(documents: DataFrame, found: DataFrame, d: Disclosure = Disclosure()) -> DataFrame:  # noqa: B008
    """(term, tag): terms that disclose a protected value, and what replaces them.

    With W windows in the corpus, a value c seen in n_c contexts carries log2(W / n_c) bits, and a term t
    seen with it in n_ct of its n_t windows reveals log2(n_ct W / (n_c n_t)) of them.  A term that
    reveals ``share`` of the bits or more discloses c.  It is generalised to its class if the class,
    weighed in the same way, stays below the threshold, and removed (empty tag) otherwise.  Terms of
    digits alone are rated like all others.  Every
    occurrence in the corpus counts in n_t, except that equal contexts of protected values count once.
    """
    contexts = materialize(_contexts(found, d), "contexts")
    values = contexts.groupBy("entity").agg(F.count("*").alias("n_c"))
    words = contexts.select("entity", "times", F.explode(F.array_distinct("terms")).alias("term"))
    pairs = words.groupBy("entity", "term").agg(F.count("*").alias("n_ct")).where(F.col("n_ct") >= d.support)
    pairs = materialize(pairs, "pairs")
    if pairs.isEmpty():
        return documents.sparkSession.createDataFrame([], "term string, tag string")
    spoken = documents.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    spoken = materialize(spoken, "terms")
    total = spoken.agg(F.sum("n")).first()[0]
    windows = F.lit(max(total / (2 * d.window), 1.0))
    again = words.groupBy("term").agg(F.sum(F.col("times") - 1).alias("again"))
    n_t = pairs.select("term").distinct().join(spoken, "term").join(again, "term").select("term", F.greatest(F.col("n") - F.col("again"), F.lit(1)).alias("n_t"))
    classes = spoken.groupBy(_class(F.col("term")).alias("class")).agg(F.sum("n").alias("n_g"))
    class_pairs = contexts.select("entity", F.explode(F.array_distinct(F.transform("terms", _class))).alias("class")).groupBy("entity", "class").agg(F.count("*").alias("n_cg"))
    share = lambda both, n: F.log2(F.col(both) * windows / (F.col("n_c") * F.col(n))) / F.log2(windows / F.col("n_c"))
    rated = pairs.join(values, "entity").join(n_t, "term").where((windows > F.col("n_c")) & (share("n_ct", "n_t") >= d.share))
    rated = rated.withColumn("class", _class(F.col("term"))).join(class_pairs, ["entity", "class"]).join(classes, "class")
    open_class = F.max(F.when(share("n_cg", "n_g") >= d.share, 1).otherwise(0))
    return materialize(rated.groupBy("term", "class").agg(open_class.alias("open")).select("term", F.when(F.col("open") == 0, F.concat(F.lit("["), "class", F.lit("]"))).otherwise("").alias("tag")), "disclosing")


def _term_spans(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, code, tags, found): places of disclosing terms, for the texts that hold any."""
    spoken = documents.select("doc_id", "code", F.explode(F.array_distinct(_terms(F.col("text")))).alias("term"))
    met = spoken.join(small(terms, BROADCAST_TERMS), "term")
    held = met.groupBy("doc_id", "code").agg(F.map_from_entries(F.collect_set(F.struct("term", "tag"))).alias("tags"))
    one = documents.withColumnsRenamed({"doc_id": "d", "code": "c"})
    held = small(materialize(held, "holding"), BROADCAST_TERMS // 10)
    texts = one.join(held, one["d"].eqNullSafe(held["doc_id"]) & (one["c"] == held["code"])).select("doc_id", "code", "text", "tags")
    quoted = F.array_join(F.transform(F.sort_array(F.map_keys("tags")), lambda t: F.concat(F.lit(r"\Q"), t, F.lit(r"\E"))), "|")
    pattern = F.concat(F.lit(rf"(?iu)(?<![{_TERM}])(?:"), quoted, F.lit(rf")(?![{_TERM}])"))
    places = once(texts, {"pattern": pattern})
    spans = _matches(F.col("text"), F.col("pattern"), len(KINDS), lambda v: F.map_contains_key(F.col("tags"), F.lower(v)))
    return places.select("doc_id", "code", "tags", spans.alias("found")).dropDuplicates(["doc_id", "code"])


def with_spans(documents: DataFrame, d: Disclosure = Disclosure(), name: str = "pii") -> DataFrame:  # noqa: B008
    """Adds a struct of ``base`` (valid spans of the four kinds), ``spans`` (with the terms added) and ``tags``.

    Terms that lie inside a base span are not added.  Null texts are empty and have no spans.  All rows
    and columns are kept, rows with equal or null ids too: equal texts get equal spans.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = once(documents, {f"{name}_base": base_spans(text), f"{name}_code": F.xxhash64(text)})
    plain = documents.select("doc_id", text.alias("text"))
    found = plain.where(F.rlike("text", F.lit("[@0-9]")))
    terms = disclosing_terms(plain, found, d)
    kind = f"struct<base:{SPANS},spans:{SPANS},tags:map<string,string>>"
    kept = [F.col(f"`{c}`") for c in documents.columns]
    own = F.col(f"{name}_base")
    if terms.isEmpty():
        return base.select(*kept, F.struct(own.alias("base"), own.alias("spans"), F.create_map().cast("map<string,string>").alias("tags")).cast(kind).alias(name))
    places = materialize(_term_spans(plain.withColumn("code", F.xxhash64("text")), terms), "term-spans")
    right = places.select(F.col("doc_id").alias(f"{name}_doc"), F.col("code").alias(f"{name}_right"), "tags", "found").withColumnsRenamed({"tags": f"{name}_tags", "found": f"{name}_found"})
    joined = base.join(small(right, BROADCAST_TERMS // 10), base["doc_id"].eqNullSafe(right[f"{name}_doc"]) & (F.col(f"{name}_code") == F.col(f"{name}_right")), "left")
    free = F.filter(f"{name}_found", lambda t: ~F.exists(own, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    spans = F.when(F.col(f"{name}_found").isNull(), own).otherwise(F.sort_array(F.concat(own, free)))
    made = F.struct(own.alias("base"), spans.alias("spans"), F.col(f"{name}_tags").alias("tags")).cast(kind)
    return once(joined, {name: made}).select(*kept, name)


def sanitised(text: Column, spans: Column, tags: Column) -> Column:
    """The text with each span replaced: base kinds by their name, terms by their class or nothing.

    Overlapping spans are replaced together, under the name of the first.
    """
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    tag = lambda s: F.when(s["kind_no"] < len(KINDS), F.get(names, s["kind_no"])).otherwise(F.coalesce(F.get(F.filter(F.map_values(F.map_filter(tags, lambda k, v: k == F.lower(s["value"]))), lambda v: v.isNotNull()), F.lit(0)), F.lit("")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        piece = F.concat(F.substring(text, s["at"] + 1, x["start"] - s["at"]), tag(x))
        taken = F.struct(x["end"].alias("at"), F.concat(s["out"], F.array(piece)).alias("out"))
        return F.when(x["start"] >= s["at"], taken).otherwise(F.struct(F.greatest(s["at"], x["end"]).alias("at"), s["out"].alias("out")))

    done = lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, zero, step, done)).otherwise(text)


def sanitise(documents: DataFrame, d: Disclosure = Disclosure()) -> DataFrame:  # noqa: B008
    """``documents`` with personal data and disclosing terms replaced in ``text``; ``n_chars``, if there, is counted anew.

    Null texts stay null; an empty table stays empty.
    """
    name = "_pii_found"
    rows = with_spans(documents, d, name)
    text = F.when(F.col("text").isNotNull(), sanitised(F.col("text"), F.col(f"{name}.spans"), F.col(f"{name}.tags")))
    clean = once(rows, {"_pii_text": text})
    new = {"text": F.col("_pii_text")} | ({"n_chars": F.length("_pii_text").cast(documents.schema["n_chars"].dataType)} if "n_chars" in documents.columns else {})
    return clean.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in documents.columns])


def listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, "term")])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind_no"]), s["start"], s["end"])), ",")


def pii_report(documents: DataFrame, d: Disclosure = Disclosure()) -> DataFrame:  # noqa: B008
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms; one row per input row."""
    rows = with_spans(documents.select("doc_id", "text"), d)
    count = lambda n: F.size(F.filter("pii.base", lambda s: s["kind_no"] == n)).cast("long")
    return rows.select(
        "doc_id", *[count(n).alias(f"n_{k}") for n, k in enumerate(KINDS)], F.sha2(listed(F.col("pii.base")), 256).alias("base_sha256"),
        listed(F.col("pii.spans")).alias("spans"), (F.size("pii.spans") - F.size("pii.base")).cast("long").alias("n_terms"),
    )
