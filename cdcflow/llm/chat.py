"""Chat formatting in budgeted windows, on DataFrame functions alone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cdcflow.functions.plan import let
from cdcflow.session import materialize

#: Turn numbers are cut into slices of this many, so that no task holds a whole conversation of any length.
SLICE = 1024
BEGIN, END = "<|im_start|>", "<|im_end|>\n"
_TOKENS = r"[\p{L}\p{M}]+|\p{N}|[^\s\p{L}\p{M}\p{N}]"


@dataclass(frozen=True)
class Budget:
    """Tokens of a window, how many of them may repeat earlier turns, and what the marks of a turn cost."""

    window: int = 512
    history: int = 96
    per_turn: int = 4


def escaped(text: Column) -> Column:
    r"""Without control strings: every ``<`` ``\``... ``|`` gets one more backslash, so ``<|`` becomes ``<\|``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _role(role: Column) -> Column:
    """A role on one line and without control strings."""
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def _role_back(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%3C"), F.lit("<")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _turns(conversations: DataFrame, budget: Budget, tokens: Column | None) -> DataFrame:
    """Turns with their place, and the tokens and the number of long turns before them.

    Running sums are taken per slice of a conversation; one summary row of each slice passes a second
    window, whose sums are added.  ``stride`` is the width of a span and ``long`` a turn above it.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.coalesce(tokens, F.lit(0)) if tokens is not None else F.regexp_count(text, F.lit(_TOKENS))
    rows = conversations.select(
        "conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"), text.alias("text"), (size + budget.per_turn).cast("long").alias("tokens"),
    ).withColumn("slice", F.coalesce(F.floor(F.col("turn") / SLICE), F.lit(-(1 << 60))))
    order = W.partitionBy("key", "slice").orderBy("turn", "role", "text")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    placed = rows.withColumn("nth", F.row_number().over(order))
    head = F.max(F.when((F.col("nth") == 1) & (F.col("role") == "system"), F.col("tokens")))
    sums = placed.groupBy("key", "slice").agg(F.count("*").alias("n"), head.alias("head"))
    by = W.partitionBy("key").orderBy("slice")
    earlier = by.rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("key", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"), F.coalesce(F.first("head").over(by), F.lit(0)).alias("system"))
    room = F.greatest(F.lit(budget.window) - F.col("system"), F.lit(budget.window // 4))
    turns = placed.join(sums, ["key", "slice"]).withColumns({"pos": F.col("nth") + F.col("n0"), "room": room})
    turns = turns.withColumns({"kept": F.least(F.lit(budget.history), F.floor(F.col("room") / 4)), "lead": (F.col("pos") == 1) & (F.col("system") > 0)})
    turns = turns.withColumn("stride", F.floor((F.col("room") - F.col("kept")) / 2))
    turns = turns.withColumns({"long": (F.col("tokens") > F.col("stride")) & ~F.col("lead"), "cost": F.when(F.col("lead"), F.lit(0)).otherwise(F.col("tokens"))})
    by_long = F.col("long").cast("long")
    here = turns.withColumns({"p1": F.coalesce(F.sum("cost").over(before), F.lit(0)), "l1": F.sum(by_long).over(order.rowsBetween(W.unboundedPreceding, 0))})
    whole = here.groupBy("key", "slice").agg(F.sum("cost").alias("p"), F.sum(by_long).alias("l"))
    offsets = whole.select("key", "slice", F.coalesce(F.sum("p").over(earlier), F.lit(0)).alias("p0"), F.coalesce(F.sum("l").over(earlier), F.lit(0)).alias("l0"))
    return here.join(offsets, ["key", "slice"]).select(
        "conv_id", "key", "pos", "role", "text", "tokens", "system", "room", "kept", "lead", "long", (F.col("p0") + F.col("p1")).alias("prefix"),
        (F.col("l0") + F.col("l1")).alias("longs"), F.floor((F.col("p0") + F.col("p1")) / F.col("stride")).alias("cell"),
    )


def chat_windows(conversations: DataFrame, budget: Budget = Budget(), tokens: Column | None = None, learn: str = "assistant") -> DataFrame:  # noqa: B008
    """conv_id, window_start, formatted, loss, n_context, n_turns, n_tokens, over_budget: one row per window.

    The tokens before each turn cut a conversation at multiples of a stride into spans of whole turns.  A
    stride is half of what a window has left besides system turn and history, and a turn longer than
    that is a span of its own, so a span always fits; only a single turn above the room is over
    budget, and is kept whole.  Each window holds the leading system turn, then the last turns
    before the span as far as they fit the history, then the span.  ``loss`` lists the places, in
    code points of ``formatted``, of the ``learn`` role's texts of the span; what is repeated
    (the first ``n_context`` turns) is masked, so every text is learnt once.

    Turns are ordered by turn, then role and text; null turns come first; repeated rows are turns of their
    own.  Null texts and roles are empty.  Rows without conv_id form one conversation without id.  Extra
    columns are not read; an empty table gives no rows.  ``tokens`` may name the token count of a turn;
    by default words, digits and marks are counted.
    """
    turns = materialize(_turns(conversations, budget, tokens), "turns")  # read three times below
    spans = turns.groupBy("key", "longs", "long", "cell").agg(
        F.min("pos").alias("start"), F.min("prefix").alias("from"), F.sum("tokens").alias("sum"), F.max("room").alias("w_room"), F.max("kept").alias("w_kept")
    ).withColumn("spare", F.when(F.col("long"), F.greatest(F.least(F.col("w_kept"), F.col("w_room") - F.col("sum")), F.lit(0))).otherwise(F.col("w_kept")))
    # a span that begins within ``spare`` tokens after a turn lies in the turn's cell or the next one
    near = turns.withColumn("look", F.explode(F.array("cell", F.col("cell") + 1)))
    s = spans.select(F.col("key"), F.col("cell").alias("look"), F.col("longs").alias("s_longs"), F.col("long").alias("s_long"), "start", "from", "spare")
    met = near.join(s, ["key", "look"])
    own = (F.col("look") == F.col("cell")) & (F.col("longs") == F.col("s_longs")) & (F.col("long") == F.col("s_long"))
    again = ~F.col("lead") & (F.col("start") > F.col("pos")) & (F.col("from") - F.col("prefix") <= F.col("spare"))
    body = met.where(own | again).select("conv_id", "key", "start", "pos", "role", "text", "tokens", own.alias("new"))
    leads = turns.where("lead").select("key", "conv_id", "pos", "role", "text", "tokens")
    headed = spans.where("start > 1").select("key", "start").join(leads, "key").select("conv_id", "key", "start", "pos", "role", "text", "tokens", F.lit(False).alias("new"))
    part = F.struct("pos", "new", "role", "text", "tokens")
    windows = body.unionByName(headed).groupBy("key", "start").agg(F.max("conv_id").alias("conv_id"), F.sort_array(F.collect_list(part)).alias("parts"))
    pieces = F.transform(
        "parts",
        lambda p: F.struct(
            F.concat(F.lit(BEGIN), _role(p["role"]), F.lit("\n")).alias("head"), escaped(p["text"]).alias("body"), p["new"].alias("new"),
            (p["new"] & (p["role"] == learn)).alias("learn"), p["tokens"].alias("tokens"),
        ),
    )

    def laid_out(parts: Column) -> Column:
        size = lambda p: F.length(p["head"]) + F.length(p["body"]) + len(END)
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("loss"))

        def step(state: Column, p: Column) -> Column:
            start = state["at"] + F.length(p["head"])
            here = F.array(F.struct(start.alias("start"), (start + F.length(p["body"])).alias("end")))
            return F.struct((state["at"] + size(p)).alias("at"), F.when(p["learn"], F.concat(state["loss"], here)).otherwise(state["loss"]).alias("loss"))

        return F.struct(
            F.array_join(F.transform(parts, lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"),
            F.aggregate(parts, zero, step)["loss"].alias("loss"), F.size(F.filter(parts, lambda p: ~p["new"])).alias("n_context"), F.size(parts).alias("n_turns"),
            F.aggregate(parts, F.lit(0).cast("long"), lambda t, p: t + p["tokens"]).alias("n_tokens"),
        )

    made = windows.select("conv_id", F.col("start").alias("window_start"), let(pieces, laid_out).alias("w"))
    return made.select("conv_id", "window_start", "w.*").withColumn("over_budget", F.col("n_tokens") > budget.window)


def read_windows(windows: DataFrame) -> DataFrame:
    """conv_id, window_start, turns (role, text) of the span and learnt texts, read back from the formatted text alone."""
    segments = F.slice(F.split("formatted", r"<\|im_end\|>\n"), F.col("n_context") + 1, F.col("n_turns") - F.col("n_context"))
    turn = lambda s: F.struct(
        _role_back(F.substring_index(F.substring(s, F.lit(len(BEGIN) + 1), F.length(s)), "\n", 1)).alias("role"),
        unescaped(F.substring(s, F.instr(s, "\n") + 1, F.length(s))).alias("text"),
    )
    learnt = F.transform("loss", lambda x: unescaped(F.substring(F.col("formatted"), x["start"] + 1, x["end"] - x["start"])))
    return windows.select("conv_id", "window_start", F.transform(segments, turn).alias("turns"), learnt.alias("learnt"), F.length("formatted").cast("long").alias("chars"))


def conversation_digests(windows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of whole conversations.

    A digest of a conversation needs its text in one place; this is the one step that gathers it.
    """
    read = read_windows(windows)
    whole = read.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("window_start", "turns", "learnt"))).alias("w"), F.sum("chars").alias("formatted_chars"))
    turns, learnt = F.flatten(F.transform("w", lambda x: x["turns"])), F.array_join(F.flatten(F.transform("w", lambda x: x["learnt"])), "")
    text = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return whole.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"), F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"), "formatted_chars",
    )
