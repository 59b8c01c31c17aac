"""Conversations as budgeted training windows.

Every turn is marked by the template and its control strings are escaped
reversibly. Prefix sums of the turns' tokens cut a conversation into spans of
whole turns; each window holds the conversation's system turn, a limited history
before its span, and the span. Only assistant texts of the span are under the
loss mask, so each assistant text is a target once, in one window.

Spans. The room is ``budget`` less the system turn (never less than an eighth of the
budget); a quarter of it is for history. A turn above half of the other three
quarters is a span of its own. The others share a span if their prefix sums fall
into the same half, which no large turn can lie between. So a window never exceeds
the budget, but for one whose only turn does (``over_budget``): texts are never cut.
A span depends on prefix sums alone: there is no walk from turn to turn, and a
conversation of any length is cut in parallel.

History. The nearest turns before the span that fit into the quarter, and into what
a large turn leaves. A turn is history of at most a few windows, as spans start apart.

Edge cases: a null text is empty; a null role is the empty role; a null ``turn``
comes first; turns of equal number are ordered by role and text, and rows that
repeat count each; rows without ``conv_id`` form the conversation null; an empty
table gives no windows. Of the input only ``conv_id``, ``turn``, ``role`` and
``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeload.llm.scratch import written
from lakeload.llm.tokens import default_vocabulary, text_tokens

BUDGET = 2048

#: Turns whose prefix sums are added up together before they are joined along the conversation.
BLOCK_TURNS = 64

OPEN, CLOSE = "<|turn|>", "<|end|>\n"

ESCAPE, LINE_END = "␛", "␤"

# Control strings of common chat templates; the escape sign is put after their first character.
CONTROL = r"<(?=\||/?s>|/?SYS>|</?SYS>>|/?think>)|\[(?=/?INST\]|/?AVAILABLE_TOOLS\]|/?TOOL_)|\|(?=>)"


def escaped(text: Column) -> Column:
    """No control string is left in the text; :func:`unescaped` gives it back."""
    doubled = F.regexp_replace(text, ESCAPE, ESCAPE + ESCAPE)
    return F.regexp_replace(doubled, f"({CONTROL})", f"$1{ESCAPE}")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, f"{ESCAPE}({ESCAPE}?)", "$1")


def token_counter(vocabulary: str) -> Callable[[Iterator[pd.Series]], Iterator[pd.Series]]:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = text_tokens(vocabulary)
        for texts in batches:
            yield texts.map(lambda text: len(tokens.packed(text)) // 4).astype("int64")

    return run


def marked_turns(turns: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Each turn with its text in the template (``formatted``), the place of its text there, its token count and its order in the conversation."""
    count = F.pandas_udf(token_counter(vocabulary or default_vocabulary()), "long")
    role = F.coalesce(F.col("role"), F.lit(""))
    body = escaped(F.coalesce(F.col("text"), F.lit("")))
    head = F.concat(F.lit(OPEN), F.replace(escaped(role), F.lit("\n"), F.lit(ESCAPE + LINE_END)), F.lit("\n"))
    return (
        turns.select("conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(-(2**62))).alias("turn"), role.alias("role"), head.alias("head"), body.alias("body"))
        .select(
            "conv_id",
            "turn",
            "role",
            F.concat("head", "body", F.lit(CLOSE)).alias("formatted"),
            F.length("head").alias("body_start"),
            F.length("body").alias("body_length"),
        )
        .withColumn("tokens", count("formatted"))
    )


def with_prefix_sums(turns: DataFrame) -> DataFrame:
    """``before``: tokens of the turns ahead; ``position``: their number.

    First within blocks of neighbouring turn numbers, then over the blocks'
    totals, so that a long conversation is not gathered in one task.
    """
    block = F.floor(F.col("turn") / BLOCK_TURNS).cast("long")
    blocked = turns.withColumn("block", block)
    totals = blocked.groupBy("conv_id", "block").agg(F.sum("tokens").alias("block_tokens"), F.count("*").alias("block_turns"))
    ahead = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = totals.select(
        "conv_id",
        "block",
        F.coalesce(F.sum("block_tokens").over(ahead), zero).alias("tokens_ahead"),
        F.coalesce(F.sum("block_turns").over(ahead), zero).alias("turns_ahead"),
    )
    # the order is total but for equal rows, and those are interchangeable
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "formatted").rowsBetween(Window.unboundedPreceding, -1)
    summed = blocked.withColumns({"in_block": F.coalesce(F.sum("tokens").over(inside), zero), "turn_in_block": F.count("*").over(inside)})
    same = summed["conv_id"].eqNullSafe(starts["conv_id"]) & (summed["block"] == starts["block"])
    joined = summed.join(starts, same).select(summed["*"], "tokens_ahead", "turns_ahead")
    return joined.withColumns({"before": F.col("tokens_ahead") + F.col("in_block"), "position": F.col("turns_ahead") + F.col("turn_in_block")}).drop(
        "block", "in_block", "turn_in_block", "tokens_ahead", "turns_ahead"
    )


def windows(turns: DataFrame, budget: int = BUDGET, vocabulary: str | None = None) -> DataFrame:
    """One row per window: its text, loss spans and turns.

    ``conv_id, first_position (of its span, in turns; orders the windows), formatted,
    loss_spans array<struct<start,length>>, n_system, n_history, n_targets (turns of
    the span), tokens, over_budget``. ``loss_spans`` are code points of ``formatted``.
    """
    placed = written(with_prefix_sums(marked_turns(turns, vocabulary)), "chat-turns")
    is_system = (F.col("position") == 0) & (F.col("role") == "system")
    systems = placed.filter(is_system).select("conv_id", F.col("tokens").alias("system_tokens"), F.col("formatted").alias("system_formatted"))
    rest = placed.filter(~is_system)

    # a conversation has one system turn, so this side has no hot key; the other is split by adaptive execution
    same = rest["conv_id"].eqNullSafe(systems["conv_id"])
    taken = F.coalesce(F.col("system_tokens"), F.lit(0).cast("long"))
    room = F.greatest(F.lit(budget) - taken, F.lit(budget // 8))
    sized = rest.join(systems.select("conv_id", "system_tokens"), same, "left").select(
        rest["*"], (F.col("before") - taken).alias("start"), room.cast("long").alias("room")
    )
    half, quarter = F.floor(F.col("room") * 3 / 8), F.floor(F.col("room") / 4)
    slot = F.floor(F.col("start") / half) * 2 + (F.col("tokens") > half).cast("long")
    spans = sized.withColumn("slot", slot)
    first = spans.groupBy("conv_id", "slot", "room").agg(F.min("start").alias("span_start"), F.sum("tokens").alias("span_tokens"))
    spare = F.least(quarter, F.greatest(F.lit(0), F.col("room") - F.col("span_tokens")))
    first = first.withColumns({"spare": spare, "cell": F.floor(F.col("span_start") / quarter)})
    # A span's history starts in the quarter of its own start or in the one before.
    reach = spans.withColumn("cell", F.explode(F.array(*[F.floor(F.col("start") / quarter) + i for i in (0, 1)])))
    h, s = reach.alias("h"), first.alias("s")
    near = (
        F.col("h.conv_id").eqNullSafe(F.col("s.conv_id"))
        & (F.col("h.cell") == F.col("s.cell"))
        & (F.col("h.start") < F.col("s.span_start"))
        & (F.col("h.start") >= F.col("s.span_start") - F.col("s.spare"))
    )
    part = ["position", "formatted", "body_start", "body_length", "tokens"]
    history = h.join(s, near).select("h.conv_id", "s.slot", *[f"h.{c}" for c in part], F.lit(False).alias("own"), F.lit(False).alias("target"))
    own = spans.select("conv_id", "slot", *part, F.lit(True).alias("own"), (F.col("role") == "assistant").alias("target"))
    # bounded: a window's turns have a token each at least, and together no more than the budget
    packed = F.array_sort(F.collect_list(F.struct(*part, "own", "target")))
    grouped = history.unionByName(own).groupBy("conv_id", "slot").agg(packed.alias("parts"))
    system_text, system_tokens = F.coalesce("system_formatted", F.lit("")), F.coalesce("system_tokens", F.lit(0).cast("long"))
    filled = grouped.join(systems, grouped["conv_id"].eqNullSafe(systems["conv_id"]), "left").select(
        grouped["conv_id"], "parts", system_text.alias("system_text"), system_tokens.alias("system_tokens")
    )
    answered = rest.select(F.col("conv_id").alias("other_id")).distinct()
    alone = systems.join(answered, systems["conv_id"].eqNullSafe(answered["other_id"]), "left_anti").select(
        "conv_id", F.array().cast(grouped.schema["parts"].dataType).alias("parts"), F.col("system_formatted").alias("system_text"), "system_tokens"
    )
    return laid_out(filled.unionByName(alone), budget)


def laid_out(grouped: DataFrame, budget: int) -> DataFrame:
    """Windows from their parts: texts joined, spans of the loss mask counted from the start."""
    # the text is concatenated as before; offsets by a running sum over the window's parts
    zero = F.struct(F.length("system_text").cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("spans"))

    def step(state: Column, part: Column) -> Column:
        span = F.struct((state["at"] + part["body_start"]).alias("start"), part["body_length"].cast("long").alias("length"))
        longer = F.concat(state["spans"], F.array(span))
        return F.struct((state["at"] + F.length(part["formatted"])).alias("at"), F.when(part["target"], longer).otherwise(state["spans"]).alias("spans"))

    own = F.filter("parts", lambda p: p["own"])
    tokens = F.col("system_tokens") + F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["tokens"])
    first = F.coalesce(F.get(F.transform(own, lambda p: p["position"]), F.lit(0)), F.lit(0).cast("long"))
    return grouped.select(
        "conv_id",
        F.concat("system_text", F.array_join(F.transform("parts", lambda p: p["formatted"]), "")).alias("formatted"),
        F.aggregate("parts", zero, step)["spans"].alias("loss_spans"),
        (F.col("system_text") != "").cast("int").alias("n_system"),
        (F.size("parts") - F.size(own)).alias("n_history"),
        F.size(own).alias("n_targets"),
        first.alias("first_position"),
        tokens.alias("tokens"),
        (tokens > budget).alias("over_budget"),
    )


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text, unescaped."""
    turns = text.split(OPEN)[1:]
    return [tuple(map(plain, turn[: -len(CLOSE)].split("\n", 1))) for turn in turns]


def plain(text: str) -> str:
    """A role or text as it was before it was escaped."""
    return re.sub(f"{ESCAPE}({ESCAPE}|{LINE_END})?", lambda m: {ESCAPE: ESCAPE, LINE_END: "\n", None: ""}[m[1]], text)
