"""Conversations as training windows of a token budget.

Prefix sums of turn tokens choose spans of whole turns: a conversation's
token line is cut into cells of half the room that the budget leaves; turns
of at most a cell's length that begin in a cell are one span, a longer turn is
a span of its own. A window is the leading system turn, the last turns before
the span that fit the history limit, and the span's turns. Loss covers the
texts of assistant turns in their own span only; repeated turns are masked.

Template: ``<|im_start|>role<|im_sep|>text<|im_end|>\\n`` per turn. In roles and
texts a backslash is doubled and ``<|`` becomes ``<\\|``, so no control string
can occur inside them, and unescaping gives them back exactly.

Job shape: only DataFrame functions. Prefix sums are taken within blocks of
turns, then over blocks; window groups are one cell of one conversation, whose
turns are bounded by the budget (and its one longer turn). A conversation with
a third of all turns is spread over its blocks and cells.

Defined results: null roles and texts count as empty; turns are ordered by
turn (null first), then role and text; repeated rows are turns each; a null
conversation id is a conversation like any other; an empty table gives no
window. A window whose system turn or single long turn exceeds the budget is
kept whole and marked ``over_budget``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens of a window, of its repeated history, and the least cell.
BUDGET, HISTORY, LEAST_CELL = 1024, 192, 64
#: Turns per block of the prefix sums.
BLOCK = 64

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
#: Control strings of a turn, as tokens.
TURN_TOKENS = 3
#: A token: up to eight letters, up to three digits, or another character.
TOKEN = r"\p{L}{1,8}|\p{N}{1,3}|[^\s\p{L}\p{N}]"


def escape(value: Column) -> Column:
    return F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(value: Column) -> Column:
    return F.regexp_replace(value, r"(?s)\\(.)", "$1")


def turn_tokens(role: Column, text: Column) -> Column:
    return (F.regexp_count(role, F.lit(TOKEN)) + F.regexp_count(text, F.lit(TOKEN)) + TURN_TOKENS).cast("long")


def format_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, conv_col: str = "conv_id",
                   turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, cell, span, formatted, n_repeated, loss_spans, n_tokens, over_budget`` per window.

    Windows of a conversation are ordered by ``cell, span``. ``n_repeated``
    leading turns repeat earlier ones. ``loss_spans`` are code point offsets
    (from 0; start, end) of the escaped texts that count for the loss.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    turns = conversations.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"),
                                 text.alias("text"), turn_tokens(role, text).alias("tokens"))
    turns = turns.withColumn("block", F.floor(F.col("turn") / BLOCK))

    # Prefix sums: within a block, then over a conversation's blocks.
    in_block = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turns = turns.withColumn("inner", F.sum("tokens").over(in_block.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "i", F.row_number().over(in_block))
    sums = turns.groupBy("conv", "block").agg(
        F.sum("tokens").alias("sum"), F.max(F.when((F.col("i") == 1) & (F.col("role") == "system"), F.struct(
            "text", "tokens"))).alias("lead"))
    over_blocks = Window.partitionBy("conv").orderBy(F.col("block").asc_nulls_first())
    sums = sums.withColumn("base", F.coalesce(F.sum("sum").over(
        over_blocks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn(
        "system", F.first("lead").over(over_blocks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).select(
        F.col("conv").alias("c"), F.col("block").alias("b"), "base", F.col("system.text").alias("system_text"),
        F.coalesce("system.tokens", F.lit(0)).alias("system_tokens"))
    placed = turns.join(sums, turns["conv"].eqNullSafe(sums["c"]) & turns["block"].eqNullSafe(sums["b"]))

    low = F.col("base") + F.col("inner") - F.col("tokens")
    size = F.greatest(F.lit(LEAST_CELL), F.floor((budget - history - F.col("system_tokens")) / 2)).cast("long")
    placed = placed.select("conv", "role", "text", "tokens", "system_text", "system_tokens", low.alias("low"),
                           size.alias("size")).withColumn("cell", F.floor(F.col("low") / F.col("size")))

    # A turn belongs to its own cell; it is also offered as history to the next one, if it may be near enough.
    near = (F.col("tokens") <= history) & (F.col("low") >= (F.col("cell") + 1) * F.col("size") - history)
    # History within a cell's size reaches back into the cell before at most.
    offers = F.when(near, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    dealt = placed.withColumn("ahead", F.explode(offers)).withColumn("cell", F.col("cell") + F.col("ahead"))
    cells = dealt.groupBy("conv", "cell").agg(
        F.sort_array(F.collect_list(F.struct(
            "low", (F.col("ahead") == 0).alias("own"), "tokens", "role", "text"))).alias("turns"),
        F.first("size").alias("size"), F.first("system_text").alias("system_text"),
        F.first("system_tokens").alias("system_tokens"))

    def window(span: int) -> Column:
        def mine(t: Column) -> Column:
            return t["own"] & ((t["tokens"] <= F.col("size")) if span == 0 else (t["tokens"] > F.col("size")))

        own = F.filter("turns", mine)
        start = F.element_at(own, 1)["low"]
        # The leading system turn is not history: it is retained by itself.
        leading = F.col("system_text").isNotNull()
        past = F.filter("turns", lambda t: (t["low"] < start) & (t["low"] + t["tokens"] <= start) & (
            t["low"] >= start - history) & ~(leading & (t["low"] == 0)))
        system = F.when(leading & (start > 0), F.array(F.struct(
            F.lit("system").alias("role"), F.col("system_text").alias("text"), F.col("system_tokens").alias("tokens")
        ))).otherwise(F.array())

        def plain(t: Column) -> Column:
            return F.struct(t["role"].alias("role"), t["text"].alias("text"), t["tokens"].alias("tokens"))

        repeated = F.concat(system, F.transform(past, plain))
        return F.when(F.size(own) > 0, F.struct(
            F.lit(span).alias("span"), F.concat(repeated, F.transform(own, plain)).alias("turns"),
            F.size(repeated).alias("n_repeated")))

    spans = cells.select("conv", "cell", F.explode(F.array(window(0), window(1))).alias("w")).where("w is not null")
    return spans.select("conv", "cell", "w.span", "w.n_repeated", "w.turns").select(
        F.col("conv").alias("conv_id"), "cell", "span", _formatted().alias("formatted"), "n_repeated",
        _loss_spans().alias("loss_spans"), _tokens().alias("n_tokens"), (_tokens() > budget).alias("over_budget"))


def _tokens() -> Column:
    return F.aggregate(F.transform("turns", lambda t: t["tokens"]), F.lit(0).cast("long"), lambda a, n: a + n)


def _formatted() -> Column:
    return F.array_join(F.transform("turns", lambda t: F.concat(
        F.lit(START), escape(t["role"]), F.lit(SEPARATOR), escape(t["text"]), F.lit(END))), "")


def _loss_spans() -> Column:
    """Stretches of assistant texts after the repeated turns."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).alias("i"),
                    F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(a: Column, t: Column) -> Column:
        start = a["at"] + len(START) + F.length(t["role"]) + len(SEPARATOR)
        end = start + F.length(t["text"])
        counts = (a["i"] >= F.col("n_repeated")) & t["assistant"]
        return F.struct(
            (end + len(END)).cast("long").alias("at"), (a["i"] + 1).alias("i"),
            F.when(counts, F.concat(a["spans"], F.array(F.struct(
                start.cast("long").alias("start"), end.cast("long").alias("end"))))).otherwise(a["spans"]).alias("spans"))

    escaped = F.transform("turns", lambda t: F.struct(
        escape(t["role"]).alias("role"), escape(t["text"]).alias("text"),
        (t["role"] == "assistant").alias("assistant")))
    return F.aggregate(escaped, zero, step, lambda a: a["spans"])


def read_back(windows: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` from the windows alone.

    The digests are of whole conversations, so a conversation's texts meet in
    one row here, first window by window, then as a whole.
    """
    bodies = F.filter(F.split("formatted", r"<\|im_start\|>"), lambda s, i: i > 0)
    fresh = F.transform(F.filter(bodies, lambda s, i: i >= F.col("n_repeated")), lambda s: F.concat(
        unescape(F.substring_index(s, SEPARATOR, 1)), F.lit("\n"),
        unescape(F.substring_index(F.substring_index(s, SEPARATOR, -1), "<|im_end|>", 1)), F.lit("\n")))
    loss = F.transform("loss_spans", lambda s: unescape(F.substr(
        F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    parts = windows.select(
        "conv_id", F.struct("cell", "span", F.array_join(fresh, "").alias("turns"), F.array_join(loss, "").alias("loss"),
                            F.size(fresh).cast("long").alias("n")).alias("w"),
        F.length("formatted").cast("long").alias("chars"))
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("w"), F.sum("chars").alias("chars"))
    turns, lost = F.array_join("w.turns", ""), F.array_join("w.loss", "")
    return whole.select(
        "conv_id", F.aggregate("w.n", F.lit(0).cast("long"), lambda a, n: a + n).alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"), F.length(lost).cast("long").alias("loss_chars"),
        F.sha2(lost, 256).alias("loss_sha256"), F.col("chars").alias("formatted_chars"))
