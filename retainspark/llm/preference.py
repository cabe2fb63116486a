"""Preference formatting of chosen and rejected conversations.

The longest common prefix of turns (equal role and text) is rendered once as the
prompt; what follows on either side is that side's completion.  Loss masks are
character spans of the completions: the contents and ends of assistant turns.

A pair's turns come together in one row, as the result of a pair is one row; no
group is larger than a rendered conversation.  Hot roles, texts or first turns
are no group at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from retainspark.llm.common import require

HEAD, MID, TAIL = "<|im_start|>", "\n", "<|im_end|>\n"
TRAINED = "assistant"


def _ordered(turns: DataFrame, pair: str, turn: str, role: str, text: str, side: str) -> DataFrame:
    """Turns of one side; rows equal in pair, turn, role and text are one."""
    rows = require(turns, [pair, turn, role, text]).toDF("pair", "turn", "role", "text")
    return (rows.filter("pair IS NOT NULL").distinct()
            .withColumn("role", F.coalesce(F.col("role").cast("string"), F.lit("")))
            .withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
            .withColumn("side", F.lit(side)))


def format_preferences(chosen: DataFrame, rejected: DataFrame, pair: str = "pair_id", turn: str = "turn",
                       role: str = "role", text: str = "text") -> DataFrame:
    """One row per pair: ``pair`` , ``n_prompt`` (turns in common from the
    start), ``prompt``, ``chosen``, ``rejected`` (rendered text), ``n_chosen``,
    ``n_rejected`` (turns after the prompt) and ``chosen_mask``,
    ``rejected_mask``: spans [start, end) of characters of the completion that
    carry loss, as ``start-end`` joined by commas.

    Turns are taken in the order of ``turn`` (null first), then role and text;
    repeated rows count once, null roles and texts as empty; rows without a pair
    are not part of one.  A pair with one side only has an empty prompt and an
    empty other completion; equal sides have two empty completions.  Other
    columns are not read.  Empty tables give an empty result."""
    rows = _ordered(chosen, pair, turn, role, text, "c").unionByName(_ordered(rejected, pair, turn, role, text, "r"))
    cell = F.struct("turn", "role", "text")
    # the turns of a side as one array: the row that is rendered in the end
    sides = (rows.groupBy("pair")
             .agg(F.sort_array(F.collect_list(F.when(F.col("side") == "c", cell))).alias("c"),
                  F.sort_array(F.collect_list(F.when(F.col("side") == "r", cell))).alias("r")))
    n = F.least(F.size("c"), F.size("r"))
    differs = F.transform(F.slice("c", 1, n), lambda x, i: F.when(
        (x["role"] != F.col("r")[i]["role"]) | (x["text"] != F.col("r")[i]["text"]), i))
    sides = sides.withColumn("n", F.coalesce(F.array_min(differs), n))
    rest = lambda s: F.slice(s, F.col("n") + 1, F.size(s))
    return sides.select(
        F.col("pair").alias(pair), F.col("n").cast("long").alias("n_prompt"), _render(F.slice("c", 1, F.col("n"))).alias("prompt"),
        _render(rest("c")).alias("chosen"), _render(rest("r")).alias("rejected"),
        (F.size("c") - F.col("n")).cast("long").alias("n_chosen"), (F.size("r") - F.col("n")).cast("long").alias("n_rejected"),
        _mask(rest("c")).alias("chosen_mask"), _mask(rest("r")).alias("rejected_mask"))


def _turn(t: Column) -> Column:
    return F.concat(F.lit(HEAD), t["role"], F.lit(MID), t["text"], F.lit(TAIL))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _turn), "")


def _mask(turns: Column) -> Column:
    """Spans of the trained turns' text and end marker in the rendered turns."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(done: Column, t: Column) -> Column:
        a = done["at"] + len(HEAD) + F.char_length(t["role"]) + len(MID)
        b = a + F.char_length(t["text"]) + len(TAIL)
        one = F.concat(a.cast("string"), F.lit("-"), b.cast("string"))
        return F.struct(b.alias("at"), F.when(t["role"] == TRAINED, F.concat(done["spans"], F.array(one)))
                        .otherwise(done["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda done: F.array_join(done["spans"], ","))
