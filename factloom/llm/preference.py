"""Preference formatting: chosen and rejected conversations become one prompt and two masked completions.

The longest common prefix of turns (same role and text) is rendered once as the prompt; the turns after it are rendered
as the chosen and the rejected completion. Masks give the character spans of a completion that count in the loss: what
the assistant says and its end mark. DataFrame functions only.

A pair is of use where both completions hold something that counts in the loss and are not the same; `is_pair` says so.

Cases: a null role or text counts as empty; turns sort by number, then role, then text, and repeated rows are kept as
repeated turns; turns without a conversation id belong to no conversation and are left out; an absent side is an empty
list of turns; equal sides give two empty completions; an empty table gives an empty table; other columns are ignored.
A conversation is one row of the result, so its turns are taken to fit into memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TURNS = "array<struct<role:string,text:string>>"


def _turn() -> Column:
    return F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def turns(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, turns): each conversation's turns in order."""
    grouped = conversations.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col)).agg(F.sort_array(F.collect_list(_turn())).alias("t"))
    return grouped.select(id_col, F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def common_prefix(a: Column, b: Column) -> Column:
    """The number of leading turns that are equal."""
    least = F.least(F.size(a), F.size(b))
    first = F.array_position(F.zip_with(F.slice(a, 1, least), F.slice(b, 1, least), lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"])), F.lit(False))
    return F.coalesce(F.nullif(first, F.lit(0)) - 1, least).cast("int")


def _one(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit("\n"), turn["text"], F.lit(CLOSE))


def render(of: Column) -> Column:
    return F.array_join(F.transform(of, _one), "")


def mask(of: Column) -> Column:
    """start:end of each assistant turn's text and end mark within the rendered turns, comma-joined."""
    empty = F.struct(F.lit(0).alias("at"), F.lit("").alias("spans"))

    def step(done: Column, turn: Column) -> Column:
        start = done["at"] + len(OPEN) + F.length(turn["role"]) + 1
        end = start + F.length(turn["text"]) + len(CLOSE)
        span = F.concat(F.when(done["spans"] == "", F.lit("")).otherwise(F.lit(",")), start.cast("string"), F.lit(":"), end.cast("string"))
        return F.struct(end.alias("at"), F.concat(done["spans"], F.when(turn["role"] == "assistant", span).otherwise(F.lit(""))).alias("spans"))

    return F.aggregate(of, empty, step, lambda x: x["spans"])


def format_pairs(pairs: DataFrame, id_col: str = "pair_id", chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """pairs: id and two arrays of (role, text). One row per pair: id, n_prompt_turns, prompt, the two completions and
    their masks, and whether it is of use."""
    none = F.array().cast(TURNS)
    both = pairs.select(F.col(id_col), F.coalesce(F.col(chosen), none).alias("c"), F.coalesce(F.col(rejected), none).alias("r"))
    cut = both.withColumn("n", common_prefix(F.col("c"), F.col("r")))
    rest = lambda side: F.slice(side, F.col("n") + 1, F.size(side))
    parts = cut.select(id_col, "n", F.slice("c", F.lit(1), F.col("n")).alias("p"), rest("c").alias("c"), rest("r").alias("r"))
    counts = lambda side: F.exists(side, lambda t: t["role"] == "assistant")
    return parts.select(
        id_col, F.col("n").cast("long").alias("n_prompt_turns"), render(F.col("p")).alias("prompt"),
        render(F.col("c")).alias("chosen"), mask(F.col("c")).alias("chosen_mask"), render(F.col("r")).alias("rejected"), mask(F.col("r")).alias("rejected_mask"),
        (counts(F.col("c")) & counts(F.col("r"))).alias("is_pair"),
    )


def swapped_replies(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(pair_id, chosen, rejected) for every conversation: chosen is the conversation; rejected is it with its last
    assistant turn, and what follows that, replaced by the last assistant turn of conversation id xor 1. Without such a
    turn on either side the rejected side is null."""
    own = turns(conversations, id_col).withColumn("last", F.expr("aggregate(transform(turns, (t, i) -> if(t.role = 'assistant', i, -1)), -1, (a, x) -> greatest(a, x))"))
    # The replies are found apart, so that a task sends one turn of a conversation and not the whole of it again.
    said = conversations.where(F.col(id_col).isNotNull() & (F.col("role") == "assistant"))
    last = said.groupBy(F.col(id_col).bitwiseXOR(F.lit(1)).alias("partner")).agg(F.max(_turn()).alias("x"))
    reply = last.select("partner", F.struct("x.role", "x.text").alias("reply"))
    pair = own.join(reply, own[id_col] == reply["partner"], "left")
    other = F.when((F.col("last") >= 0) & F.col("reply").isNotNull(), F.concat(F.slice("turns", F.lit(1), F.greatest("last", F.lit(0))), F.array("reply")))
    return pair.select(F.col(id_col).alias("pair_id"), F.col("turns").alias("chosen"), other.alias("rejected"))
