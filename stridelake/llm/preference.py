"""Preference formatting: shared turns as one prompt, the rest as paired, masked completions.

Input is long: one row for each turn of the chosen and the rejected conversation of a pair. Turns are compared by place;
the longest common prefix is everything before the first place that differs in role or text or that one side lacks. It
is rendered once as the prompt. A completion is rendered from the rest of its side; its mask lists the character ranges
(from, to) that an assistant wrote, end mark included, which is what a loss counts.

A NULL text is an empty turn, a NULL role a role of its own; a pair without one side gets NULL for its completion, equal
sides get empty completions; of rows that repeat a turn the smallest (role, text) counts; extra columns are ignored; an
empty table has no pairs. The turns of one pair form one row, as its rendered text does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.llm.common import laid_out, running

BEGIN, MIDDLE, END, SPEAKER = "<|", "|>\n", "<|end|>\n", "assistant"


def _head(role: Column) -> Column:
    return F.concat(F.lit(BEGIN), F.coalesce(role, F.lit("")), F.lit(MIDDLE))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t["role"]), t["text"], F.lit(END))), "")


def _mask(turns: Column) -> Column:
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.length(_head(t["role"]))
        end = begin + F.length(t["text"]) + F.lit(len(END))
        span = F.struct(begin.cast("int").alias("start"), end.cast("int").alias("end"))
        return F.struct(end.cast("int").alias("at"),
                        F.when(t["role"] == SPEAKER, F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def format_pairs(turns: DataFrame) -> DataFrame:
    """``turns (pair_id, side, turn, role, text)`` with side ``chosen`` or ``rejected`` to one row for each pair."""
    both = turns.groupBy("pair_id", "turn").agg(*[
        F.min(F.when(F.col("side") == side, F.struct("role", F.coalesce("text", F.lit("")).alias("text")))).alias(side)
        for side in ("chosen", "rejected")])
    shared = F.col("chosen").eqNullSafe(F.col("rejected"))
    line = F.struct("turn", "chosen", "rejected", (~shared).alias("apart"))
    pairs = both.groupBy("pair_id").agg(
        F.array_sort(F.collect_list(line)).alias("turns"), F.min(F.when(~shared, F.col("turn"))).alias("first"),
        *[F.count(side).alias(f"n_{side}") for side in ("chosen", "rejected")])
    before = F.filter("turns", lambda t: F.col("first").isNull() | (t["turn"] < F.col("first")))
    pairs = pairs.withColumn("shared", F.transform(before, lambda t: t["chosen"]))
    out = [F.col("pair_id"), F.size("shared").alias("prompt_turns"), _rendered(F.col("shared")).alias("prompt")]
    for side in ("chosen", "rejected"):
        rest, there = _rest(side), F.col(f"n_{side}") > 0
        out += [F.when(there, _rendered(rest)).alias(side), F.when(there, _mask(rest)).alias(f"{side}_mask")]
    return pairs.select(*out)


def _rest(side: str) -> Column:
    own = F.filter("turns", lambda t: (t["turn"] >= F.col("first")) & t[side].isNotNull())
    return F.transform(own, lambda t: t[side])


def sampled_pairs(conversations: DataFrame) -> DataFrame:
    """Pairs from plain conversations: chosen is the conversation up to its last answer, rejected the same with the
    next conversation's last answer, in the order of conversation ids, the last one's with the first one's. Turns after the
    last answer are left out, and conversations without an answer have no pair."""
    plain = conversations.select("conv_id", "turn", "role", "text")
    last = plain.where(F.col("role") == SPEAKER).groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    last = last.select("conv_id", F.col("last.turn").alias("last_turn"), F.col("last.text").alias("answer"))
    numbered = running(laid_out(last, ["conv_id"], "answers"), None, "nth").drop("_part", "_row")
    n = numbered.count()  # the last one takes the first one's answer
    following = numbered.select(F.pmod(F.col("nth") + (n - 1), F.lit(max(n, 1))).alias("nth"), F.col("answer").alias("other"))
    swap = numbered.join(following, "nth").select("conv_id", "last_turn", "other")
    turns = plain.join(swap, "conv_id").where(F.col("turn") <= F.col("last_turn"))
    sides = F.explode(F.array(F.lit("chosen"), F.lit("rejected"))).alias("side")
    text = F.when((F.col("side") == "rejected") & (F.col("turn") == F.col("last_turn")), F.col("other")).otherwise(F.col("text"))
    return turns.select(F.col("conv_id").alias("pair_id"), sides, "turn", "role", "text", "other", "last_turn").select(
        "pair_id", "side", "turn", "role", text.alias("text"))
