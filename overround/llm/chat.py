"""Preference formatting: two conversations that begin alike become one prompt and two completions.

Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN = "struct<role:string,text:string>"


def gather_turns(turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation as one array, ordered by turn, then role, then text.

    Rows without a conversation id belong to no conversation and are left out; a null turn number comes
    first, a null role is ``user``, a null text is empty; equal rows are repeated turns and stay. One array
    is one conversation, which later is one row of the result anyway.
    """
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("conv_id"), F.struct(
            F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("user")).alias("role"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("row"))
    return rows.groupBy("conv_id").agg(F.transform(
        F.sort_array(F.collect_list("row")), lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("turns"))


def common_prefix(a: Column, b: Column) -> Column:
    """How many leading turns two arrays of turns share."""
    n = F.least(F.size(a), F.size(b))
    differ = F.filter(F.sequence(F.lit(0), n), lambda i: (i >= n) | ~F.get(a, i).eqNullSafe(F.get(b, i)))
    return F.array_min(differ)


def _render(turns: Column, start: str, end: str) -> Column:
    return F.transform(turns, lambda t: F.concat(F.lit(start.split("{role}")[0]), t["role"],
                                                 F.lit(start.split("{role}")[1]), t["text"], F.lit(end)))


def _spans(turns: Column, rendered: Column, start: str, end: str) -> Column:
    """[from, to) in characters of what the trained role says, closing mark included."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,stop:long>>").alias("spans"))
    fixed = len(start) - len("{role}")

    def step(acc: Column, i: Column) -> Column:
        turn, stop = F.get(turns, i), acc["at"] + F.length(F.get(rendered, i)).cast("long")
        span = F.struct((acc["at"] + fixed + F.length(turn["role"])).cast("long").alias("start"), stop.alias("stop"))
        return F.struct(stop.alias("at"), F.when(turn["role"] == "assistant", F.array_append(acc["spans"], span))
                        .otherwise(acc["spans"]).alias("spans"))

    positions = F.filter(F.sequence(F.lit(-1), F.size(turns) - 1), lambda i: i >= 0)
    return F.aggregate(positions, zero, step, lambda acc: acc["spans"])


def format_preferences(pairs: DataFrame, *, id_col: str = "pair_id", chosen_col: str = "chosen",
                       rejected_col: str = "rejected", start: str = "<|{role}|>\n", end: str = "<|end|>\n") -> DataFrame:
    """One row per pair: prompt, the two completions, and where each trains.

    ``chosen`` and ``rejected`` are arrays of (role, text). The turns that both begin with are rendered once
    as ``prompt``; what follows of each is its completion. The masks list the character spans that
    ``assistant`` speaks; all else (headers, other roles) isn't trained. A null array counts as empty; two
    equal conversations give two empty completions and empty masks, ``informative`` is then false; so it is
    when neither completion has a trained span. Rows are kept as they are, repeated ids and null ids too.
    Columns beyond the named ones are ignored. It is a projection: no shuffle, no join.
    """
    empty = F.array().cast(f"array<{TURN}>")
    base = pairs.select(F.col(id_col).alias("pair_id"), *(
        F.coalesce(F.col(c).cast(f"array<{TURN}>"), empty).alias(n)
        for c, n in ((chosen_col, "chosen"), (rejected_col, "rejected"))))
    cut = base.withColumn("n", common_prefix(F.col("chosen"), F.col("rejected")))
    parts = cut.select(
        "pair_id", F.col("n").alias("prompt_turns"), F.slice("chosen", F.lit(1), F.col("n")).alias("p"),
        *(F.slice(c, F.col("n") + 1, F.size(c)).alias(c) for c in ("chosen", "rejected")))
    rendered = parts.select("*", *(_render(F.col(c), start, end).alias(f"{c}_out") for c in ("p", "chosen", "rejected")))
    out = rendered.select(
        "pair_id", "prompt_turns", F.concat_ws("", "p_out").alias("prompt"),
        *(F.concat_ws("", f"{c}_out").alias(f"{c}_completion") for c in ("chosen", "rejected")),
        *(_spans(F.col(c), F.col(f"{c}_out"), start, end).alias(f"{c}_mask") for c in ("chosen", "rejected")))
    return out.withColumn("informative", (F.size("chosen_mask") > 0) & (F.size("rejected_mask") > 0))


def contrast_last_reply(conversations: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected) from (conv_id, turns): a conversation against one with a worse last reply.

    ``chosen`` ends with the last assistant turn. ``rejected`` says there what the assistant said one reply
    earlier (a stale answer), or, where that is missing or the same, the first half of the reply's characters
    (a broken-off answer). Conversations without an assistant turn give no pair.
    """
    def reply(t: Column) -> Column:
        return t["role"] == "assistant"

    replies = F.filter("turns", reply)
    last = F.array_max(F.filter(F.sequence(F.lit(0), F.size("turns") - 1),
                                lambda i: F.get(F.col("turns"), i)["role"] == "assistant"))
    rows = conversations.select("conv_id", "turns", F.transform(replies, lambda t: t["text"]).alias("said"), last.alias("last"))
    rows = rows.where("last is not null")
    now, before = F.element_at("said", -1), F.try_element_at("said", F.lit(-2))
    worse = F.when(before.isNotNull() & (before != now), before).otherwise(
        now.substr(F.lit(1), F.floor(F.length(now) / 2).cast("int")))
    return rows.select(
        F.col("conv_id").alias("pair_id"), F.slice("turns", F.lit(1), F.col("last") + 1).alias("chosen"),
        F.concat(F.slice("turns", F.lit(1), F.col("last")), F.array(
            F.struct(F.lit("assistant").alias("role"), worse.alias("text")))).alias("rejected"))
