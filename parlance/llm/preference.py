"""Preference formatting of chosen and rejected conversations (operator 10).

The longest common turn prefix of the two is rendered once as the prompt; what
follows it in each is rendered as a completion with a mask, one character per
character of the completion: 1 where the loss counts (the text and the end mark
of assistant turns), 0 elsewhere (headers, other roles). DataFrame functions
only.

Rows: turns are ordered by (turn, role, text); a null role reads as
``unknown`` and a null text as empty, turns without a conv_id belong to no
conversation. Equal conversations, or one that is a prefix of the other, leave
an empty completion and usable = false. Repeated turns stay turns. Extra columns
are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.operators.positions import exact_rank, with_id_bucket

END = "<|end|>\n"


def _header(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def render(turns: Column) -> Column:
    """The turns (array of role, text) as one text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), t["text"], F.lit(END))), "")


def mask(turns: Column) -> Column:
    """The loss mask of ``render(turns)``."""
    counts = lambda t: F.when(t["role"] == "assistant", "1").otherwise("0")
    return F.array_join(
        F.transform(
            turns,
            lambda t: F.concat(F.repeat(F.lit("0"), F.length(_header(t))), F.repeat(counts(t), F.length(t["text"]) + F.lit(len(END)))),
        ),
        "",
    )


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): one row per conversation, its turns as an ordered array of (role, text)."""
    one = F.struct("turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("t"))
    return rows.select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs (pair_id, chosen, rejected: arrays of (role, text)) as prompt and masked completions."""
    differs = F.array_position(F.zip_with("chosen", "rejected", lambda x, y: x.eqNullSafe(y)), False)
    common = F.when(differs == 0, F.size("chosen")).otherwise(differs - 1).cast("int")
    rows = pairs.select("pair_id", "chosen", "rejected", common.alias("n_prompt"))
    rest = lambda c: F.slice(c, F.col("n_prompt") + 1, F.greatest(F.size(c) - F.col("n_prompt"), F.lit(0)))
    return rows.select(
        "pair_id",
        F.col("n_prompt").cast("long").alias("n_prompt_turns"),
        render(F.slice("chosen", F.lit(1), F.col("n_prompt"))).alias("prompt"),
        render(rest("chosen")).alias("chosen"),
        mask(rest("chosen")).alias("chosen_mask"),
        render(rest("rejected")).alias("rejected"),
        mask(rest("rejected")).alias("rejected_mask"),
        ((F.size("chosen") > F.col("n_prompt")) & (F.size("rejected") > F.col("n_prompt"))).alias("usable"),
    )


def crossed_endings(turns: DataFrame) -> DataFrame:
    """Pairs from plain conversations: each whole one against its beginning with a neighbour's ending.

    A conversation parts at the middle one of its assistant turns (the earlier
    of two). By the order of their ids, conversations with an assistant turn are
    neighbours two by two; an odd last one takes the ending of the one before.
    Chosen is the conversation, rejected its turns before the parting, followed
    by the neighbour's from its own parting on. Every conversation with an
    assistant turn gives one pair (a single one has no neighbour and gives
    none). Ranks come from bucket counts, not from a window over all ids.
    """
    convs = conversations(turns)
    spoken = F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i + 1)), lambda i: i.isNotNull())
    parted = convs.withColumn("at", F.get(spoken, F.ceil(F.size(spoken) / 2).cast("int") - 1)).where("at is not null")
    ids = turns.where("conv_id is not null and role = 'assistant'").select("conv_id").distinct()
    ranks = exact_rank(with_id_bucket(ids, "_ids", "conv_id"), [], ["conv_id"], F.col("_ids")).select("conv_id", "rank")
    total = ranks.agg(F.count("*").alias("n"))
    last = (F.col("rank") == F.col("n")) | (F.col("rank") % 2 == 0)
    other = ranks.crossJoin(F.broadcast(total)).select("conv_id", (F.col("rank") + F.when(last, -1).otherwise(1)).alias("rank"))  # total: one row
    mate = other.join(ranks.withColumnRenamed("conv_id", "mate"), "rank").select("conv_id", "mate")
    upto = F.slice("turns", F.lit(1), F.col("at") - 1)
    endings = parted.select(F.col("conv_id").alias("mate"), F.slice("turns", F.col("at"), F.size("turns")).alias("ending"))
    rows = parted.join(mate, "conv_id").join(endings, "mate")
    return rows.select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"), F.concat(upto, "ending").alias("rejected"))
