"""Preference pairs for chat models: the longest common turn prefix of the chosen and the
rejected conversation is rendered once, as the prompt; what follows on either side is a
completion, in which only assistant turns are trained on. Spark SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import running_total
from ..session import materialise

START, END = "<|turn|>", "<|end|>"


def rendered(role: Column, text: Column) -> Column:
    """One turn as text."""
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END), F.lit("\n"))


def format_preferences(pairs: DataFrame, *, pair_id: str = "pair_id") -> DataFrame:
    """One row per rendered turn of every pair.

    ``pairs`` has a pair id, ``side`` (chosen or rejected), ``turn``, ``role`` and ``text``.
    The result has the pair id, ``section`` (prompt, chosen, rejected), ``turn``, ``rendered``
    (the turn as text), ``prompt_turns`` (how many turns the prompt has) and ``train`` (the
    mask: whether the loss counts; true for assistant turns of the completions). Joining
    ``rendered`` in order of ``turn`` gives the three texts; the prompt is there once.

    The prefix ends before the first turn at which role or text differ or one side has none;
    if the sides are equal, all is prompt. Turns go by their number, whatever it starts with
    and even with gaps. A null role counts as user, a null text as empty; rows without a pair
    id or a turn are left out; of several rows with one turn number the least (role, text)
    stands. A pair with one side only has an empty prompt. An empty table gives no rows.

    Turns are compared by a join on pair and turn and never gathered, so a conversation of any
    length, or one that holds a third of all turns, is spread like any other rows.
    """
    turns = (
        pairs.filter(F.col(pair_id).isNotNull() & F.col("turn").isNotNull())
        .select(
            F.col(pair_id).alias("pair_id"),
            F.col("turn").alias("turn"),
            F.col("side").alias("side"),
            F.struct(
                F.coalesce("role", F.lit("user")).alias("role"),
                F.coalesce("text", F.lit("")).alias("text"),
            ).alias("said"),
        )
        .filter(F.col("side").isin("chosen", "rejected"))
        .groupBy("pair_id", "turn")
        .agg(
            F.min(F.when(F.col("side") == "chosen", F.col("said"))).alias("chosen"),
            F.min(F.when(F.col("side") == "rejected", F.col("said"))).alias("rejected"),
        )
    )
    differ = ~F.col("chosen").eqNullSafe(F.col("rejected"))
    forks = turns.groupBy("pair_id").agg(F.min(F.when(differ, F.col("turn"))).alias("fork"))
    placed = turns.join(forks, "pair_id").withColumn(
        "prompt", F.col("fork").isNull() | (F.col("turn") < F.col("fork"))
    )
    lengths = placed.groupBy("pair_id").agg(
        F.sum(F.col("prompt").cast("long")).alias("prompt_turns")
    )
    sections = F.when(
        F.col("prompt"), F.array(F.struct(F.lit("prompt").alias("section"), F.col("chosen").alias("said")))
    ).otherwise(
        F.array(
            F.struct(F.lit("chosen").alias("section"), F.col("chosen").alias("said")),
            F.struct(F.lit("rejected").alias("section"), F.col("rejected").alias("said")),
        )
    )
    return (
        placed.join(lengths, "pair_id")
        .select("pair_id", "turn", "prompt_turns", F.explode(sections).alias("s"))
        .filter("s.said is not null")
        .select(
            F.col("pair_id").alias(pair_id),
            "s.section",
            "turn",
            rendered(F.col("s.said.role"), F.col("s.said.text")).alias("rendered"),
            "prompt_turns",
            ((F.col("s.section") != "prompt") & (F.col("s.said.role") == "assistant")).alias("train"),
        )
    )


def swapped_answers(conversations: DataFrame) -> DataFrame:
    """Preference pairs from plain conversations: the conversation is chosen; rejected is the
    same one with its last assistant turn replaced by that of the next conversation, in order
    of ids, that has one; the last takes the first one's. So each conversation with an assistant
    turn forms a pair, unless it is the only one; those without form none. Of several rows with
    one turn the least (role, text) stands. Rows without an id or a turn are left out.
    """
    turns = (
        conversations.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
        .groupBy(F.col("conv_id").alias("conv_id"), F.col("turn").alias("turn"))
        .agg(
            F.min(
                F.struct(
                    F.coalesce("role", F.lit("user")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"),
                )
            ).alias("said")
        )
        .select("conv_id", "turn", "said.role", "said.text")
    )
    answers = (
        turns.filter("role = 'assistant'")
        .groupBy("conv_id")
        .agg(F.max(F.struct("turn", "text")).alias("answer"))
        .select("conv_id", F.col("answer.turn").alias("last"), F.col("answer.text").alias("other"))
    )
    answers = materialise(answers, "answers")
    ranked = running_total(answers.select("conv_id", F.lit(1).alias("one")), "conv_id", "one")
    ranked = materialise(ranked.select("conv_id", "upto"), "ranks")
    number = ranked.count()
    before = F.when(F.col("upto") > 1, F.col("upto") - 1).otherwise(F.lit(number))
    swap = answers.join(ranked, "conv_id").select(before.alias("upto"), "other")
    both = (
        answers.select("conv_id", "last")
        .join(ranked, "conv_id")
        .filter(F.lit(number > 1))
        .join(swap, "upto")
        .select("conv_id", "last", "other")
    )
    joined = turns.join(both, "conv_id")
    at_last = F.col("turn") == F.col("last")
    sides = F.array(
        F.struct(F.lit("chosen").alias("side"), F.col("text").alias("text")),
        F.struct(
            F.lit("rejected").alias("side"),
            F.when(at_last, F.col("other")).otherwise(F.col("text")).alias("text"),
        ),
    )
    return joined.filter("turn <= last").select(
        F.col("conv_id").alias("pair_id"), "turn", "role", F.explode(sides).alias("s")
    ).select("pair_id", "turn", "role", "s.side", "s.text")
