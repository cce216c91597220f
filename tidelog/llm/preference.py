"""Preference pairs for chat training, with DataFrame functions alone.

A pair has a chosen and a rejected conversation. What both begin with, turn by turn, is rendered once as the
prompt; what follows on each side is that side's completion. Completions are masked: a trainer learns the
characters from `train_from` up to `train_to` of a rendered turn, which are the text of assistant turns of
completions; all else is context.

Turns stay rows of their own, so no conversation, however long, is gathered in one task. A turn is part of
the prompt if every turn up to it has the same roles and texts on both sides: the first turn at which the
sides differ is the least turn that only one side has, a minimum that is combined before the shuffle.

Defined results: rows repeated within a side count once; different rows of one turn number stand together at
that turn, in the order of role and text; a null turn number comes last, a null role is "unknown", a null
text is empty (and null and empty texts are the same text); rows without a pair_id are left out, for they
belong to no pair. Equal sides give a prompt and no completion; a pair of one side only has no prompt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LAST = 2**63 - 1
TRAINED_ROLE = "assistant"


def _side(turns: DataFrame, chosen: int) -> DataFrame:
    return turns.filter("pair_id IS NOT NULL").select(
        F.col("pair_id").cast("long").alias("pair_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(LAST)).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.lit(chosen).alias("chosen"),
        F.lit(1 - chosen).alias("rejected"),
    )


def preference_rows(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """pair_id, part (prompt, chosen, rejected), turn, role, rendered, train_from, train_to of every turn.

    Both inputs have (pair_id, turn, role, text); other columns are not looked at.
    """
    turns = (
        _side(chosen, 1)
        .union(_side(rejected, 0))
        .groupBy("pair_id", "turn", "role", "text")
        .agg(F.max("chosen").alias("chosen"), F.max("rejected").alias("rejected"))
    )
    apart = turns.filter("chosen <> rejected").groupBy("pair_id").agg(F.min("turn").alias("apart"))
    shared = F.col("apart").isNull() | (F.col("turn") < F.col("apart"))
    parts = F.when(shared, F.array(F.lit("prompt"))).otherwise(
        F.array_compact(F.array(F.when(F.col("chosen") == 1, "chosen"), F.when(F.col("rejected") == 1, "rejected")))
    )
    header = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"))
    trained = (F.col("part") != "prompt") & (F.col("role") == TRAINED_ROLE)
    return (
        turns.join(apart, "pair_id", "left")
        .select("pair_id", F.explode(parts).alias("part"), "turn", "role", "text")
        .select(
            "pair_id", "part", "turn", "role",
            F.concat(header, "text", F.lit("\n")).alias("rendered"),
            F.when(trained, F.length(header)).otherwise(0).cast("long").alias("train_from"),
            F.when(trained, F.length(header) + F.length("text")).otherwise(0).cast("long").alias("train_to"),
        )
    )


def joined(rows: DataFrame) -> DataFrame:
    """pair_id, prompt, chosen, rejected as whole strings; for conversations that fit a training context."""

    def whole(part: str):  # noqa: ANN202
        own = F.collect_list(F.when(F.col("part") == part, F.struct("turn", "role", "rendered")))
        return F.array_join(F.transform(F.sort_array(own), lambda t: t["rendered"]), "").alias(part)

    return rows.groupBy("pair_id").agg(whole("prompt"), whole("chosen"), whole("rejected"))


def swapped_endings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns from recorded conversations (conv_id, turn, role, text).

    Every conversation is chosen; the rejected side has the same turns but ends with the last turn of the
    conversation of the next id, or without a last turn where there is none.
    """
    kept = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("pair_id"), "turn", "role", "text")
    last = kept.groupBy("pair_id").agg(F.max(F.struct("turn", "role", "text")).alias("last"))
    ends = last.select("pair_id", F.col("last.turn").alias("end"))
    before = kept.join(ends, "pair_id").filter("turn < end").select("pair_id", "turn", "role", "text")
    other = last.select((F.col("pair_id") - 1).alias("pair_id"), "last.role", "last.text")
    ending = ends.join(other, "pair_id").select("pair_id", F.col("end").alias("turn"), "role", "text")
    return kept, before.union(ending)
