"""Conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.operators.concat import ordered_concat

LATEST_PROMPTS = 50  # fixed value


def join_deltas(deltas: DataFrame, keys: list[str], position: str, text: str) -> DataFrame:
    """The pieces of a message in order; a message without text is empty."""
    joined = ordered_concat(deltas, keys, position, text, "", "message")
    everyone = deltas.select(*keys).distinct()
    return everyone.join(joined, keys, "left").withColumn("message", F.coalesce("message", F.lit("")))


def replace_last(history: DataFrame, answers: DataFrame) -> DataFrame:
    """The message that is being written (one per conversation in ``answers``: conv_id, turn, text) replaced."""
    named = answers.select(F.col("conv_id").alias("c__"), F.col("turn").alias("t__"), F.col("text").alias("x__"))
    joined = history.join(named, (F.col("conv_id") == F.col("c__")) & (F.col("turn") == F.col("t__")), "left")
    return joined.select("conv_id", "turn", "role", F.coalesce("x__", "text").alias("text"))


def histories(messages: DataFrame) -> DataFrame:
    """Per conversation its messages in order as a JSON list of role and content."""
    item = messages.withColumn("item__", F.to_json(F.struct("role", F.col("text").alias("content"))))
    joined = ordered_concat(item, ["conv_id"], "turn", "item__", ",", "items__")
    return joined.select("conv_id", F.concat(F.lit("["), F.col("items__"), F.lit("]")).alias("history"))


def latest_prompts(prompts: DataFrame, key: str, team: str | None = None, rows: int = LATEST_PROMPTS) -> DataFrame:
    """Newest first; a top-k heap per task."""
    chosen = prompts if not team else prompts.filter(F.col("team_name") == team)
    return chosen.orderBy(F.col(key).desc_nulls_first()).limit(rows)
