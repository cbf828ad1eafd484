"""Model calls over rows (T01, T02, T10, T13, P04): the model is passed in by the caller."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions.text import failed_generation, parse_answer
from silverlode.operators.skew import match_keys
from silverlode.session import ensure_checkpoints

Expression = Callable[[Column], Column]
BatchModel = Callable[[Iterator[pd.Series]], Iterator[pd.Series]]

ATTEMPTS = 3  # fixed value: tries per question

# The instruction that follows the review.
REVIEW_INSTRUCTION = (
    ". Analyze the sentiment and briefly explain the reason. "
    'Return your response ONLY as a JSON object with keys "label" (Positive/Negative/Neutral) and "reason".'
)


def review_prompt(review: Column) -> Column:
    """A NULL review gives a NULL prompt."""
    return F.concat(F.lit("Review: "), review, F.lit(REVIEW_INSTRUCTION))


def score(df: DataFrame, prompt: Column, scorer: Expression, column: str) -> DataFrame:
    """T01 with a scorer that is a Spark expression: a projection, no shuffle."""
    return df.withColumn(column, scorer(prompt))


def _as_udf(model: BatchModel):
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from model(batches)

    return F.pandas_udf(ask, "string").asNondeterministic()  # no filter moves below the call and repeats it


def score_with_model(df: DataFrame, prompt: Column, model: BatchModel, column: str, calls: int | None = None) -> DataFrame:
    """T01 with an external model: one call per distinct prompt.

    ``model`` gets an iterator of Arrow batches per task, so it opens its client once per task. The prompts are made
    distinct before the call (partial distinct first, so a prompt shared by a third of the rows costs one row per
    task), spread over ``calls`` tasks, and joined back; a hot prompt is a skewed left side, which AQE splits or
    broadcasts around. A NULL prompt is not sent and has a NULL answer. Spark may repeat a lost task, so a model may
    see a prompt twice. The answers are a checkpoint: however many consumers the result has, no prompt is sent again.
    """
    ensure_checkpoints(df.sparkSession)
    ask = _as_udf(model)
    named = df.withColumn("prompt__", prompt)
    prompts = named.select("prompt__").filter(F.col("prompt__").isNotNull()).distinct()
    if calls is not None:
        prompts = prompts.repartition(calls, "prompt__")
    answers = prompts.select(F.col("prompt__").alias("asked__"), ask("prompt__").alias(column)).checkpoint()
    return named.join(answers, match_keys(named, answers, [("prompt__", "asked__")]), "left").drop("prompt__", "asked__")


def sentiment(df: DataFrame, prompt: Column, scorer: Expression) -> DataFrame:
    """Prompt → answer → struct → two columns; an unreadable answer gives NULLs."""
    scored = score(df, prompt, scorer, "answer__")
    return scored.withColumn("parsed__", parse_answer(F.col("answer__"))).select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col("parsed__.label").alias("SENTIMENT_LABEL"),
        F.col("parsed__.reason").alias("SENTIMENT_REASON"),
    )


def retry(df: DataFrame, attempt: Callable[[Column, int], Column], prompt: str, attempts: int = ATTEMPTS) -> DataFrame:
    """T13 in batch form: up to ``attempts`` tries per row; the first answer that is not a failure is kept.

    ``attempt`` gives the answer of a try. Later tries are evaluated only for rows whose earlier ones failed (``coalesce`` stops
    at the first value), in the same projection: no shuffle and no loop over jobs.
    """
    tries = []
    for n in range(1, attempts + 1):
        answer = attempt(F.col(prompt), n)
        good = answer.isNotNull() & (answer != "") & ~failed_generation(answer)
        tries.append(F.when(good, F.struct(F.lit(n).alias("attempts"), answer.alias("answer"))))
    last = F.struct(F.lit(attempts).alias("attempts"), F.lit(None).cast("string").alias("answer"))
    return df.withColumn("try__", F.coalesce(*tries, last)).select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col("try__.attempts").alias("attempts"),
        F.col("try__.answer").alias("answer"),
        F.col("try__.answer").isNotNull().alias("succeeded"),
    )


def retry_with_model(df: DataFrame, prompt: Column, model: BatchModel, attempts: int = ATTEMPTS) -> DataFrame:
    """T13 with an external model: each round scores only the prompts that still fail; every attempt is a row.

    Rounds are cut with ``checkpoint()`` so that a later round does not repeat the calls of an earlier one. Columns:
    prompt, attempt, answer, succeeded.
    """
    ensure_checkpoints(df.sparkSession)
    ask = _as_udf(model)
    open_prompts = df.select(prompt.alias("prompt")).filter(F.col("prompt").isNotNull()).distinct()
    rounds = None
    for n in range(1, attempts + 1):
        answered = open_prompts.select("prompt", F.lit(n).alias("attempt"), ask("prompt").alias("answer"))
        good = F.coalesce((F.col("answer") != "") & ~failed_generation(F.col("answer")), F.lit(False))
        answered = answered.withColumn("succeeded", good).checkpoint()
        rounds = answered if rounds is None else rounds.unionByName(answered)
        open_prompts = answered.filter(~F.col("succeeded")).select("prompt")
    return rounds
