"""Feedback on generated statements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions.text import drop_semicolon, strip
from silverlode.operators.mutate import merge
from silverlode.operators.skew import match

KEY_PREFIX = "select ai showsql "  # fixed value: how a question is written in the log
INDEX_ROWS = 50  # fixed value: entries shown of a feedback index


def feedback_key(question: Column) -> Column:
    return F.concat(F.lit(KEY_PREFIX), drop_semicolon(strip(question)))


def stored_type(kind: Column, keep_quirk: bool = True) -> Column:
    """The source stores positive feedback as NEGATIVE; ``keep_quirk=False`` stores what was said."""
    upper = F.upper(kind)
    return F.when(upper == "POSITIVE", "NEGATIVE").otherwise(upper) if keep_quirk else upper


def _usable() -> Column:
    question = drop_semicolon(strip(F.col("question")))
    response = strip(F.coalesce(F.col("response"), F.lit("")))
    return (F.coalesce(question, F.lit("")) != "") & (response != "")


def refused(feedback: DataFrame) -> DataFrame:
    """Feedback without a question or a response."""
    return feedback.filter(~_usable())


def prepared(feedback: DataFrame, keep_quirk: bool = True) -> DataFrame:
    """Usable feedback as entries, the latest (``given_at``) per text."""
    return (
        feedback.filter(_usable())
        .select(
            feedback_key(F.col("question")).alias("sql_text"),
            F.struct(
                F.col("given_at"),
                stored_type(F.col("kind"), keep_quirk).alias("feedback_type"),
                strip(F.col("response")).alias("response"),
                F.coalesce(F.col("comment"), F.lit("")).alias("content"),
            ).alias("entry"),
        )
        .groupBy("sql_text")
        .agg(F.max("entry").alias("entry"))
        .select("sql_text", "entry.feedback_type", "entry.response", "entry.content")
    )


def add_feedback(entries: DataFrame, feedback: DataFrame, keep_quirk: bool = True) -> DataFrame:
    """Upsert by text."""
    return merge(entries, prepared(feedback, keep_quirk), ["sql_text"])


def delete_feedback(entries: DataFrame, texts: DataFrame) -> DataFrame:
    """T09"""
    gone = texts.select(F.col("sql_text").alias("gone__")).distinct()
    return entries.join(gone, match([F.col("sql_text")], [F.col("gone__")]), "left_anti")


def index_view(index: DataFrame, rows: int | None = None) -> DataFrame:
    """Content and the two JSON attributes; all entries, or at most ``rows``."""
    view = index.select(
        "CONTENT",
        F.get_json_object("ATTRIBUTES", "$.sql_id").alias("SQL_ID"),
        F.get_json_object("ATTRIBUTES", "$.sql_text").alias("SQL_TEXT"),
        "ATTRIBUTES",
    )
    return view if rows is None else view.limit(rows)
