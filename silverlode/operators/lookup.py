"""Lookups with a fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions.text import not_blank, strip, text_key
from silverlode.operators.skew import match, match_keys
from silverlode.operators.staging import compute_once


def _first_by(df: DataFrame, key: Column, value: str, key_name: str, value_name: str) -> DataFrame:
    """One row per key: the value whose name sorts first in any case (the order of the snapshot)."""
    order = F.struct(F.upper(value), F.col(value))
    return (
        df.select(key.alias(key_name), F.col(value))
        .filter(F.coalesce(F.col(key_name), F.lit("")) != "")
        .groupBy(key_name)
        .agg(F.min_by(value, order).alias(value_name))
    )


def resolve_name(df: DataFrame, column: str, profiles: DataFrame, category_first: bool = False) -> DataFrame:
    """The profile of a display text: by exact name, else by category, else the text itself.

    Both lookups have one row per key, so neither join multiplies rows. Adds ``resolved`` and ``resolved_by``.
    """
    text = strip(F.col(column))
    by_name = _first_by(profiles, strip(F.col("profile")), "profile", "name__", "via_name")
    by_category = _first_by(profiles, strip(F.col("category")), "profile", "category__", "via_category")
    joined = df.join(by_name, match([text], [F.col("name__")]), "left").join(by_category, match([text], [F.col("category__")]), "left")
    name = F.when(F.col("via_name").isNotNull(), F.struct(strip(F.col("via_name")).alias("v"), F.lit("name").alias("how")))
    category = F.when(F.col("via_category").isNotNull(), F.struct(strip(F.col("via_category")).alias("v"), F.lit("category").alias("how")))
    order = [category, name] if category_first else [name, category]
    found = F.coalesce(*order, F.struct(text.alias("v"), F.lit("text").alias("how")))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], found["v"].alias("resolved"), found["how"].alias("resolved_by"))


def route(df: DataFrame, predicted: str, profiles: DataFrame, default: str) -> DataFrame:
    """The first profile whose category equals the predicted label in lower case, else the default."""
    by_category = _first_by(profiles, F.lower(strip(F.col("category"))), "profile", "category__", "routed__")
    joined = df.join(by_category, match([F.lower(strip(F.col(predicted)))], [F.col("category__")]), "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(F.col("routed__"), F.lit(default)).alias("route"))


def latest_log_entry(queries: DataFrame, column: str, log: DataFrame) -> DataFrame:
    """Id of the newest log entry with the same text, white space aside; else by the whole full text.

    ``log``: sql_id, sql_text, sql_fulltext, translated_at, use_count. The log is reduced to its best entry per text
    before the join (newest first, unknown times last, then most used), with partial results per task, so a statement
    that fills a third of the log is one row in the join.
    """
    best = F.max_by("sql_id", F.struct("translated_at", "use_count", "sql_id"))

    def best_by(text: Column, key: str, name: str) -> DataFrame:
        return compute_once(log, {key: text_key(text)}).groupBy(key).agg(best.alias(name))

    by_text = best_by(F.col("sql_text"), "k1", "id1")
    by_full = best_by(F.col("sql_fulltext"), "k2", "id2")
    key = text_key(not_blank(strip(F.col(column))))
    joined = compute_once(queries, {"key__": key})
    for best_entries, name in ((by_text, "k1"), (by_full, "k2")):
        joined = joined.join(best_entries, match_keys(joined, best_entries, [("key__", name)]), "left")
    return joined.select(*[F.col(f"`{c}`") for c in queries.columns], F.coalesce("id1", "id2").alias("sql_id"))
