"""Enrichment and conforming to a target table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.operators.skew import join_per_key

EXACT = T.DecimalType(38, 10)

# The sample reviews that are assigned to rows.
SAMPLE_REVIEWS = [
    "The flight was on time and comfortable.",
    "Long delay and unfriendly staff.",
    "Quick boarding and smooth flight.",
    "Lost my luggage, not happy.",
    "Great service and tasty snacks.",
]


def exact_average(column: str | Column, scale: int = 4) -> Column:
    """Average of a number that does not depend on the order of the rows.

    The sum is an exact decimal with ten decimal places, as in the target table; only the final division is floating
    point, so partial sums may be merged in any order.
    """
    value = F.col(column) if isinstance(column, str) else column
    total = F.sum(value.cast("decimal(28,10)")).cast("double")
    return F.round(total / F.count(value), scale)


def group_averages(df: DataFrame, key: str, measures: dict[str, str], scale: int = 4) -> DataFrame:
    """Averages per group; ``measures`` maps output name → column. Partial sums are made before the shuffle."""
    return df.groupBy(key).agg(*[exact_average(c, scale).alias(name) for name, c in measures.items()])


def with_group_averages(df: DataFrame, key: str, measures: dict[str, str], scale: int = 4) -> DataFrame:
    """Every detail row with the averages of its group; a NULL group has none.

    A join and not a window: a window would sort a hot group in one task.
    """
    averages = group_averages(df, key, measures, scale).withColumnRenamed(key, "group__")
    joined = join_per_key(df, averages, key, "group__", "left")
    return joined.select(F.col(f"`{key}`"), *[F.col(f"`{c}`") for c in df.columns if c != key], *measures)


def upper_columns(df: DataFrame) -> DataFrame:
    """P01"""
    return df.toDF(*[c.upper() for c in df.columns])


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """The target's columns, types and order; a value that does not fit becomes NULL, not an error."""
    return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in target.fields])


def seeded_pick(choices: Sequence[str], key: Column, seed: int = 0) -> Column:
    """One of the choices per row, decided by the row's key and a seed: a rerun or another partitioning gives the
    same rows. Built on MD5 so that any engine can reproduce it."""
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.element_at(F.array(*[F.lit(c) for c in choices]), (number % len(choices) + 1).cast("int"))


def assign_review(df: DataFrame, key: str, seed: int = 0, column: str = "REVIEW") -> DataFrame:
    return df.withColumn(column, seeded_pick(SAMPLE_REVIEWS, F.col(key), seed))


def stacked_measure(df: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Average and row count of a measure per combination of keys."""
    return df.groupBy(*keys).agg(exact_average(measure).alias(f"avg_{measure}"), F.count("*").alias("row_count"))


def group_detail(df: DataFrame, key: str, value: str, columns: list[str]) -> DataFrame:
    """Chosen columns of one group."""
    return df.filter(F.col(key) == value).select(*columns)
