"""Joins of a large table with one row per key.

A table that was just grouped by the join key is already partitioned by it, so Spark puts no exchange between the
aggregate and the join, and AQE, which splits exchanges, cannot split a hot key of the other side. The joins here give
both sides an exchange of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def match(left: Sequence[Column], right: Sequence[Column], nulls_equal: bool = False) -> Column:
    """Equality of key expressions together with a hash of them. The types of the two sides must be the same.

    The hash adds nothing to the result, but a table that is partitioned by the keys alone does not satisfy a join on
    keys and hash: both sides get an exchange of their own for the join, and AQE can split a hot key.
    """
    equal = [a.eqNullSafe(b) if nulls_equal else a == b for a, b in zip(left, right)]
    return reduce(lambda x, y: x & y, [*equal, F.xxhash64(*left) == F.xxhash64(*right)])


def common_type(left: DataFrame, a: str, right: DataFrame, b: str) -> tuple[Column, Column]:
    """Both key columns in a type that holds every value of either: a cast never makes different keys equal."""
    one, two = left.schema[a].dataType, right.schema[b].dataType
    if one == two:
        return left[a], right[b]
    numbers = [isinstance(t, T.NumericType) for t in (one, two)]
    if all(numbers):
        if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in (one, two)):
            if all(isinstance(t, (T.FloatType, T.DoubleType)) for t in (one, two)):
                return left[a].cast("double"), right[b].cast("double")
            # As doubles large whole numbers meet, as decimals small fractions do: equal is what is equal as both.
            both = lambda c: F.when(c.isNotNull(), F.struct(c.cast("double").alias("d"), c.try_cast("decimal(38,10)").alias("n")))
            return both(left[a]), both(right[b])
        scale = max(t.scale if isinstance(t, T.DecimalType) else 0 for t in (one, two))
        return left[a].try_cast(f"decimal(38,{scale})"), right[b].try_cast(f"decimal(38,{scale})")
    dates = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(one, dates) and isinstance(two, dates):
        kind = "timestamp" if T.TimestampType in (type(one), type(two)) else "timestamp_ntz"
        return left[a].cast(kind), right[b].cast(kind)
    return left[a].cast("string"), right[b].cast("string")


def match_keys(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """``match`` for pairs of key columns; in the types of ``common_type``."""
    return match(*zip(*[common_type(left, a, right, b) for a, b in pairs]))


def join_per_key(df: DataFrame, per_key: DataFrame, key: str, per_key_name: str, how: str) -> DataFrame:
    """``df`` with the columns of ``per_key``, a table grouped from ``df`` by ``key``.

    No size is guessed or counted beforehand: AQE measures the grouped table, broadcasts it below the session's
    threshold, and splits a hot key otherwise.
    """
    return df.join(per_key, match_keys(df, per_key, [(key, per_key_name)]), how)
