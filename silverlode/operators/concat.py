"""Ordered string aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def ordered_concat(
    df: DataFrame, keys: Sequence[str], position: str, value: str, separator: str = ", ", name: str = "joined", run: int | None = None
) -> DataFrame:
    """Values of a group joined in the order of an integer position (ties: by value); one shuffle on the keys.

    The result holds all values of its group, so one task must hold them in any case. With ``run``, stretches of that
    many positions are joined first, in other tasks, and a second shuffle brings their pieces together: for long, dense
    sequences, where sorting a group takes longer than moving it.
    """
    sep = _literal(separator)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(position).alias("position__"), F.col(value).alias("value__"))
    if run is not None:
        stretch = F.expr(f"position__ div {run}").alias("position__")
        joined = F.expr(f"listagg(value__, {sep}) WITHIN GROUP (ORDER BY at__, value__)").alias("value__")
        rows = rows.select(*keys, stretch, F.col("position__").alias("at__"), "value__").groupBy(*keys, "position__").agg(joined)
    return rows.groupBy(*keys).agg(F.expr(f"listagg(value__, {sep}) WITHIN GROUP (ORDER BY position__, value__)").alias(name))
