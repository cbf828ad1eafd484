"""Costly columns that must be computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` that later projections and filters cannot be merged into.

    Catalyst pushes a filter on a computed column below the projection and repeats the expression at every use. The
    columns are therefore the output of a generator (one row in, one row out): a narrow, code-generated step.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))
