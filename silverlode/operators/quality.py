"""Row quality (F01): one predicate, kept rows and the reasons of the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def invalid(column: str) -> Column:
    """Missing or negative; never NULL itself."""
    return F.col(column).isNull() | (F.col(column) < 0)


def quality_filter(df: DataFrame, column: str) -> DataFrame:
    """Rows with a value of at least 0; written so that both tests reach the Parquet scan."""
    return df.filter(F.col(column).isNotNull() & (F.col(column) >= 0))


def quality_rejects(df: DataFrame, column: str) -> DataFrame:
    """The other rows with their reason."""
    reason = F.when(F.col(column).isNull(), "missing").otherwise("negative")
    return df.filter(invalid(column)).withColumn("reject_reason", reason)
