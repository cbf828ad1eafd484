"""Synthetic rows (T14): seeded, parallel, with references that hold.

Every value is a function of (table, column, row number, seed): any partitioning gives the same rows, and a lost task
recomputes the same values. Keys are dense, so a reference to a parent is arithmetic and needs no join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.sources.tables import union_all

Draw = Callable[[Column, Column], Column]  # (row number, seeded number below 2**32) → value


def serial(start: int = 1) -> Draw:
    return lambda row, _: row + start


def pick(values: Sequence) -> Draw:
    pool = list(values)
    return lambda _, number: F.element_at(F.array(*[F.lit(v) for v in pool]), (number % len(pool) + 1).cast("int"))


def whole(low: int, high: int) -> Draw:
    return lambda _, number: number % (high - low + 1) + low


def amount(low: int, high: int, scale: int = 2) -> Draw:
    """A decimal with ``scale`` places between two whole numbers."""
    steps = (high - low) * 10**scale + 1
    return lambda _, number: (((number % steps) + low * 10**scale) / F.lit(10**scale)).cast(f"decimal(18,{scale})")


def day(first: str, days: int) -> Draw:
    return lambda _, number: F.date_add(F.lit(first).cast("date"), (number % days).cast("int"))


def label(prefix: str) -> Draw:
    return lambda row, _: F.concat(F.lit(prefix), row.cast("string"))


@dataclass(frozen=True)
class Reference:
    """A column that holds a key of another synthetic table with dense keys from ``start``."""

    table: str
    start: int = 1


@dataclass(frozen=True)
class Table:
    name: str
    rows: int
    columns: dict[str, Draw | Reference]


def pools(df: DataFrame, columns: Sequence[str], values: int) -> dict[str, list]:
    """Per column up to ``values`` different values of an existing table, those with the smallest hash: repeatable, small,
    and as varied as the table."""
    out = {}
    for c in columns:
        known = df.select(c).where(F.col(c).isNotNull()).distinct().orderBy(F.xxhash64(c), F.col(c)).limit(values)
        out[c] = sorted((r[0] for r in known.collect()), key=repr)
    return out


def seeded_number(table: str, column: str, row: Column, seed: int) -> Column:
    digest = F.md5(F.concat(F.lit(f"{table}:{column}:"), row.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def generate(spark: SparkSession, tables: Sequence[Table], seed: int = 0) -> dict[str, DataFrame]:
    """The tables by name. Parents must be listed before the tables that refer to them."""
    sizes: dict[str, int] = {}
    out: dict[str, DataFrame] = {}
    for table in tables:
        row = F.col("id")
        values = []
        for name, draw in table.columns.items():
            number = seeded_number(table.name, name, row, seed)
            if isinstance(draw, Reference):
                if draw.table not in sizes:
                    raise ValueError(f"{table.name}.{name}: list {draw.table} first")
                value = number % sizes[draw.table] + draw.start
            else:
                value = draw(row, number)
            values.append(value.alias(name))
        out[table.name] = spark.range(table.rows).select(*values)
        sizes[table.name] = table.rows
    return out


def load_status(tables: dict[str, DataFrame], wanted: dict[str, int]) -> DataFrame:
    """ID, NAME, ROWS_LOADED, STATUS per table."""
    rows = [
        df.agg(F.count("*").alias("ROWS_LOADED")).select(
            F.lit(i).alias("ID"),
            F.lit(name).alias("NAME"),
            "ROWS_LOADED",
            F.when(F.col("ROWS_LOADED") == wanted[name], "COMPLETED").otherwise("FAILED").alias("STATUS"),
        )
        for i, (name, df) in enumerate(tables.items(), 1)
    ]
    return union_all(rows)
