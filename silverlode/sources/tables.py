"""Catalog tables and files as DataFrames."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions.text import TABLE_NAME, strip

# Row caps of the source's result grids.
DEFAULT_RESULT_CAP = 100
MODEL_SQL_RESULT_CAP = 10000
RULE_TEST_RESULT_CAP = 1000
PREVIEW_ROWS = 10


def list_tables(spark: SparkSession, schema: str | None = None) -> DataFrame:
    """Tables and views of a schema."""
    rows = [(t.name, t.tableType, t.description or " ") for t in spark.catalog.listTables(schema)]
    return spark.createDataFrame(rows, "name string, table_type string, comments string")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table; fails with the name when it is not in the catalog."""
    if not spark.catalog.tableExists(name):
        raise ValueError(f"table not found: {name}")
    return spark.table(name)


def read_folder(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_database(spark: SparkSession, url: str, table: str, partition_column: str, lower_bound: object, upper_bound: object, partitions: int, **options: str) -> DataFrame:
    """S01 for a database: executors read ranges of a column in parallel; filters and columns are pushed into the database."""
    ranges = {"partitionColumn": partition_column, "lowerBound": str(lower_bound), "upperBound": str(upper_bound), "numPartitions": str(partitions)}
    return spark.read.format("jdbc").options(url=url, dbtable=table, **ranges, **options).load()


def register_table(spark: SparkSession, name: str, location: str, file_format: str = "parquet") -> DataFrame:
    """Drop-first registration of a table over a location, so that a rerun does not clash."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING {file_format} LOCATION '{location}'")
    return spark.table(name)


def create_if_missing(spark: SparkSession, name: str, schema: T.StructType) -> tuple[bool, int]:
    """(created now, rows present)."""
    if spark.catalog.tableExists(name):
        return False, spark.table(name).count()
    spark.createDataFrame([], schema).write.format("parquet").saveAsTable(name)
    return True, 0


def reload_table(df: DataFrame, name: str) -> int:
    """Create if missing, replace all rows, return the new row count."""
    df.write.format("parquet").mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name).count()


def append_by_position(df: DataFrame, name: str) -> None:
    """Positional append; the caller orders the columns first (``conform``)."""
    df.write.insertInto(name)


def browse(table: DataFrame, where: str | Column | None = None, limit: int | None = None) -> DataFrame:
    """Rows that match a free condition, all of them or at most ``limit``."""
    rows = table
    if isinstance(where, Column):
        rows = rows.filter(where)
    elif where and where.strip():
        rows = rows.filter(F.expr(where))
    return rows if limit is None else rows.limit(limit)


def model_rows(rows: DataFrame) -> DataFrame:
    """What is shown of the result of a statement that a model wrote."""
    return browse(rows, None, MODEL_SQL_RESULT_CAP)


def browse_table(spark: SparkSession, name: str, where: str | None = None, limit: int | None = None) -> DataFrame:
    """F05 on a catalog table; the name is checked before it is used."""
    if not re.match(TABLE_NAME, name.upper()):
        raise ValueError(f"invalid table or view name: {name}")
    return browse(spark.table(name), where, limit)


def keyword_search(names: DataFrame, column: str, keyword: str | None) -> DataFrame:
    """names that contain the keyword in any case; no keyword = all."""
    word = (keyword or "").strip().lower()
    return names if not word else names.filter(F.lower(column).contains(word))


def distinct_names(names: DataFrame, column: str) -> DataFrame:
    """Trimmed, non-empty, each once."""
    return names.select(strip(F.col(column)).alias(column)).filter(F.col(column) != "").dropDuplicates([column])


def sample_blocks(tables: dict[str, DataFrame], rows: int) -> DataFrame:
    """The first ``rows`` rows of each object as one CSV text block with a header.

    The number of rows per object is the size asked for by the caller, so a block is small by construction.
    """
    blocks = []
    for name, table in tables.items():
        line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in table.columns]))
        header = f"OBJECT: {name}\n" + ",".join(table.columns)
        blocks.append(
            table.limit(rows)
            .select(line.alias("line"))
            .groupBy()
            .agg(F.array_join(F.collect_list("line"), "\n").alias("lines"), F.count("*").alias("sample_rows"))
            .filter("sample_rows > 0")
            .select(
                F.lit(name).alias("object_name"),
                "sample_rows",
                F.concat(F.lit(header + "\n"), F.col("lines"), F.lit("\n")).alias("sample_text"),
            )
        )
    out = blocks[0]
    for block in blocks[1:]:
        out = out.unionByName(block)
    return out


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
