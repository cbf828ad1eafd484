"""Execution history as JSON lines."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions.elapsed import elapsed_seconds
from silverlode.functions.text import not_blank

# The public columns of the history, in order.
REPORT_COLUMNS = [
    "画面名",
    "実行ID",
    "作成日時",
    "自然言語の質問",
    "実行に使用した質問",
    "カテゴリ予測",
    "Profile",
    "生成されたSQL",
    "ステータス",
    "試行回数",
    "実行開始時間",
    "Select AI開始時間",
    "Select AI終了時間",
    "Select AI経過時間（秒）",
    "SQL実行開始時間",
    "SQL実行終了時間",
    "SQL実行経過時間（秒）",
    "全体経過時間（秒）",
    "結果件数",
    "エラー内容",
]
ELAPSED_COLUMNS = ["Select AI経過時間（秒）", "SQL実行経過時間（秒）", "全体経過時間（秒）"]

# Earlier names of columns, tried in order when the current one is empty.
FORMER_NAMES = {
    "Select AI経過時間（秒）": ["Select AI経過時間"],
    "SQL実行開始時間": ["SELECT開始時間"],
    "SQL実行終了時間": ["SELECT終了時間"],
    "SQL実行経過時間（秒）": ["SELECT経過時間（秒）", "SELECT経過時間"],
    "全体経過時間（秒）": ["全体経過時間"],
}


def _stored_names() -> list[str]:
    return REPORT_COLUMNS + [old for names in FORMER_NAMES.values() for old in names]


def history_schema() -> T.StructType:
    """Current and former columns as text: JSON scalars of any type are read as their text."""
    return T.StructType([T.StructField(n, T.StringType()) for n in _stored_names()])


def normalise_history(records: DataFrame) -> DataFrame:
    """Exactly the public columns; an empty one takes its first non-empty former name, else ''."""
    have = set(records.columns)

    def text(name: str) -> Column:
        return F.col(f"`{name}`").cast("string") if name in have else F.lit(None).cast("string")

    def first_of(name: str) -> Column:
        return F.coalesce(*[not_blank(text(n)) for n in [name, *FORMER_NAMES.get(name, [])]], F.lit(""))

    chosen = records.select(*[first_of(name).alias(name) for name in REPORT_COLUMNS])
    return chosen.select(
        *[elapsed_seconds(F.col(f"`{c}`")).alias(c) if c in ELAPSED_COLUMNS else F.col(f"`{c}`") for c in REPORT_COLUMNS]
    )


def append_history(records: DataFrame, folder: str) -> None:
    """Append; every call adds files, no rewrite of what is there."""
    normalise_history(records).write.mode("append").json(folder)


def read_history(spark: SparkSession, folder: str) -> DataFrame:
    """Blank, broken and non-object lines are skipped; a missing history is empty."""
    try:
        raw = spark.read.schema(history_schema()).option("mode", "DROPMALFORMED").json(folder)
    except AnalysisException:
        raw = spark.createDataFrame([], history_schema())
    return normalise_history(raw)


def rejected_lines(spark: SparkSession, folder: str) -> DataFrame:
    """S13, the skipped lines for inspection."""
    lines = spark.read.text(folder).filter(F.trim("value") != "")
    parsed = F.try_parse_json("value")
    return lines.filter(parsed.isNull() | ~F.schema_of_variant(parsed).startswith("OBJECT"))


def report(records: DataFrame, screen: str | None = None) -> DataFrame:
    """The public report, optionally of one screen."""
    return records if not screen else records.filter(F.col("`画面名`") == screen)


def export_frame(records: DataFrame) -> DataFrame:
    """Elapsed columns as numbers, unreadable ones NULL."""
    return records.select(
        *[F.col(f"`{c}`").try_cast("double").alias(c) if c in ELAPSED_COLUMNS else F.col(f"`{c}`") for c in REPORT_COLUMNS]
    )


def export_csv(records: DataFrame, folder: str) -> None:
    """One folder of CSV part files with headers; empty reports are not written."""
    frame = export_frame(records)
    if not frame.isEmpty():
        frame.write.mode("overwrite").option("header", True).csv(folder)
