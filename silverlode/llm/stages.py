"""Stages of the corpus pipeline: functions of (spark, docs, sf_dir).

All but the last return the columns they were given. Rows are told apart by id and text; a row that repeats in both is
one document to the near-copy stage and several to the others. Null texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm.common import utf8
from silverlode.llm.jaccard_join import near_copies
from silverlode.llm.packing import pack
from silverlode.llm.quality_rules import judge
from silverlode.llm.secret_scan import redact
from silverlode.llm.suffix_dedup import repeats
from silverlode.operators.skew import match


def _only(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` whose id and text hash are among ``keys`` (``id``, ``text_hash``)."""
    own = [F.col(f"d.{id_col}").cast("long"), F.xxhash64(utf8(f"d.{text}"))]
    on = match(own, [F.col("k.id"), F.col("k.text_hash")], nulls_equal=True)
    return docs.alias("d").join(keys.alias("k"), on, "left_semi")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(utf8("text")).alias("text_hash"), "text")
    return _only(docs, judge(rows, ("id", "text_hash")).where("kept").select("id", "text_hash"))


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id; texts without words stay."""
    found = near_copies(docs)
    group = F.coalesce(F.col("component").cast("string"), F.concat(F.lit("print "), F.col("print").cast("string")))
    first = F.min_by(F.struct("id", "text_hash"), F.struct(F.col("id").isNull(), "id", "text_hash")).alias("first")
    chosen = found.where("size > 0").groupBy(group.alias("group")).agg(first).select("first.*")
    times = found.where("size > 0").groupBy("id", "text_hash").agg(F.count("*").alias("times"))
    chosen = chosen.join(times.withColumnsRenamed({"id": "i", "text_hash": "t"}), F.col("id").eqNullSafe(F.col("i")) & (F.col("text_hash") == F.col("t")), "inner")
    chosen = chosen.select("id", "text_hash", "times").unionByName(found.where("size = 0").select("id", "text_hash", F.lit(1).cast("long").alias("times")))
    once = _only(docs, chosen.where("times = 1"))
    repeated = _only(docs, chosen.where("times > 1"))
    key = "_" * (1 + max(map(len, docs.columns)))  # longer than any name of the table, so it clashes with none
    return once.unionByName(repeated.withColumn(key, F.xxhash64("text")).dropDuplicates(["doc_id", key]).drop(key))


def no_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that start earlier elsewhere; a text of which nothing is left goes."""
    left = repeats(docs, tuple(docs.columns), "doc_id", "text", rewrite="text", length="n_chars")
    return left.where("n_removed = 0 or n_removed < n_bytes").select(*docs.columns)


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by its kind."""
    return redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 ids."""
    return pack(docs)
