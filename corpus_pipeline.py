"""Corpus preparation: quality, near copies, repeated passages, secrets, packing.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from silverlode.llm.common import table
from silverlode.llm.stages import no_near_copies, no_repeats, no_secrets, packed, quality
from silverlode.session import work_folder

STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", no_near_copies),
    ("suffix_array_dedup", no_repeats),
    ("secret_scan", no_secrets),
    ("packing", packed),
]

#: The latent model of the first stage and the packing of the last have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over ``documents``."""
    docs, folder = table(spark, sf_dir, "documents"), work_folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
