"""Connected components of a link table, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import written
from silverlode.operators.skew import match


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Every node's neighbours (the larger ones, or the smaller ones and itself) are tied to its least neighbour."""
    least = pairs.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("low"))
    tied = pairs.join(least, match([pairs["a"]], [least["node"]]), "inner")
    if larger:
        return tied.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    return tied.select(F.col("b").alias("a"), F.col("low").alias("b")).union(least.select(F.col("node").alias("a"), F.col("low").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``least``) for each node of the links (``a``, ``b``, both long): the least node of its component.

    A hot node's links can be split in every join. A round costs two joins and is written to the shared folder; the
    number of rounds grows with the logarithm of the largest component.
    """
    links = written(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, True).where("a <> b").distinct()
        links = written(_star(large, False).where("a <> b").distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("least")).union(links.select(F.col("b").alias("node"), F.col("b").alias("least")).distinct())
