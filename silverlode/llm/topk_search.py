"""Exhaustive top-k search by inner product, term at a time.

Vectors are sparse integer rows (dimension -> weight; zero weights are absent). Candidates are dealt to blocks, queries
to blocks; every pair of blocks is one group. In a group the candidates are posting lists, one per dimension. For each
dimension that a query uses, its postings are scattered, weighted, into the queries' dense score arrays. Then the best
k of each array are picked by partition, and the picks of all candidate blocks are merged per query.

A group holds ``candidates x queries`` scores of one block pair, whatever the table's size, and sends k rows per query
on. Vectors that are null or hold null or non-finite components take no part; vectors of different lengths lack the
dimensions beyond their end. Rows without an id take no part. An id that repeats is several candidates and, with its vectors,
several queries, each with its own k places; a query skips all candidates of its own id. Weights that no long holds
raise an error when they are made. Scores are exact whatever their size (beyond a long, a block pair is computed in
Python integers, which is slow), and one of the best k that no long holds raises an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverlode.llm.common import table

CANDIDATE_BLOCK, QUERY_BLOCK = 4096, 2048


def quantised(vectors: DataFrame, vector: str = "embedding", scale: int = 256) -> Column:
    """floor(scale * x) of each component, null where the vector takes no part; an error where a long cannot hold it."""
    parts = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    error = F.raise_error(F.lit(f"a component of {vector}, times {scale}, is beyond 64 bits")).cast("long")
    weight = lambda x: F.when(F.abs(x * scale) < F.lit(2.0**63), F.floor(x * scale).cast("long")).otherwise(error)
    return F.when(F.col(vector).isNotNull() & sound, F.transform(parts, weight))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Dense score arrays, one row per query, accumulated dimension by dimension from postings."""
    largest = lambda x: max(abs(int(x.min(initial=0))), int(x.max(initial=0)))
    most = largest(queries) * largest(candidates) * max(1, queries.shape[1])
    kind = np.int32 if most < 2**31 else np.int64 if most < 2**63 else object
    out = np.zeros((len(queries), len(candidates)), kind)
    for term in range(queries.shape[1]):
        using, posted = np.flatnonzero(queries[:, term]), np.flatnonzero(candidates[:, term])
        if not len(using) or not len(posted):
            continue
        weights, postings = queries[using, term].astype(kind), candidates[posted, term].astype(kind)
        if len(using) == len(queries) and len(posted) == len(candidates):
            out += weights[:, None] * postings
        else:
            out[np.ix_(using, posted)] += weights[:, None] * postings
    return out


def best(queries: np.ndarray, query_ids: np.ndarray, candidates: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the query, candidate id and score of the k best candidates of each query; ties go to the smaller id."""
    order = np.argsort(ids, kind="stable")
    candidates, ids = candidates[order], ids[order]
    got: list[list[np.ndarray]] = [[], [], []]
    for start in range(0, len(queries), 256):
        part, own = queries[start : start + 256], query_ids[start : start + 256]
        dense = scores(part, candidates)
        for place, (row, query) in enumerate(zip(dense, own, strict=True), start):
            a, b = np.searchsorted(ids, query), np.searchsorted(ids, query, side="right")
            keep = np.arange(len(ids)) if a == b else np.r_[0:a, b : len(ids)]
            found = row[keep]
            if len(found) > k:
                least = np.partition(found, len(found) - k)[len(found) - k]
                above, level = np.flatnonzero(found > least), np.flatnonzero(found == least)
                pick = np.r_[above, level[: k - len(above)]]
            else:
                pick = np.arange(len(found))
            got[0].append(np.full(len(pick), place, np.int64))
            got[1].append(ids[keep[pick]])
            got[2].append(found[pick].astype(np.int64))
    return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in got)


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", weights: str = "weights", candidate_block: int = CANDIDATE_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id``, ``rank`` (from 1), the candidate's id and ``score``. Weights are arrays of long; null ones are left out."""
    taking = F.col(weights).isNotNull() & F.col(id_col).isNotNull()
    candidates = candidates.where(taking).select(F.col(id_col).cast("long").alias("id"), F.col(weights).alias("w"))
    queries = queries.where(taking).select(F.col(id_col).cast("long").alias("id"), F.col(weights).alias("w"))
    # Equal query rows are asked once and answered as often as they occur.
    queries = queries.groupBy("id", "w").agg(F.count("*").alias("times")).withColumn("vector", F.xxhash64("w"))
    n_c, n_q = max(1, -(-candidates.count() // candidate_block)), max(1, -(-queries.count() // query_block))
    block = lambda n: F.pmod(F.xxhash64("id", "w"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = candidates.select("id", "w", block(n_c).alias("c"), each(n_q).alias("q"))
    right = queries.select("id", "w", "times", "vector", each(n_c).alias("c"), block(n_q).alias("q"))
    names = ("query_id", "vector", "times", "id", "score")

    def run(some: pa.Table, asked: pa.Table) -> pa.Table:
        if not some.num_rows or not asked.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        width = max(1, max(pc.max(pc.list_value_length(t["w"])).as_py() for t in (some, asked)))
        place, ids, score = best(_matrix(asked["w"], width), asked["id"].to_numpy(), _matrix(some["w"], width), some["id"].to_numpy(), k)
        query = [asked[n].to_numpy()[place] for n in ("id", "vector", "times")]
        return pa.table(dict(zip(names, (*query, ids, score), strict=True)))

    picks = left.groupBy("c", "q").cogroup(right.groupBy("c", "q")).applyInArrow(run, ", ".join(f"{n} long" for n in names))
    order = Window.partitionBy("query_id", "vector").orderBy(F.col("score").desc(), "id")
    ranked = picks.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    ranked = ranked.withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best candidates for every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    vectors = vectors.select("vec_id", quantised(vectors).alias("weights"))
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


OP6_SQL = """
WITH sound AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), terms AS (
  SELECT vec_id, unnest(range(len(embedding))) AS dim, floor(256 * CAST(unnest(embedding) AS DOUBLE))::BIGINT AS weight FROM sound
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.weight * c.weight)::BIGINT AS score
  FROM terms q JOIN terms c ON q.dim = c.dim AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL
)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
WHERE rank <= 5
"""

QUERIES = {"op6_topk_search": (op6_topk_search, OP6_SQL)}
