"""Exact top-k similarity search (J14) without a cross join.

Entries are split into cells around a few of their own vectors (pivots). For unit vectors, cosine ≥ t means an angle of
at most acos(t), and by the triangle inequality a cell can hold a partner of a query only if the query's angle to the
pivot is within that angle of the cell's own range. So a query goes to the cells it needs and to no others, which is
an equi-join on the cell. Cells and their queries are cut into blocks of bounded size, and only the best ``limit``
partners per query leave a block.

Where vectors have no clusters the cells prune little. So in a block vectors are turned by a rotation fitted on a bounded
sample and compared part by part: by Cauchy-Schwarz the rest of a product is bounded by the lengths of the rests, and most
pairs are dropped, exactly, after the first part (``_Scan``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverlode.functions.vectors import norm

# Ranges and defaults of the search settings.
MIN_THRESHOLD, MAX_THRESHOLD, DEFAULT_THRESHOLD = 0.10, 0.95, 0.90
MAX_LIMIT, DEFAULT_LIMIT = 5, 3
DIGITS = 6  # similarities are compared after rounding
SAMPLE_ROWS = 2048  # entries that the rotation is fitted on
CUTS, STRETCH = 4, 512  # parts of a vector; rows taken together
PROBED, DROPS = 16, 0.2  # one row in so many tells whether the first part leaves so few pairs that parts are worth it
SPARSE = 0.02  # share of pairs below which they are done one by one at once
SLACK = 1e-6  # pruning never decides what rounding could


def _units(batch: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    """The rows of a batch that have a direction, and their vectors scaled to length 1."""
    if not len(batch):
        return batch, np.empty((0, 0))
    matrix = np.stack(batch["vector"].to_list()).astype("float64")
    length = np.sqrt((matrix * matrix).sum(axis=1))
    usable = length > 0
    return batch[usable], matrix[usable] / length[usable, None]


def _angles(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(vectors @ pivots.T, -1.0, 1.0))


def _with_cells(entries: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Entries with their nearest pivot and the angle to it."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, units = _units(batch)
            if len(rows):
                angles = _angles(units, pivots)
                cell = angles.argmin(axis=1)
                angle = angles[np.arange(len(rows)), cell]
                yield pd.DataFrame({"id": rows["id"], "v": list(units), "cell": cell.astype("int32"), "angle": angle})

    return entries.mapInPandas(assign, "id long, v array<double>, cell int, angle double")


def _needed_cells(queries: DataFrame, pivots: np.ndarray, low: np.ndarray, high: np.ndarray, reach: float) -> DataFrame:
    """Queries, once per cell that can hold a partner."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, units = _units(batch)
            if len(rows):
                angles = _angles(units, pivots)
                row, cell = np.nonzero((angles - reach <= high) & (angles + reach >= low))
                ids = rows["id"].to_numpy()
                for part in np.array_split(np.arange(len(row)), len(row) // 10000 + 1):
                    yield pd.DataFrame({"id": ids[row[part]], "v": list(units[row[part]]), "cell": cell[part].astype("int32")})

    return queries.mapInPandas(spread, "id long, v array<double>, cell int")


def _blocks(counts: DataFrame, rows: int) -> dict[int, int]:
    return {r["cell"]: -(-r["n"] // rows) for r in counts.collect()}  # one row per cell


def _block_of(cell_blocks: dict[int, int]):
    sizes = F.create_map(*[F.lit(x) for pair in cell_blocks.items() for x in pair])
    return F.element_at(sizes, F.col("cell"))


def _rotation(sample: np.ndarray) -> np.ndarray:
    """An orthogonal matrix that puts the directions in which the sample's units reach furthest first."""
    return np.linalg.eigh(sample.T @ sample)[1][:, ::-1]


@dataclass
class _Scan:
    """One block of queries against one block of entries, with the whole products counted.

    Vectors are turned and cut into ``CUTS`` parts. After some parts, what the rest can add to a product is at most the
    product of the lengths of both rests (Cauchy-Schwarz); pairs that cannot reach what they must are dropped, and what
    they must reach is the threshold, or the query's ``limit``-th best so far. Entries come in stretches of alike first parts,
    bounded by the box around those; stretches are taken by their bounds, the best first, until no bound is enough.
    """

    rotation: np.ndarray
    threshold: float
    limit: int
    skip_same: bool
    pairs: int = 0
    full: int = 0

    def run(self, ids_q: np.ndarray, units_q: np.ndarray, ids_e: np.ndarray, units_e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query ids, entry ids, rounded similarities) of each query's best ``limit``; ties: lower id."""
        width = units_e.shape[1]
        cuts = np.unique(np.linspace(0, width, CUTS + 1).astype(int))
        turned_e = units_e @ self.rotation
        order = np.lexsort([turned_e[:, k] // 0.25 for k in range(min(3, width))])
        ids_e, units_e, turned_e = ids_e[order], units_e[order], turned_e[order]
        rest_e = self._rests(turned_e, cuts)
        head = slice(0, cuts[1])
        stretches = [slice(k, k + STRETCH) for k in range(0, len(ids_e), STRETCH)]
        high = np.array([turned_e[s, head].max(axis=0) for s in stretches])
        low = np.array([turned_e[s, head].min(axis=0) for s in stretches])
        longest = np.array([rest_e[s, 0].max() for s in stretches])
        turned_e, rest_e = turned_e.astype(np.float32), rest_e.astype(np.float32)
        out = []
        for start in range(0, len(ids_q), STRETCH):
            part = slice(start, start + STRETCH)
            turned_q = units_q[part] @ self.rotation
            rest_q = self._rests(turned_q, cuts)
            ahead = turned_q[:, head]
            bounds = np.maximum(ahead, 0) @ high.T + np.minimum(ahead, 0) @ low.T + rest_q[:, :1] * longest
            best = _Best(ids_q[part], self.limit, self.threshold)
            turned_q, rest_q = turned_q.astype(np.float32), rest_q.astype(np.float32)
            self.pairs += len(ahead) * len(ids_e)
            for k in np.argsort(-bounds.max(axis=0)).tolist():
                rows = np.flatnonzero(bounds[:, k] >= best.needed - SLACK)
                if len(rows):
                    self._stretch(rows, units_q[part], turned_q, rest_q, stretches[k], ids_e, units_e, turned_e, rest_e, cuts, best)
            out.append(best.rows())
        return tuple(np.concatenate(x) for x in zip(*out))

    @staticmethod
    def _rests(turned: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Lengths of what lies behind each cut; the last is 0."""
        squares = np.add.reduceat(turned * turned, cuts[:-1], axis=1)
        return np.sqrt(np.maximum(0.0, squares[:, ::-1].cumsum(axis=1)[:, ::-1] - squares))

    def _stretch(self, rows, units_q, turned_q, rest_q, stretch, ids_e, units_e, turned_e, rest_e, cuts, best) -> None:
        """Sums are counted in half the bits, with room for what that may lose; only what passes is counted exactly."""
        needed = (best.needed[rows, None] - SLACK - units_e.shape[1] * 2.0**-22).astype(np.float32)
        few = self._left(rows[::PROBED], needed[::PROBED], turned_q, rest_q, stretch, turned_e, rest_e, cuts, 1)
        if few is not None and few.mean() < DROPS:
            ok = self._left(rows, needed, turned_q, rest_q, stretch, turned_e, rest_e, cuts, len(cuts) - 2)
            q, e = np.divmod(np.flatnonzero(ok), ok.shape[1])
            self.full += len(q)
        else:
            scores = turned_q[rows] @ turned_e[stretch].T
            self.full += scores.size
            q, e = np.divmod(np.flatnonzero(scores >= needed), scores.shape[1])
        values = np.concatenate([np.einsum("ij,ij->i", units_q[rows[q[i : i + 65536]]], units_e[stretch][e[i : i + 65536]]) for i in range(0, len(q), 65536)] or [np.zeros(0)])
        values, others = np.round(values, DIGITS), ids_e[stretch][e]
        good = values >= self.threshold
        if self.skip_same:
            good &= others != best.ids[rows[q]]
        best.add(rows[q[good]], others[good], values[good])

    @staticmethod
    def _left(rows, needed, turned_q, rest_q, stretch, turned_e, rest_e, cuts, parts) -> np.ndarray | None:
        """The pairs that may still reach what they must after so many parts, or after one that leaves few."""
        sums, ok = 0.0, None
        for k in range(min(parts, len(cuts) - 2)):
            piece = slice(cuts[k], cuts[k + 1])
            sums = sums + turned_q[rows, piece] @ turned_e[stretch, piece].T
            ok = sums + rest_q[rows, k, None] * rest_e[stretch, k] >= needed
            if ok.mean() < SPARSE:
                break
        return ok


class _Best:
    """The best entries so far of some queries, and what a further one must reach."""

    def __init__(self, ids: np.ndarray, limit: int, threshold: float):
        self.ids, self.limit = ids, limit
        self.needed = np.full(len(ids), threshold)
        self.held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))

    def add(self, rows: np.ndarray, others: np.ndarray, values: np.ndarray) -> None:
        if not len(rows):
            return
        rows, others, values = (np.concatenate(x) for x in zip(self.held, (rows, others, values)))
        order = np.lexsort([others, -values, rows])
        rows, others, values = rows[order], others[order], values[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = place < self.limit
        full = rows[place == self.limit - 1]
        self.needed[full] = np.maximum(self.needed[full], values[place == self.limit - 1])
        self.held = rows[keep], others[keep], values[keep]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows, others, values = self.held
        return self.ids[rows], others, values


def _scanned(queries: pd.DataFrame, entries: pd.DataFrame, scan: _Scan) -> pd.DataFrame:
    found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    if len(queries) and len(entries):
        found = scan.run(queries["id"].to_numpy(), np.stack(queries["v"].to_list()), entries["id"].to_numpy(), np.stack(entries["v"].to_list()))
    return pd.DataFrame(dict(zip(("query_id", "entry_id", "similarity"), found)))


def _grid(queries: DataFrame, entries: DataFrame, threshold: float, limit: int, pivots: int, block_rows: int):
    """Queries and entries in the blocks that must meet, and the rotation; None where there are no entries."""
    if not MIN_THRESHOLD <= threshold <= MAX_THRESHOLD or not 1 <= limit <= MAX_LIMIT:
        raise ValueError("threshold or limit out of range")
    left, right = (df.select("id", "vector").filter("vector IS NOT NULL") for df in (queries, entries))
    directed = right.filter(norm(F.col("vector")) > 0)
    sample = directed.orderBy(F.md5(F.col("id").cast("string"))).limit(max(pivots, SAMPLE_ROWS)).toPandas()
    if sample.empty:
        return None
    _, units = _units(sample)
    centres = units[:pivots]
    celled = _with_cells(right, centres)
    ranges = celled.groupBy("cell").agg(F.min("angle").alias("low"), F.max("angle").alias("high"), F.count("*").alias("n")).collect()
    low, high = np.full(len(centres), np.inf), np.full(len(centres), -np.inf)
    for r in ranges:
        low[r["cell"]], high[r["cell"]] = r["low"], r["high"]
    reach = math.acos(max(-1.0, threshold - SLACK)) + SLACK
    spread = _needed_cells(left, centres, low, high, reach)

    entry_blocks = {r["cell"]: -(-r["n"] // block_rows) for r in ranges}
    query_blocks = {**dict.fromkeys(entry_blocks, 1), **_blocks(spread.groupBy("cell").agg(F.count("*").alias("n")), block_rows)}
    hashed = F.abs(F.xxhash64("id"))
    own_entry, own_query = F.pmod(hashed, _block_of(entry_blocks)), F.pmod(hashed, _block_of(query_blocks))
    each_query_block = F.explode(F.sequence(F.lit(0), _block_of(query_blocks) - 1))
    each_entry_block = F.explode(F.sequence(F.lit(0), _block_of(entry_blocks) - 1))
    e = celled.select("id", "v", "cell", own_entry.cast("int").alias("eb"), each_query_block.alias("qb"))
    q = spread.select("id", "v", "cell", own_query.cast("int").alias("qb"), each_entry_block.alias("eb"))
    keys = ["cell", "eb", "qb"]
    return q.groupBy(*keys).cogroup(e.groupBy(*keys)), _rotation(units)


def top_matches(
    queries: DataFrame,
    entries: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    limit: int = DEFAULT_LIMIT,
    skip_same: bool = False,
    pivots: int = 16,
    block_rows: int = 20000,
) -> DataFrame:
    """For each query the ``limit`` most similar entries with a similarity of at least ``threshold``.

    Both sides: ``id long, vector array``. Result: query_id, entry_id, similarity (rounded), rank. Vectors of length
    zero match nothing. ``pivots`` trades pruning against copies of the queries; the result does not depend on it, nor
    on the sample of ``SAMPLE_ROWS`` entries that the rotation is fitted on.
    """
    grid = _grid(queries, entries, threshold, limit, pivots, block_rows)
    if grid is None:
        return queries.sparkSession.createDataFrame([], "query_id long, entry_id long, similarity double, rank int")
    blocks, rotation = grid
    found = blocks.applyInPandas(lambda q, e: _scanned(q, e, _Scan(rotation, threshold, limit, skip_same)), "query_id long, entry_id long, similarity double")
    best = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), F.col("entry_id").asc())
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= limit)


def products(
    queries: DataFrame, entries: DataFrame, threshold: float = DEFAULT_THRESHOLD, limit: int = DEFAULT_LIMIT, skip_same: bool = False, pivots: int = 16, block_rows: int = 20000
) -> DataFrame:
    """The work of the same search: ``pairs`` in blocks that meet, and for how many the whole product was computed."""
    grid = _grid(queries, entries, threshold, limit, pivots, block_rows)
    if grid is None:
        return queries.sparkSession.createDataFrame([(0, 0)], "pairs long, whole long")
    blocks, rotation = grid

    def count(q: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        scan = _Scan(rotation, threshold, limit, skip_same)
        _scanned(q, e, scan)
        return pd.DataFrame({"pairs": [scan.pairs], "whole": [scan.full]})

    sums = blocks.applyInPandas(count, "pairs long, whole long").agg(F.sum("pairs").alias("pairs"), F.sum("whole").alias("whole"))
    return sums.select(F.coalesce("pairs", F.lit(0)).alias("pairs"), F.coalesce("whole", F.lit(0)).alias("whole"))
