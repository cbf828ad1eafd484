"""Helpers shared by the operators: reading a table, texts as bytes, word hashes, row batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.session import work_folder

MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)
CACHED_WORDS = 60_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str) -> Column:
    """The text as UTF-8 bytes; null is empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def schema_of(df: DataFrame, ids: list[str], added: str) -> T.StructType:
    """The id columns as they are, and added columns given as DDL."""
    return T.StructType([T.StructField(c, df.schema[c].dataType) for c in ids] + T.StructType.fromDDL(added).fields)


def batches_of(rows: list[list], like: pa.RecordBatch, ids: list[str], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    """Id columns of ``like`` beside computed columns, one list per column."""
    arrays = [like.column(like.schema.get_field_index(c)) for c in ids] + [pa.array(x, t) for x, (_, t) in zip(rows, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[*ids, *(n for n, _ in fields)])


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of a word (bytes); remembers a bounded number of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash for each run of ``width`` words; shorter texts are one run."""
    if len(hashes) == 0:
        return hashes
    n = max(1, len(hashes) - width + 1)
    out = hashes[:n].copy()
    for i in range(1, min(width, len(hashes))):
        out *= STEP
        out += hashes[i : i + n]
    return mixed(out)


def planes(values: np.ndarray) -> bytes:
    """Fixed-width values byte by byte (all first bytes, all second bytes, ...): small numbers then compress well."""
    flat = np.ascontiguousarray(values)
    return flat.view(np.uint8).reshape(len(flat), flat.dtype.itemsize).T.tobytes() if len(flat) else b""


def from_planes(data: bytes, kind: np.dtype | str) -> np.ndarray:
    kind = np.dtype(kind)
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        sizes = np.diff(np.frombuffer(batch.column(batch.schema.get_field_index(column)).buffers()[1], np.int32, batch.num_rows + 1, 4 * batch.column(batch.schema.get_field_index(column)).offset))
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows from a table in the shared folder: lineage ends there, and lost executors cost no recomputation."""
    folder = work_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
