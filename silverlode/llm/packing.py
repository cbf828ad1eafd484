"""Packing of token sequences by minimum bin slack.

Every text becomes its token ids and an end id. Whole windows of ``capacity`` ids are cut off first; what remains of a
document (fewer than ``capacity`` ids) is packed with other remainders. Per window: the longest remainder is set, a
bitset of reachable sums over the remaining-length counts is grown (one integer per length, shifted by powers of two
of that length), the sum closest to the capacity is taken, and the lengths that make it up are traced back. The
multiset found is used as often as the counts allow, so the work depends on the number of different lengths. Only when
all that is left fits into one window, it is split into windows of powers of two (which need no padding) if that is less.

Rows are dealt to shards of about ``shard_rows`` rows, and each shard packs on its own: nothing is ordered or counted
across the whole corpus, a shard's tail costs a window or two of padding, and only lengths and checksums are shuffled.
A null text counts as empty and is one end id. Repeated rows are packed each. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm.common import batches_of, schema_of, table, utf8

CAPACITY = 1024
END_ID = 0
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
END_OF_TEXT = "<|endoftext|>"
#: Characters on whose classes (letter, number, space) both libraries agree by test; other texts take the slower one.
UNUSUAL = re.compile("[\x1c-\x1f\x85]|[^\x00-\u024f\u2010-\u2027\u2030-\u205e\u20ac]")


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit integers, as ``tokenizers`` gives them.

    The same vocabulary exists as a rank file, which is encoded four times as fast; texts in common scripts take that
    way, all others the tokenizer itself. Tests hold both against each other.
    """

    def __init__(self, tokenizer: str = TOKENIZER, ranks: str | None = RANKS):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.fast = Tokenizer.from_file(self.path(tokenizer)), None
        if ranks:
            import public_tokenizers
            import tiktoken

            with open(self.path(ranks), "rb") as file:
                table_ = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            special = {END_OF_TEXT: self.tokenizer.token_to_id(END_OF_TEXT)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table_, special_tokens=special)

    @staticmethod
    def path(name: str) -> str:
        if "/" in name:
            return name
        import public_tokenizers

        return public_tokenizers.path(name)

    def ids(self, text: str) -> bytes:
        if self.fast is None or UNUSUAL.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()


def pieces_of(ids: bytes, capacity: int) -> tuple[list[int], list[int]]:
    """Lengths and checksums of whole windows and the remainder."""
    step, n = 4 * capacity, len(ids)
    view = memoryview(ids)
    return [min(step, n - a) // 4 for a in range(0, n, step)], [zlib.crc32(view[a : a + step]) for a in range(0, n, step)]


def tokens(docs: DataFrame, ids: tuple[str, ...] = ("doc_id",), text: str = "text", tokenizer: str = TOKENIZER, ranks: str | None = RANKS, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Ids, ``row_no`` (within the task), ``lengths`` and ``checksums`` of the pieces; with ``keep_ids``, ``token_ids``."""
    ids = list(ids)
    fields = [("row_no", pa.int64()), ("lengths", pa.list_(pa.int32())), ("checksums", pa.list_(pa.int64()))]
    fields += [("token_ids", pa.binary())] * keep_ids
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = Encoder(tokenizer, ranks), 0
        for batch in batches:
            got = [encoder.ids(x.decode("utf-8", "replace")) + end for x in batch.column(len(ids)).to_pylist()]
            cut = [pieces_of(x, capacity) for x in got]
            rows = [list(range(row, row + len(got))), [x[0] for x in cut], [x[1] for x in cut], *([got] if keep_ids else [])]
            row += len(got)
            yield batches_of(rows, batch, ids, fields)

    added = "row_no long, lengths array<int>, checksums array<long>" + ", token_ids binary" * keep_ids
    return docs.select(*ids, utf8(text).alias("raw")).mapInArrow(run, schema_of(docs, ids, added))


def padding(length: int, capacity: int) -> int:
    """Sequences are padded to the capacity, except at a power of two."""
    return 0 if length & (length - 1) == 0 else capacity - length


def fill(counts: dict[int, int], capacity: int, powers: bool = True) -> dict[int, int]:
    """The multiset of lengths for one window: the longest, and what comes closest to the capacity beside it; with
    ``powers``, what leaves least padding, be it at a power of two."""
    longest = max(counts)
    room, full = capacity - longest, (1 << (capacity - longest + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, take = counts[length] - (length == longest), 1
        left = min(left, room // length)
        while left > 0:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & full
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    best = reach.bit_length() - 1
    if powers and padding(longest + best, capacity):
        exact = [p - longest for p in (1 << k for k in range(capacity.bit_length())) if p >= longest and reach >> (p - longest) & 1]
        best = exact[-1] if exact else best
    chosen = {longest: 1}
    for length, take, before in reversed(steps):
        if not before >> best & 1:
            chosen[length] = chosen.get(length, 0) + take
            best -= length * take
    return chosen


def plan(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Multisets of lengths and how often each is used; together they use every length once."""
    counts: dict[int, int] = {}
    for x in lengths:
        counts[x] = counts.get(x, 0) + 1
    out, left = [], sum(lengths)
    while left > capacity:
        chosen = fill(counts, capacity, powers=False)
        times = _use(counts, chosen)
        out.append((chosen, times))
        left -= times * sum(x * n for x, n in chosen.items())
    return out + _last(counts, capacity)


def _use(counts: dict[int, int], chosen: dict[int, int]) -> int:
    """Takes a multiset out of the counts as often as they allow; returns how often."""
    times = min(counts[x] // n for x, n in chosen.items())
    for x, n in chosen.items():
        counts[x] -= n * times
        if not counts[x]:
            del counts[x]
    return times


def _last(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """What fits into one window as one, or as several at powers of two where these need less padding together."""
    whole, out = dict(counts), []
    while counts:
        chosen = fill(counts, capacity)
        out.append((chosen, _use(counts, chosen)))
    total = lambda chosen: padding(sum(x * n for x, n in chosen.items()), capacity)
    if whole and total(whole) <= sum(total(chosen) * times for chosen, times in out):
        return [(whole, 1)]
    return out


def pack_shard(lengths: list[list[int]], capacity: int) -> tuple[list[list[int]], list[list[int]], int]:
    """Sequence number and offset of every piece of every row, and the number of sequences."""
    at = [[0] * len(x) for x in lengths]
    where = [[0] * len(x) for x in lengths]
    number, waiting = 0, {}
    for i, row in enumerate(lengths):
        for k, n in enumerate(row):
            if n == capacity:
                at[i][k] = number
                number += 1
            else:
                waiting.setdefault(n, []).append((i, k))
    for chosen, times in plan([n for n, rows in waiting.items() for _ in rows], capacity):
        for _ in range(times):
            offset = 0
            for n, copies in chosen.items():
                for _ in range(copies):
                    i, k = waiting[n].pop()
                    at[i][k], where[i][k] = number, offset
                    offset += n
            number += 1
    return at, where, number


def pack(docs: DataFrame, ids: tuple[str, ...] = ("doc_id",), text: str = "text", tokenizer: str = TOKENIZER, ranks: str | None = RANKS, capacity: int = CAPACITY, shard_rows: int = 2000, keep_ids: bool = False) -> DataFrame:
    """One row per piece: ids, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    With ``keep_ids``, also the piece's ``token_ids`` (binary, unsigned 32-bit, little-endian): sequences are these in
    the order of ``offset``.
    """
    ids = list(ids)
    shards = max(1, -(-docs.count() // shard_rows))
    rows = tokens(docs, tuple(ids), text, tokenizer, ranks, capacity, keep_ids)
    rows = rows.withColumn("shard", F.pmod(F.xxhash64(*ids, "row_no", "checksums"), F.lit(shards)))
    out = T.StructType([*rows.schema.fields, T.StructField("at", T.ArrayType(T.LongType())), T.StructField("where", T.ArrayType(T.IntegerType()))])

    def run(group: pa.Table) -> pa.Table:
        at, where, _ = pack_shard(group["lengths"].to_pylist(), capacity)
        first = group["shard"][0].as_py() << 40
        group = group.append_column("at", pa.array([[first + x for x in row] for row in at], pa.list_(pa.int64())))
        return group.append_column("where", pa.array(where, pa.list_(pa.int32())))

    placed = rows.groupBy("shard").applyInArrow(run, out)
    total = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("doc_tokens")
    piece = F.posexplode(F.arrays_zip("lengths", "checksums", "at", "where")).alias("piece", "p")
    held = placed.select(*ids, total, *(["token_ids"] if keep_ids else []), piece)
    start = F.col("piece").cast("long") * capacity
    extra = [F.expr(f"substring(token_ids, int(4L * piece * {capacity} + 1), 4 * p.lengths)").alias("token_ids")] if keep_ids else []
    return held.select(
        *ids, start.alias("start"), F.col("p.lengths").cast("long").alias("length"), F.col("p.checksums").alias("ids_crc32"), "doc_tokens",
        F.col("p.at").alias("sequence_id"), F.col("p.where").cast("long").alias("offset"), *extra,
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` in sequences of at most 1024 ids."""
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op3_packing": (op3_packing, None)}
