"""CSV records that may go over several lines, cut out of byte ranges of a file by many tasks.

A file is read as lines, in the byte ranges Spark deals it out in. Whether a line begins inside quotes depends on all lines
before it, but each range can say what it makes of either case. A first pass gives these two answers per range, a window
over the ranges carries the state from range to range, and a second pass cuts records. Only a record that goes over the
end of a range is shuffled, in pieces; all others stay in the task that read them.

Quotes count as Spark's own CSV reader counts them: a quote opens a cell only at its beginning, a doubled one is text, and
behind a closed cell everything up to the separator belongs to it. Line breaks inside quotes are read as line feeds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MOST_RANGES = 1 << 22  # their states reach the driver: 9 bytes each
PIECES = "file string, start long, first boolean, open boolean, body string"


def ends_inside(line: str, inside: bool, separator: str = ",", quote: str = '"') -> bool:
    """Whether the cell that the line ends in is still open."""
    if quote not in line:
        return inside
    at = 0
    while True:
        if not inside:
            if line.startswith(quote, at):
                inside, at = True, at + len(quote)
                continue
        else:
            at = line.find(quote, at)
            if at < 0:
                return True
            at += len(quote)
            if line.startswith(quote, at):
                at += len(quote)
                continue
            inside = False
        at = line.find(separator, at)
        if at < 0:
            return False
        at += len(separator)


def _key(file: str, start: int) -> int:
    return xxhash.xxh3_64_intdigest(f"{start}:{file}".encode())


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    for batch in batches:
        for file, start, line in zip(*(c.to_pylist() for c in batch.columns)):
            yield file, start, line.removesuffix("\r")


def _read(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def range_states(lines: DataFrame, separator: str, quote: str) -> DataFrame:
    """(``file``, ``start``, ``inside``): whether the byte range begins inside quotes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, states = [], None, [False, True]
        for file, start, line in _lines(batches):
            if now != (file, start):
                if now:
                    out.append((*now, *states))
                now, states = (file, start), [False, True]
            if quote in line:
                states = [ends_inside(line, s, separator, quote) for s in states] if states[0] != states[1] else [ends_inside(line, states[0], separator, quote)] * 2
        if now:
            out.append((*now, *states))
        columns = list(zip(*out)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.int64(), pa.bool_(), pa.bool_()))], names=["file", "start", "outside", "inside"])

    answers = lines.mapInArrow(run, "file string, start long, outside boolean, inside boolean")
    # A range whose answers agree sets the state; one that swaps them flips it. A state is the last one set, and the flips since.
    before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy("file").orderBy("start")
    flips = answers.withColumn("flips", F.sum(F.when(F.col("outside") & ~F.col("inside"), 1).otherwise(0)).over(upto) % 2)
    held = F.when(F.col("outside") == F.col("inside"), F.col("outside").cast("int").bitwiseXOR(F.col("flips").cast("int")))
    state = F.coalesce(F.last(held, ignorenulls=True).over(before), F.lit(0)).bitwiseXOR(F.coalesce(F.last("flips").over(before), F.lit(0)).cast("int"))
    return flips.select("file", "start", (state == 1).alias("inside"))


@dataclass
class _Cutter:
    """Records of one byte range; what belongs to the record before or goes on behind comes out as open pieces."""

    file: str
    start: int
    inside: bool
    separator: str
    quote: str
    held: list[str] = field(default_factory=list)
    head: bool = False
    first: bool = True

    def __post_init__(self):
        self.head = self.inside

    def take(self, line: str) -> tuple | None:
        if self.start == 0 and self.first and not self.held:
            line = line.removeprefix("﻿")
        self.held.append(line)
        self.inside = ends_inside(line, self.inside, self.separator, self.quote)
        return None if self.inside else self._out()

    def _out(self) -> tuple:
        out = (self.file, self.start, self.first and self.start == 0, self.head or self.inside, "\n".join(self.held), not self.head)
        self.held, self.head, self.first = [], False, False
        return out

    def rest(self) -> list[tuple]:
        return [self._out()] if self.held else []


def records(spark: SparkSession, path: str, separator: str = ",", quote: str = '"') -> DataFrame | None:
    """(``first``, ``record``): every record of the file or folder and whether it is a file's first; blank lines are left out.

    None if the files have more byte ranges than the driver should hold the states of.
    """
    lines = _read(spark, path)
    states = range_states(lines, separator, quote).cache()
    try:
        if states.count() > MOST_RANGES:
            return None
        known = {_key(r.file, r.start): r.inside for r in states.collect()}
    finally:
        states.unpersist()
    keys = np.sort(np.fromiter(known, np.uint64, len(known)))
    sent = spark.sparkContext.broadcast((keys, np.fromiter((known[k] for k in keys.tolist()), np.bool_, len(keys))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, inside = sent.value
        cutter, out, size = None, [], 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[]] * 6
            out.clear()
            kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], names=["file", "start", "first", "open", "body", "begins"])

        for file, start, line in _lines(batches):
            if cutter is None or (cutter.file, cutter.start) != (file, start):
                out += cutter.rest() if cutter else []
                key = np.uint64(_key(file, start))
                at = int(np.searchsorted(keys, key))
                if at == len(keys) or keys[at] != key:
                    raise RuntimeError("the files are dealt out differently from the first pass; read them again")
                cutter = _Cutter(file, start, bool(inside[at]), separator, quote)
            done = cutter.take(line)
            if done:
                out.append(done)
            size += len(line)
            if size > 1 << 22:
                yield flush()
                size = 0
        out += cutter.rest() if cutter else []
        yield flush()

    cut = lines.mapInArrow(run, f"{PIECES}, begins boolean")
    whole = cut.where("not open").select("first", F.col("body").alias("record"))
    # A record over the end of a range: the piece that begins it and all open pieces up to the next such piece.
    order = W.partitionBy("file").orderBy("start", "begins")
    pieces = cut.where("open").withColumn("number", F.sum(F.col("begins").cast("int")).over(order))
    joined = pieces.groupBy("file", "number").agg(F.bool_or("first").alias("first"), F.expr("listagg(body, '\n') WITHIN GROUP (ORDER BY start, begins)").alias("record"))
    return whole.unionByName(joined.select("first", "record")).where("record <> ''")
