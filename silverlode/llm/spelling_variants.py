"""Spelling variants: words one edit apart, the commoner form of each word, and the root its forms lead to.

Words are counted in tasks (a task sends a word once per ``HELD`` distinct ones, so a frequent word is no hot key) and
kept from ``least_length`` code points and ``least_count`` occurrences on. Two words are near if one inserted, deleted or
replaced code point makes one of the other. Of every unordered pair exactly one side generates the other: the longer
word deletes, and of two words of equal length the one with the lesser letter replaces. Generated edits are 64-bit
hashes only, updated from the word's hash; they are probed against Bloom filters of the vocabulary. What the filters let
through is spelled out, shuffled and joined with the vocabulary, which removes the false positives.

Filters are sharded by length, and a shard of many words is sliced by hash: a slice has about ``SLICE_WORDS`` words.
Slices are broadcast in rounds of at most ``round_bytes``, and a round probes only the lengths and hashes it holds. So
what is broadcast has a fixed bound however large the vocabulary is; a larger one takes more rounds.

A word's form has the largest count among its near words (ties: least in code-point order) if that is ``ratio`` times the
word's own or more. Counts grow along forms, so chains end; roots are found by pointer jumping, in a logarithmic number of
joins, in which a hot root can be split.

Null and empty texts have no words. Repeated rows count each. An empty table gives an empty result. Runs of any length
are words; edits are generated in blocks of bounded size. With ``typo_every``, a run whose checksum with the row's id
is a multiple loses a letter first (made-up misspellings); a null id takes part in none. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm.common import STEP, mixed, table, utf8, written
from silverlode.operators.skew import match
from silverlode.session import work_folder

#: The letters of words after A-Z are lower-cased, in code-point order.
LETTERS = "".join(map(chr, [*range(0x61, 0x7B), *range(0xC0, 0x100)]))
LEAST_LENGTH, LEAST_COUNT, RATIO, TYPO_EVERY = 5, 3, 2, 97
HELD = 200_000
SEGMENT = 1 << 20
BITS_PER_WORD, PROBES = 24, 5
SLICE_WORDS, ROUND_BYTES = 1 << 20, 64 << 20
BLOCK = 1 << 19
POWER = 0x9E3779B97F4A7C15
LONG = 32


# -- words ------------------------------------------------------------------------------------------------------------


def runs(text: str, letters: str = LETTERS) -> Iterator[list[str]]:
    """Maximal runs of letters, in lists of those of about a million characters."""
    inside = re.escape(letters)
    word, other = re.compile(f"[{inside}]+"), re.compile(f"[^{inside}]")
    at = 0
    while at < len(text):
        cut = other.search(text, at + SEGMENT) if len(text) - at > SEGMENT else None
        end = cut.start() if cut else len(text)
        yield word.findall(text, at, end)
        at = end


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, typo_every: int | None = None, letters: str = LETTERS) -> DataFrame:
    """(``word``, ``n``): runs of ``letters``, A-Z lower-cased, that are long and frequent enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for row, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                own: Counter[str] = Counter()
                for words in runs(raw.as_buffer().to_pybytes().lower().decode("utf-8", "replace"), letters):
                    own.update(words)
                start = zlib.crc32(f"{row}:".encode())
                for word, n in own.items():
                    if len(word) < least_length:
                        continue
                    if typo_every and row is not None:
                        h = zlib.crc32(word.encode(), start)
                        if h % typo_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least_length:
                                continue
                    total[word] += n
                if len(total) >= HELD:
                    yield flush()
        yield flush()

    parts = docs.select(F.col(key).cast("string").alias("key"), utf8(text).alias("raw")).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# -- hashes of words and of their edits ---------------------------------------------------------------------------------


def powers(n: int) -> np.ndarray:
    out = np.full(n, POWER, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


INVERSE = np.uint64(pow(POWER, -1, 1 << 64))


def shard_of(length: int) -> int:
    """Filters are kept per length; long words share one per power of two."""
    return length if length < LONG else LONG + (length // LONG).bit_length()


def by_length(words: list[str], letters: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, letter numbers from 1 as a matrix) for the words of each length."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    codes = (np.searchsorted(np.array(list(map(ord, letters)), np.uint32), points) + 1).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        yield length, rows, codes[starts[rows, None] + np.arange(length)]


def finished(sums: np.ndarray, length: int) -> np.ndarray:
    """Hashes that filters are made of, from sums of letter times power."""
    return mixed(sums + np.uint64(length * int(STEP) & 0xFFFFFFFFFFFFFFFF))


def edits(matrix: np.ndarray, n_letters: int, deletions: bool = True, replacements: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray | None, np.ndarray]]:
    """(length, rows, positions, letters or None, hashes) of the edits, in blocks of bounded size.

    A deletion out of a run of equal letters is generated once, a replacement only by a greater letter: each unordered
    pair of near words comes up once.
    """
    length = matrix.shape[1]
    power = powers(length)
    width = max(1, min(length, BLOCK // n_letters))
    height = max(1, BLOCK // (width * n_letters))
    each = np.arange(1, n_letters + 1, dtype=np.uint64)
    tall = max(1, BLOCK // length)
    for top in range(0, len(matrix), tall) if deletions and length > 1 else ():
        part = matrix[top : top + tall]
        before = np.cumsum(part * power, axis=1, dtype=np.uint64)
        less = (before - part * power) + (before[:, -1:] - before) * INVERSE
        new = np.ones(part.shape, bool)
        new[:, 1:] = part[:, 1:] != part[:, :-1]
        r, p = np.nonzero(new)
        yield length - 1, r + top, p, None, finished(less[r, p], length - 1)
    for top in range(0, len(matrix), height) if replacements else ():
        part = matrix[top : top + height]
        sums = (part * power).sum(axis=1, dtype=np.uint64)
        for left in range(0, length, width):
            block = part[:, left : left + width]
            r, p, c = np.nonzero(each > block[:, :, None])
            hashes = sums[r] + (each[c] - block[r, p]) * power[p + left]
            yield length, r + top, p + left, each[c], finished(hashes, length)


def spelled(matrix: np.ndarray, rows: np.ndarray, at: np.ndarray, put: np.ndarray | None, letters: str) -> list[str]:
    """The edited words as strings."""
    if put is None:
        keep = np.arange(matrix.shape[1] - 1)
        out = matrix[rows[:, None], keep + (keep >= at[:, None])]
    else:
        out = matrix[rows]
        out[np.arange(len(rows)), at] = put
    points = np.array(list(map(ord, letters)), np.uint32)[out.astype(np.int64) - 1]
    width, text = points.shape[1], points.tobytes().decode("utf-32-le")
    return [text[i : i + width] for i in range(0, len(text), width)]


# -- blocked Bloom filters ------------------------------------------------------------------------------------------------


def slice_of(hashes: np.ndarray, slices: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(slices)).astype(np.int64)


def masks(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block number and the bits within the block's 64."""
    block = ((hashes & np.uint64(0xFFFFFFFF)) * np.uint64(blocks)) >> np.uint64(32)
    more, bits = mixed(hashes + STEP), np.zeros(len(hashes), np.uint64)
    for k in range(PROBES):
        bits |= np.uint64(1) << ((more >> np.uint64(6 * k)) & np.uint64(63))
    return block.astype(np.int64), bits


def blocks_for(words: int) -> int:
    return max(1, -(-words * BITS_PER_WORD // 64))


def bloom(hashes: np.ndarray, blocks: int) -> np.ndarray:
    out = np.zeros(blocks, np.uint64)
    at, bits = masks(hashes, blocks)
    np.bitwise_or.at(out, at, bits)
    return out


def passing(hashes: np.ndarray, slices: int, held: dict[int, np.ndarray]) -> np.ndarray:
    """Indices of the hashes that one of the held slices lets through."""
    if slices == 1:
        (only,) = held.values()
        at, bits = masks(hashes, len(only))
        return np.flatnonzero(only[at] & bits == bits)
    of, out = slice_of(hashes, slices), []
    for number, bits_of in held.items():
        mine = np.flatnonzero(of == number)
        at, bits = masks(hashes[mine], len(bits_of))
        out.append(mine[bits_of[at] & bits == bits])
    return np.concatenate(out)


def _hashed(words: DataFrame, letters: str) -> DataFrame:
    """(``shard``, ``print``) of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, matrix in by_length(batch.column(0).to_pylist(), letters):
                prints = finished((matrix * powers(length)).sum(axis=1, dtype=np.uint64), length)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(prints), shard_of(length), np.int32)), pa.array(prints.view(np.int64))], names=["shard", "print"])

    return words.select("word").mapInArrow(run, "shard int, print long")


def _filters(words: DataFrame, letters: str, slice_words: int) -> tuple[DataFrame, dict[int, int], list[tuple[int, int, int]]]:
    """Filters as a table (``shard``, ``slice``, ``bits``), the slices per shard, and (shard, slice, bytes) of each.

    The driver sees one count per shard (at most ``LONG`` and one per power of two); one group holds one slice's hashes.
    """
    hashed = written(_hashed(words, letters), "word-prints")
    counts = {r.shard: r.n for r in hashed.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    slices = {k: max(1, -(-n // slice_words)) for k, n in counts.items()}
    blocks = {k: blocks_for(-(-n // slices[k])) for k, n in counts.items()}
    per_shard = F.create_map(*[F.lit(x) for k in sorted(slices) for x in (k, slices[k])]) if slices else F.create_map(F.lit(0), F.lit(1))
    sliced = hashed.withColumn("slice", (F.shiftrightunsigned("print", 40) % per_shard[F.col("shard")]).cast("int"))

    def run(group: pa.Table) -> pa.Table:
        shard = group["shard"][0].as_py()
        bits = bloom(group["print"].combine_chunks().to_numpy().view(np.uint64), blocks[shard])
        return pa.table({"shard": group["shard"].slice(0, 1), "slice": group["slice"].slice(0, 1), "bits": pa.array([bits.tobytes()], pa.binary())})

    made = written(sliced.groupBy("shard", "slice").applyInArrow(run, "shard int, slice int, bits binary"), "word-filters")
    return made, slices, [(k, s, 8 * blocks[k]) for k in sorted(slices) for s in range(slices[k])]


def _rounds(pieces: list[tuple[int, int, int]], most: int) -> Iterator[list[tuple[int, int]]]:
    """Filters broadcast together: at most ``most`` bytes (one at least)."""
    held, size = [], 0
    for shard, number, n in pieces:
        if held and size + n > most:
            yield held
            held, size = [], 0
        held.append((shard, number))
        size += n
    if held:
        yield held


# -- near words -----------------------------------------------------------------------------------------------------------


def candidates(words: DataFrame, letters: str = LETTERS, slice_words: int = SLICE_WORDS, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(``word``, ``n``, ``other``): each generated edit that the filters let through, false positives included."""
    spark = words.sparkSession
    filters, slices, pieces = _filters(words, letters, slice_words)
    folder = work_folder(spark, "near-words")
    schema = "word string, n long, other string"
    for k, held in enumerate(_rounds(pieces, round_bytes)):
        wanted = spark.createDataFrame(held, "shard int, slice int")
        at: dict[int, dict[int, np.ndarray]] = {}
        for r in filters.join(F.broadcast(wanted), ["shard", "slice"]).toLocalIterator():
            at.setdefault(r.shard, {})[r.slice] = np.frombuffer(r.bits, np.uint64)
        sent = spark.sparkContext.broadcast(at)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            here = sent.value
            for batch in batches:
                texts, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
                for length, rows, matrix in by_length(texts, letters):
                    less, same = shard_of(length - 1), shard_of(length)
                    for size, r, p, c, hashes in edits(matrix, len(letters), less in here, same in here):
                        ok = passing(hashes, slices[shard_of(size)], here[shard_of(size)])
                        if len(ok):
                            others = spelled(matrix, r[ok], p[ok], None if c is None else c[ok], letters)
                            of = rows[r[ok]]
                            yield pa.RecordBatch.from_arrays([pa.array([texts[i] for i in of], pa.string()), pa.array(counts[of], pa.int64()), pa.array(others, pa.string())], names=["word", "n", "other"])

        words.select("word", "n").mapInArrow(run, schema).write.parquet(f"{folder}/{k:05d}")
        sent.destroy()
    if not pieces:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/*")


def roots(forms: DataFrame) -> DataFrame:
    """(``word``, ``root``) for the words that have a form: where following forms ends."""
    state = written(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("at"), F.col("root").alias("next"))
        joined = state.join(ahead, match([state["root"]], [ahead["at"]]), "left")
        state = written(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if state.where("moved").isEmpty():
            return state.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, letters: str = LETTERS, slice_words: int = SLICE_WORDS, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root`` for distinct words made of ``letters`` with counts ``n``."""
    found = candidates(words, letters, slice_words, round_bytes)
    exact = words.select(F.col("word").alias("own"), F.col("n").alias("own_n"))
    pairs = found.join(exact, match([found["other"]], [exact["own"]]), "inner").select("word", "n", "other", F.col("own_n").alias("other_n"))
    both = pairs.select("word", "other", "other_n").union(pairs.select("other", "word", "n"))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = both.groupBy(F.col("word").alias("near_of")).agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.select("word", "n").join(near, F.col("word") == F.col("near_of"), "left")
    common = -F.col("best.less") >= ratio * F.col("n")
    stats = written(
        joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(common, F.col("best.form")).alias("form"), F.when(common, -F.col("best.less")).alias("form_n")),
        "spelling-forms",
    )
    ends = roots(stats.where("form is not null")).withColumnRenamed("word", "of")
    return stats.join(ends, F.col("word") == F.col("of"), "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all ``documents``, with one letter missing from the runs that the checksum picks."""
    words = written(word_counts(table(spark, sf_dir, "documents"), typo_every=TYPO_EVERY), "words")
    return variants(words)


#: Checksums are the usual reflected ones; the polynomial is a fixed value. All letters beyond ASCII are two bytes in UTF-8.
SQL = """
WITH RECURSIVE steps AS (
  SELECT list(v ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(3988292384::BIGINT, a >> 1) ELSE a >> 1 END, i::BIGINT) AS v
    FROM range(256) r(i))
), found AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00C0-\u00FF]+')) AS run
  FROM documents
), counted AS (
  SELECT id, run, count(*) AS n FROM found WHERE length(run) >= 5 GROUP BY id, run
), summed AS (
  SELECT run, n, xor(list_reduce(
      flatten(list_transform(string_split(id || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END)),
      lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h
  FROM counted, steps
), typed AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM summed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), less AS (
  SELECT DISTINCT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM words, range(1000) r(i) WHERE i < length(word)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n FROM near GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * w.n THEN form END AS form, CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), ends AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL
  SELECT e.word, f.word, f.form FROM ends e JOIN formed f ON e.next = f.word
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, e.root FROM formed f JOIN ends e ON f.word = e.word AND e.next IS NULL
"""

QUERIES = {"op12_spelling_variants": (op12_spelling_variants, SQL)}
