"""Language identification with interpolated Kneser-Ney character models.

One model per language, order ``ORDER``, on folded characters (lower case; digits and other non-letters become one
blank). All models live in one sorted array of 64-bit n-gram keys per order, with a column of log-probabilities per
language. A text is scored on all its characters: every language's cross-entropy is divided by the number of
characters, and the lowest wins. ``score`` is the winner's posterior from a softmax whose temperature is calibrated on
learning rows that the models did not see; ``accepted`` is false where the cross-entropy lies above what nearly all
of those rows stay below (text unlike every known language).

Learning reads at most ``ROWS_PER_LANGUAGE`` labelled rows per language, those with the smallest hash of the text; this
bound makes the model's size independent of the corpus. Scoring reads every row. A text that is null or has no letter
is ``und`` with score 0. With nothing to learn from, every text is ``und``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverlode.llm.common import batches_of, schema_of, table, utf8
from silverlode.session import ensure_checkpoints

ORDER = 4
ROWS_PER_LANGUAGE = 600
BLANK = 1
DISCOUNT = 0.75
QUANTILE = 0.995


def _fold_table() -> np.ndarray:
    """Code point -> folded 16-bit symbol: lower-case letter, or the blank."""
    out = np.full(0x10000, BLANK, np.uint16)
    for code in range(0x10000):
        c = chr(code)
        if c.isalpha() or unicodedata.category(c).startswith("M"):
            low = c.lower()
            out[code] = ord(low) if len(low) == 1 and ord(low) < 0x10000 else code
    return out


_TABLES: list[np.ndarray] = []  # folded symbols, letters


def folded(raw: bytes) -> np.ndarray:
    """Symbols of a UTF-8 text, runs of blanks as one, a blank before and after; empty without a letter."""
    if not _TABLES:
        _TABLES.extend([_fold_table(), np.array([chr(c).isalpha() for c in range(0x10000)])])
    fold, letter = _TABLES
    points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    if len(points) and points.max() > 0xFFFF:
        high = points > 0xFFFF
        letters = np.array([chr(c).isalpha() for c in points[high].tolist()], bool)
        worded = letters.any()
        points = points.copy()
        points[high] = np.where(letters, 0xE000 + points[high] % 0x1900, 0)
        worded |= letter[points].any()
        symbols = fold[points]
        symbols[high] = np.where(letters, points[high], BLANK)
    else:
        worded, symbols = letter[points].any(), fold[points]
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != BLANK) | (symbols[:-1] != BLANK)
    symbols = symbols[keep]
    if not worded:
        return symbols[:0]
    return np.concatenate([[BLANK], symbols[int(symbols[0] == BLANK) :], [BLANK] * int(symbols[-1] != BLANK)]).astype(np.uint64)


def grams(symbols: np.ndarray, order: int) -> np.ndarray:
    """Keys of the n-grams that end at each symbol but the first; the start is filled with blanks."""
    padded = np.concatenate([np.full(order - 2, BLANK, np.uint64), symbols]) if order > 2 else symbols
    n = len(symbols) - 1
    out = np.zeros(n, np.uint64)
    for i in range(order):
        out = (out << np.uint64(16)) | padded[len(padded) - n - order + 1 + i : len(padded) - order + 1 + i]
    return out


class Model:
    """Sorted n-gram keys of the highest order and of each lower one, with log-probabilities per language.

    ``tables[k]`` is (keys, logs) for order k+1. An n-gram that a language lacks falls back to that language's
    interpolation weight of the context times the lower order, so ``weights[k]`` is (context keys, logs) likewise.
    """

    def __init__(self, languages: list[str], counts: list[tuple[np.ndarray, np.ndarray]], order: int = ORDER):
        self.languages, self.order = languages, order
        self.temperature, self.limit = 1.0, float("inf")
        n = len(languages)
        symbols = np.unique(np.concatenate([np.unique(k & np.uint64(0xFFFF)) for k, _ in counts])) if n else np.empty(0, np.uint64)
        self.floor = -np.log(len(symbols) + 1.0)
        per_order: list[list[tuple[np.ndarray, np.ndarray]]] = []
        for keys, number in counts:
            rows = [(keys, number)]
            for k in range(order - 1, 0, -1):  # continuation counts: different symbols before the shorter n-gram
                rows.append(np.unique(rows[-1][0] & np.uint64((1 << 16 * k) - 1), return_counts=True))
            per_order.append(rows[::-1])
        self.tables, self.weights = [], []
        for k in range(order):
            keys = np.unique(np.concatenate([r[k][0] for r in per_order])) if n else np.empty(0, np.uint64)
            contexts = np.unique(keys >> np.uint64(16))
            backoff = np.zeros((len(contexts), n), np.float32)
            logs = np.empty((len(keys), n), np.float32)
            at = np.searchsorted(contexts, keys >> np.uint64(16))
            for j in range(n):
                own, number = per_order[j][k]
                count = np.zeros(len(keys))
                count[np.searchsorted(keys, own)] = number
                total = np.bincount(at, count, len(contexts))
                kinds = np.bincount(at, count > 0, len(contexts))
                weight = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
                lower = self._logs(keys & np.uint64((1 << 16 * k) - 1), k)[:, j] if k else np.full(len(keys), self.floor)
                share = np.where(total[at] > 0, np.maximum(count - DISCOUNT, 0) / np.maximum(total[at], 1), 0.0)
                logs[:, j] = np.log(share + weight[at] * np.exp(lower))
                backoff[:, j] = np.log(weight)
            self.tables.append((keys, logs))
            self.weights.append((contexts, backoff))

    def _logs(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Log-probability of n-grams of an order, per language."""
        if order == 0:
            return np.full((len(keys), len(self.languages)), self.floor, np.float32)
        known, logs = self.tables[order - 1]
        at = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
        out = logs[at] if len(known) else np.zeros((len(keys), len(self.languages)), np.float32)
        miss = known[at] != keys if len(known) else np.ones(len(keys), bool)
        if miss.any():
            contexts, backoff = self.weights[order - 1]
            context = keys[miss] >> np.uint64(16)
            place = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            weight = np.where((contexts[place] == context)[:, None], backoff[place], 0)
            out[miss] = weight + self._logs(keys[miss] & np.uint64((1 << 16 * (order - 1)) - 1), order - 1)
        return out

    def entropies(self, symbols: np.ndarray) -> np.ndarray:
        """Cross-entropy per character, in nats, for each language."""
        keys, number = np.unique(grams(symbols, self.order), return_counts=True)
        return -(number @ self._logs(keys, self.order)) / (len(symbols) - 1)

    def posterior(self, entropies: np.ndarray) -> np.ndarray:
        x = -entropies * self.temperature
        x = np.exp(x - x.max(-1, keepdims=True))
        return x / x.sum(-1, keepdims=True)

    def calibrate(self, entropies: np.ndarray, truth: np.ndarray) -> None:
        """Temperature with the best log-likelihood, and the limit that nearly all true entropies stay below."""
        if not len(truth):
            return
        scores = []
        for t in np.geomspace(0.5, 200, 40):
            self.temperature = float(t)
            scores.append((-np.log(np.maximum(self.posterior(entropies)[np.arange(len(truth)), truth], 1e-12)).mean(), self.temperature))
        self.temperature = min(scores)[1]
        self.limit = float(np.quantile(entropies[np.arange(len(truth)), truth], QUANTILE))


def bucket(column: str, modulus: int = 3) -> Column:
    """Hash class of an id; null is in class 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus)), F.lit(0))


def learn(rows: DataFrame, text: str = "text", lang: str = "lang", rows_per_language: int = ROWS_PER_LANGUAGE, order: int = ORDER) -> Model:
    """Fit on a bounded sample of labelled rows; one in eight of them calibrates."""
    spark = rows.sparkSession
    ensure_checkpoints(spark)
    raw = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.xxhash64(text).alias("h"), F.col(text).cast("binary").alias("raw"))
    # The same text (a group of copies) is drawn once.
    different = raw.select("lang", "h").distinct()
    share = 3.0 * rows_per_language / F.col("n")  # of the hash range; three times what is wanted, whatever the language's size
    low = different.join(F.broadcast(different.groupBy("lang").agg(F.count("*").alias("n"))), "lang").where((F.col("h") + 2.0**63) / 2.0**64 < share)
    order_by = Window.partitionBy("lang").orderBy("h")
    hashes = low.withColumn("n", F.row_number().over(order_by)).where(F.col("n") <= rows_per_language).select("lang", "h")
    picked = raw.join(F.broadcast(hashes), ["lang", "h"], "left_semi")  # rows_per_language keys per language
    picked = picked.dropDuplicates(["lang", "h"]).checkpoint()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang_, h, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                symbols = folded(x)
                if len(symbols) > 1 and h % 8:
                    keys, number = np.unique(grams(symbols, order), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang_] * len(keys)), pa.array(keys.view(np.int64)), pa.array(number)], names=["lang", "gram", "n"])

    grouped = picked.select("lang", "h", "raw").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(grouped["lang"].unique())
    counts = []
    for name in languages:
        own = grouped[grouped["lang"] == name]
        keys = own["gram"].to_numpy(np.int64).view(np.uint64)
        place = np.argsort(keys)
        counts.append((keys[place], own["n"].to_numpy(np.int64)[place]))
    model = Model(languages, counts, order)
    if languages:
        unseen = [(r.lang, folded(bytes(r.raw))) for r in picked.where(F.col("h") % 8 == 0).select("lang", "raw").toLocalIterator()]
        unseen = [(a, b) for a, b in unseen if a in languages and len(b) > 1]
        if unseen:
            model.calibrate(np.array([model.entropies(b) for _, b in unseen]), np.array([languages.index(a) for a, _ in unseen]))
    return model


def identify(docs: DataFrame, model: Model, ids: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """Ids, ``lang_pred``, ``score``, ``entropy`` (nats per character) and ``accepted``."""
    ids = list(ids)
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by rows_per_language
    fields = [("lang_pred", pa.string()), ("score", pa.float64()), ("entropy", pa.float64()), ("accepted", pa.bool_())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            rows = []
            for x in batch.column(len(ids)).to_pylist():
                symbols = folded(x)
                if len(symbols) < 2 or not known.languages:
                    rows.append(("und", 0.0, None, False))
                    continue
                entropies = known.entropies(symbols)
                j = int(entropies.argmin())
                rows.append((known.languages[j], float(known.posterior(entropies)[j]), float(entropies[j]), bool(entropies[j] <= known.limit)))
            yield batches_of([list(x) for x in zip(*rows, strict=True)] if rows else [[]] * 4, batch, ids, fields)

    return docs.select(*ids, utf8(text).alias("raw")).mapInArrow(run, schema_of(docs, ids, "lang_pred string, score double, entropy double, accepted boolean"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every row of ``documents``, learned from rows outside the held-out third."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(bucket("doc_id") != 1))
    return identify(docs, model).withColumn("held_out", bucket("doc_id") == 1).select("doc_id", "held_out", "lang_pred", "score", "entropy", "accepted")


QUERIES = {"op7_language_id": (op7_language_id, None)}
