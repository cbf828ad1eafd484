"""Language-model scores by context-tree weighting, and by word counts.

The model codes bytes. A byte is eight binary decisions; a decision is a node of the byte's binary tree under a context,
the preceding bytes. For each decision, Krichevsky-Trofimov estimates of all context depths from 0 to ``DEPTH`` are
mixed: a node's weighted probability is the mean of its own estimate and of the product of its children's, and so the
evidence of the learning texts decides, context by context, how deep to look. Scored texts do not change the model.

What is coded is the text's words in ASCII lower case, joined by blanks and closed by a line feed (the end token).

Distribution. Texts are dealt to chunks of about ``chunk_bytes`` by a hash. A chunk sends each different word and each
different (context, byte) once, with its count in learning texts, as sorted arrays split by buckets of the key; a bucket
sums the counts of all chunks. Buckets of contexts go by the two nearest bytes, so all nodes below depth 2 are local to
one bucket; the two topmost levels have 255 * 257 nodes at most, which are summed from all buckets and sent to each. Every
bucket then answers each chunk's question in the order in which it was asked, and chunks add up their texts. Nothing
grows with the corpus on the driver or in a broadcast; group sizes are set by ``chunk_bytes``, whatever source or
text repeats. Statistics cover all learning texts, and their number grows with the corpus.

A null text counts as empty: one end token. Rows whose id is null are learned from. Repeated rows count each. Without
learning texts every decision has probability one half. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import chain
from math import lgamma

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from silverlode.llm.common import from_planes, mixed, planes, table, utf8

DEPTH = 5
CHUNK_BYTES = 4_000_000
END = b"\n"
_SMALL = np.array([lgamma(n + 0.5) for n in range(4096)])
_SMALL_1 = np.array([lgamma(n + 1.0) for n in range(8192)])


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series; exact enough from 100 on."""
    return (x - 0.5) * np.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x**3)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""

    def half(n: np.ndarray) -> np.ndarray:
        return np.where(n < 4096, _SMALL[np.minimum(n, 4095)], _log_gamma(np.maximum(n, 100) + 0.5))

    total = zeros + ones
    whole = np.where(total < 8192, _SMALL_1[np.minimum(total, 8191)], _log_gamma(np.maximum(total, 100) + 1.0))
    return half(zeros) + half(ones) - whole - np.log(np.pi)


def words_of(raw: bytes) -> list[bytes]:
    return raw.lower().split()


def keys_of(bodies: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, byte) keys of all bytes of the bodies, nearest context byte first, and the bodies' lengths."""
    lead = END * depth
    buffer = np.frombuffer(lead + lead.join(bodies), np.uint8)
    sizes = np.array([len(x) for x in bodies], np.int64)
    ends = np.cumsum(sizes + depth)
    inside = np.ones(len(buffer), bool)
    starts = ends - sizes - depth
    inside[(starts[:, None] + np.arange(depth)).ravel()] = False
    key = np.zeros(len(buffer) - depth, np.uint64)
    for back in range(1, depth + 1):
        key = (key << np.uint64(8)) | buffer[depth - back : len(buffer) - back]
    key = (key << np.uint64(8)) | buffer[depth:]
    return key[inside[depth:]], sizes


class Level:
    """The nodes of one context depth for one bit of the byte: counts and weights, ordered by node."""

    def __init__(self, nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray):
        self.nodes, self.zeros, self.ones = nodes, zeros, ones
        self.own = log_estimate(zeros, ones)


def levels_of(keys: np.ndarray, counts: np.ndarray, depth: int, top: int) -> tuple[list[list[Level]], list[list[np.ndarray]]]:
    """``[d - top][bit]`` for context depths ``top..depth``: levels with counts, and each key's node position there."""
    levels, places = [], []
    for d in range(top, depth + 1):
        short = ((keys >> np.uint64(8 * (depth - d + 1))) << np.uint64(8)) | (keys & np.uint64(255))
        pairs, back = np.unique(short, return_inverse=True)
        sums = np.bincount(back, counts, len(pairs)).astype(np.int64)
        row, at = [], []
        for bit in range(8):
            node = pairs >> np.uint64(8 - bit)
            first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else np.empty(0, np.int64)
            one = ((pairs >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.int64)
            total = np.add.reduceat(sums, first) if len(first) else sums
            ones = np.add.reduceat(sums * one, first) if len(first) else sums
            row.append(Level(node[first], total - ones, ones))
            at.append((np.cumsum(np.r_[True, node[1:] != node[:-1]]) - 1)[back] if len(node) else back)
        levels.append(row)
        places.append(at)
    return levels, places


def _parent(nodes: np.ndarray, bit: int) -> np.ndarray:
    """Node number one context byte shorter."""
    mask = np.uint64((1 << bit) - 1)
    return ((nodes >> np.uint64(bit + 8)) << np.uint64(bit)) | (nodes & mask)


def weigh(levels: list[list[Level]]) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """Per level: logarithm of the weighted probability, and of the product of the children's (deepest: none)."""
    out: list[list[tuple[np.ndarray, np.ndarray]]] = []
    for d in range(len(levels) - 1, -1, -1):
        row = []
        for bit, level in enumerate(levels[d]):
            if d == len(levels) - 1:
                row.append((level.own, np.full(len(level.own), -np.inf)))
                continue
            below = levels[d + 1][bit]
            at = np.searchsorted(level.nodes, _parent(below.nodes, bit))
            product = np.bincount(at, out[0][bit][0], len(level.nodes))
            row.append((np.logaddexp(level.own, product) - np.log(2), product))
        out.insert(0, row)
    return out


def descend(share: np.ndarray, left: np.ndarray, level: Level, product: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Add a depth to the mixture: probability of a one so far, and the weight left for deeper contexts."""
    weight = np.ones(len(level.own)) if last else 1 / (1 + np.exp(np.clip(product - level.own, -700, 700)))
    estimate = (level.ones + 0.5) / (level.zeros + level.ones + 1.0)
    return share + left * weight * estimate, left * (1 - weight)


def top_sums(keys: np.ndarray, counts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of depth 1 (nearest byte * 256 + node of the byte's tree): zeros, ones, log product of the nodes below."""
    levels, _ = levels_of(keys, counts, depth, 2)
    weighted = weigh(levels)
    parts = []
    for bit, level in enumerate(levels[0]):
        parent = _parent(level.nodes, bit)
        number = (parent >> np.uint64(bit)) * np.uint64(256) + (np.uint64(1 << bit) | (parent & np.uint64((1 << bit) - 1)))
        parts.append((number.astype(np.int64), level.zeros, level.ones, weighted[0][bit][0]))
    node, zeros, ones, log = (np.concatenate(x) for x in zip(*parts, strict=True))
    found, at = np.unique(node, return_inverse=True)
    return found, *(np.bincount(at, x, len(found)) for x in (zeros, ones, log))


def top_mixture(node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, product: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For depth 1 nodes, as dense arrays of 256 * 256: probability of a one so far, and the weight left."""
    share, left = np.zeros(65536), np.ones(65536)
    zeros, ones = zeros.astype(np.int64), ones.astype(np.int64)
    first = Level(node, zeros, ones)
    root = Level(np.arange(256), *(np.bincount(node & 255, x, 256).astype(np.int64) for x in (zeros, ones)))
    weighted = np.logaddexp(first.own, product) - np.log(2)
    r_share, r_left = descend(np.zeros(256), np.ones(256), root, np.bincount(node & 255, weighted, 256), False)
    share[node], left[node] = descend(r_share[node & 255], r_left[node & 255], first, product, False)
    return share, left


def log_probabilities(keys: np.ndarray, counts: np.ndarray, depth: int, share: np.ndarray, left: np.ndarray) -> np.ndarray:
    """log10 of the probability of each key's byte in its context. Keys must be all of their nearest two bytes."""
    levels, places = levels_of(keys, counts, depth, 2)
    weighted = weigh(levels)
    out = np.zeros(len(keys))
    for bit in range(8):
        for d, row in enumerate(levels):
            level = row[bit]
            parent = _parent(level.nodes, bit)
            if d == 0:
                at = ((parent >> np.uint64(bit)) * np.uint64(256) + (np.uint64(1 << bit) | (parent & np.uint64((1 << bit) - 1)))).astype(np.int64)
                now = share[at], left[at]
            else:
                at = np.searchsorted(levels[d - 1][bit].nodes, parent)
                now = now[0][at], now[1][at]
            now = descend(*now, level, weighted[d][bit][1], d == len(levels) - 1)
        one = now[0][places[-1][bit]]
        out += np.log10(np.where((keys >> np.uint64(7 - bit)) & np.uint64(1), one, 1 - one))
    return out


def _bucket_of_keys(keys: np.ndarray, depth: int, buckets: int) -> np.ndarray:
    return (mixed(keys >> np.uint64(8 * (depth - 1))) % np.uint64(buckets)).astype(np.int64)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])]


def looked_up(keys: np.ndarray, known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``values`` at each key's place in ``known`` (sorted, complete): short runs are sorted, and each key sought once."""
    out, run = np.empty(len(keys), values.dtype), 1 << 16
    if len(known) and int(known[-1]) >> 48:
        return values[np.searchsorted(known, keys)]
    for a in range(0, len(keys), run):
        part = keys[a : a + run]
        part = np.sort((part << np.uint64(16)) | np.arange(len(part), dtype=np.uint64))
        key = part >> np.uint64(16)
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        value = values[np.searchsorted(known, key[first])]
        out[a + (part & np.uint64(run - 1)).astype(np.int64)] = np.repeat(value, np.diff(np.r_[first, len(key)]))
    return out


def _questions(raws: list[bytes], depth: int, buckets: int) -> tuple:
    """What a chunk asks: its words (in a fixed order), its keys, and which bucket each word belongs to."""
    lists = [[*words_of(x), END] for x in raws]
    n_words = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = pa.array(list(chain.from_iterable(lists)), pa.binary()).dictionary_encode()
    names = flat.dictionary.to_pylist()
    hashes = _hashes(names)
    order = np.argsort(hashes, kind="stable")
    if len(names) and (np.diff(hashes[order]) == 0).any():
        order = np.array(sorted(range(len(names)), key=lambda i: (int(hashes[i]), names[i])))
    rank = np.empty(len(names), np.int64)
    rank[order] = np.arange(len(names))
    slots = rank[flat.indices.to_numpy()]
    names = list(map(names.__getitem__, order.tolist()))
    keys, sizes = keys_of([b" ".join(x[:-1]) + END for x in lists], depth)
    return names, slots, n_words, keys, sizes, (hashes[order] % np.uint64(buckets)).astype(np.int64)


_BLOCKS = "kind string, bucket long, chunk long, keys binary, counts binary"
_NODES = "kind string, node long, zeros long, ones long, product double"
_ANSWERS = "chunk long, kind string, bucket long, answers binary, train_tokens long, vocabulary long"


def _empty(ddl: str) -> pa.Table:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    return pa.table({n: pa.array([], kinds[k]) for n, k in (x.split() for x in ddl.split(", "))})


def _ask(group: pa.Table, depth: int, buckets: int) -> pa.Table:
    raws, learn = group["raw"].to_pylist(), ~group["held_out"].to_numpy(zero_copy_only=False).astype(bool)
    names, slots, n_words, keys, sizes, of_word = _questions(raws, depth, buckets)
    rows: list[tuple] = []
    chunk = group["chunk"][0].as_py()
    number = np.bincount(slots, np.repeat(learn, n_words), len(names)).astype("<i8")
    order = np.argsort(of_word, kind="stable")
    cuts = np.searchsorted(of_word[order], np.arange(buckets + 1))
    for b in range(buckets):
        mine = order[cuts[b] : cuts[b + 1]]
        if len(mine):
            # Words hold no line feed; the end token is one, and is sent as an empty word.
            rows.append(("word", b, chunk, b"\n".join(names[i].rstrip(END) for i in mine), planes(number[mine])))
    marked = np.sort((keys << np.uint64(1)) | np.repeat(learn, sizes).astype(np.uint64))
    flat = marked >> np.uint64(1)
    first = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    different, learned = flat[first], np.add.reduceat((marked & np.uint64(1)).astype(np.int64), first)
    of_key = _bucket_of_keys(different, depth, buckets)
    order = np.argsort(of_key, kind="stable")
    cuts = np.searchsorted(of_key[order], np.arange(buckets + 1))
    for b in range(buckets):
        mine = order[cuts[b] : cuts[b + 1]]
        if len(mine):
            steps = np.diff(different[mine], prepend=np.uint64(0))  # small numbers compress
            rows.append(("byte", b, chunk, planes(steps.astype("<u8")), planes(learned[mine].astype("<u4"))))
    return pa.table(dict(zip(("kind", "bucket", "chunk", "keys", "counts"), map(list, zip(*rows, strict=True)), strict=True)), schema=_empty(_BLOCKS).schema)


def _byte_blocks(blocks: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, list[np.ndarray]]:
    asked = [np.cumsum(from_planes(x, "<u8")) for x in blocks["keys"].to_pylist()]
    counts = np.concatenate([from_planes(x, "<u4") for x in blocks["counts"].to_pylist()])
    keys, at = np.unique(np.concatenate(asked), return_inverse=True)
    sizes = np.cumsum([len(x) for x in asked])[:-1]
    return asked, keys, np.bincount(at, counts, len(keys)).astype(np.int64), np.split(at, sizes)


def _word_blocks(blocks: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    asked = [x.split(b"\n") for x in blocks["keys"].to_pylist()]
    flat = pa.array([w for x in asked for w in x], pa.binary()).dictionary_encode()
    counts = np.concatenate([from_planes(x, "<i8") for x in blocks["counts"].to_pylist()])
    at = flat.indices.to_numpy()
    return np.bincount(at, counts, len(flat.dictionary)).astype(np.int64), np.split(at, np.cumsum([len(x) for x in asked])[:-1])


def _summarise(blocks: pa.Table, depth: int) -> pa.Table:
    kind = blocks["kind"][0].as_py()
    if kind == "word":
        sums, _ = _word_blocks(blocks)
        node, zeros, ones, product = np.zeros(1, np.int64), [int((sums > 0).sum())], [int(sums.sum())], np.zeros(1)
    else:
        _, keys, counts, _ = _byte_blocks(blocks)
        node, zeros, ones, product = top_sums(keys, counts, depth)
    columns = [[kind] * len(node), node, np.asarray(zeros, np.int64), np.asarray(ones, np.int64), product]
    return pa.table(dict(zip(("kind", "node", "zeros", "ones", "product"), columns, strict=True)))


def _tops(nodes: pa.Table) -> pa.Table:
    """One row: totals of the words, and the mixture of the two topmost depths."""
    kind = np.array(nodes["kind"].to_pylist())
    node, zeros, ones, product = (nodes[c].to_numpy() for c in ("node", "zeros", "ones", "product"))
    byte, word = kind == "byte", kind == "word"
    share, left = top_mixture(node[byte], zeros[byte], ones[byte], product[byte])
    return pa.table({"one": [0], "train_tokens": [int(ones[word].sum())], "vocabulary": [int(zeros[word].sum())], "share": [share.tobytes()], "left": [left.tobytes()]})


def _answer(blocks: pa.Table, tops: pa.Table, depth: int) -> pa.Table:
    if not blocks.num_rows or not tops.num_rows:
        return _empty(_ANSWERS)
    kind, n = blocks["kind"][0].as_py(), blocks.num_rows
    if kind == "word":
        sums, places = _word_blocks(blocks)
        answers = [planes(sums[at].astype("<i8")) for at in places]
    else:
        _, keys, counts, places = _byte_blocks(blocks)
        share, left = (np.frombuffer(tops[c][0].as_py(), float) for c in ("share", "left"))
        logs = log_probabilities(keys, counts, depth, share, left)
        answers = [planes(logs[at].astype("<f4")) for at in places]
    totals = [[tops[c][0].as_py()] * n for c in ("train_tokens", "vocabulary")]
    return pa.table(dict(zip((x.split()[0] for x in _ANSWERS.split(", ")), [blocks["chunk"], blocks["kind"], blocks["bucket"], answers, *totals], strict=True)), schema=_empty(_ANSWERS).schema)


def _score(group: pa.Table, answers: pa.Table, ids: list[str], depth: int, buckets: int, schema: pa.Schema) -> pa.Table:
    if not group.num_rows:
        return schema.empty_table()
    names, slots, n_words, keys, sizes, of_word = _questions(group["raw"].to_pylist(), depth, buckets)
    got = {(k, b): x for k, b, x in zip(*(answers[c].to_pylist() for c in ("kind", "bucket", "answers")), strict=True)}
    n, v = answers["train_tokens"][0].as_py(), answers["vocabulary"][0].as_py()

    def gather(kind: str, bucket: np.ndarray, dtype: str) -> np.ndarray:
        out = np.empty(len(bucket), dtype)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in np.unique(bucket).tolist():
            out[order[cuts[b] : cuts[b + 1]]] = from_planes(got[kind, b], dtype)
        return out

    count = gather("word", of_word, "<i8")
    base = np.log10((count + 0.1) / (n + 0.1 * (v + 1)))
    different = distinct(keys)
    logs = gather("byte", _bucket_of_keys(different, depth, buckets), "<f4").astype(float)
    per_byte = looked_up(keys, different, logs)
    word_starts, byte_starts = np.cumsum(n_words) - n_words, np.cumsum(sizes) - sizes
    score = np.add.reduceat(per_byte, byte_starts)
    columns = {
        "n_tokens": n_words,
        "n_known": np.add.reduceat((count > 0).astype(np.int64)[slots], word_starts),
        "train_tokens": np.full(len(sizes), n, np.int64),
        "base_score": np.add.reduceat(base[slots], word_starts),
        "score": score,
        "n_bytes": sizes,
        "bits_per_byte": -score / np.log10(2) / sizes,
    }
    arrays = [group[c].combine_chunks() for c in [*ids, "held_out"]] + [pa.array(x) for x in columns.values()]
    return pa.Table.from_arrays(arrays, schema=schema)


def score(docs: DataFrame, held_out: Column, ids: tuple[str, ...] = ("doc_id",), text: str = "text", depth: int = DEPTH, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Ids, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` (both log10), ``n_bytes``, ``bits_per_byte``.

    Rows where ``held_out`` is true are scored but not learned from.
    """
    if not 2 <= depth <= 6:
        raise ValueError("depth must be 2 to 6")
    ids = list(ids)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = int(size // chunk_bytes + 1)
    buckets = max(4, min(chunks // 2, 4096))
    row_hash = F.xxhash64(*ids, text)
    rows = docs.select(*ids, F.coalesce(held_out, F.lit(False)).alias("held_out"), utf8(text).alias("raw"), F.pmod(row_hash, F.lit(chunks)).alias("chunk"))
    out = T.StructType([*(rows.schema[c] for c in [*ids, "held_out"]), *T.StructType.fromDDL("n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double").fields])
    arrow = to_arrow_schema(out)
    blocks = rows.groupBy("chunk").applyInArrow(lambda g: _ask(g, depth, buckets), _BLOCKS)
    nodes = blocks.groupBy("kind", "bucket").applyInArrow(lambda g: _summarise(g, depth), _NODES)
    nodes = nodes.groupBy("kind", "node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("product").alias("product"))
    tops = nodes.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(lambda g: _tops(g), "one long, train_tokens long, vocabulary long, share binary, left binary")
    each = tops.select(F.explode(F.array(F.lit("word"), F.lit("byte"))).alias("kind"), "train_tokens", "vocabulary", "share", "left")
    each = each.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))).alias("bucket"), "*")
    answers = blocks.groupBy("kind", "bucket").cogroup(each.groupBy("kind", "bucket")).applyInArrow(lambda a, b: _answer(a, b, depth), _ANSWERS)
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(lambda a, b: _score(a, b, ids, depth, buckets, arrow), out)


def op1_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every row of ``documents``; a tenth by the hash of the id is held out of learning."""
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) == 0
    return score(table(spark, sf_dir, "documents"), held_out)


QUERIES = {"op1_tree_weighting": (op1_tree_weighting, None)}
