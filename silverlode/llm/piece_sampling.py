"""Sampled subword segmentations without replacement, by Gumbel top-k search, and decoding.

A text's segmentations into pieces of a vocabulary form a lattice. Pieces have probabilities, hence so have the
segmentations; every one gets a Gumbel-perturbed log-probability, and the ``k`` with the highest are a sample of ``k``
different segmentations without replacement. They are found top-down without looking at the others: the best value in
the whole lattice is one Gumbel draw, the path that has it is drawn edge by edge, and at each of its steps the paths that
leave it there are a subspace whose best value is a Gumbel draw of the subspace's mass, truncated at the value above. The
search then opens the subspace with the highest best value (an A* search whose bounds are exact), draws the path that
has it, and splits that subspace the same way. The next best value after ``k`` paths is the threshold for the
probability that a path is in such a sample (inclusion score).

Pieces never hold a blank but at their start, so the lattice is a chain of the lattices of blank-led units; equal units of
a batch are built once. All draws are hashes of (seed, row key, sample, unit, step): the result depends on the row
alone, not on batches or partitions.

The vocabulary's scores are merge ranks, not log-probabilities; a piece of rank r gets a weight of
``(r + OFFSET) ** -POWER``. Characters that are no piece are spelled in byte pieces, which have the least weight.

Null and empty texts have one segmentation, the empty one. A text with fewer than ``k`` segmentations has fewer rows.
Repeated rows (same key and text) have the same samples. U+2581 in a text counts as a blank, as in the vocabulary.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm.common import STEP, mixed, slices, table, utf8

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
UNIT = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
OFFSET, POWER = 2.7, 1.0
BATCH_BYTES = 4_000_000
_ODD = np.uint64(0x2545F4914F6CDD1D)
_SPELLED = 1 << 24


class Vocabulary:
    """Pieces by length as sorted hashes, with log-weights."""

    def __init__(self, model: str = MODEL):
        import public_tokenizers
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=model if "/" in model else public_tokenizers.path(model))
        size = processor.get_piece_size()
        self.pieces = [processor.id_to_piece(i) for i in range(size)]
        self.byte_ids = np.array([processor.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        # As decoded: byte pieces are their byte, those beyond ASCII as an escape that UTF-8 turns into the byte.
        self.shown = [x.replace(BLANK, " ") for x in self.pieces]
        for b, i in enumerate(self.byte_ids.tolist()):
            self.shown[i] = chr(b) if b < 128 else chr(0xDC00 + b)
        plain = [i for i in range(size) if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i) or processor.is_unused(i))]
        if any(BLANK in self.pieces[i].lstrip(BLANK) for i in plain):
            raise ValueError("a piece holds a blank after its start")
        rank = {i: r for r, i in enumerate(sorted(plain, key=lambda i: (-processor.get_score(i), i)))}
        norm = np.log(sum((r + OFFSET) ** -POWER for r in range(len(plain) + 1)))
        self.byte_weight = float(-POWER * np.log(len(plain) + OFFSET) - norm)
        self.longest = max(len(self.pieces[i]) for i in plain)
        self.by_length = []
        self.longer = np.zeros((self.longest + 1, 1 << 18), bool)  # by length: whether a longer piece may begin so
        for n in range(1, self.longest + 1):
            ids = np.array([i for i in plain if len(self.pieces[i]) == n], np.int64)
            codes = np.frombuffer("".join(self.pieces[i] for i in ids).encode("utf-32-le"), np.uint32).reshape(len(ids), n) if len(ids) else np.empty((0, n), np.uint32)
            hashes = piece_hashes(codes.ravel(), np.arange(len(ids)) * n, n) if len(ids) else np.empty(0, np.uint64)
            for m in range(1, n if len(ids) else 1):
                self.longer[m, (piece_hashes(codes.ravel(), np.arange(len(ids)) * n, m) >> np.uint64(46)).astype(np.int64)] = True
            order = np.argsort(hashes)
            weights = np.array([-POWER * np.log(rank[i] + OFFSET) - norm for i in ids])
            seen = np.zeros(1 << 18, bool)
            seen[(hashes >> np.uint64(46)).astype(np.int64)] = True
            self.by_length.append((hashes[order], ids[order].astype(np.int32), weights[order], seen))

    def decode(self, ids: list[int]) -> str:
        """The text of piece ids; a leading blank was added by the encoder and goes."""
        text = "".join(map(self.shown.__getitem__, ids))
        if not text.isascii():
            text = text.encode("utf-8", "surrogateescape").decode("utf-8", "replace").replace(BLANK, " ")
        return text[1:] if text[:1] == " " else text


def units(text: str) -> list[str]:
    """A text's units without their first blank, which each of them has (the text's first one is added)."""
    if not text:
        return []
    if BLANK in text or "  " in text or text[0] == " " or text[-1] == " ":
        return [x[1:] for x in UNIT.findall(BLANK + text.replace(" ", BLANK))]
    return text.split(" ")


def piece_hashes(codes: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for i in range(length):
        out = (out + codes[at + i].astype(np.uint64) + np.uint64(1)) * _ODD
    return mixed(out)


def _salted(keys: np.ndarray, sample: int) -> np.ndarray:
    return mixed(keys + np.uint64(sample * int(STEP) & 0xFFFFFFFFFFFFFFFF))


class Lattice:
    """Lattices of different units, one after another; position = character.

    The edges that leave position p are ``first[p]`` to ``first[p + 1]``, by length: ``length``, ``piece`` (spelled
    characters: ``_SPELLED`` + code point), ``log`` (log-probability of leaving by this edge). ``upto[p]`` has the
    cumulative probabilities of p's edges.
    """

    def __init__(self, units: list[str], vocabulary: Vocabulary):
        codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        self.end = np.cumsum(sizes)
        self.start = self.end - sizes
        n, width = len(codes), vocabulary.longest
        left = (np.repeat(self.end, sizes) - np.arange(n)).astype(np.int32)  # characters to the unit's end
        found: list[tuple[np.ndarray, ...]] = []  # per length: source, rank among its edges, piece, weight
        hashes, at = np.zeros(n, np.uint64), np.arange(n, dtype=np.int32)
        self.degree = np.zeros(n, np.int32)
        for length in range(1, width + 1):
            if length > 1:
                on = np.flatnonzero(vocabulary.longer[length - 1][slot] & (left[at] >= length))
                at, hashes = at[on], hashes[on]
            if not len(at):
                break
            hashes = (hashes + codes[at + (length - 1)].astype(np.uint64) + np.uint64(1)) * _ODD
            known, ids, weight, seen = vocabulary.by_length[length - 1]
            key = mixed(hashes)
            slot = (key >> np.uint64(46)).astype(np.int64)
            if len(known):
                some = np.flatnonzero(seen[slot])
                key = key[some]
                place = np.minimum(np.searchsorted(known, key), len(known) - 1)
                hit = np.flatnonzero(known[place] == key)
                source, place = at[some[hit]], place[hit]
                found.append((source, self.degree[source], ids[place], weight[place], length))
                self.degree[source] += 1
            if length == 1:
                source = np.flatnonzero(self.degree == 0).astype(np.int32)
                code = codes[source].astype(np.int32)
                piece = np.where(code < 128, vocabulary.byte_ids[np.minimum(code, 127)], _SPELLED + code).astype(np.int32)
                found.append((source, self.degree[source], piece, (1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)) * vocabulary.byte_weight, 1))
                self.degree[source] = 1
        self.first = np.r_[0, np.cumsum(self.degree, dtype=np.int64)]
        edges = int(self.first[-1])
        source, self.piece, weight, self.length = np.empty(edges, np.int32), np.empty(edges, np.int32), np.empty(edges), np.empty(edges, np.int32)
        rank = np.empty(edges, np.int32)
        while found:
            of, turn, piece, w, length = found.pop()
            to = self.first[of] + turn
            source[to], rank[to], self.piece[to], weight[to], self.length[to] = of, turn, piece, w, length
        # Mass from each position to the unit's end, from the back, all units at once.
        mass = np.zeros(n + 1)
        distance = left[source]
        inner = self.length < distance
        order = np.argsort(distance.astype(np.uint16) if n and distance.max() < 1 << 16 else distance, kind="stable")
        cuts = np.r_[np.flatnonzero(np.r_[True, np.diff(distance[order]) > 0]), edges] if edges else [0]
        total = weight
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            e = order[a:b]
            from_ = source[e]
            value = total[e]
            some = np.flatnonzero(inner[e])
            value[some] += mass[from_[some] + self.length[e[some]]]
            total[e] = value
            head = np.flatnonzero(rank[e] == 0)
            top = np.maximum.reduceat(value, head)
            count = np.diff(np.r_[head, len(e)])
            mass[from_[head]] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, count)), head))
        self.log = total - mass[source]
        chance = np.zeros((n, int(self.degree.max(initial=1))), np.float32)
        chance[source, rank] = np.exp(self.log)
        self.upto = np.cumsum(chance, 1)


def uniform(seeds: np.ndarray, number: np.ndarray | int) -> np.ndarray:
    """Hash of (mixed) seeds and numbers as a number in (0, 1)."""
    out = mixed(seeds + (np.asarray(number).astype(np.uint64) + np.uint64(1)) * STEP)
    return ((out >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


class Paths:
    """Paths of some texts, step by step; ``text`` is in order, ``step`` counts within the text."""

    def __init__(self, text: np.ndarray, unit: np.ndarray, place: np.ndarray, edge: np.ndarray, lattice: Lattice):
        self.text, self.unit, self.place, self.edge = text, unit, place, edge
        self.log = lattice.log[edge]
        starts = np.flatnonzero(np.r_[True, text[1:] != text[:-1]]) if len(text) else np.empty(0, np.int64)
        sizes = np.diff(np.r_[starts, len(text)])
        self.rows, self.starts, self.sizes = text[starts], starts, sizes
        self.step = np.arange(len(text)) - np.repeat(starts, sizes)
        upto = np.empty(len(text))
        for a, n in zip(starts.tolist(), sizes.tolist(), strict=True):  # each on its own: sums don't depend on the batch
            np.cumsum(self.log[a : a + n], out=upto[a : a + n])
        self.before = upto - self.log  # log-probability of the steps before
        self.total = upto[starts + sizes - 1] if len(text) else upto


def draw(units: np.ndarray, place: np.ndarray, lattice: Lattice, keys: np.ndarray, number: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Continue units from a place to their end: (index of the unit, place, edge) of each step, in order."""
    who = np.flatnonzero(place < lattice.end[units])
    at, stop = place[who], lattice.end[units[who]]
    begin, seed = lattice.start[units[who]], mixed(keys[who] ^ mixed((number[who].astype(np.uint64) << np.uint64(8)) + np.uint64(sample) + STEP))
    parts: list[tuple[np.ndarray, ...]] = []
    turn = 0
    while len(who):
        u = uniform(seed, at - begin)
        rank = (lattice.upto[at] <= u.astype(np.float32)[:, None]).sum(1)
        edge = lattice.first[at] + np.minimum(rank, lattice.degree[at] - 1)  # sums are rounded
        parts.append((who, np.full(len(who), turn), at, edge))
        at = at + lattice.length[edge]
        live = np.flatnonzero(at < stop)
        who, at, stop, begin, seed = who[live], at[live], stop[live], begin[live], seed[live]
        turn += 1
    if not parts:
        return (np.empty(0, np.int64),) * 3
    who, turn_, at, edge = (np.concatenate(x) for x in zip(*parts, strict=True))
    # Steps to their place: a unit's steps follow one another.
    steps = np.bincount(who, minlength=len(units))
    to = (np.cumsum(steps) - steps)[who] + turn_
    out = tuple(np.empty(len(to), np.int64) for _ in range(3))
    for x, y in zip(out, (who, at, edge), strict=True):
        x[to] = y
    return out


def truncated(mass: np.ndarray, limit: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel draws at ``mass`` (a log-probability) that stay below ``limit``."""
    with np.errstate(over="ignore"):
        return mass - np.log(np.exp(np.minimum(mass - limit, 700)) - np.log(u))


class Subspaces:
    """Subspaces that leave a text's path at its steps, with their best values."""

    def __init__(self, paths: Paths, value: np.ndarray, first: np.ndarray, gone: np.ndarray, lattice: Lattice, keys: np.ndarray, sample: int):
        """``value``, ``first`` and ``gone`` per path: its perturbed log-probability, the step from which it splits its
        subspace, and the edges already left out at that step (bits by rank)."""
        self.paths = paths
        rest = np.log(np.maximum(-np.expm1(np.minimum(paths.log, -1e-15)), 1e-300))
        at_first = paths.starts + first
        self.gone = np.zeros(len(paths.starts), np.int64) | gone
        self.gone |= np.left_shift(np.int64(1), paths.edge[at_first] - lattice.first[paths.place[at_first]])
        some = np.flatnonzero(gone)
        rest[at_first[some]] = _open_mass(lattice, paths.place[at_first[some]], self.gone[some])
        mass = np.where(lattice.degree[paths.place] > 1, paths.before + rest, -np.inf)
        u = uniform(_salted(keys, sample)[paths.text], paths.step + (1 << 40))
        self.best = truncated(mass, np.repeat(value, paths.sizes), u)
        self.best[~np.isfinite(mass)] = -np.inf
        if first.any():
            self.best[paths.step < np.repeat(first, paths.sizes)] = -np.inf
        self.first = first

    def left_out(self, at: np.ndarray, lattice: Lattice) -> np.ndarray:
        """Edges left out (bits by rank) at steps, given by their position; one step per text."""
        p = self.paths
        own = np.left_shift(np.int64(1), p.edge[at] - lattice.first[p.place[at]])
        row = np.searchsorted(p.rows, p.text[at])
        return np.where(p.step[at] == self.first[row], self.gone[row], own)

    def top(self, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """Best value per text (-inf: none), and its step's position in the arrays."""
        best, at = np.full(texts, -np.inf), np.zeros(texts, np.int64)
        if len(self.best):
            most = np.maximum.reduceat(self.best, self.paths.starts)
            hit = np.flatnonzero(self.best == np.repeat(most, self.paths.sizes))[::-1]
            best[self.paths.rows] = most
            at[self.paths.text[hit]] = hit
        return best, at


def _edges(lattice: Lattice, place: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Probabilities of the edges at places (by rank), 0 where left out."""
    rank = np.arange(lattice.upto.shape[1])
    edge = np.minimum(lattice.first[place][:, None] + rank, len(lattice.log) - 1)
    on = (rank < lattice.degree[place][:, None]) & ((gone[:, None] >> rank) & 1 == 0)
    return np.where(on, np.exp(lattice.log[edge]), 0.0)


def _open_mass(lattice: Lattice, place: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Log-probability of the edges that are not left out."""
    with np.errstate(divide="ignore"):
        return np.log(_edges(lattice, place, gone).sum(1))


def sample(texts: list[str], keys: np.ndarray, k: int, vocabulary: Vocabulary, run: int = 100_000) -> list[list[tuple[bytes, float, float, float]]]:
    """For each text up to ``k`` (ids as little-endian unsigned 32-bit, log-probability, perturbed, log-inclusion).

    The texts share one lattice, and are searched in runs of about ``run`` units, whose arrays stay in the processor's cache.
    """
    lists = [units(x) for x in texts]
    flat = pa.array(list(chain.from_iterable(lists)), pa.string()).dictionary_encode()
    kinds = flat.indices.to_numpy().astype(np.int64)
    lattice = Lattice([BLANK + x for x in flat.dictionary.to_pylist()], vocabulary)
    ends = np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))
    out, a = [], 0
    while a < len(texts):
        done = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + run, side="right")))
        out += _search(kinds[done : ends[b - 1]], np.diff(ends[a:b], prepend=done), keys[a:b], k, lattice, vocabulary)
        a = b
    return out


def _search(kinds: np.ndarray, n_units: np.ndarray, keys: np.ndarray, k: int, lattice: Lattice, vocabulary: Vocabulary) -> list[list[tuple[bytes, float, float, float]]]:
    """``sample`` for texts given as their units' numbers in the lattice."""
    texts = range(len(n_units))
    first_unit = np.cumsum(n_units) - n_units
    text = np.repeat(np.arange(len(texts)), n_units)
    number = np.arange(len(kinds)) - np.repeat(first_unit, n_units)
    out: list[list[tuple[bytes, float, float, float]]] = [[] if n else [(b"", 0.0, 0.0, 0.0)] for n in n_units.tolist()]
    if not len(kinds):
        return out
    who, place, edge = draw(kinds, lattice.start[kinds], lattice, keys[text], number, 0)
    paths = Paths(text[who], who, place, edge, lattice)
    value = -np.log(-np.log(uniform(mixed(keys[paths.rows] + STEP), np.full(len(paths.rows), 1 << 42))))
    spaces = [Subspaces(paths, value, np.zeros(len(value), np.int64), np.zeros(len(value), np.int64), lattice, keys, 0)]
    found = [(paths, value)]
    for j in range(1, k + 1):
        tops = [s.top(len(texts)) for s in spaces]
        which = np.argmax([b for b, _ in tops], 0)
        best = np.max([b for b, _ in tops], 0)
        if j == k:
            break
        parts, values, firsts, gones = [], [], [], []
        for s, (space, (_, at)) in enumerate(zip(spaces, tops, strict=True)):
            mine = np.flatnonzero((which == s) & np.isfinite(best))
            if not len(mine):
                continue
            p, at = space.paths, at[mine]
            gone = space.left_out(at, lattice)
            upto = np.cumsum(_edges(lattice, p.place[at], gone), 1)
            u = uniform(_salted(keys[mine], j), p.step[at] + (1 << 41)) * upto[:, -1]
            turn = lattice.first[p.place[at]] + np.minimum((upto <= u[:, None]).sum(1), (np.diff(upto, axis=1, prepend=0) > 0).cumsum(1).argmax(1))
            space.best[at] = -np.inf
            # The path so far, the new edge, the rest of its unit, and the units after it.
            size = np.zeros(len(texts), np.int64)
            size[mine] = p.step[at]
            kept = np.flatnonzero(p.step < size[p.text])
            unit, stop = p.unit[at], p.place[at] + lattice.length[turn]
            rest = draw(kinds[unit], stop, lattice, keys[mine], number[unit], j)
            last = np.full(len(texts), len(kinds))
            last[mine] = unit
            after = np.flatnonzero(np.arange(len(kinds)) > last[text])
            free = draw(kinds[after], lattice.start[kinds[after]], lattice, keys[text[after]], number[after], j)
            units = np.concatenate([p.unit[kept], unit, unit[rest[0]], after[free[0]]])
            places = np.concatenate([p.place[kept], p.place[at], rest[1], free[1]])
            edges = np.concatenate([p.edge[kept], turn, rest[2], free[2]])
            order = np.lexsort((places, units))
            parts.append((text[units[order]], units[order], places[order], edges[order]))
            values.append((mine, best[mine], p.step[at], gone))
        if not parts:
            break
        text_, units, places, edges = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(text_, kind="stable")
        paths = Paths(text_[order], units[order], places[order], edges[order], lattice)
        rows, value, first, gone = (np.concatenate(x) for x in zip(*values, strict=True))
        order = np.argsort(rows)
        spaces.append(Subspaces(paths, value[order], first[order], gone[order], lattice, keys, j))
        found.append((paths, value[order]))
    for paths, value in found:
        ids = lattice.piece[paths.edge].astype(np.int64)
        spelled = np.flatnonzero(ids >= _SPELLED)
        cuts = paths.starts
        if len(spelled):
            data = [chr(c).encode() for c in (ids[spelled] - _SPELLED).tolist()]
            sizes = np.ones(len(ids), np.int64)
            sizes[spelled] = list(map(len, data))
            begin = np.cumsum(sizes) - sizes
            long = np.zeros(int(sizes.sum()), np.int64)
            long[begin] = np.where(ids < _SPELLED, ids, 0)
            for a, d in zip(begin[spelled].tolist(), data, strict=True):
                long[a : a + len(d)] = vocabulary.byte_ids[list(d)]
            ids, cuts = long, begin[cuts]
        blob, ends = ids.astype("<u4").tobytes(), np.r_[cuts[1:], len(ids)]
        with np.errstate(over="ignore", divide="ignore"):
            seen = np.where(np.isfinite(best[paths.rows]), np.log(-np.expm1(-np.exp(np.minimum(paths.total - best[paths.rows], 700)))), 0.0)
            seen = np.where(paths.total - best[paths.rows] < -30, paths.total - best[paths.rows], seen)
        for r, a, b, log, v, s in zip(paths.rows.tolist(), cuts.tolist(), ends.tolist(), paths.total.tolist(), value.tolist(), seen.tolist(), strict=True):
            out[r].append((blob[4 * a : 4 * b], log, v, s))
    return out


def encode(docs: DataFrame, ids: tuple[str, ...] = ("doc_id",), text: str = "text", k: int = 2, seed: int = 0, model: str = MODEL, batch_bytes: int = BATCH_BYTES, decoded: bool = False) -> DataFrame:
    """Up to ``k`` rows per row: ids, ``sample`` (from 1), ``piece_ids``, ``log_prob``, ``perturbed``, ``log_inclusion``.

    ``decoded`` adds what the piece ids decode to: ``text_crc32`` (of its UTF-8 bytes) and ``same_text``, whether it is the row's text.
    """
    ids = list(ids)
    fields = {"sample": pa.int32(), "piece_ids": pa.binary(), "log_prob": pa.float64(), "perturbed": pa.float64(), "log_inclusion": pa.float64()}
    if decoded:
        fields |= {"text_crc32": pa.int64(), "same_text": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model)
        for batch in slices(batches, "raw", batch_bytes):
            keys = batch.column(len(ids)).to_numpy().view(np.uint64)
            texts = [x.decode("utf-8", "replace").replace("▁", " ") for x in batch.column(len(ids) + 1).to_pylist()]
            rows = sample(texts, keys, k, vocabulary)
            take = pa.array(np.repeat(np.arange(len(rows)), [len(x) for x in rows]))
            flat = [(j + 1, *y) for x in rows for j, y in enumerate(x)]
            if decoded:
                again = (vocabulary.decode(np.frombuffer(x[1], "<u4").tolist()) for x in flat)
                flat = [(*x, zlib.crc32(y.encode()), y == texts[i]) for x, y, i in zip(flat, again, take.to_pylist(), strict=True)]
            columns = [batch.column(i).take(take) for i in range(len(ids))]
            columns += [pa.array(v, t) for v, t in zip(zip(*flat, strict=True), fields.values(), strict=True)] if flat else [pa.array([], t) for t in fields.values()]
            yield pa.RecordBatch.from_arrays(columns, names=[*ids, *fields])

    rows = docs.select(*ids, F.xxhash64(F.lit(seed), *ids).alias("key"), utf8(text).alias("raw"))
    ddl = "sample int, piece_ids binary, log_prob double, perturbed double, log_inclusion double" + (", text_crc32 long, same_text boolean" if decoded else "")
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*ids).schema.fields)
    return rows.mapInArrow(run, f"{own}, {ddl}")


def decode(encoded: DataFrame, ids: str = "piece_ids", out: str = "text", model: str = MODEL) -> DataFrame:
    """``encoded`` with the text of the piece ids in column ``out``; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model)
        for batch in batches:
            blobs = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            texts = [None if x is None else vocabulary.decode(np.frombuffer(x, "<u4").tolist()) for x in blobs]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{columns}, `{out}` string")


def op8_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every row of ``documents``, and what they decode to."""
    rows = encode(table(spark, sf_dir, "documents"), decoded=True)
    size = (F.octet_length("piece_ids") / 4).cast("long")
    return rows.select("doc_id", "sample", size.alias("n_pieces"), F.crc32("piece_ids").alias("ids_crc32"), "log_prob", "perturbed", "log_inclusion", "text_crc32", "same_text")


QUERIES = {"op8_piece_sampling": (op8_piece_sampling, None)}
