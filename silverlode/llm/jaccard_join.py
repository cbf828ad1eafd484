"""Exact similarity join of word 5-gram sets in the Jaccard metric, and its connected components.

Two texts link when 100 * |A and B| >= ``LEAST`` * |A or B|, a distance of at most ``1 - LEAST / 100``.

*Regions.* Shingles are ordered, rare ones first. Two sets that link share a shingle among the first
``n - ceil(LEAST/100 n) + 1`` of each, so the texts that have a shingle there form a region, and no link leaves all
regions. Texts of a shingle whose lengths differ too much are in different regions, and shingles with the same texts make
one region, which counts as many times.

*First regions.* Sets of given sizes that link share at least a certain number of leading shingles. A set's regions are
ordered, those of few members first; the first one that a pair shares has so many shingles in it and after it, in both. A
set stays only in the regions from which on it has enough left for some size of a partner, and a pair meets only where both
have enough left for their sizes. So most chance meetings, and most regions of shingles that many texts hold, drop out.

*Distances.* A region's pivot is the member with the smallest hash of its fingerprint, hence the same in most regions of a
group of near copies. Every member that may link to its region's pivot is compared with it, exactly. What links to the pivot
needs no comparison among itself: it is connected already, however large the group is.

Regions of ``CROWDED`` members or more whose members are still apart get up to ``TURNS`` more pivots in turn, chosen by another
mix of the fingerprint each time, which merges most of what links at all.

*Windows.* What is left are members of a region that belong to different components. By the triangle inequality two of
them can link only if their distances to the pivot differ by no more than the threshold. Pairs that share one of the
``PRIOR`` regions before this one met there already. What is left of the pairs is compared exactly. Regions with one
component drop out, and lengths that differ too much are never compared.

Equal sets are one set from the start (``min`` of the id per fingerprint); copies never are compared. Common shingles
come last in the order: they are found by counts over all texts, so a line that many texts share makes no region unless
a text has little else. The order only decides how much work there is; any order gives the same links. Comparisons
run in cells (pivot hash, member hash), so that a hot pivot's members are spread. Shingles and sets are
known by 64-bit hashes.

Ids are integers. A null text counts as empty; texts without words link with nothing. Fewer than five words are one
shingle. Repeated rows are one set. Rows with a null id are compared like others; they are in a component, but do not
name it unless it has null ids only. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverlode.llm.common import STEP, WordHashes, from_planes, mixed, planes, slices, table, utf8, window_hashes, written
from silverlode.llm.components import components
from silverlode.operators.skew import match

WORDS, LEAST = 5, 75
COMMON_KEPT = 1 << 16
BLOCK_BYTES, COUNT_BYTES, BUCKET_BYTES = 8_000_000, 8_000_000, 16_000_000
FILTER_BITS = 22
CROWDED, TURNS = 24, 3
PRIOR = 4
_LONG = np.dtype("<u8")


def shingles(raws: list[bytes], hashes: WordHashes, words: int = WORDS, run: int = 1_000_000) -> Iterator[np.ndarray]:
    """The sets of some texts, each ordered by hash. Words are held for about ``run`` bytes at a time."""
    start = 0
    while start < len(raws):
        stop, size = start, 0
        while stop < len(raws) and (stop == start or size + len(raws[stop]) <= run):
            size += len(raws[stop])
            stop += 1
        lists = [x.lower().split() for x in raws[start:stop]]
        flat = hashes.of(list(chain.from_iterable(lists)))
        windows = window_hashes(flat, words) if len(flat) >= words else flat
        at = 0
        for n in map(len, lists):
            found = windows[at : at + n - words + 1] if n >= words else window_hashes(flat[at : at + n], words)
            at += n
            found = np.sort(found)
            if len(found) > 1 and (double := found[1:] == found[:-1]).any():
                found = found[np.r_[True, ~double]]
            yield found
        start = stop


def fingerprint(found: np.ndarray) -> int:
    """Signed 64-bit fingerprint of a set; 0 for the empty one."""
    return int(np.array([mixed(found ^ np.uint64(len(found))).sum(dtype=np.uint64)]).view(np.int64)[0]) if len(found) else 0


def common_shingles(docs: DataFrame, text: str, words: int, kept: int = COMMON_KEPT) -> np.ndarray:
    """Hashes and counts of shingles that many texts hold, the ``kept`` commonest at most.

    Counted over all texts: a task sends the shingles that three of its texts or more hold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "raw", COUNT_BYTES):
            sets = list(shingles(batch.column(0).to_pylist(), hashes, words))
            every = np.sort(np.concatenate(sets)) if sets else np.empty(0, _LONG)
            first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]) if len(every) else np.empty(0, np.int64)
            count = np.diff(np.r_[first, len(every)])
            many = count >= 3
            yield pa.RecordBatch.from_arrays([pa.array(every[first[many]].view(np.int64)), pa.array(count[many])], names=["h", "n"])

    counted = docs.select(utf8(text).alias("raw")).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    rows = counted.where("n >= 16").orderBy(F.col("n").desc(), "h").limit(kept).toPandas()  # at most `kept` rows
    out = np.empty(len(rows), [("h", _LONG), ("n", "<i8")])
    out["h"], out["n"] = rows["h"].to_numpy(np.int64).view(_LONG), rows["n"].to_numpy(np.int64)
    return np.sort(out, order="h")


class Order:
    """The common order of shingles: by count, as far as they are common, then by hash."""

    def __init__(self, common: np.ndarray):
        self.hashes, self.counts = common["h"], common["n"]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def leading(self, found: np.ndarray, least: int) -> np.ndarray:
        """The first shingles of a set, as many as a link needs."""
        number = len(found) - -(-least * len(found) // 100) + 1
        some = np.flatnonzero(self.seen[(found >> np.uint64(44)).astype(np.int64)])
        if len(some):
            at = np.minimum(np.searchsorted(self.hashes, found[some]), len(self.hashes) - 1)
            count = np.where(self.hashes[at] == found[some], self.counts[at], 0)
            if count.any():
                every = np.zeros(len(found), np.int64)
                every[some] = count
                return found[np.lexsort((found, every))[:number]]
        return found[:number]


def _keys(docs: DataFrame, text: str, common: np.ndarray, words: int, least: int, buckets: int) -> DataFrame:
    """Blocks of (shingle, set) for the leading shingles, and each row's set.

    Rows with ``keys`` are a task's block for a bucket: sets (``prints``, ``sizes``), and for each shingle (``keys``, in
    order) the set's place (``places``). Rows without are one text each: ``id``, ``text_hash``, ``print``, ``size``.
    """
    columns = {"bucket": pa.int64(), "keys": pa.binary(), "places": pa.binary(), "prints": pa.binary(), "sizes": pa.binary(), "id": pa.int64(), "text_hash": pa.int64(), "print": pa.int64(), "size": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, order_of = WordHashes(), Order(common)
        for batch in slices(batches, "raw", BLOCK_BYTES):
            prints, sizes, keys, places, own = [], [], [], [], set()
            all_prints, all_sizes = [], []
            for found in shingles(batch.column(2).to_pylist(), hashes, words):
                mark = fingerprint(found)
                all_prints.append(mark)
                all_sizes.append(len(found))
                if len(found) and mark not in own:
                    first = order_of.leading(found, least)
                    keys.append(first)
                    places.append(np.full(len(first), len(own), np.uint32))
                    own.add(mark)
                    prints.append(mark)
                    sizes.append(len(found))
            n = batch.num_rows
            spread = np.arange(n) % buckets
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip([spread, *[[None] * n] * 4, batch.column(0), batch.column(1), all_prints, all_sizes], columns.values(), strict=True)], names=list(columns))
            if not keys:
                continue
            key, place = np.concatenate(keys), np.concatenate(places)
            print_, size = np.array(prints, np.int64), np.array(sizes, np.int64)
            bucket = mixed(key) % np.uint64(buckets)
            order = np.lexsort((key, bucket))
            key, place = key[order], place[order]
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
            rows = []
            for b in range(buckets):
                if cuts[b] < cuts[b + 1]:
                    mine, at = np.unique(place[cuts[b] : cuts[b + 1]], return_inverse=True)
                    rows.append((b, key[cuts[b] : cuts[b + 1]].tobytes(), planes(at.astype(np.uint32)), print_[mine].tobytes(), planes(size[mine]), None, None, None, None))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), columns.values(), strict=True)], names=list(columns))

    kinds = {pa.int64(): "long", pa.binary(): "binary"}
    return docs.mapInArrow(run, ", ".join(f"{k} {kinds[v]}" for k, v in columns.items()))


_REGIONS = "region long, print long, size long, members long, need long, weight long, id long, text_hash long, is_set boolean"


def shared_least(m: np.ndarray, n: np.ndarray, least: int) -> np.ndarray:
    """Of the leading shingles of the set whose leading part ends first, all that both sets hold are leading in both; so
    sets of sizes m and n that link share at least so many regions."""
    return -(-least * (m + n) // (100 + least)) - -(-least * np.maximum(m, n) // 100) + 1


def _regions(group: pa.Table, least: int) -> pa.Table:
    """Members of the regions of a bucket's shingles, and the sets of rows as they came.

    A shingle's sets in order of size are cut where neighbours differ too much to link; what is left together, two sets or
    more, is a region. Shingles with the same sets have the same region; ``weight`` is how many of the bucket have it.
    ``need``: no link of the member in this region comes with fewer shared shingles.
    """
    rows = group.filter(pc.is_null(group["keys"]))
    keys, places, prints, sizes, base = [], [], [], [], 0
    blocks = group.filter(pc.is_valid(group["keys"]))
    for k, p, f, n in zip(*(blocks[c].to_pylist() for c in ("keys", "places", "prints", "sizes")), strict=True):
        keys.append(np.frombuffer(k, _LONG))
        places.append(from_planes(p, np.uint32).astype(np.int64) + base)
        prints.append(np.frombuffer(f, np.int64))
        sizes.append(from_planes(n, np.int64))
        base += len(prints[-1])
    none = [np.empty(0, np.int64)]
    key, place, print_, size = (np.concatenate(x or none) for x in (keys, places, prints, sizes))
    key = key.view(_LONG)
    order = np.argsort(key, kind="stable")
    key, place = key[order], place[order]
    many = np.zeros(len(key), bool)
    many[1:] = key[1:] == key[:-1]
    many[:-1] |= many[1:]
    key, member, n = key[many], print_[place[many]], size[place[many]]
    order = np.lexsort((member, n, key))
    key, member, n = key[order], member[order], n[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (member[1:] != member[:-1])
    key, member, n = key[new], member[new], n[new]  # the same set from different tasks
    head = np.ones(len(key), bool)
    head[1:] = (key[1:] != key[:-1]) | (100 * n[:-1] < least * n[1:])
    first = np.flatnonzero(head)
    count = np.diff(np.r_[first, len(key)])
    marks = np.add.reduceat(mixed(member.view(_LONG) + STEP), first) if len(first) else np.empty(0, _LONG)
    region, at, weight = np.unique(mixed(marks ^ (count.view(_LONG) * STEP)), return_index=True, return_counts=True)
    keep = np.zeros(len(first), bool)
    keep[at] = True
    keep &= count > 1
    names, weights = np.empty(len(first), np.int64), np.empty(len(first), np.int64)
    names[at], weights[at] = region.view(np.int64), weight
    low = np.maximum(np.repeat(n[first], count), -(-least * n // 100))
    high = np.minimum(np.repeat(n[first + count - 1], count), 100 * n // least)
    need = np.maximum(np.minimum(shared_least(n, low, least), shared_least(n, high, least)) - 1, 1)  # rounding may take one
    keep, members = np.repeat(keep, count), np.repeat(count, count)
    values = [v[keep] for v in (np.repeat(names, count), member, n, members, need, np.repeat(weights, count))]
    empty, more = [None] * int(keep.sum()), [None] * rows.num_rows
    columns = [(values[0], more), (values[1], rows["print"]), (values[2], rows["size"]), (values[3], more), (values[4], more), (values[5], more), (empty, rows["id"]), (empty, rows["text_hash"]), ([False] * len(empty), [True] * len(more))]
    kinds = {"long": pa.int64(), "boolean": pa.bool_()}
    names = [x.split() for x in _REGIONS.split(", ")]
    array = lambda v, t: v.combine_chunks() if isinstance(v, pa.ChunkedArray) else pa.array(v, t)
    return pa.table({c: pa.chunked_array([array(v, kinds[t]) for v in pair]) for (c, t), pair in zip(names, columns, strict=True)})


def _compared(texts: pa.Table, pairs: pa.Table, words: int) -> pa.Table:
    """Sizes of intersection and union of the pairs of a cell."""
    sets = dict(zip(texts["print"].to_pylist(), shingles([zlib.decompress(x) for x in texts["packed"].to_pylist()], WordHashes(), words), strict=True))
    a, b = pairs["a"].to_pylist(), pairs["b"].to_pylist()
    both = []
    for x, y in zip(a, b, strict=True):
        one, two = sets[x], sets[y]
        if len(one) > len(two):
            one, two = two, one
        at = np.minimum(np.searchsorted(two, one), len(two) - 1)
        both.append(int((two[at] == one).sum()))
    union = [len(sets[x]) + len(sets[y]) - n for x, y, n in zip(a, b, both, strict=True)]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "both": pa.array(both, pa.int64()), "either": pa.array(union, pa.int64())})


def compare(pairs: DataFrame, texts: DataFrame, words: int = WORDS, cells: int = 64, crowd: int = 20_000) -> DataFrame:
    """(``a``, ``b``, ``both``, ``either``) for pairs of sets; ``texts`` has one ``packed`` text per ``print``.

    Pairs of the same ``home`` (their region's pivot) share a cell, so that a text is sent about once; a home with more
    than ``crowd`` pairs is split by the hash of ``a``.
    """
    many = pairs.groupBy(F.col("home").alias("of")).agg(F.ceil(F.count("*") / crowd).alias("parts"))
    sized = pairs.join(many, match([pairs["home"]], [many["of"]]), "inner")
    placed = sized.select("a", "b", F.pmod(F.xxhash64("home"), F.lit(cells)).alias("p"), F.pmod(F.xxhash64("a", F.lit(1)), F.col("parts")).alias("q"))
    need = placed.select(F.col("a").alias("need"), "p", "q").union(placed.select(F.col("b").alias("need"), "p", "q")).distinct()
    sent = need.join(texts, match([need["need"]], [texts["print"]]), "inner").select(F.col("p").alias("u"), F.col("q").alias("v"), "print", "packed")
    out = "a long, b long, both long, either long"
    return sent.groupBy("u", "v").cogroup(placed.groupBy("p", "q")).applyInArrow(lambda x, y: _compared(x, y, words), out)


def _texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(``print``, ``packed``): a compressed text for each wanted set (``print``, ``of_id``, ``of_hash``, ``times``).

    A bit table of the wanted texts' hashes (``2 ** FILTER_BITS`` bits, whatever the corpus) keeps most other texts from
    being shuffled; the join decides.
    """
    marks = wanted.select(F.pmod("of_hash", F.lit(1 << FILTER_BITS)).alias("m")).distinct().toPandas()["m"].to_numpy(np.int64)
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[marks] = True
    packed_bits = np.packbits(bits).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(np.frombuffer(packed_bits, np.uint8)).astype(bool)
        for batch in batches:
            batch = batch.filter(pa.array(known[batch.column(1).to_numpy() & ((1 << FILTER_BITS) - 1)]))
            packed = pa.array([zlib.compress(x, 6) for x in batch.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], names=["id", "text_hash", "packed"])

    some = rows.mapInArrow(run, "id long, text_hash long, packed binary")
    same = match([some["id"], some["text_hash"]], [wanted["of_id"], wanted["of_hash"]], nulls_equal=True)
    found = written(some.join(wanted, same, "inner").select("print", "packed", "times"), "found")
    once = found.where("times = 1").select("print", "packed")
    return once.union(found.where("times > 1").select("print", "packed").dropDuplicates(["print"]))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = WORDS, least: int = LEAST) -> DataFrame:
    """(``id``, ``text_hash``, ``print``, ``size``, ``component``) for each row: its set and the smallest id that links reach."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets, cells = int(max(8, min(8192, size // BUCKET_BYTES + 1))), int(max(16, size // BLOCK_BYTES))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(utf8(text)).alias("text_hash"), utf8(text).alias("raw"))
    common = common_shingles(docs, text, words)
    blocks = _keys(rows, text, common, words, least, buckets)
    found = written(blocks.groupBy("bucket").applyInArrow(lambda g: _regions(g, least), _REGIONS), "regions")
    sets = found.where("is_set").select("id", "text_hash", "print", "size")
    fits = lambda a, b: 100 * F.least(a, b) >= least * F.greatest(a, b)
    own = sets.where("size > 0").groupBy("print", "id", "text_hash").agg(F.count("*").alias("times"))
    own = own.groupBy("print").agg(F.min("id").alias("id"), F.min(F.struct("id", "text_hash", "times")).alias("of"))
    own = written(own.select("print", "id", F.col("of.id").alias("of_id"), F.col("of.text_hash").alias("of_hash"), F.col("of.times").alias("times")), "sets")

    def texts_of(needed: DataFrame) -> DataFrame:
        wanted = own.join(needed, match([own["print"]], [needed["p"]]), "left_semi").select("print", "of_id", "of_hash", "times")
        return _texts(rows, wanted)

    linked = lambda d: d.where(100 * F.col("both") >= least * F.col("either")).select("a", "b")
    star = lambda known: known.select(F.col("node").alias("a"), F.col("least").alias("b"))
    with_part = lambda r, known: r.join(known, match([r["print"]], [known["node"]]), "left").select(*r.columns, F.coalesce("least", "print").alias("part"))

    def shared_at_least(m: Column, n: Column) -> Column:
        """``shared_least`` of columns."""
        overlap = F.floor((least * (m + n) + (99 + least)) / (100 + least))
        return overlap - F.floor((least * F.greatest(m, n) + 99) / 100) + 1

    # The regions of a set in their common order, small ones first. A region may be the first that two sets share only if
    # as many shingles as a link demands follow from there on in both.
    whole = found.where("not is_set").repartition("print").groupBy("print", "region").agg(F.first("size").alias("size"), F.first("members").alias("members"), F.first("need").alias("need"), F.sum("weight").alias("weight"))
    mine = Window.partitionBy("print")
    in_order = mine.orderBy("members", "region")
    before = F.sum("weight").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("weight")
    prior = F.collect_list("region").over(in_order.rowsBetween(-PRIOR, -1))
    ranked = whole.select("region", "print", "size", "need", (F.sum("weight").over(mine) - before).alias("rest"), prior.alias("prior"))
    early = written(ranked.where("rest >= need").drop("need"), "early")
    pivots = early.groupBy(F.col("region").alias("of")).agg(F.min_by(F.struct("print", "size", "rest"), F.struct(F.xxhash64("print"), "print")).alias("p"), F.count("*").alias("n")).where("n > 1")
    members = early.join(pivots, match([early["region"]], [pivots["of"]]), "inner")
    members = written(members.select("region", "print", "size", "rest", "prior", F.col("p.print").alias("pivot"), F.col("p.size").alias("pivot_size"), F.col("p.rest").alias("pivot_rest"), "n"), "members")

    def may_link(m: Column, n: Column, rest_m: Column, rest_n: Column) -> Column:
        """Whether a region may be the first that two sets share, if they link."""
        return fits(m, n) & (F.least(rest_m, rest_n) >= shared_at_least(m, n))

    first = members.where((F.col("print") != F.col("pivot")) & may_link(F.col("size"), F.col("pivot_size"), F.col("rest"), F.col("pivot_rest")))
    first = written(first.select(F.col("print").alias("a"), F.col("pivot").alias("b")).distinct(), "pairs")
    crowded = written(members.where(F.col("n") >= CROWDED).select("region", "print", "size", "rest"), "crowded")
    needed = first.select(F.col("a").alias("p")).union(first.select("b")).union(crowded.select("print")).distinct()
    texts = texts_of(needed)
    measured = written(compare(first.withColumn("home", F.col("b")), texts, words, cells), "distances")
    known = components(linked(measured))
    # Crowded regions get further pivots, each compared with the members of other components.
    for turn in range(1, TURNS + 1):
        part = with_part(crowded, known)
        chosen = part.groupBy(F.col("region").alias("of")).agg(F.min_by(F.struct("print", "size", "part", "rest"), F.struct(F.xxhash64("print", F.lit(turn)), "print")).alias("v"))
        met = part.join(chosen, match([part["region"]], [chosen["of"]]) & (F.col("part") != F.col("v.part")) & may_link(F.col("size"), F.col("v.size"), F.col("rest"), F.col("v.rest")), "inner")
        pairs = written(met.select(F.col("print").alias("a"), F.col("v.print").alias("b")).distinct(), "pairs")
        if pairs.isEmpty():
            break
        new = linked(compare(pairs.withColumn("home", F.col("b")), texts, words, cells))
        known = components(star(known).union(new))
    # Regions that still hold several components, and the windows of their members.
    part = with_part(members, known)
    open_ = part.groupBy("region").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select(F.col("region").alias("open"))
    left = part.join(open_, match([part["region"]], [open_["open"]]), "left_semi").where(F.col("print") != F.col("pivot"))
    away = measured.select(F.col("a").alias("m"), F.col("b").alias("of"), (1 - F.col("both") / F.col("either")).alias("away"))
    left = left.join(away, match([left["print"], left["pivot"]], [away["m"], away["of"]]), "left")
    left = written(left.select("region", "pivot", "print", "size", "part", "rest", "prior", "away"), "open")
    a, b = (left.select(*[F.col(c).alias(f"{c}_{s}") for c in ("region", "pivot", "print", "part", "size", "rest", "prior", "away")]) for s in "ab")
    window = F.abs(F.col("away_a") - F.col("away_b")) <= F.lit(1 - least / 100 + 1e-9)
    apart = (F.col("part_a") < F.col("part_b")) & may_link(F.col("size_a"), F.col("size_b"), F.col("rest_a"), F.col("rest_b")) & F.coalesce(window, F.lit(True))
    apart &= ~F.arrays_overlap("prior_a", "prior_b")  # what shares an earlier region met there
    met = a.join(b, match([F.col("region_a")], [F.col("region_b")]) & apart, "inner").groupBy(F.col("print_a").alias("a"), F.col("print_b").alias("b"))
    pairs = written(met.agg(F.min("pivot_a").alias("home")), "pairs")
    more = linked(compare(pairs, texts_of(pairs.select(F.col("a").alias("p")).union(pairs.select("b")).distinct()), words, cells))
    whole = components(star(known).union(more))
    tied = own.join(whole, match([own["print"]], [whole["node"]]), "left").select("print", "id", F.coalesce("least", "print").alias("least"))
    lowest = tied.groupBy(F.col("least").alias("lowest")).agg(F.min("id").alias("component"))
    per_set = tied.join(lowest, match([tied["least"]], [lowest["lowest"]]), "inner").select(F.col("print").alias("of"), "component")
    joined = sets.join(per_set, match([F.when(sets["size"] > 0, sets["print"])], [per_set["of"]]), "left")
    return joined.select("id", "text_hash", "print", "size", F.when(F.col("size") > 0, F.col("component")).otherwise(F.col("id")).alias("component"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near copies among all rows of ``documents``."""
    found = near_copies(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), F.col("component").alias("component_id"))


QUERIES = {"op10_jaccard_join": (op10_jaccard_join, None)}
