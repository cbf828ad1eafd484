"""Repeated passages and near copies, against brute force."""

import random

import pytest

from silverlode.llm import jaccard_join, suffix_dedup
from silverlode.llm.components import components
from tests.llm import data

ROWS = data.odd_texts()


def corpus(seed, n=60):
    """Copies, near copies of different degrees, shared passages."""
    rng = random.Random(seed)
    passages = [data.prose(100 + k, 30) for k in range(3)]
    rows, bases = [], [data.prose(k, rng.randint(20, 150)) for k in range(6)]
    for i in rng.sample(range(1000), n):
        w = rng.choice(bases).split(" ")
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
            w[rng.randrange(len(w))] = f"w{rng.randrange(50)}"
        if rng.random() < 0.3:
            w.insert(rng.randrange(len(w)), rng.choice(passages))
        rows.append((i, " ".join(w)))
    return rows


def spans(spark, rows, **options):
    got = suffix_dedup.repeats(data.table(spark, rows), ("doc_id", "text"), **options).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got), key=str)


@pytest.mark.parametrize("size", [4_000_000, 2_000])
def test_repeats_odd(spark, size):
    assert spans(spark, ROWS, chunk_bytes=size) == sorted(data.repeats(ROWS), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_corpus(spark, seed):
    rows = corpus(seed)
    assert spans(spark, rows, chunk_bytes=3_000) == sorted(data.repeats(rows), key=str)


def test_repeats_short_width(spark):
    rows = [(i, "".join(random.Random(i).choice("ab") for _ in range(60))) for i in range(8)]
    assert spans(spark, rows, width=8, gram=4, chunk_bytes=100) == sorted(data.repeats(rows, 8), key=str)


def test_rewritten_texts(spark):
    docs = data.table(spark)
    got = suffix_dedup.repeats(docs, tuple(docs.columns), rewrite="text", length="n_chars").collect()
    want = {(i, t): n for (i, t), (_, _, n, _, _) in zip(ROWS, data.repeats(ROWS))}
    assert len(got) == len(ROWS)
    for r in got:
        assert (r.text is None) == (r.n_chars is None)
        if r.text is not None:
            assert r.n_chars == len(r.text) and len(r.text.encode()) >= r.n_bytes - r.n_removed
    untouched = {t for (i, t), n in want.items() if not n}
    assert untouched <= {r.text for r in got}
    assert suffix_dedup.whole_characters("aßb".encode(), [{"start": 2, "stop": 3}]) == "aßb"


def test_levels_grow_geometrically():
    import numpy as np

    rng = np.random.default_rng(0)
    hashes = rng.permutation(np.arange(1, 6401, dtype=np.uint64))
    family = suffix_dedup.Family(hashes, np.zeros(6400, np.int64), np.arange(6400), np.zeros(6400, np.uint8))
    for k in range(64):
        order = np.argsort(hashes[100 * k : 100 * k + 100]) + 100 * k
        family.add(hashes[order], order)
        sizes = [len(x) for x, _ in family.levels]
        assert all(a > b for a, b in zip(sizes, sizes[1:])) and len(sizes) <= 7
    assert sum(len(x) for x, _ in family.levels) == 6400


def test_suffixes_in_stretches(monkeypatch):
    import numpy as np
    import pyarrow as pa

    rows = [(i, t) for i, t in corpus(4, 40)] + [(2000, ""), (2001, "x" * 99), (2002, "y" * 700), (2003, ""), (2004, "z" * 100)]
    group = pa.table({"chunk": [0] * len(rows), "place": [i for i, _ in rows], "raw": pa.array([t.encode() for _, t in rows], pa.binary())})
    chunk = suffix_dedup.Chunk(group, "place")
    whole = suffix_dedup.chosen(chunk, suffix_dedup.Rolling(chunk.buffer), 100, 32)
    monkeypatch.setattr(suffix_dedup, "STRETCH", 128)
    for a, b in zip(whole, suffix_dedup.chosen(chunk, suffix_dedup.Rolling(chunk.buffer), 100, 32), strict=True):
        assert len(a) and np.array_equal(a, b)


def test_suffixes_take_little_memory():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    texts = [np.random.default_rng(i).integers(97, 123, 10_000).astype(np.uint8).tobytes() for i in range(200)]
    group = pa.table({"chunk": [0] * 200, "place": list(range(200)), "raw": pa.array(texts, pa.binary())})
    chunk = suffix_dedup.Chunk(group, "place")
    tracemalloc.start()
    suffix_dedup.chosen(chunk, suffix_dedup.Rolling(chunk.buffer), 100, 32)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * len(chunk.buffer)  # 8 bytes of sums a byte, and runs


def linked(spark, rows):
    got = jaccard_join.near_copies(data.table(spark, rows)).collect()
    return sorted(((r.id, r.size, r.component) for r in got), key=str)


def test_components_odd(spark):
    assert linked(spark, ROWS) == sorted(data.components(ROWS), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_corpus(spark, seed):
    rows = corpus(seed, 120)
    assert linked(spark, rows) == sorted(data.components(rows), key=str)


def test_components_with_common_shingles(spark):
    line = "this line is in every text of the table for sure"
    rows = [(i, line + " " + data.prose(i // 3, 8 if i % 2 else 14)) for i in range(70)]
    assert linked(spark, rows) == sorted(data.components(rows), key=str)


def groups_near_the_threshold(n):
    """A text and two others, each unlike it in other places; some link and some just don't."""
    rows = []
    for g in range(n):
        words = [f"g{g}w{k}" for k in range(200)]
        for j in (0, 1, 2):
            w = list(words)
            for k in range(j * 60, j * 60 + 24 + g % 5 if j else 0):
                w[k] = f"{w[k]}v{j}"
            rows.append((3 * g + j, " ".join(w)))
    return rows


def test_components_near_the_threshold(spark, monkeypatch):
    rows, seen, write = groups_near_the_threshold(30), {}, jaccard_join.written

    def counted(df, name):
        out = write(df, name)
        seen[name] = max(seen.get(name, 0), out.count())
        return out

    monkeypatch.setattr(jaccard_join, "written", counted)
    want = data.components(rows)
    assert 30 < len({c for _, _, c in want}) < 90
    assert linked(spark, rows) == sorted(want, key=str)
    assert seen["members"] <= 9 * 30 and seen["open"] <= 9 * 30  # not one for each shingle that they share


def test_components_of_what_pivots_leave(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TURNS", 0)
    rng, rows = random.Random(8), []
    for b in range(4):
        base = data.prose(50 + b, 90).split(" ")
        for i in range(40):
            w = list(base)
            for k in rng.sample(range(90), rng.randint(1, 7)):
                w[k] = f"w{rng.randrange(9)}"
            rows.append((len(rows), " ".join(w[rng.choice([0, 0, 3, 9]) :])))
    assert linked(spark, rows) == sorted(data.components(rows), key=str)


def test_star_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(200, 260)]
    root = {x: x for p in links for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if find(a) != find(b):
            root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.least for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    alone = {a for a, b in links if a == b}
    assert {x: find(x) for x in root if x not in alone or x in got} == got


def test_empty(spark):
    assert spans(spark, []) == [] and linked(spark, []) == []
    assert spans(spark, [(1, None), (2, "")]) == sorted(data.repeats([(1, None), (2, "")]), key=str)
    assert linked(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]
