"""Spelling variants against all pairs of words."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from silverlode.llm import spelling_variants as sv
from silverlode.llm.queries import QUERIES
from tests.compare import connect, differences
from tests.conftest import SF
from tests.llm import data


def near(a, b):
    """One inserted, deleted or replaced character."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = sorted((a, b), key=len, reverse=True)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def counted(rows, typo_every=None, least_length=5, least_count=3):
    total = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if typo_every and i is not None and h % typo_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= least_length and n >= least_count}


def brute(words, ratio=2):
    out = {}
    for w, n in words.items():
        beside = [x for x in words if near(w, x)]
        best = min(beside, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= ratio * n else None
        out[w] = (n, len(beside), form, words[form] if form else None)

    def root(w):
        return root(out[w][2]) if out[w][2] else w

    return {w: (*x, root(w)) for w, x in out.items()}


def got(df):
    rows = df.collect()
    assert df.columns == ["word", "n", "n_near", "form", "form_n", "root"] and len({r.word for r in rows}) == len(rows)
    return {r.word: tuple(r)[1:] for r in rows}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abcé", min_size=1, max_size=6), min_size=1, max_size=6, unique=True))
def test_edits_are_all_near_words_once(words):
    letters = "abcé"
    seen = Counter()
    for length, rows, matrix in sv.by_length(words, letters):
        for size, r, p, c, hashes in sv.edits(matrix, len(letters)):
            others = sv.spelled(matrix, r, p, c, letters) if size else []
            for i, other, h in zip(r.tolist(), others, hashes.tolist()):
                ((_, _, m),) = sv.by_length([other], letters)
                assert int(sv.finished((m * sv.powers(size)).sum(axis=1, dtype=np.uint64), size)[0]) == h
                seen[frozenset((words[rows[i]], other))] += 1
    for a in words:
        for b in words:
            if a < b and near(a, b):
                assert seen[frozenset((a, b))] == 1


def test_blocks_do_not_matter(monkeypatch):
    words = ["abcabcabc", "aabbccaab", "cbacbacba"]
    ((_, _, matrix),) = sv.by_length(words, "abc")
    whole = sorted((s, int(a), int(b), int(x)) for s, r, p, _, h in sv.edits(matrix, 3) for a, b, x in zip(r, p, h))
    monkeypatch.setattr(sv, "BLOCK", 7)
    assert whole == sorted((s, int(a), int(b), int(x)) for s, r, p, _, h in sv.edits(matrix, 3) for a, b, x in zip(r, p, h))


def test_filters_forget_nothing():
    hashes = sv.mixed(np.arange(5000, dtype=np.uint64))
    blocks = sv.blocks_for(5000)
    bits = sv.bloom(hashes, blocks)
    assert len(sv.passing(hashes, 1, {0: bits})) == 5000
    assert len(sv.passing(sv.mixed(np.arange(5000, 105_000, dtype=np.uint64)), 1, {0: bits})) < 1000


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(sv, "SEGMENT", 10)
    text = "abc defgh, ij klmnopqrstuvwxyz abc é " * 5
    assert [w for part in sv.runs(text) for w in part] == re.findall("[a-zÀ-ÿ]+", text)


def rows():
    base = ["house", "houze", "houses", "hause", "mouse", "moose", "naïve", "naive", "naiveté", "x" * 90, "x" * 89, "ÀÉÎÕÜ", "ÀÉÎÕü", "abcde÷", "aaaaa", "aaaaaa", "tree", "Trees"]
    out = [(i, " ".join(w for k, w in enumerate(base) for _ in range((k * 7 + 3 * i) % 11))) for i in range(12)]
    return [*out, *data.odd_texts(), (None, "house " * 9), (40, data.prose(3, 3000)), (41, data.prose(4, 3000)), (42, None)]


@pytest.mark.parametrize("typo_every", [None, 3, 97])
@pytest.mark.parametrize("slice_words, round_bytes", [(1 << 20, 1 << 26), (20, 200)])
def test_all_pairs(spark, typo_every, slice_words, round_bytes):
    words = sv.word_counts(data.table(spark, rows()), typo_every=typo_every)
    want = brute(counted(rows(), typo_every))
    assert got(sv.variants(words, slice_words=slice_words, round_bytes=round_bytes)) == want
    assert any(x[4] not in (w, x[2]) for w, x in want.items()) and any(x[1] == 0 for x in want.values())


def test_chains_end_at_the_commonest(spark):
    chain = {"a" * 5 + "bcdefgh"[:k] + "z" * (7 - k): 3 << k for k in range(8)}
    words = spark.createDataFrame(list(chain.items()), "word string, n long")
    assert got(sv.variants(words)) == brute(chain)
    assert {x[4] for x in brute(chain).values()} == {"aaaaabcdefgh"}


def test_ties_and_smallest_vocabularies(spark):
    words = {"aaaaa": 1, "aaaab": 2, "aaaac": 2, "éaaaa": 2, "b": 5, "a": 9, "ab": 4}
    assert got(sv.variants(spark.createDataFrame(list(words.items()), "word string, n long"))) == brute(words)
    assert got(sv.variants(spark.createDataFrame([], "word string, n long"))) == {}
    assert got(sv.variants(sv.word_counts(data.table(spark, [])))) == {}


def test_query(spark):
    run, sql = QUERIES["op12_spelling_variants"]
    df = run(spark, SF)
    assert differences(df, df.collect(), connect(SF), sql) == []
