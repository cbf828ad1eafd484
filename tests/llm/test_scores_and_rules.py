"""Language-model scores, quality rules, language identification."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverlode.llm import language_id, quality_rules, tree_weighting
from silverlode.llm.common import WordHashes
from tests.conftest import SF
from tests.llm import data

ROWS = data.odd_texts()


def scored(docs, **options):
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) == 0
    return tree_weighting.score(docs, held, **options).collect()


def by_node(bits, depth, context, byte):
    """Probability of a byte after a context by the recursion over all nodes. bits: (context, prefix) -> [zeros, ones]."""

    def estimate(n):
        a, b = n
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    children = {}
    for c, p in bits:
        if c:
            children.setdefault((c[1:], p), []).append(c)

    def weighted(c, p):
        own = estimate(bits[c, p])
        if len(c) == depth:
            return own
        return math.log(0.5) + np.logaddexp(own, sum(weighted(x, p) for x in children.get((c, p), [])))

    log = 0.0
    for bit in range(8):
        prefix, one = (1 << bit) | (byte >> (8 - bit)), byte >> (7 - bit) & 1
        chance = 0.5
        for d in range(depth, -1, -1):
            c = context[depth - d :] if d else b""
            a, b = bits.get((c, prefix), [0, 0])
            own = (b + 0.5) / (a + b + 1)
            if d == depth:
                chance = own
            else:
                product = sum(weighted(x, prefix) for x in children.get((c, prefix), []))
                w = 1 / (1 + math.exp(min(700, product - estimate([a, b]))))
                chance = w * own + (1 - w) * chance
        log += math.log10(chance if one else 1 - chance)
    return log


def test_scores_against_all_nodes(spark):
    rows = [(1, "abab abba"), (2, "ba ab"), (3, "zz ab"), (10, "abab"), (4, None)]
    depth, bits = 2, {}
    texts = {i: b" ".join(data.words(t)) + b"\n" for i, t in rows}
    for i, x in texts.items():
        if not data.held_out(i, 10, 0):
            padded = b"\n" * depth + x
            for k in range(len(x)):
                for d in range(depth + 1):
                    c = padded[k + depth - d : k + depth]
                    for bit in range(8):
                        n = bits.setdefault((c, (1 << bit) | (x[k] >> (8 - bit))), [0, 0])
                        n[x[k] >> (7 - bit) & 1] += 1
    want = {i: sum(by_node(bits, depth, (b"\n" * depth + x)[k : k + depth], x[k]) for k in range(len(x))) for i, x in texts.items()}
    got = {r.doc_id: r.score for r in scored(data.table(spark, rows), depth=depth)}
    assert got == pytest.approx(want, rel=1e-5)


def test_probabilities_add_up():
    keys, _ = tree_weighting.keys_of([b"abcabcabd\n", b"bcd\n"], 3)
    known, counts = np.unique(keys, return_counts=True)
    context = known[0] >> np.uint64(8)
    every = np.unique(np.concatenate([known, (context << np.uint64(8)) | np.arange(256, dtype=np.uint64)]))
    count = np.zeros(len(every), np.int64)
    count[np.searchsorted(every, known)] = counts
    share, left = tree_weighting.top_mixture(*tree_weighting.top_sums(every, count, 3))
    logs = tree_weighting.log_probabilities(every, count, 3, share, left)
    assert (10 ** logs[every >> np.uint64(8) == context]).sum() == pytest.approx(1)


def test_base_scores_and_chunks(spark):
    docs = data.table(spark)
    want = sorted(data.base_scores(ROWS), key=str)
    for size in (4_000_000, 700):
        got = scored(docs, chunk_bytes=size)
        rows = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=str)
        assert [r[:4] for r in rows] == [r[:4] for r in want]
        assert [r[4] for r in rows] == pytest.approx([r[4] for r in want])
    few, many = (sorted((str(r.doc_id), r.score) for r in scored(docs, chunk_bytes=s)) for s in (4_000_000, 700))
    assert [x for _, x in few] == pytest.approx([x for _, x in many])


def test_scores_beat_word_counts_on_held_out_texts(spark):
    rows = tree_weighting.op1_tree_weighting(spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_empty_tables(spark):
    none = data.table(spark, [])
    assert scored(none) == []
    assert quality_rules.judge(none).collect() == []
    model = language_id.learn(none)
    assert language_id.identify(data.table(spark), model).select("lang_pred").distinct().collect()[0][0] == "und"
    assert language_id.identify(none, model).collect() == []


def measured(text):
    raw = (text or "").encode()
    w = raw.split()
    windows = list(zip(*(w[k:] for k in range(5))))
    seen = Counter(windows)
    hit = {i + k for i, x in enumerate(windows) if seen[x] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


def test_features(spark):
    docs = data.table(spark)
    got = sorted(tuple(r) for r in quality_rules.features(docs, ("text",)).select("text", *quality_rules.FEATURES[:5]).na.fill("").collect())
    assert got == sorted((t or "", *measured(t)) for _, t in ROWS)
    assert quality_rules.repeated_words(b"a b c d e a b c d e".split(), WordHashes()) == 10


def test_verdicts(spark):
    rows = quality_rules.judge(data.table(spark)).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_rules_agree_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    kept = quality_rules.op2_quality_rules(spark, folder)
    rows = kept.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    clean, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in clean) >= 0.97 * sum(not r.base_failed for r in clean)
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad)


def test_fit_finds_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(20000) < 0.9
    fire = [np.where(truth, rng.random(20000) < 0.001, rng.random(20000) < p) for p in (0.5, 0.4, 0.3)]
    good = np.where(truth, rng.random(20000) < 0.98, rng.random(20000) < 0.4)
    patterns = ["".join("0" if f[i] else "1" for f in fire) + ("2" if good[i] else "0") for i in range(20000)]
    posterior, share, answers = quality_rules.fit(Counter(patterns))
    said = np.array([posterior[p] >= 0.5 for p in patterns])
    assert (said == truth).mean() > 0.95 and abs(share - 0.9) < 0.05
    assert quality_rules.fit({})[0] == {}


def test_fit_finds_accuracies_of_careless_rules():
    rng = np.random.default_rng(2)
    truth = rng.random(20000) < 0.9
    fire = [np.where(truth, rng.random(20000) < 0.05, rng.random(20000) < p) for p in (0.8, 0.7, 0.6, 0.7)]
    patterns = ["".join("0" if f[i] else "2" for f in fire) for i in range(20000)]
    posterior, share, answers = quality_rules.fit(Counter(patterns))
    said = np.array([posterior[p] >= 0.5 for p in patterns])
    assert (said == truth).mean() > 0.97 and abs(share - 0.9) < 0.02
    assert answers[0, :, 0] == pytest.approx(0.05, abs=0.01) and answers[1, :, 0] == pytest.approx([0.8, 0.7, 0.6, 0.7], abs=0.05)
    one_bad = np.array(["0" in p for p in patterns])
    assert (said & one_bad).sum() > 2500  # one bad vote does not decide


def by_row(patterns, kinds, certain, rounds, smoothing=1.0):
    """The same expectation-maximisation text by text, without pattern counts."""
    names = sorted(set(kinds))
    belief = []
    for p in patterns:
        bad = [sum(c == "0" and k == name for c, k in zip(p, kinds)) for name in names]
        belief.append([float(not any(bad)), *(x / max(1, sum(bad)) for x in bad)])
    for _ in range(rounds):
        share = [(sum(b[k] for b in belief) + smoothing) / (len(patterns) + smoothing * (len(names) + 1)) for k in range(len(names) + 1)]
        says = [[[(sum(b[k] for b, p in zip(belief, patterns) if p[r] == v) + smoothing / 3) / (sum(b[k] for b in belief) + smoothing) for v in "012"] for r in range(len(kinds))] for k in range(len(names) + 1)]
        belief = []
        for p in patterns:
            chance = [share[k] * math.prod(says[k][r][int(v)] for r, v in enumerate(p)) for k in range(len(names) + 1)]
            if any(p[r] == "0" for r in certain):
                chance[0] = 0.0
            belief.append([x / sum(chance) for x in chance])
    return {p: b[0] for p, b in zip(patterns, belief)}


def test_posteriors_against_text_by_text():
    rng = np.random.default_rng(3)
    patterns = ["".join(rng.choice(list("012"), 5, p=(0.1, 0.2, 0.7))) for _ in range(150)]
    kinds, certain = ["a", "a", "b", "b", "c"], (0,)
    for rounds in (1, 2, 20):
        posterior, _, _ = quality_rules.fit(Counter(patterns), kinds, certain, rounds)
        assert posterior == pytest.approx(by_row(patterns, kinds, certain, rounds), abs=1e-9)
    assert all(posterior[p] == 0 for p in patterns if p[0] == "0")


def test_verdicts_are_not_all_must_pass(spark):
    rows = quality_rules.op2_quality_rules(spark, "/root/testdata/sf0.1").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    differ = [r for r in rows if r.kept != (not r.base_failed and "0" not in r.votes)]
    assert differ and any(r.kept for r in differ)
    kept = Counter(labels.get(r.doc_id) for r in rows if r.kept)
    assert kept[1] >= 3323 and kept[0] <= 5
    # Texts with repeated lines and nothing else against them.
    lines = [r for r in rows if r.votes == "212222222" and not r.base_failed]
    assert lines and all(r.kept for r in lines)
    counts, kinds = Counter(r.votes for r in rows), [k for k, _, _ in quality_rules.rules().values()]
    verdicts = [{p: x >= 0.5 for p, x in quality_rules.fit(counts, kinds, (0, 1), rounds, smoothing)[0].items()} for rounds, smoothing in ((500, 1.0), (250, 1.0), (1000, 1.0), (500, 0.5), (500, 2.0))]
    assert all(v == verdicts[0] for v in verdicts)


def test_language(spark):
    rows = language_id.op7_language_id(spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == data.held_out(r.doc_id, 3, 1) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)


def test_language_of_odd_texts(spark):
    model = language_id.learn(data.table(spark))
    assert model.languages == ["en"]
    rows = language_id.identify(data.table(spark), model, ("doc_id", "text")).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))


def kneser_ney(texts, order):
    """Probability of a symbol after a context, by dictionaries: interpolated, lower orders from continuation counts."""
    levels = [Counter(g for t in texts for g in windows(t, order))]
    for _ in range(order - 1):
        levels.append(Counter(g[1:] for g in levels[-1]))
    levels = levels[::-1]

    def chance(gram, kinds):
        if not gram:
            return 1 / (kinds + 1)
        after = {g: n for g, n in levels[len(gram) - 1].items() if g[:-1] == gram[:-1]}
        total, lower = sum(after.values()), chance(gram[1:], kinds)
        if not total:
            return lower
        return max(after.get(gram, 0) - 0.75, 0) / total + 0.75 * len(after) / total * lower

    return chance


def windows(text, order):
    """The n-grams that end at each character but the first of a folded text."""
    plain = " " + " ".join("".join(c.lower() if c.isalpha() else " " for c in text).split()) + " "
    padded = " " * (order - 2) + plain
    return [padded[i : i + order] for i in range(len(padded) - order + 1)]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_entropies_against_dictionaries(spark, order):
    learned = {"x": ["Abracadabra, the cat!", "a ban on 12 bananas", "the ban"], "y": ["zwei Bäume über Nacht", "über den Baum"]}
    chances = {n: kneser_ney(t, order) for n, t in learned.items()}
    kinds = len({c for t in learned.values() for x in t for g in windows(x, order) for c in g[-1]})
    counts = []
    for texts in learned.values():
        keys = np.concatenate([language_id.grams(language_id.folded(x.encode()), order) for x in texts])
        counts.append(np.unique(keys, return_counts=True))
    model = language_id.Model(list(learned), counts, order)
    asked = ["the cat", "Baum über Nacht", "q", "Abracadabra the 3 bananas", "über bananas zzz", "łódź"]
    rows = language_id.identify(data.table(spark, list(enumerate(asked))), model, ("doc_id", "text")).collect()
    assert len(rows) == len(asked)
    for r in rows:
        want = {n: -sum(math.log(f(g, kinds)) for g in windows(r.text, order)) / len(windows(r.text, order)) for n, f in chances.items()}
        assert r.lang_pred == min(want, key=want.get) and r.entropy == pytest.approx(min(want.values()), abs=1e-4)
        assert model.entropies(language_id.folded(r.text.encode())) == pytest.approx(list(want.values()), abs=1e-4)


def test_language_probabilities_add_up():
    texts = [b"abracadabra", b"banana ab"]
    counts = [np.unique(language_id.grams(language_id.folded(x), 3), return_counts=True) for x in texts]
    model = language_id.Model(["x", "y"], counts, 3)
    symbols = np.unique(np.concatenate([k & np.uint64(0xFFFF) for k, _ in counts]))
    context = counts[0][0][3] >> np.uint64(16)
    logs = model._logs((context << np.uint64(16)) | symbols, 3)
    # One part of the lowest distribution is kept for unseen symbols.
    assert np.all(np.exp(logs).sum(0) <= 1 + 1e-6) and np.all(np.exp(logs).sum(0) > 0.9)
