"""Weak supervision of document quality.

Rules vote good or bad on a text, or abstain. Nobody labels anything: a latent model (Dawid-Skene with the abstention
as a third answer) is fitted by expectation-maximisation to the counts of vote patterns. Its classes are the good texts
and one kind of bad texts per group of rules (short, repeating, full of marks, oddly shaped), so rules that fail
together do not count as independent witnesses, and each rule gets its answer probabilities in every class. Patterns
that fail the base rules are known to be bad. A text is kept when its posterior probability of being good reaches a
half; a single bad vote does not decide.

Texts are read once in Arrow batches. Only counts of vote patterns reach the driver: ``3 ** len(RULES)`` rows at most,
whatever the corpus. A null text counts as empty; it has no words and fails the base rules. An empty table gives an
empty result. Repeated rows are judged one by one, alike.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm.common import WordHashes, batches_of, schema_of, table, utf8, window_hashes
from silverlode.session import ensure_checkpoints

SYMBOLS = b"#*$%&|<>"
NOT_A_CHARACTER = bytes(range(0x80, 0xC0)) + b"\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LETTERS = bytes(range(65, 91)), bytes(range(65, 91)) + bytes(range(97, 123))
ENDS = (b".", b"!", b"?", b'"', b":")
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended", "n_upper", "n_letters", "n_distinct", "n_bars", "n_shouts"]
WINDOW = 5


def repeated_words(words: list[bytes], hashes: WordHashes) -> int:
    """Words that lie in a 5-word window found twice or more in the text."""
    if len(words) < WINDOW + 1:
        return 0
    keys = window_hashes(hashes.of(words), WINDOW)
    if len(np.unique(keys)) == len(keys):
        return 0
    windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    seen = Counter(windows)
    hit = np.zeros(len(words) + 1, np.int64)
    for i, window in enumerate(windows):
        if seen[window] > 1:
            hit[i] += 1
            hit[min(i + WINDOW, len(words))] -= 1
    return int((np.cumsum(hit[:-1]) > 0).sum())


def measure(raw: bytes, hashes: WordHashes) -> tuple[int, ...]:
    """What the rules look at, in the order of ``FEATURES``."""
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    without = lambda drop: len(raw) - len(raw.translate(None, drop))
    return (
        len(words),
        len(raw.translate(None, NOT_A_CHARACTER)),
        without(SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words, hashes),
        len(lines),
        sum(x.rstrip().endswith(ENDS) for x in lines),
        without(UPPER),
        without(LETTERS),
        len(set(words)),
        raw.count(b"|"),
        raw.count(b"!!"),
    )


def features(docs: DataFrame, ids: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """Ids and one long column for each of ``FEATURES``."""
    ids = list(ids)
    fields = [(c, pa.int64()) for c in FEATURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [measure(x, hashes) for x in batch.column(len(ids)).to_pylist()]
            yield batches_of([[x[i] for x in found] for i in range(len(FEATURES))], batch, ids, fields)

    return docs.select(*ids, utf8(text).alias("raw")).mapInArrow(run, schema_of(docs, ids, ", ".join(f"{c} long" for c in FEATURES)))


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def rules() -> dict[str, tuple[str, Column, Column]]:
    """Rule -> (kind of bad text, votes bad, votes good); neither: it abstains. What two measures say alike is one rule."""
    mean_word = _share("word_chars", "n_words")
    dup_lines, upper, ended = _share("n_dup_lines", "n_lines"), _share("n_upper", "n_letters"), _share("n_ended", "n_lines")
    symbols, bars, shouts, distinct = _share("n_symbols", "word_chars"), _share("n_bars", "n_words"), _share("n_shouts", "n_words"), _share("n_distinct", "n_words")
    long = F.col("n_words") >= 50
    return {
        "short": ("short", F.col("n_words") < 10, F.col("n_words") >= 10),
        "repeats": ("repeats", 100 * F.col("n_repeat_words") > 20 * F.col("n_words"), dup_lines <= 0.30),
        "few_words": ("repeats", long & (distinct < 0.15), distinct > 0.35),
        "symbols": ("marks", symbols > 0.10, symbols < 0.01),
        "bars": ("marks", bars > 0.10, bars < 0.01),
        "shouts": ("marks", shouts > 0.20, shouts < 0.01),
        "word_length": ("shape", (mean_word < 2.5) | (mean_word > 12), mean_word.between(3.5, 8.5)),
        "capitals": ("shape", upper > 0.5, upper < 0.2),
        "line_ends": ("shape", long & (ended < 0.1), ended >= 0.95),
    }


#: Rules whose bad vote is a base rule: such texts are bad for certain.
CERTAIN = ("short", "repeats")


def vote_pattern() -> Column:
    """One character per rule: 0 bad, 1 abstains, 2 good."""
    return F.concat(*[F.when(bad, "0").when(good, "2").otherwise("1") for _, bad, good in rules().values()])


def fit(counts: dict[str, int], kinds: list[str] | None = None, certain: tuple[int, ...] = (), rounds: int = 500, smoothing: float = 1.0) -> tuple[dict[str, float], float, np.ndarray]:
    """Expectation-maximisation on vote patterns.

    ``kinds`` is the kind of bad text that each rule knows (one kind, if not given); ``certain`` are the rules whose bad
    vote settles a text. Returns the posterior probability of good by pattern, the share of good texts, and the answer
    probabilities ``[class (good, then the kinds in order of name), rule, answer]``. The start is plain: patterns
    without a bad vote are good, others belong to the kinds of their bad votes in equal parts. ``smoothing`` is the
    number of texts added to each class, spread over the answers; nothing bounds how often a rule may be wrong.
    """
    if not counts:
        return {}, 0.5, np.empty((2, 0, 3))
    patterns = sorted(counts)
    votes = np.array([[int(c) for c in p] for p in patterns])
    weight = np.array([counts[p] for p in patterns], float)
    group = np.array(kinds or ["bad"] * votes.shape[1])
    against = np.stack([((votes == 0) & (group == k)).sum(1) for k in sorted(set(group))], 1)
    settled = (votes[:, list(certain)] == 0).any(1)
    hot = np.eye(3)[votes]
    belief = np.concatenate([(against.sum(1) == 0)[:, None], against], 1).astype(float)
    belief /= belief.sum(1, keepdims=True)
    for _ in range(rounds):
        held = weight[:, None] * belief
        mass = np.einsum("pk,prv->krv", held, hot) + smoothing / 3
        answers = mass / mass.sum(2, keepdims=True)
        share = (held.sum(0) + smoothing) / (weight.sum() + smoothing * belief.shape[1])
        log = np.einsum("prv,krv->pk", hot, np.log(answers)) + np.log(share)
        log[settled, 0] = -np.inf
        new = np.exp(log - log.max(1, keepdims=True))
        new /= new.sum(1, keepdims=True)
        moved, belief = np.abs(new - belief).max(), new
        if moved < 1e-9:
            break
    return dict(zip(patterns, belief[:, 0].tolist(), strict=True)), float(share[0]), answers


def judge(docs: DataFrame, ids: tuple[str, ...] = ("doc_id",), text: str = "text", least: float = 0.5) -> DataFrame:
    """Ids, features, ``base_failed``, ``votes``, ``posterior`` (of good) and ``kept``, one row per row of ``docs``."""
    spark = docs.sparkSession
    ensure_checkpoints(spark)
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    voted = features(docs, ids, text).withColumns({"base_failed": base, "votes": vote_pattern()}).checkpoint()
    counts = {r.votes: r["count"] for r in voted.groupBy("votes").count().collect()}  # 3 ** len(RULES) rows at most
    known_rules = rules()
    posterior, _, _ = fit(counts, [kind for kind, _, _ in known_rules.values()], tuple(list(known_rules).index(x) for x in CERTAIN))
    known = spark.createDataFrame(sorted(posterior.items()), "votes string, posterior double")
    judged = voted.join(F.broadcast(known), "votes", "left")  # as many rows as there are patterns
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= least))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdicts for every row of ``documents``."""
    return judge(table(spark, sf_dir, "documents")).select("doc_id", *FEATURES[:5], "base_failed", "kept", "posterior", "votes")


QUERIES = {"op2_quality_rules": (op2_quality_rules, None)}
