"""Token counts against the libraries on whole texts."""

import json
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from silverlode.llm import token_counts
from silverlode.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm import data

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"]
COUNTERS = {name: token_counts.Counter(name) for name in FILES}
PARTS = ["a", "bc", "the", " ", "  ", "\n", "\n\n", "\t", "1", "23", ".", "'s", "'", "<|endoftext|>", "é", "日本", "。", "́", " ", "😀", "_", "|", "don't", "\x1c", "　", "ſ", "İ", "\x85"]


def whole(name, texts):
    """Numbers of tokens, each text given to the library as it is."""
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=token_counts.path(name))
        return [len(model.encode(t)) for t in texts]
    library = Tokenizer.from_file(token_counts.path(name))
    return [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("name", FILES)
def test_cuts_are_known_for_the_public_files(name):
    assert COUNTERS[name]._cut is not None


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=250, deadline=None)
@given(parts=st.lists(st.sampled_from(PARTS), max_size=40), size=st.integers(1, 9))
def test_cuts_change_no_count(name, parts, size):
    text, counter = "".join(parts), COUNTERS[name]
    assert counter.counts([text], 1, size, 40)[0] == counter._lengths([text])[0]


@settings(max_examples=250, deadline=None)
@given(text=st.text(max_size=60))
def test_any_characters(text):
    for name in FILES:
        assert COUNTERS[name].counts([text], 1, 1, 40)[0] == COUNTERS[name]._lengths([text])[0]


def test_unknown_descriptions_are_not_cut():
    with open(token_counts.path(FILES[0]), encoding="utf-8") as file:
        spec = json.load(file)
    assert token_counts.json_cuts(spec) == token_counts.BETWEEN_CLASSES
    added = {"content": "<a b>", "lstrip": False, "rstrip": False}
    assert token_counts.json_cuts({**spec, "added_tokens": [added]}) is None
    assert token_counts.json_cuts({**spec, "added_tokens": [{**added, "content": "<m>", "rstrip": True}]}) is None
    assert token_counts.json_cuts({**spec, "added_tokens": [{**added, "content": "<x1>"}]}) == token_counts.BEFORE_SPACE
    assert token_counts.json_cuts({**spec, "pre_tokenizer": {"type": "Metaspace"}}) is None
    assert token_counts.json_cuts({**spec, "normalizer": {"type": "Prepend", "prepend": "x"}}) is None
    assert token_counts.json_cuts({**spec, "pre_tokenizer": None}) is None


@pytest.mark.parametrize("name", FILES)
def test_remembered_words_are_bounded(name, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 20)
    monkeypatch.setattr(token_counts, "SHORT", 6)
    counter, texts = token_counts.Counter(name), [data.prose(i, 80) for i in range(20)]
    assert counter.counts(iter(texts), 20, 100, 300).tolist() == whole(name, texts)
    assert len(counter._known) < 200 and max(map(len, counter._known)) <= 6


def test_a_text_without_a_safe_place_is_one_piece():
    text = "x" * 5000
    assert list(COUNTERS[FILES[0]].blocks(text, 10)) == [text]


@pytest.mark.parametrize("name", FILES)
def test_odd_rows(spark, name):
    rows = [*data.odd_texts(), (30, "a<|endoftext|>b <|endoftext|>"), (31, data.prose(7, 400) + "<|endoftext|>" * 3)]
    got = token_counts.token_counts(data.table(spark, rows), ("doc_id", "text", "chunk"), tokenizer=name, limit=100, block_chars=50, batch_bytes=2000).collect()
    counts = whole(name, [t or "" for _, t in rows])
    want = Counter((i, t, 1, len((t or "").encode()), n, n > 100) for (i, t), n in zip(rows, counts))
    assert Counter(tuple(r) for r in got) == want


def test_empty_table(spark):
    out = token_counts.token_counts(data.table(spark, []))
    assert out.collect() == [] and out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_query(spark):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_token_counts"][0](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    counts = whole(FILES[0], [r.text or "" for r in docs])
    assert got == {r.doc_id: (len((r.text or "").encode()), n, n > 512) for r, n in zip(docs, counts)}
