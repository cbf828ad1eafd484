"""Token counts: texts go into the tokenizer's library in batches of like size, and only lengths come out.

A text is cut at places no token can cross: into blocks of about ``block_chars`` characters, so a text of any length is
encoded in bounded memory, and these into words. Blocks of many rows make up batches of about ``batch_bytes`` bytes; a
batch's different words go to the library at once, and their lengths are added up per row. Lengths of short words are
remembered, a bounded number of them. Ids never leave the library.

Where a cut is safe is derived from the tokenizer's own description (``json_cuts``, ``piece_cuts``). A tokenizer whose
description is not one of the known forms is given whole texts; so is a text without any such place, e.g. one endless word.

A null text counts as empty: no bytes, no tokens. Repeated rows are counted each. An empty table gives an empty result.
Rows stay in the task that read them; nothing is shuffled. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from silverlode.llm.common import batches_of, schema_of, slices, table, utf8

TOKENIZER, LIMIT = "byte_bpe_50k.json", 512
BLOCK_CHARS, BATCH_BYTES = 1 << 16, 1 << 20
REMEMBERED, SHORT = 1 << 18, 48
#: A character that is no white space, then white space. The white space begins the next piece.
BEFORE_SPACE = r"(?<=[!-~\p{L}\p{N}])(?=[ \n])"
#: Also between ASCII letters and digits, and before the stops of scripts that write no spaces.
BETWEEN_CLASSES = BEFORE_SPACE + r"|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[\p{Han}\p{Hiragana}\p{Katakana}])(?=[，。、！？])"
#: One space between visible ASCII characters; it is dropped, since the next piece gets one put before it.
AT_SPACE = r"(?<=[!-~]) (?=[!-~])"
#: Where blanks and line feeds are the only white space, every run of them begins a word.
WORD, ODD_SPACE = re.compile(r"[ \n]*[^ \n]+|[ \n]+"), re.compile(r"[^\S \n]")


def path(name: str) -> str:
    """A file as given, or one of the public ones by name."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def json_cuts(spec: dict) -> str | None:
    """The places where a text may be cut for a tokenizer of the ``tokenizers`` library, as a pattern, or None.

    Known: byte-pair merges within words, where words are found by the usual byte-level expression or by a split that
    drops white space; normalizers that look at single characters or at runs of white space. No added token may
    reach over a cut: none holds white space or takes it from its right side, and none holds a letter beside a digit.
    """
    steps = lambda part, key: [] if part is None else part[key] if part["type"] == "Sequence" else [part]
    if (spec.get("model") or {}).get("type") != "BPE" or spec["model"].get("dropout"):
        return None
    if any(n["type"] not in ("NFC", "NFD", "Lowercase", "Replace") for n in steps(spec.get("normalizer"), "normalizers")):
        return None
    if any(n["type"] == "Replace" and n.get("pattern") != {"Regex": r"\s+"} for n in steps(spec.get("normalizer"), "normalizers")):
        return None
    added = spec.get("added_tokens") or []
    if any(regex.search(r"\s", t["content"]) or t.get("rstrip") or t.get("lstrip") for t in added):
        return None
    words = steps(spec.get("pre_tokenizer"), "pretokenizers")
    plain = [w for w in words if w["type"] == "ByteLevel" and not w.get("add_prefix_space")]
    if not words or not plain or len(plain) + sum(w["type"] == "Split" for w in words) != len(words):
        return None
    if words == plain and len(words) == 1 and plain[0].get("use_regex", True):
        beside = any(regex.search(BETWEEN_CLASSES, t["content"]) for t in added)
        return BEFORE_SPACE if beside or spec.get("normalizer") else BETWEEN_CLASSES
    splits = [w for w in words if w["type"] == "Split"]
    dropping = len(splits) == 1 and splits[0]["behavior"] == "Removed" and splits[0].get("invert") and r"[^\s\p{L}\p{N}]+" in splits[0]["pattern"].get("Regex", "")
    return BEFORE_SPACE if dropping and not any(w.get("use_regex", True) for w in plain) else None


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a serialised message, as its public wire format defines them."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at : at + size]
        at += size


def piece_cuts(model: bytes) -> str | None:
    """The same for a model of the ``sentencepiece`` library.

    Known: byte-pair merges with a space put before the text, unchanged characters, and no piece in which a space follows
    anything but a space. Then nothing is merged over a cut, and the space dropped there is put back in front.
    """
    spec = list(_fields(model))
    pieces = [dict(_fields(x)).get(1, b"").decode() for n, x in spec if n == 1]
    trainer, normalizer = (dict(_fields(next((x for n, x in spec if n == k), b""))) for k in (2, 3))
    merges, prefixed, suffix = trainer.get(3, 1) == 2, normalizer.get(3, 1) == 1, trainer.get(24, 0) == 1
    plain = normalizer.get(1, b"") == b"identity" and not normalizer.get(2)
    inner = any(a != "▁" and b == "▁" for p in pieces for a, b in zip(p, p[1:]))
    return AT_SPACE if merges and prefixed and plain and not suffix and not inner else None


class Counter:
    """Numbers of tokens of texts, by the library that goes with the file's ending; no begin, end or added tokens."""

    def __init__(self, tokenizer: str = TOKENIZER):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        name = path(tokenizer)
        if name.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=name)
            cuts = piece_cuts(model.serialized_model_proto())
            self._lengths = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            with open(name, encoding="utf-8") as file:
                cuts = json_cuts(json.load(file))
            library = Tokenizer.from_file(name)
            library.no_truncation()
            library.no_padding()
            self._lengths = lambda texts: [len(x) for x in library.encode_batch_fast(texts, add_special_tokens=False)]
        self._cut = regex.compile(cuts) if cuts else None
        self._by_word = cuts in (BEFORE_SPACE, BETWEEN_CLASSES)
        self._known: dict[str, int] = {}

    def blocks(self, text: str, size: int = BLOCK_CHARS) -> Iterator[str]:
        """The text in pieces whose numbers of tokens add up to the text's; each about ``size`` characters."""
        start = 0
        while self._cut and len(text) - start > size:
            found = self._cut.search(text, start + size)
            if not found:
                break
            yield text[start : found.start()]
            start = found.end()
        yield text[start:] if start else text

    def words(self, block: str) -> list[str]:
        """The same at every safe place, or at those before blanks and line feeds."""
        if self._cut is None:
            return [block]
        if self._by_word and not ODD_SPACE.search(block):
            return WORD.findall(block)
        out, start = [], 0
        for found in self._cut.finditer(block):
            out.append(block[start : found.start()])
            start = found.end()
        return [*out, block[start:]]

    def _flush(self, held: list[tuple[int, list[str]]], out: np.ndarray) -> None:
        known, new = self._known, set()
        if len(known) > REMEMBERED:
            known.clear()
        for _, words in held:
            new.update(words)
        new = [w for w in new if w not in known]
        known.update(zip(new, self._lengths(new)))
        for row, words in held:
            out[row] += sum(map(known.__getitem__, words))
        for word in new:
            if len(word) > SHORT:
                del known[word]
        held.clear()

    def counts(self, texts: Iterator[str], n: int, size: int = BLOCK_CHARS, batch_bytes: int = BATCH_BYTES) -> np.ndarray:
        """Tokens per text, for ``n`` texts."""
        out, held, weight = np.zeros(n, np.int64), [], 0
        for row, text in enumerate(texts):
            for block in self.blocks(text, size):
                held.append((row, self.words(block)))
                weight += len(block.encode())
                if weight >= batch_bytes:
                    self._flush(held, out)
                    weight = 0
        self._flush(held, out)
        return out


def token_counts(
    docs: DataFrame, ids: tuple[str, ...] = ("doc_id",), text: str = "text", tokenizer: str = TOKENIZER, limit: int = LIMIT,
    block_chars: int = BLOCK_CHARS, batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Id columns, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens)."""
    ids = list(ids)
    fields = [("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer)
        for batch in slices(batches, "raw__", 8 * batch_bytes):
            raw = batch.column(len(ids))
            sizes = [len(x.as_buffer()) for x in raw]
            counts = counter.counts((x.as_buffer().to_pybytes().decode("utf-8", "replace") for x in raw), len(raw), block_chars, batch_bytes)
            yield batches_of([sizes, counts.tolist(), (counts > limit).tolist()], batch, ids, fields)

    added = "n_bytes long, n_tokens long, over_limit boolean"
    return docs.select(*ids, utf8(text).alias("raw__")).mapInArrow(run, schema_of(docs, ids, added))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``; more than 512 tokens are over the limit."""
    return token_counts(table(spark, sf_dir, "documents"))


QUERIES = {"op11_token_counts": (op11_token_counts, None)}
