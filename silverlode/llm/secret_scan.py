"""Secrets in texts, also inside URL, Unicode, base64 and compressed layers.

The base patterns are matched on the whole text. Then a worklist unwraps layers: all URL runs of a text, all its Unicode
escapes and each base64 run become a new text, which is scanned and searched for further layers, until nothing new appears. A layer whose content was met
before is not entered again, so a text that decodes to itself ends. Every character of a layer remembers the span of
the original text it came from (one span for a whole base64 or compressed run), so all findings have spans there.

A text's work stays in one row of an Arrow batch; nothing is shuffled. Null and empty texts give a row without spans.
Compressed data are found in base64 runs and in bytes written as URL or Unicode escapes. All members are unpacked to
the end, in parts of about ``max_layer`` characters that end where no match can go on; ``n_oversize`` counts the layers
longer than that. Bytes that are no UTF-8 become U+FFFD; text with a zero byte beside every character is also read
without them (UTF-16). Where something cannot be read (a valid header whose data break off, an unbroken run of more than
four parts, a row with more than ``MAX_ROW`` characters of layers), ``unread`` has the span of the whole run or row,
which the redaction takes out. Two bytes of a bare zlib header occur by chance in any data; they count only if at least
``TELLING`` characters that read came out before. The cost of a run is in proportion to its length, noise included.
"""

from __future__ import annotations

import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from collections.abc import Callable, Generator, Iterator
from itertools import islice
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm.common import batches_of, schema_of, table, utf8

# Fixed patterns of the base kinds, and the least length of what they catch.
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
# The same at every place, also inside another match: decoded blanks and quotes may end a value early.
EACH_ASSIGN = re.compile(f"(?={ASSIGN.pattern})", re.ASCII)
KINDS = ("assign", "access", "hex")
# A run that holds something that could not be read is a span of its own kind.
NAMES, UNREAD = (*KINDS, "unread"), 3
HINTS = ("passw", "secret", "token", "api")

PERCENT = re.compile(r"%[0-9A-Fa-f]{2}")
PERCENT_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
# A run goes on over line ends, also escaped ones; what stands beside it may be in the alphabet too.
BREAK = re.compile(r"[ \t]*\r?\n[ \t]*|(?:\\r)?\\n")
BASE64 = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{16,}}(?:(?:{BREAK.pattern})[A-Za-z0-9+/_-]+)*={{0,2}}")
PACKED = re.compile(rb"\x1f\x8b\x08[\x00-\x1f].{4}[\x00\x02\x04][\x00-\x0d\xff]|BZh[1-9]1AY&SY|\xfd7zXZ\x00", re.DOTALL)
STARTS = re.compile(PACKED.pattern + rb"|\x78[\x01\x5e\x9c\xda]")
# Bytes written as escapes between characters that stand for themselves, and what compressed ones begin with.
URL_BYTES = re.compile(r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9._~/!*'()+:,;=@$&^-])+")
URL_START = re.compile(r"(?i)%1f%8b|%fd(?:7|%37)|(?:B|%42)(?:Z|%5a)(?:h|%68)|(?:x|%78)(?:%01|%5e|\^|%9c|%da)")
ESCAPED_BYTES = re.compile(r"""(?:\\x[0-9A-Fa-f]{2}|\\u00[0-9A-Fa-f]{2}|\\[nrt0\\'"]|[\x20\x21\x23-\x26\x28-\x5b\x5d-\x7e])+""")
ESCAPED_START = re.compile(r"(?i){0}1f{0}8b|{0}fd(?:7|{0}37)|(?:B|{0}42)(?:Z|{0}5a)(?:h|{0}68)|(?:x|{0}78)(?:\^|{0}(?:01|5e|9c|da))".replace("{0}", r"\\(?:x|u00)"))
ONE_ESCAPED = re.compile(r"""\\(?:x|u00)([0-9A-Fa-f]{2})|\\([nrt0\\'"])""")
ONE_BYTE = re.compile(r"""%[0-9A-Fa-f]{2}|\\(?:x|u00)[0-9A-Fa-f]{2}|\\[nrt0\\'"]|.""")
SHORT_ESCAPES = {"n": "\n", "r": "\r", "t": "\t", "0": "\0"}
# Characters with a zero beside each: UTF-16.
WIDE = re.compile(r"(?:[^\0]\0){4}|(?:\0[^\0]){4}")
WIDE_PAIR = re.compile(r"[^\0]\0|\0[^\0]")
TELLING = 32
# What a match and all its encoded forms are made of; the shortest match has 12 characters.
ISLAND = re.compile(r"[\t\n\r\0\x20-\x7e]{12,}")
# Behind these no match and no encoded run goes on.
CLOSED = re.compile(r"""[^A-Za-z0-9+/_.=\-"':%\\&#;{}\s]|\n[ \t\r]*\n|[G-Zg-z]\x20+(?=[A-Za-z])""")
# Length of a part of a compressed layer, how many of them an unbroken run may take, characters of all layers of a row.
MAX_LAYER, HELD, MAX_ROW = 8_000_000, 4, 1 << 32
ENDED = (None, None, False)

Span = tuple[int, int]


def base_spans(text: str, assign: re.Pattern = ASSIGN) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the base patterns, ordered so."""
    found = []
    lower = text.lower()
    if any(x in lower for x in HINTS):
        found += [(m.start(), m.end(2), 0) for m in assign.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], x[2], x[1]))


class Layer:
    """A decoded text; character i comes from ``starts[i]`` to ``ends[i]`` of the original, or all from ``whole``."""

    def __init__(self, text: str, at: tuple[np.ndarray, np.ndarray] | None, whole: Span | None):
        self.text, self.at, self.whole = text, at, whole

    def span(self, start: int, end: int) -> Span:
        if self.at is None:
            return self.whole or (start, end)
        return int(self.at[0][start]), int(self.at[1][end - 1])

    def rewritten(self, pieces: list[tuple[int, int, str]]) -> Layer:
        """The text with each piece (start, end) replaced by one character."""
        parts, last = [], 0
        for start, end, c in pieces:
            parts += [self.text[last:start], c]
            last = end
        text = "".join([*parts, self.text[last:]])
        if self.whole:
            return Layer(text, None, self.whole)
        first, stop = (np.fromiter((x[k] for x in pieces), np.int64, len(pieces)) for k in (0, 1))
        shrunk = np.r_[0, np.cumsum(stop - first - 1)]
        place = first - shrunk[:-1]
        starts = np.arange(len(text)) + np.repeat(shrunk, np.diff(np.r_[0, place + 1, len(text)]))
        ends = starts + 1
        ends[place] = stop
        return Layer(text, (starts, ends) if self.at is None else (self.at[0][starts], self.at[1][ends - 1]), None)


def readable(text: str) -> bool:
    if text.count("\ufffd") * 20 > len(text):
        return False
    bad = sum(1 for c in text if c == "\ufffd" or not (c.isprintable() or c in "\t\r\n"))
    return len(text) >= 4 and bad * 20 <= len(text)


def islands(layer: Layer) -> Layer:
    """What can hold a match, encoded or not; everything between is one U+FFFD. Noise is short then, and loses nothing."""
    pieces, last = [], 0
    for m in ISLAND.finditer(layer.text):
        if m.start() > last:
            pieces.append((last, m.start(), "\ufffd"))
        last = m.end()
    if last < len(layer.text):
        pieces.append((last, len(layer.text), "\ufffd"))
    return layer.rewritten(pieces)


def opener(data: bytes | memoryview) -> Callable | None:
    """What unpacks gzip, zlib, bzip2 or xz data."""
    if data[:2] == b"\x1f\x8b":
        return lambda: zlib.decompressobj(31)
    if len(data) > 2 and data[0] == 0x78 and (data[0] * 256 + data[1]) % 31 == 0:
        return zlib.decompressobj
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor
    return lzma.LZMADecompressor if data[:6] == b"\xfd7zXZ\x00" else None


def unpacked(data: bytes | memoryview, most: int) -> Iterator[bytes | None]:
    """Content of all members in parts of up to ``most`` bytes, and what stands between and behind them; None where the data break off."""
    while data:
        make = opener(data)
        if make is None:
            more = PACKED.search(data)
            yield data[: more.start()] if more else data
            data = data[more.start() :] if more else b""
            continue
        one = make()
        try:
            while not one.eof:
                out = one.decompress(data, most)
                data = getattr(one, "unconsumed_tail", b"")
                if out:
                    yield out
                elif not one.eof and getattr(one, "needs_input", not data):
                    yield None
                    return
        except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
            yield None
            return
        data = one.unused_data.lstrip(b"\0")


def closed(text: str) -> int:
    """The last place that no match and no encoded run can go over; 0 if there is none."""
    for size in (1 << 16, 1 << 20, len(text)):
        start = max(0, len(text) - size)
        place = 0
        for m in CLOSED.finditer(text, start):
            place = m.end()
        if place or not start:
            return place
    return 0


def contents(data: bytes | memoryview, most: int, span: Span) -> Generator[tuple[Layer | None, Span, bool], None, bool]:
    """The content of compressed data as layers that nothing goes over, and whether it is longer than ``most`` (said
    once). None stands for something that could not be read. Returns whether the data were compressed at all."""
    parts = unpacked(data, most) if opener(data) else iter((None,))
    part = next(parts, b"")
    if part is None and PACKED.match(data):
        yield None, span, False
    if not part:
        return part is not None or PACKED.match(data) is not None
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    held, size, over, broken = "", 0, False, False
    while part:
        held += decoder.decode(part)
        size += len(part)
        if len(held) > most:
            place = closed(held)
            if place:
                yield Layer(held[:place], None, span), span, size > most and not over
                held, over = held[place:], True
            elif len(held) > HELD * most:
                yield Layer(held, None, span), span, not over
                held, over, broken = held[-(most // 2) :], True, True
        part = next(parts, b"")
    held += decoder.decode(b"", True)
    yield Layer(held, None, span), span, size > most and not over
    lost = part is None and (PACKED.match(data) is not None or len(held) >= TELLING and readable(held))
    if broken or lost:
        yield None, span, False
    return part is not None or lost


def _percent(layer: Layer) -> Layer:
    """All URL runs of a text decoded at once; bytes that are no UTF-8 become U+FFFD one by one."""
    pieces = []
    for m in PERCENT_RUN.finditer(layer.text):
        used = m.start()
        for c in unquote_to_bytes(m[0]).decode("utf-8", "surrogateescape"):
            lost = 0xDC80 <= ord(c) < 0xDD00
            width = 3 if lost else 3 * len(c.encode())
            pieces.append((used, used + width, "\ufffd" if lost else c))
            used += width
    return layer.rewritten(pieces)


def _escapes(layer: Layer) -> Layer:
    """All Unicode escapes of a text decoded at once."""
    pieces = []
    for m in ESCAPE.finditer(layer.text):
        number = int(m[5]) if m[5] else int(m[1] or m[2] or m[3] or m[4], 16)
        pieces.append((m.start(), m.end(), chr(number) if number < 0x110000 and not 0xD800 <= number < 0xE000 else "\ufffd"))
    return layer.rewritten(pieces)


def _plain(data: bytes, shift: int, lines: list[Span], layer: Layer, span: Span) -> Layer:
    """Data of a base64 run from its character ``shift`` on as a text; over several lines each character has the span of its line."""
    if len(lines) == 1:
        return Layer(data.decode("utf-8", "replace"), None, span)
    text = data.decode("utf-8", "surrogateescape")
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    lost = (codes >= 0xDC80) & (codes < 0xDD00)
    width = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000) - 2 * lost
    last = np.cumsum(width) - 1
    ends = np.cumsum([b - a for a, b in lines])
    spans = np.array([layer.span(a, b) for a, b in lines], np.int64)
    line = lambda at: np.minimum(np.searchsorted(ends, at, side="right"), len(lines) - 1)
    first, final = line(shift + (last - width + 1) * 8 // 6), line(shift + (last * 8 + 7) // 6)
    return Layer("".join("\ufffd" if 0xDC80 <= ord(c) < 0xDD00 else c for c in text), (spans[first, 0], spans[final, 1]), None)


def _inside(data: bytes, most: int, span: Span, start: int = 0) -> Iterator[tuple[Layer | None, Span, bool]]:
    """Compressed data that begin anywhere in others; what follows the first that unpack is read with them."""
    view = memoryview(data)
    for x in STARTS.finditer(data, start):
        if (yield from contents(view[x.start() :], most, span)):
            return


def _used(data: bytes, most: int) -> int:
    """How many bytes the first members that unpack reach to; all if none does, since the text goes on in the alphabet."""
    view = memoryview(data)
    for x in STARTS.finditer(data):
        rest = view[x.start() :]
        try:
            while make := opener(rest):
                one = make()
                while not one.eof:
                    out = one.decompress(rest, most)
                    rest = getattr(one, "unconsumed_tail", b"")
                    if not out and not one.eof and getattr(one, "needs_input", not rest):
                        raise EOFError
                rest = one.unused_data
            return len(data) - len(rest)
        except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
            continue
    return len(data)


def _escaped_bytes(layer: Layer, most: int, run: re.Pattern, begin: re.Pattern, decode: Callable[[str], bytes]) -> Iterator[tuple[Layer | None, Span, bool]]:
    """Compressed data whose bytes are written as escapes."""
    x = begin.search(layer.text)
    while x:
        written = run.match(layer.text, x.start())[0]
        data = decode(written)
        size = _used(data, most)
        if size < len(data):
            written = "".join(islice((t[0] for t in ONE_BYTE.finditer(written)), size))
        stop = x.start() + len(written)
        yield from _inside(data[:size], most, layer.span(x.start(), stop))
        x = begin.search(layer.text, stop)


def _unescaped(run: str) -> bytes:
    return ONE_ESCAPED.sub(lambda m: chr(int(m[1], 16)) if m[1] else SHORT_ESCAPES.get(m[2], m[2]), run).encode("latin-1")


def _narrow(layer: Layer) -> Layer:
    """UTF-16 read as bytes, without the zeros."""
    return layer.rewritten([(m.start(), m.end(), m[0].strip("\0")) for m in WIDE_PAIR.finditer(layer.text)])


def _base64(m: re.Match, layer: Layer, most: int) -> Iterator[tuple[Layer | None, Span, bool]]:
    """Layers of a base64 run at its four alignments, so that characters before the encoded part do not matter; at one if
    that reads. Compressed data may begin anywhere."""
    lines, at = [], m.start()
    for x in BREAK.finditer(layer.text, m.start(), m.end()):
        lines.append((at, x.start()))
        at = x.end()
    lines.append((at, m.end()))
    body = "".join(layer.text[a:b] for a, b in lines).rstrip("=").replace("-", "+").replace("_", "/")
    span = layer.span(m.start(), m.end())
    for shift in range(4):
        size = len(body) - shift
        data = binascii.a2b_base64(body[shift : len(body) - (size % 4 == 1)] + "=" * (-size % 4 % 3))
        if not (yield from contents(data, most, span)):
            plain = _plain(data, shift, lines, layer, span)
            yield plain, span, False
            if not shift and "\ufffd" not in plain.text and all(c.isprintable() or c in "\t\r\n" for c in plain.text):
                return
            yield from _inside(data, most, span, 1)


def layers_of(layer: Layer, most: int) -> Iterator[tuple[Layer | None, Span, bool]]:
    """The layers directly inside a text, None for an unreadable one; its span; whether one was longer than ``most``."""
    text = layer.text
    if "%" in text and PERCENT.search(text):
        yield _percent(layer), (0, 0), False
        yield from _escaped_bytes(layer, most, URL_BYTES, URL_START, unquote_to_bytes)
    if ("\\" in text or "&#" in text) and ESCAPE.search(text):
        yield _escapes(layer), (0, 0), False
        yield from _escaped_bytes(layer, most, ESCAPED_BYTES, ESCAPED_START, _unescaped)
    if "\0" in text and WIDE.search(text):
        yield _narrow(layer), (0, 0), False
    for m in BASE64.finditer(text):
        yield from _base64(m, layer, most)


def scan(text: str, most: int = MAX_LAYER, row: int = MAX_ROW) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int, int]:
    """Base spans; all spans; number of layers that read as text or hold a secret; number of layers longer than ``most``.

    A row whose layers hold more than ``row`` characters is unread as a whole.
    """
    base = base_spans(text)
    spans, entered, over, size = set(base), 0, 0, 0
    seen, work = set(), [(text, layers_of(Layer(text, None, None), most))]
    while work:
        outer, inside = work[-1]
        inner, span, cut = next(inside, ENDED)
        over += cut
        if span is None:
            work.pop()
        elif inner is None:
            spans.add((*span, UNREAD))
        elif inner.text and inner.text != outer:
            if inner.text.count("\ufffd") * 20 > len(inner.text):
                inner = islands(inner)
            key = (hashlib.blake2b(inner.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), inner.span(0, len(inner.text)))
            if key in seen:
                continue
            seen.add(key)
            size += len(inner.text)
            if size > row:
                spans.add((0, len(text), UNREAD))
                break
            found = base_spans(inner.text, EACH_ASSIGN)
            entered += bool(found) or readable(inner.text)
            spans.update((*inner.span(a, b), kind) for a, b, kind in found)
            work.append((inner.text, layers_of(inner, most)))
    return base, sorted(spans, key=lambda x: (x[0], x[2], x[1])), entered, over


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{NAMES[k]}:{a}:{b}" for a, b, k in spans)


def secrets(docs: DataFrame, ids: tuple[str, ...] = ("doc_id",), text: str = "text", max_layer: int = MAX_LAYER) -> DataFrame:
    """Ids, ``base``, ``found`` and ``unread`` (arrays of start, end, kind; code points, end exclusive), ``n_layers``, ``n_oversize``."""
    ids = list(ids)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
    fields = [("base", span), ("found", span), ("unread", span), ("n_layers", pa.int64()), ("n_oversize", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = lambda spans: [{"start": a, "end": b, "kind": NAMES[k]} for a, b, k in spans]
        for batch in batches:
            out = [scan(x.decode("utf-8", "replace"), max_layer) for x in batch.column(len(ids)).to_pylist()]
            named = [[y for y in x[1] if y[2] != UNREAD] for x in out]
            unread = [[y for y in x[1] if y[2] == UNREAD] for x in out]
            spans = [[rows(x[0]) for x in out], [rows(x) for x in named], [rows(x) for x in unread]]
            yield batches_of([*spans, [x[2] for x in out], [x[3] for x in out]], batch, ids, fields)

    kind = "array<struct<start:long,end:long,kind:string>>"
    return docs.select(*ids, utf8(text).alias("raw")).mapInArrow(run, schema_of(docs, ids, f"base {kind}, found {kind}, unread {kind}, n_layers long, n_oversize long"))


def span_text(column: str) -> Column:
    return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; ``length`` follows the new text if there."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = batch.column(at).to_pylist()
            for i, x in enumerate(texts):
                if not x:
                    continue
                out, last = [], 0
                for a, b, kind in scan(x)[1]:
                    if b > last:
                        if a >= last:
                            out += [x[last:a], f"<{NAMES[kind]}>"]
                        last = b
                if last:
                    texts[i] = "".join(out) + x[last:]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if length in names:
                n = batch.schema.get_field_index(length)
                columns[n] = pa.array([old if x is None else len(x) for x, old in zip(texts, columns[n].to_pylist(), strict=True)], columns[n].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every row of ``documents``."""
    found = secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    digest = F.sha2(span_text("base"), 256).alias("base_sha256")
    return found.select("doc_id", *[count(k) for k in KINDS], digest, span_text("found").alias("spans"), span_text("unread").alias("unread"), "n_layers", "n_oversize")


QUERIES = {"op9_secret_scan": (op9_secret_scan, None)}
