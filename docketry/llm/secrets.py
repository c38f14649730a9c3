"""Secret scans through nested encodings.

A text is scanned, and so is every layer that can be unwrapped from it: URL escapes, Unicode escapes, base64 (also
hexadecimal) and compressed bytes, nested in any order. The layers of a text wait in a worklist until none is left; a layer
that was seen before (by its content and place) is not taken again, which ends cycles. Every layer carries, for each
of its characters, the part of the original text it came from, so findings are reported as spans of the original.
"""

from __future__ import annotations

import binascii
import bz2
import collections
import hashlib
import itertools
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm._shared import slices

#: Kinds in their order.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # maximal runs, so the length can be asked for at once
_HEX = re.compile(r"[0-9a-f]{32,}")

_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}|(?:\\x[0-9A-Fa-f]{2})+|&\#[0-9]{1,7};|&\#[xX][0-9A-Fa-f]{1,6};")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}+={0,2}")
#: Runs over line ends, which may be escaped as in JSON.
_WRAPPED = re.compile(r"[A-Za-z0-9+/_-]++(?:[ \t]*+(?:\r?\n|(?:\\r)?\\n)[ \t]*+[A-Za-z0-9+/_-]++)++")
_LINE_END = re.compile(r"[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t]*")
_HEX_BYTES = re.compile(r"[0-9A-Fa-f]{28,}")
#: The shortest finding has 14 signs, and no escape or base64 makes it shorter.
_STRETCH = re.compile("[\t\n\r\x20-\x7e\x80-퟿-\U0010ffff]{14}")
#: Stretches of two-byte and four-byte signs of the first page, in either order of their bytes.
_WIDE = re.compile(rb"((?:[\t\n\r\x20-\x7e\xa0-\xff]\x00{3}){14,})|((?:\x00{3}[\t\n\r\x20-\x7e\xa0-\xff]){14,})|((?:[\t\n\r\x20-\x7e\xa0-\xff]\x00){14,})|((?:\x00[\t\n\r\x20-\x7e\xa0-\xff]){14,})")
#: How compressed streams begin: gzip, zlib, bz2, xz, zstandard.
_MAGIC = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\(\xb5/\xfd")
_URL_SAFE = str.maketrans("-_", "+/")


def find(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end (exclusive) of the secrets that stand plainly in a text, by start and then kind."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return ordered(found)


def ordered(spans) -> list[tuple[str, int, int]]:
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


class Layer:
    """A text with, for each character, the start and end of its origin in the original (None: itself)."""

    __slots__ = ("ends", "starts", "text")

    def __init__(self, text: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None):
        self.text, self.starts, self.ends = text, starts, ends

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        if self.starts is None:
            at = np.arange(len(self.text))
            return at, at + 1
        return self.starts, self.ends

    def replaced(self, pattern: re.Pattern, decode) -> Layer | None:
        """The layer with each match replaced by what it stands for; None if nothing was replaced.

        ``decode`` gives a match's text and how many signs each of its characters took, or None.
        """
        parts, starts, ends, at = [], [], [], 0
        own = None
        for m in pattern.finditer(self.text):
            if (new := decode(m[0])) is None:
                continue
            own = own or self.arrays()
            text, widths = new
            upto = m.start() + np.cumsum(np.array(widths, np.int64))
            parts += [self.text[at : m.start()], text]
            starts += [own[0][at : m.start()], own[0][upto - widths]]
            ends += [own[1][at : m.start()], own[1][upto - 1]]
            at = m.end()
        if not parts:
            return None
        starts.append(own[0][at:])
        ends.append(own[1][at:])
        return Layer("".join(parts) + self.text[at:], np.concatenate(starts), np.concatenate(ends))


def _from_escapes(run: str, data: bytes, signs: int) -> tuple[str, list[int]] | None:
    """A run of escaped bytes as text; bytes that are not UTF-8 stay as they are written."""
    parts, widths, at = [], [], 0
    for c in data.decode("utf-8", "surrogateescape"):
        size = signs if "\udc80" <= c <= "\udcff" else signs * len(c.encode())
        if "\udc80" <= c <= "\udcff":
            parts.append(run[at : at + size])
            widths += [1] * size
        else:
            parts.append(c)
            widths.append(size)
        at += size
    text = "".join(parts)
    return (text, widths) if text != run else None


def _from_url(run: str) -> tuple[str, list[int]] | None:
    return _from_escapes(run, bytes.fromhex(run.replace("%", "")), 3)


def _from_unicode(run: str) -> tuple[str, list[int]] | None:
    try:
        if run[0] == "&":
            return chr(int(run[3:-1], 16) if run[2] in "xX" else int(run[2:-1])), [len(run)]
        if run.startswith("\\u{"):
            return chr(int(run[3:-1], 16)), [len(run)]
        if run[1] == "U":
            return chr(int(run[2:], 16)), [len(run)]
    except (ValueError, OverflowError):
        return None
    if run[1] == "x":
        return _from_escapes(run, bytes.fromhex(run.replace("\\x", "")), 4)
    parts, widths, at = [], [], 0
    for c in bytes.fromhex(run.replace("\\u", "")).decode("utf-16-be", "surrogatepass"):
        size = 12 if ord(c) > 0xFFFF else 6
        alone = "\ud800" <= c <= "\udfff"
        parts.append(run[at : at + size] if alone else c)
        widths += [1] * size if alone else [size]
        at += size
    text = "".join(parts)
    return (text, widths) if text != run else None


#: Escapes that a quoted or a printed byte string has besides those of the bytes that are no signs.
_PLAIN = {"n": 10, "r": 13, "t": 9, "a": 7, "b": 8, "f": 12, "v": 11, "0": 0, "\\": 92, "'": 39, '"': 34, "/": 47}
_URL_BYTES = re.compile(r"(?:[!-$&-~]|%[0-9A-Fa-f]{2})*+")
_JSON_BYTES = re.compile(r"""(?:[ -\[\]-~]|\\u00[0-9A-Fa-f]{2}|\\[nrtbf/\\"])*+""")
_JSON_MAGIC = re.compile(
    r"\\u001[fF]\\u008[bB](?:\\u0008|\\b)|(?:x|\\u0078)(?:\\u0001|\\u005[eE]|\^|\\u009[cC]|\\u00[dD][aA])|(?:B|\\u0042)(?:Z|\\u005[aA])(?:h|\\u0068)(?:[1-9]|\\u003[1-9])|\\u00[fF][dD](?:7|\\u0037)(?:z|\\u007[aA])(?:X|\\u0058)(?:Z|\\u005[aA])\\u0000|(?:\(|\\u0028)\\u00[bB]5(?:/|\\/|\\u002[fF])\\u00[fF][dD]"
)
_PRINTED_BYTES = re.compile(r"""(?:[ -\[\]-~]|\\x[0-9A-Fa-f]{2}|\\[nrtabfv0\\'"])*+""")
_TOKEN = re.compile(r"""%([0-9A-Fa-f]{2})|\\(?:x|u00)([0-9A-Fa-f]{2})|\\([nrtabfv0/\\'"])|(.)""", re.DOTALL)
_URL_MAGIC = re.compile(r"%1[fF]%8[bB](?:%08)|(?:x|%78)(?:%01|%5[eE]|\^|%9[cC]|%[dD][aA])|(?:B|%42)(?:Z|%5[aA])(?:h|%68)(?:[1-9]|%3[1-9])|%[fF][dD](?:7|%37)(?:z|%7[aA])(?:X|%58)(?:Z|%5[aA])%00|(?:\(|%28)%[bB]5(?:/|%2[fF])%[fF][dD]")
_PRINTED_MAGIC = re.compile(
    r"\\x1[fF]\\x8[bB]\\x08|(?:x|\\x78)(?:\\x01|\\x5[eE]|\^|\\x9[cC]|\\x[dD][aA])|(?:B|\\x42)(?:Z|\\x5[aA])(?:h|\\x68)(?:[1-9]|\\x3[1-9])|\\x[fF][dD](?:7|\\x37)(?:z|\\x7[aA])(?:X|\\x58)(?:Z|\\x5[aA])(?:\\x00|\\0)|(?:\(|\\x28)\\x[bB]5(?:/|\\x2[fF])\\x[fF][dD]"
)


def _escaped_bytes(layer: Layer, most: int) -> Iterator[Layer]:
    """Layers from compressed bytes that are written as escapes, with the signs among them that need none."""
    for mark, magic, pattern in (("%", _URL_MAGIC, _URL_BYTES), ("\\x", _PRINTED_MAGIC, _PRINTED_BYTES), ("\\u00", _JSON_MAGIC, _JSON_BYTES)):
        if mark not in layer.text:
            continue
        done = 0
        for m in magic.finditer(layer.text):
            if m.start() < done:
                continue
            run = pattern.match(layer.text, m.start())
            if mark not in run[0]:
                continue
            done = run.end()
            tokens = list(_TOKEN.finditer(run[0]))
            data = bytes(_PLAIN[t[3]] if t[3] else ord(t[4]) if t[4] else int(t[1] or t[2], 16) for t in tokens)
            for form in {data, bytes(32 if t[0] == "+" else c for t, c in zip(tokens, data, strict=True))} if mark == "%" else (data,):
                ends: dict[int, int] = {}
                for at, text in _packed_texts(form, most):
                    if at not in ends:  # the signs after a whole stream need not belong to it
                        end: list[int] = []
                        collections.deque(_unwrapped(form, at, end), maxlen=0)
                        ends[at] = tokens[end[0] - 1].end() if end else len(run[0])
                    a, b = layer.origin(run.start() + tokens[at].start(), run.start() + ends[at])
                    yield Layer(text, np.broadcast_to(np.int64(a), len(text)), np.broadcast_to(np.int64(b), len(text)))


class _Zstandard:
    """Takes small pieces of input, as its output has no bound of its own."""

    def __init__(self):
        self.one, self.eof, self.unused_data, self.unconsumed_tail = zstandard.ZstdDecompressor().decompressobj(), False, b"", b""

    def decompress(self, data: bytes, most: int) -> bytes:
        out = self.one.decompress(data[:256])
        self.eof = self.one.eof
        rest = data[256:]
        self.unused_data, self.unconsumed_tail = (self.one.unused_data + rest, b"") if self.eof else (b"", rest)
        return out


def _opened(data: bytes):
    """A decompressor for the stream that the data begin with, or None."""
    if not (m := _MAGIC.match(data)):
        return None
    return {b"\x1f": lambda: zlib.decompressobj(31), b"x": zlib.decompressobj, b"B": bz2.BZ2Decompressor, b"\xfd": lambda: lzma.LZMADecompressor(lzma.FORMAT_XZ), b"(": _Zstandard}[m[0][:1]]()


def _inflated(source: Iterator[bytes], left: list[int], piece: int = 1 << 20) -> Iterator[bytes]:
    """What the compressed streams that follow one another in the source hold, in pieces; a broken stream up to the break.

    ``left`` gets the number of bytes taken from the source but not used, if the last stream is whole.
    """
    one, data, ended = None, b"", False
    while True:
        if one is None:
            while len(data) < 6 and (new := next(source, None)) is not None:
                data = (data + new).lstrip(b"\0")  # padding between streams
            if (one := _opened(data)) is None:
                left.append(len(data))
                return
        elif not data and getattr(one, "needs_input", True):
            if (new := next(source, None)) is None:
                ended = True
            else:
                data = new
        try:
            out = one.decompress(data, piece)
        except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError):
            return
        data = one.unused_data if one.eof else getattr(one, "unconsumed_tail", b"")
        if out:
            yield out
        if one.eof:
            one, data = None, data.lstrip(b"\0")
        elif ended and not out:
            return


def _unwrapped(data: bytes, at: int, end: list[int]) -> Iterator[bytes]:
    """Pieces of the streams from a place in the data on, through the compression inside them; ``end`` gets where they end, if they are whole."""
    taken = at

    def source() -> Iterator[bytes]:
        nonlocal taken
        while taken < len(data):
            taken += len(new := data[taken : taken + (1 << 16)])
            yield new

    def outer() -> Iterator[bytes]:
        own: list[int] = []
        yield from _inflated(source(), own)
        end.extend(taken - n for n in own)

    pieces, met = outer(), set()
    while True:
        head = b""
        while len(head) < 6 and (new := next(pieces, None)) is not None:
            head += new
        digest = hashlib.sha256(head).digest()
        pieces = itertools.chain([head], pieces) if head else iter(())
        if digest in met:  # streams can hold themselves
            return
        met.add(digest)
        if not _MAGIC.match(head):
            break
        pieces = _inflated(pieces, [])
    yield from pieces


def _chunks(pieces: Iterator[bytes], most: int) -> Iterator[bytes]:
    """The pieces as chunks of up to ``most`` bytes, each with the last half of the one before."""
    held, new = bytearray(), False
    for piece in pieces:
        for k in range(0, len(piece), max(1, most // 2)):
            held += piece[k : k + max(1, most // 2)]
            new = True
            while len(held) >= most:
                yield bytes(held[:most])
                del held[: max(1, most // 2)]
                new = len(held) > most - max(1, most // 2)
    if new:
        yield bytes(held)


def _packed_texts(data: bytes, most: int) -> Iterator[tuple[int, str]]:
    """Text of the compressed streams that begin anywhere in the data, and of those anywhere inside them, in chunks, with its place in the data."""
    work, met = [(0, _streams(data, most))], set()
    while work:
        begin, chunks = work[-1]
        if (found := next(chunks, None)) is None:
            work.pop()
            continue
        at, chunk = found
        at = at if len(work) == 1 else begin
        if (text := _readable(chunk)) is not None:
            yield at, text
        for text, _, _ in _wide(chunk):
            yield at, text
        if _MAGIC.search(chunk) and (key := (hashlib.sha256(chunk).digest(), at)) not in met:
            met.add(key)
            work.append((at, _streams(chunk, most)))


def _streams(data: bytes, most: int) -> Iterator[tuple[int, bytes]]:
    """Chunks of the streams in the data, each with the place where its first stream begins."""
    at = 0
    while m := _MAGIC.search(data, at):
        end: list[int] = []
        at = m.start()
        for chunk in _chunks(_unwrapped(data, at, end), most):
            yield at, chunk
        at = max(at + 1, end[0]) if end else at + 1


def _readable(data: bytes) -> str | None:
    """The data as text, each byte that is not UTF-8 as a lone surrogate; None if no stretch could hold a finding."""
    text = data.decode("utf-8", "surrogateescape")
    return text if _STRETCH.search(text) else None


def _wide(data: bytes) -> Iterator[tuple[str, int, int]]:
    """Stretches of wide signs: the text, the place of the first sign's first byte, and the bytes of a sign."""
    for m in _WIDE.finditer(data) if b"\0" in data else ():
        size = 4 if m.lastindex < 3 else 2
        yield m[0][(m.lastindex % 2 == 0) * (size - 1) :: size].decode("latin-1"), m.start(), size


def _widths(text: str) -> np.ndarray:
    if text.isascii():
        return np.ones(len(text), np.int64)
    return np.fromiter((1 if "\udc80" <= c <= "\udcff" else len(c.encode()) for c in text), np.int64, len(text))


def _bytes_of(run: str) -> Iterator[tuple[bytes, int, int, int]]:
    """The readings of a run of base64 or hexadecimal digits, from each alignment: bytes, first sign, and (for n bytes) m signs that give them."""
    body = run.translate(_URL_SAFE)
    for first in range(4):
        usable = body[first : len(body) - ((len(body) - first) % 4 == 1)]
        if len(usable) >= 16:
            yield binascii.a2b_base64(usable + "=" * (-len(usable) % 4)), first, 3, 4
    for m in _HEX_BYTES.finditer(run):
        for first in (m.start(), m.start() + 1):
            yield bytes.fromhex(run[first : m.end() - (m.end() - first) % 2]), first, 1, 2


def _signs(layer: Layer) -> Iterator[tuple[str, np.ndarray]]:
    """The runs of digits in a layer, alone and joined over line ends, with the place of each digit."""
    for m in _BASE64.finditer(layer.text):
        run = m[0].rstrip("=")
        yield run, np.arange(m.start(), m.start() + len(run))
    for m in _WRAPPED.finditer(layer.text) if "\n" in layer.text or "\\n" in layer.text else ():
        lines, at = [], m.start()
        for end in [*_LINE_END.finditer(m[0]), None]:
            upto = m.end() if end is None else m.start() + end.start()
            lines.append((at, upto))
            at = m.start() + end.end() if end else upto
        run = "".join(layer.text[a:b] for a, b in lines)
        if len(run) >= 16:
            yield run, np.concatenate([np.arange(a, b) for a, b in lines])


def _runs(layer: Layer, most: int) -> Iterator[Layer]:
    """Layers from the runs of base64 or hexadecimal digits in a layer, through any compression around them."""
    for run, places in _signs(layer):
        for data, first, n, signs in _bytes_of(run):
            for at, text in _packed_texts(data, most):
                a, b = layer.origin(int(places[first + at // n * signs]), int(places[-1]) + 1)
                yield Layer(text, np.broadcast_to(np.int64(a), len(text)), np.broadcast_to(np.int64(b), len(text)))
            for text, at, size in _wide(data):
                first_byte = at + np.arange(len(text)) * size
                begin, end = (places[np.minimum(first + b // n * signs, len(places) - 1)] for b in (first_byte, first_byte + size - 1))
                own = layer.arrays()
                yield Layer(text, own[0][begin], own[1][np.minimum(end + signs - 1, int(places[-1]))])
            if (text := _readable(data)) is None:
                continue
            widths = _widths(text)
            last = np.cumsum(widths)
            begin = places[np.minimum(first + (last - widths) // n * signs, len(places) - 1)]
            end = places[np.minimum(first - (-last // n) * signs, len(places)) - 1]
            own = layer.arrays()
            yield Layer(text, own[0][begin], own[1][end])


def _inner(layer: Layer, most: int) -> Iterator[Layer]:
    """The layers that can be unwrapped from a layer."""
    if "%" in layer.text and (new := layer.replaced(_URL, _from_url)) is not None:
        yield new
    if ("\\" in layer.text or "&#" in layer.text) and (new := layer.replaced(_UNICODE, _from_unicode)) is not None:
        yield new
    yield from _escaped_bytes(layer, most)
    yield from _runs(layer, most)


def spans(text: str, max_layer_bytes: int = 1 << 26) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The base findings, and all findings with those of unwrapped layers mapped to the original text."""
    base = find(text)
    every = set(base)
    work, seen = [_inner(Layer(text), max_layer_bytes)], set()
    while work:  # depth first, so that a large layer is held in one chunk
        if (new := next(work[-1], None)) is None:
            work.pop()
            continue
        if not new.text:
            continue
        key = hashlib.sha256(new.text.encode("utf-8", "surrogatepass")).digest(), int(new.starts.min()), int(new.ends.max())
        if key in seen:
            continue
        seen.add(key)
        every.update((kind, *new.origin(a, b)) for kind, a, b in find(new.text))
        work.append(_inner(new, max_layer_bytes))
    return base, ordered(every)


def listed(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in found)


def redacted(text: str, found: list[tuple[str, int, int]], mask: str = "[SECRET]") -> str:
    """The text with each found span, or union of overlapping spans, replaced by the mask."""
    parts, at = [], 0
    for _, a, b in found:
        if a >= at:
            parts += [text[at:a], mask]
        at = max(at, b)
    return "".join(parts) + text[at:]


def scan(docs: DataFrame, max_layer_bytes: int = 1 << 26) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for each row of ``docs(doc_id, text)``.

    One narrow pass without a shuffle. Null and empty texts have no findings; repeated rows are scanned each; an empty
    table gives no rows; other columns are ignored. A compressed layer is read in
    overlapping chunks of ``max_layer_bytes``.
    """
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in batch.column(1):
                base, every = spans(text.as_py() or "", max_layer_bytes)
                kinds = [kind for kind, _, _ in base]
                rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(listed(base).encode()).hexdigest(), listed(every)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def redact(docs: DataFrame, mask: str = "[SECRET]", max_layer_bytes: int = 1 << 26) -> DataFrame:
    """``docs`` with every found span of ``text`` masked (``n_chars``, if a column, follows).

    All rows and columns stay: null and empty texts, rows without an id and repeated rows too; an empty table gives no rows. Overlapping spans
    are one mask.
    """
    names, at = docs.columns, docs.columns.index("text")
    size = names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns, changed, texts, lengths = list(batch.columns), False, [], []
            for k, value in enumerate(batch.column(at)):
                text = value.as_py()
                found = spans(text, max_layer_bytes)[1] if text else []
                new = redacted(text, found, mask) if found else text
                changed |= new is not text
                texts.append(new)
                if size is not None:
                    lengths.append(len(new) if found else columns[size][k].as_py())
            if changed:
                columns[at] = pa.array(texts, columns[at].type)
                if size is not None:
                    columns[size] = pa.array(lengths, columns[size].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
