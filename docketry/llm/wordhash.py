"""Word hashes of many texts at once, as array passes over their UTF-8 bytes."""

from __future__ import annotations

import functools

import numpy as np

from docketry.llm.langid import mixed

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


@functools.cache
def _is_word() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x41, 0x5B), *range(0x80, 0x100)]] = True
    return table


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of each word of the lower-cased texts, in order, and how many words each text has.

    A word is a maximal run of ASCII letters and digits and of any signs beyond ASCII.
    """
    terms, counts = word_terms(texts)
    return terms[0], counts


def word_terms(texts: list[str], prefixes: tuple[int, ...] = ()) -> tuple[list[np.ndarray], np.ndarray]:
    """Word hashes as of :func:`word_hashes`, and for each prefix size the hashes of the words' first so many bytes.

    Hashes of prefixes differ from those of words of the same bytes.
    """
    lowered = [text.lower().encode() for text in texts]
    data = np.frombuffer(b" ".join([b"", *lowered, b""]), np.uint8)
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    inside = _is_word()[data]
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = turns[::2], turns[1::2]
    room = max(1 << 16, 1 << int(len(data)).bit_length())
    power, inverse = _powers(room)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    hashes = [mixed((sums[ends] - sums[starts]) * inverse[starts])]
    for size in prefixes:
        upto = np.minimum(ends, starts + size)
        hashes.append(mixed(mixed((sums[upto] - sums[starts]) * inverse[starts]) + np.uint64(size)))
    text_ends = np.cumsum(sizes + 1)
    upto = np.searchsorted(starts, text_ends)
    return hashes, np.diff(np.concatenate([[0], upto]))
