"""Collocations: phrases whose words occur together far more often than apart, by level-wise passes over the texts.

Level k counts phrases of k words. Only occurrences whose two overlapping phrases of k-1 words are both frequent are emitted, as a phrase is never
more frequent than its parts. What a pass knows of the level before is a Bloom filter of all its frequent phrases, of a size that is bounded whatever the
corpus: a false positive costs an emitted row, never a wrong count, since counts decide. The levels' tables are written; cuts are scored by joins of them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm._shared import trim
from docketry.operators.durable import written

#: Signs that end a piece of text.
ENDS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes(0x2E if c in ENDS else 0x20 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_PROBES = 4
_U = np.uint64


def words_of(plain: bytes) -> tuple[pa.Array, np.ndarray]:
    """The words of a lower-cased text (see :func:`lowered`) and the number of each one's piece."""
    data = np.frombuffer(plain, np.uint8)
    inside = (data != 0x20) & (data != 0x2E)
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    return words, np.searchsorted(np.flatnonzero(data == 0x2E), starts)


def lowered(text: bytes) -> bytes:
    """The text with ASCII letters in lower case, a blank for each tab, and ``.`` for each sign that ends a piece."""
    return text.translate(_PLAIN)


def _last_words(plain: bytes, n: int) -> bytes:
    """The end of a lower-cased text from its n-th last word on; empty for n = 0."""
    at = len(plain)
    for _ in range(n):
        while at and plain[at - 1] in b" .":
            at -= 1
        at = max(plain.rfind(b" ", 0, at), plain.rfind(b".", 0, at)) + 1
    return plain[at:] if n else b""


def runs_of(batches: Iterator[pa.RecordBatch], overlap: int, at_once: int) -> Iterator[tuple[str, bytes]]:
    """The lower-cased texts of ``lang, text`` put together by lang, about ``at_once`` bytes at a time.

    A text that goes on in the next run is cut between words, and its last ``overlap`` words are there again.
    """
    held: dict[str, list[bytes]] = defaultdict(list)
    size = 0
    for batch in batches:
        langs, texts = batch.column("lang"), batch.column("text")
        for row in range(batch.num_rows):
            lang, text, at = langs[row].as_py(), lowered(texts[row].as_py()), 0
            while at < len(text):
                stop = at + at_once - size
                end = min((p for p in (text.find(b" ", stop), text.find(b".", stop)) if p >= 0), default=len(text))
                held[lang].append(text[at:end])
                size, at = size + end - at, end
                if size >= at_once:
                    yield from ((name, b"".join(parts)) for name, parts in held.items())
                    held, size = defaultdict(list), 0
                    if end < len(text):
                        held[lang].append(_last_words(text[:end], overlap))
            held[lang].append(b".")
            size += 1
    yield from ((name, b"".join(parts)) for name, parts in held.items())


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


def _folded(words: list[np.ndarray]) -> np.ndarray:
    """One hash for each phrase, from its words' hashes."""
    out = words[0]
    for word in words[1:]:
        out = _mixed(out * _U(0x9E3779B97F4A7C15) + word)
    return out


class Phrases:
    """A Bloom filter: ``bits`` is a power of two."""

    def __init__(self, lines: np.ndarray, bits: int) -> None:
        self.lines, self.bits = lines, bits

    @staticmethod
    def places(hashes: np.ndarray, bits: int) -> np.ndarray:
        step = _mixed(hashes) | _U(1)
        return np.stack([(hashes + _U(k) * step) & _U(bits - 1) for k in range(_PROBES)])

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for place in self.places(hashes, self.bits):
            out &= (self.lines[(place >> _U(6)).astype(np.int64)] >> (place & _U(63)) & _U(1)).astype(bool)
        return out


def phrase_filter(phrases: DataFrame, count: int, most_bits: int = 1 << 27) -> Phrases:
    """The filter of ``phrases(lang, phrase)``: 16 bits for each, ``most_bits`` at most (16 MB at the default)."""
    bits = 1 << min(max(16 * count, 1 << 10).bit_length(), most_bits.bit_length() - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True)
            split = [(xxhash.xxh3_64_intdigest(lang.encode()), phrase.encode().split(b" ")) for lang, phrase in rows]
            hashes = [np.array([xxhash.xxh3_64_intdigest(words[j], seed) for seed, words in split], _U) for j in range(len(split[0][1]) if split else 0)]
            if not hashes:
                continue
            places = Phrases.places(_folded(hashes), bits).ravel()
            masks = _U(1) << (places & _U(63))
            yield pa.RecordBatch.from_arrays([pa.array((places >> _U(6)).astype(np.int64)), pa.array(masks.view(np.int64))], ["line", "mask"])

    lines = np.zeros(bits >> 6, _U)
    found = phrases.select("lang", "phrase").mapInArrow(run, "line long, mask long").groupBy("line").agg(F.bit_or("mask").alias("mask")).toArrow()  # bits / 64 rows at most
    lines[found.column("line").to_numpy()] = found.column("mask").to_numpy().view(_U)
    return Phrases(lines, bits)


def _distinct(ids: list[np.ndarray], size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of columns of numbers below ``size``, and how often each occurs."""
    if size ** len(ids) <= 2**63:
        code = ids[0].astype(np.int64)
        for column in ids[1:]:
            code = code * size + column
        code, counts = np.unique(code, return_counts=True)
        columns = []
        for _ in ids[1:]:
            columns.insert(0, code % size)
            code = code // size
        return [code, *columns], counts
    order = np.lexsort(ids[::-1])
    ids = [column[order] for column in ids]
    new = np.ones(len(order), bool)
    new[1:] = np.any([column[1:] != column[:-1] for column in ids], axis=0)
    first = np.flatnonzero(new)
    return [column[first] for column in ids], np.diff([*first, len(order)])


def counted(lang: str, plain: bytes, k: int, known: Phrases | None) -> tuple[pa.Array, np.ndarray]:
    """The phrases of k words of a lower-cased text, with their counts; for k > 1 only those whose two parts the filter holds."""
    words, piece = words_of(plain)
    encoded = words.dictionary_encode()
    own, ids = encoded.dictionary, encoded.indices.to_numpy().astype(np.int64)
    if len(ids) < k:
        return pa.array([], pa.string()), np.empty(0, np.int64)
    last = len(ids) - k + 1
    ok = piece[:last] == piece[k - 1 :]
    if k > 1:
        seed = xxhash.xxh3_64_intdigest(lang.encode())
        hashed = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in own.to_pylist()), _U, len(own))[ids]
        part = known.holds(_folded([hashed[j : last + 1 + j] for j in range(k - 1)]))
        ok &= part[:-1] & part[1:]
    at = np.flatnonzero(ok)
    columns, counts = _distinct([ids[at + j] for j in range(k)], len(own))
    taken = [own.take(pa.array(c)) for c in columns]
    phrases = pc.binary_join_element_wise(*taken, pa.scalar(b" ", pa.large_binary())) if k > 1 else taken[0]
    return phrases.cast(pa.large_string()), counts


def level(docs: DataFrame, k: int, known: Phrases | None, at_once: int = 1 << 22) -> DataFrame:
    """``lang, phrase, n``: how often each phrase of k words occurs in ``docs(lang, text)``, for phrases whose parts are all in the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, plain in runs_of(batches, k - 1, at_once):
            phrases, counts = counted(lang, plain, k, shared.value)
            for at in range(0, len(phrases), 1 << 16):
                part = phrases.slice(at, 1 << 16).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), part, pa.array(counts[at : at + len(part)], pa.int64())], ["lang", "phrase", "n"])
        trim()

    rows = docs.select("lang", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def levels(docs: DataFrame, longest: int = 3, least: int = 10, most_bits: int = 1 << 27) -> tuple[list[DataFrame], DataFrame]:
    """The tables ``lang, phrase, n`` of phrases of 1 to ``longest`` words that occur ``least`` times or more, and ``lang, n`` of all words.

    The first level is counted whole and written, as the sum of all words needs it.
    """
    words, _ = written(level(docs, 1, None))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    tables = [words.where(F.col("n") >= least)]
    for k in range(2, longest + 1):
        known = phrase_filter(tables[-1], tables[-1].count(), most_bits)
        found, _ = written(level(docs, k, known).where(F.col("n") >= least))
        tables.append(found)
    return tables, totals


def scored(tables: list[DataFrame], totals: DataFrame, absorbed: float = 0.5) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of all phrases of two words or more that no longer one absorbs.

    A phrase of a occurrences, cut into a first part of l and a rest of r, scores ``floor(10^6 a a / (l r))``; the lowest-scoring cut counts, the
    first of these. It is absorbed if it lies within a longer phrase of the tables with ``absorbed * a`` occurrences or more. Numbers are decimals of 38 digits,
    so a passes 10^15 before they do, and then it is an error.
    """
    part = lambda at, n: F.array_join(F.slice("_w", at, n), " ")
    out = None
    for k in range(2, len(tables) + 1):
        cuts = []
        rows = tables[k - 1].select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("_w"))
        for c in range(1, k):
            left = tables[c - 1].select(F.col("lang").alias("_lang"), F.col("phrase").alias("_left"), F.col("n").alias(f"l{c}"))
            right = tables[k - c - 1].select(F.col("lang").alias("_lang"), F.col("phrase").alias("_right"), F.col("n").alias(f"r{c}"))
            rows = rows.withColumn("_l", part(1, c)).withColumn("_r", part(c + 1, k - c))
            rows = rows.join(left, (F.col("lang") == F.col("_lang")) & (F.col("_l") == F.col("_left"))).drop("_lang", "_left", "_l")
            rows = rows.join(right, (F.col("lang") == F.col("_lang")) & (F.col("_r") == F.col("_right"))).drop("_lang", "_right", "_r")
            score = F.expr(f"(cast(1000000 as decimal(8,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l{c} as decimal(19,0)) * cast(r{c} as decimal(19,0)))")
            cuts.append(F.struct(score.cast("long").alias("score"), F.lit(c).alias("k"), F.col(f"l{c}").alias("l"), F.col(f"r{c}").alias("r")))
        rows = rows.withColumn("_cut", F.array_min(F.array(*cuts)))
        for longer in range(k + 1, len(tables) + 1):
            inside = tables[longer - 1].select("lang", "n", F.split("phrase", " ").alias("_w"))
            inside = inside.select(F.col("lang").alias("_lang"), "n", F.explode(F.array(*[part(at, k) for at in range(1, longer - k + 2)])).alias("_in"))
            inside = inside.groupBy("_lang", "_in").agg(F.max("n").alias("_n"))
            absorbs = (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_in")) & (F.col("_n") >= F.col("a") * F.lit(absorbed))
            rows = rows.join(inside, absorbs, "left_anti")
        rows = rows.select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")
        out = rows if out is None else out.unionByName(rows)
    return out.join(totals, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def ranked(found: DataFrame, most: int, salts: int) -> DataFrame:
    """``found`` with ``rank``: each lang's first by score and a descending, phrase ascending. Ranked within salts first, so no lang's rows meet in one task."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    salted = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("_rank") <= most)
    return salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most).drop("_salt", "_rank")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, most: int = 2000, absorbed: float = 0.5, salts: int | None = None) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each lang's first ``most`` collocations in ``docs(lang, text)``.

    Words and pieces are those of :func:`words_of`; only ASCII letters are lower-cased. A null lang is ``und``, as is that lang itself; a null or empty
    text has no words; repeated rows count each time. No text gives no rows. Other columns are ignored.
    """
    taken = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text").where("text is not null")
    tables, totals = levels(taken, longest, least)
    found, _ = written(scored(tables, totals, absorbed))
    return ranked(found, most, salts or max(1, int((found.count() / most) ** 0.5))).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
