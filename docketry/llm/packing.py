"""Packing token streams into fixed windows by non-negative least squares over length combinations.

Documents are tokenized where they are read and packed in blocks of bounded size, so nothing is shuffled and no
task holds more than a block. Within a block every full window of a document is a sequence of its own. What is
left of each document has a length below the window; the histogram of these lengths is covered with shallow
combinations (one, two or three lengths that fill the window exactly): non-negative least squares gives how often to
use each, rounding down makes it whole, and what the combinations leave over is packed greedily, longest first, cut at
window ends. The last, partly filled window of a block is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm._shared import slices
from docketry.llm.tokencount import load_vocabulary

#: The splitting rule of byte-level vocabularies, a fixed value of that file format.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Encoder:
    """Token ids as the tokenizer file's library gives them, special strings in a text included.

    When the file's ids follow its merge order, the equal but faster rank-based library encodes; texts that it
    refuses (extremely long runs) and other files go to the file's own library.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow, self.fast = Tokenizer.from_file(path), None
        try:
            ranks, specials = load_vocabulary(path)
        except ValueError:
            return
        with open(path, encoding="utf-8") as file:
            vocab = json.load(file)["model"]["vocab"]
        from docketry.llm.tokencount import byte_alphabet

        back = byte_alphabet()
        ids = {bytes(back[c] for c in word): n for word, n in vocab.items() if word not in specials}
        merges = [ids.get(word, -1) for word, rank in sorted(ranks.items(), key=lambda x: x[1]) if rank >= 0]
        if set(ids) == set(ranks) and all(a < b for a, b in zip(merges, merges[1:], strict=False)) and max(ids[bytes([b])] for b in range(256)) < merges[0]:
            self.fast = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ids, special_tokens=specials)

    def __call__(self, text: str) -> np.ndarray:
        if self.fast:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except BaseException as error:  # the library's panics, on extremely long runs, are no Exceptions and have no public class
                if type(error).__name__ != "PanicException":
                    raise
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def combinations(lengths: np.ndarray, window: int, triples: int = 24) -> list[tuple[int, ...]]:
    """Pairs of present lengths that fill the window, and triples that hold two of the most frequent lengths."""
    present = set(np.flatnonzero(lengths).tolist())
    out: list[tuple[int, ...]] = [(a, window - a) for a in sorted(present) if a <= window - a and window - a in present]
    common = sorted(present, key=lambda a: (-lengths[a], a))[:triples]
    found = {tuple(sorted((a, b, window - a - b))) for a in common for b in common if window - a - b in present}
    return out + sorted(found)


def nonnegative_least_squares(columns: list[tuple[int, ...]], target: np.ndarray, sweeps: int = 40) -> np.ndarray:
    """Minimises the squared distance of the columns' counts to the target over x >= 0, by cyclic coordinate descent."""
    sparse = [tuple(zip(*np.unique(c, return_counts=True), strict=True)) for c in columns]
    sparse = [[(int(a), int(n)) for a, n in c] for c in sparse]
    norm = [sum(n * n for _, n in c) for c in sparse]
    rest, x = target.astype(float).tolist(), [0.0] * len(columns)
    for _ in range(sweeps):
        moved = 0.0
        for j, column in enumerate(sparse):
            step = sum(rest[a] * n for a, n in column) / norm[j]
            new = max(0.0, x[j] + step)
            if step := new - x[j]:
                moved += abs(step)
                x[j] = new
                for a, n in column:
                    rest[a] -= step * n
        if moved < 1e-3 * (1 + len(columns)):
            break
    return np.array(x)


def pack(totals: list[int], window: int) -> list[tuple[int, int, int, int, int]]:
    """``(document, start, length, sequence, offset)`` of each piece, for documents of so many tokens each."""
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    waiting: dict[int, list[int]] = defaultdict(list)
    histogram = np.zeros(window + 1, np.int64)
    for k, total in enumerate(totals):
        for start in range(0, total - window + 1, window):
            pieces.append((k, start, window, sequence, 0))
            sequence += 1
        if rest := total % window:
            waiting[rest].append(k)
            histogram[rest] += 1
    columns = combinations(histogram, window)
    for column, times in zip(columns, np.floor(nonnegative_least_squares(columns, histogram) + 1e-6).astype(int), strict=True):
        need = {a: column.count(a) for a in column}
        for _ in range(min([int(times), *(len(waiting[a]) // n for a, n in need.items())])):
            offset = 0
            for length in column:
                k = waiting[length].pop()
                pieces.append((k, totals[k] - length, length, sequence, offset))
                offset += length
            sequence += 1
    left = [(length, k) for length in sorted(waiting, reverse=True) for k in waiting[length]]
    spare = sum(length for length, _ in left)
    room, offset = min(window, _power(spare, window)), 0
    for length, k in left:
        start = totals[k] - length
        while length:
            take = min(length, room - offset)
            pieces.append((k, start, take, sequence, offset))
            start, length, offset, spare = start + take, length - take, offset + take, spare - take
            if offset == room and spare:
                sequence, offset, room = sequence + 1, 0, _power(spare, window)
    return pieces


def _power(spare: int, window: int) -> int:
    """The next sequence's size: the window while it can be filled, then the largest power of two that can."""
    return window if spare >= window else 1 << max(0, spare.bit_length() - 1)


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = 1024, end_id: int = 0, block_tokens: int = 6_000_000) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of all ``docs(doc_id, text)``.

    A document is its token ids and ``end_id``; a null or empty text is the end id alone. Each id lies in one
    piece; repeated rows are packed each; an empty table gives no rows; other columns are ignored. Sequence ids
    are made from the input partition's number and a running number, so a task that is run again gives the same.
    A block holds up to ``block_tokens`` ids, or one document that is longer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path), np.array([end_id], np.uint32)
        base, names, held, size = TaskContext.get().partitionId() << 36, [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal base, size
            totals = [len(ids) + 1 for ids in held]
            rows = pack(totals, window)
            k, start, length, sequence, offset = (np.array(c, np.int64) for c in zip(*rows, strict=True))
            sums = []
            for doc, a, n in zip(k.tolist(), start.tolist(), length.tolist(), strict=True):
                ids = held[doc][a : a + n]
                crc = zlib.crc32(ids.astype("<u4", copy=False).tobytes())
                sums.append(zlib.crc32(end.tobytes(), crc) if len(ids) < n else crc)
            out = [pa.array([names[i] for i in k.tolist()], pa.int64()), start, length, np.array(sums, np.int64), np.array(totals, np.int64)[k], base + sequence, offset]
            base += int(sequence.max()) + 1
            names.clear()
            held.clear()
            size = 0
            return pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in slices(batches):
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "")
                if held and size + len(ids) + 1 > block_tokens:
                    yield flush()
                names.append(name)
                held.append(ids)
                size += len(ids) + 1
        if held:
            yield flush()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)
