"""Toxicity scores from the nearest labelled examples by TF-IDF cosine.

Every word of the sampled examples is a term. Its weight in a text is ``(1 + ln tf) * ln(1 + N / df) * relevance``, where relevance
is a floor and the squared log-odds by which the term's examples differ in label from all examples, shrunk towards none for rare terms
("supervised term weighting", Debole and Sebastiani, 2003). Without it a text's many neutral words outweigh the few that tell.

The examples stand in an inverted index whose postings are cut into blocks of examples, with the largest weight of each term and block.
The few terms that a large share of the examples have are columns of a dense matrix instead, and their part of a cosine is known exactly
for all examples at once. A query adds its block maxima to that up to a bound for each block, reads the postings of its most promising blocks, and
then of every other block whose bound reaches the k-th best cosine: the nearest k are exact. Votes are weighted by distance and
calibrated by logistic regression on leave-one-out votes of the examples.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm._shared import slices
from docketry.llm.langid import batches_of, held_out
from docketry.llm.wordhash import word_hashes
from docketry.operators.durable import checkpointed


def bags(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sorted distinct word hashes of each text and how often each occurs."""
    for _, part in batches_of(texts):
        hashes, counts = word_hashes(part)
        ends = np.cumsum(counts)
        for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True):
            yield np.unique(hashes[a:b], return_counts=True)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The concatenated ranges of given starts and sizes, and which range each value is from."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes - starts, sizes), owner


@dataclass
class Index:
    """Unit vectors of labelled examples: block postings of the sparse terms, a dense matrix of the frequent ones."""

    terms: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # sorted hashes
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))  # idf times relevance
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    labels: np.ndarray = field(default_factory=lambda: np.zeros(0))
    block: int = 32
    base_rate: float = 0.5
    slope: float = 1.0
    shift: float = 0.0

    def vector(self, bag: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """A text's known terms (places in the vocabulary) and unit weights."""
        if not len(self.terms) or not len(bag[0]):
            return np.zeros(0, np.int64), np.zeros(0)
        at = np.minimum(np.searchsorted(self.terms, bag[0]), len(self.terms) - 1)
        known = self.terms[at] == bag[0]
        at = at[known]
        weights = (1 + np.log(bag[1][known])) * self.weight[at]
        return at, weights / np.sqrt(weights @ weights) if len(at) else weights

    def add(self, ids: list, labels: list, vectors: list, dense_share: float = 0.1) -> list[int]:
        """Takes the examples in, and gives their order in the index: those with the same weightiest term stand together, so that block maxima are tight."""
        head = [int(p[w.argmax()]) if len(p) else -1 for p, w in vectors]
        order = sorted(range(len(vectors)), key=lambda k: (head[k], labels[k], k))
        self.ids, self.labels = np.array([ids[k] for k in order], np.int64), np.array([labels[k] for k in order], float)
        n = len(order)
        own = np.repeat(np.arange(n), [len(vectors[k][0]) for k in order])
        place = np.concatenate([vectors[k][0] for k in order]) if n else np.zeros(0, np.int64)
        value = np.concatenate([vectors[k][1] for k in order]) if n else np.zeros(0)
        frequent = np.flatnonzero(np.bincount(place, minlength=len(self.terms)) > max(1.0, dense_share * n))
        self.column = np.full(len(self.terms), -1)
        self.column[frequent] = np.arange(len(frequent))
        self.dense = np.zeros((len(frequent), n))
        thick = self.column[place] >= 0
        self.dense[self.column[place[thick]], own[thick]] = value[thick]
        own, place, value = own[~thick], place[~thick], value[~thick]
        by_term = np.argsort(place, kind="stable")
        self.example, self.value, place = own[by_term], value[by_term], place[by_term]
        fresh = np.ones(len(place), bool)
        fresh[1:] = (place[1:] != place[:-1]) | (self.example[1:] // self.block != self.example[:-1] // self.block)
        cell = np.flatnonzero(fresh)  # a cell is one term's postings in one block
        self.cell_start, self.cell_size = cell, np.diff(np.append(cell, len(place)))
        self.cell_block = self.example[cell] // self.block
        self.cell_max = np.maximum.reduceat(self.value, cell) if len(cell) else np.zeros(0)
        self.term_cell = np.searchsorted(place[cell], np.arange(len(self.terms) + 1))
        return order

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, without: np.ndarray | None = None, first_blocks: int = 4) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the k examples of largest positive cosine, rounded to 12 places, ties by place, exactly: (examples, cosines)."""
        n, m = len(self.ids), len(queries)
        if not n or not m:
            return [(np.zeros(0, np.int64), np.zeros(0))] * m
        blocks = -(-n // self.block)
        whose = np.repeat(np.arange(m), [len(p) for p, _ in queries])
        place, weight = np.concatenate([p for p, _ in queries]), np.concatenate([w for _, w in queries])
        thick = self.column[place] >= 0
        frequent = np.zeros((m, len(self.dense)))
        frequent[whose[thick], self.column[place[thick]]] = weight[thick]
        scores = np.zeros((m, blocks * self.block))
        scores[:, :n] = frequent @ self.dense
        whose, place, weight = whose[~thick], place[~thick], weight[~thick]
        cell, owner = _ranges(self.term_cell[place], self.term_cell[place + 1] - self.term_cell[place])
        at = whose[owner] * blocks + self.cell_block[cell]  # query and block of each cell
        factor = weight[owner]
        bound = scores.reshape(m, blocks, self.block).max(2) + np.bincount(at, factor * self.cell_max[cell], m * blocks).reshape(m, blocks)
        excluded = np.full(m, -1) if without is None else without
        rows = np.flatnonzero(excluded >= 0)

        def read(chosen: np.ndarray) -> None:
            mine = np.flatnonzero(chosen.reshape(-1)[at])
            posting, of = _ranges(self.cell_start[cell[mine]], self.cell_size[cell[mine]])
            of = mine[of]
            flat = (at[of] // blocks) * (blocks * self.block) + self.example[posting]
            scores.reshape(-1)[:] += np.bincount(flat, factor[of] * self.value[posting], scores.size)

        done = np.zeros((m, blocks), bool)
        first = np.argpartition(-bound, min(first_blocks, blocks - 1), axis=1)[:, :first_blocks]
        np.put_along_axis(done, first, True, 1)
        read(done)
        known = np.where(np.repeat(done, self.block, 1), scores, 0.0)
        known[rows, excluded[rows]] = 0.0
        kth = np.partition(known, max(0, known.shape[1] - k), axis=1)[:, max(0, known.shape[1] - k)]
        rest = ~done & (bound * (1 + 1e-9) + 1e-12 >= kth[:, None])
        read(rest)
        scores[np.repeat(~(done | rest), self.block, 1)] = 0.0  # these cannot be among the nearest
        scores[rows, excluded[rows]] = 0.0
        most = min(k, scores.shape[1])
        kth = -np.partition(-scores, most - 1, axis=1)[:, most - 1]
        out = []
        for row, least in zip(scores, kth, strict=True):
            own = np.flatnonzero(row >= max(least - 1e-12, 1e-12))  # all that may tie with the k-th
            cosines = np.minimum(np.round(row[own], 12), 1.0)
            first = np.lexsort((own, -cosines))[:k]
            out.append((own[first], cosines[first]))
        return out

    def vote(self, examples: np.ndarray, cosines: np.ndarray, softness: float = 0.1, prior_weight: float = 0.5) -> float:
        """The share of label 1 among neighbours weighted by 1 / (distance + softness), with the base rate as one weak vote."""
        own = 1 / (1 - cosines + softness)
        return float((prior_weight * self.base_rate + own @ self.labels[examples]) / (prior_weight + own.sum()))

    def score(self, vote: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * _logit(vote) + self.shift, -40, 40))))


def _logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _calibrated(votes: list[float], labels: np.ndarray, ridge: float = 0.05) -> tuple[float, float]:
    """Slope (positive) and shift of a logistic regression of labels on the votes' log-odds, shrunk to 1 and 0."""
    x, y = _logit(np.array(votes)), np.array(labels, float)
    a, b = 1.0, 0.0
    for _ in range(50 if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(p - y) @ x + ridge * (1 + 0.01 * len(x)) * (a - 1), (p - y).sum() + ridge * b])
        w = p * (1 - p)
        h = np.array([[(w * x) @ x + ridge * (1 + 0.01 * len(x)), w @ x], [w @ x, w.sum() + ridge]])
        step = np.linalg.solve(h, g)
        a, b = max(0.05, a - float(step[0])), b - float(step[1])
        if abs(step).max() < 1e-9:
            break
    return a, b


def build(ids: list, labels: list, examples: list[tuple[np.ndarray, np.ndarray]], k: int = 15, shrink: float = 20.0, floor: float = 0.02) -> Index:
    """The index of labelled bags of words: all their terms, however frequent or rare, and the calibration of votes."""
    y = np.array(labels, float)
    index = Index(base_rate=(y.sum() + 1) / (len(y) + 2))
    if not len(y):
        return index
    terms, inverse = np.unique(np.concatenate([b[0] for b in examples]), return_inverse=True)
    df = np.bincount(inverse, minlength=len(terms))
    ones = np.bincount(inverse, np.repeat(y, [len(b[0]) for b in examples]), len(terms))
    rate = (ones + shrink * index.base_rate) / (df + shrink)
    index.terms, index.weight = terms, np.log(1 + len(y) / np.maximum(df, 1)) * (floor + (_logit(rate) - _logit(index.base_rate)) ** 2)
    vectors = [index.vector(b) for b in examples]
    order = index.add(ids, labels, vectors)
    votes = []
    for group in _groups([vectors[e] for e in order], 64):
        votes += [index.vote(*near) for near in index.nearest(group, k, np.arange(len(votes), len(votes) + len(group)))]
    index.slope, index.shift = _calibrated(votes, index.labels)
    return index


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 4000, k: int = 15) -> Index:
    """Learns from ``labels(doc_id, toxic)`` of documents that are not held out.

    The sample is the labelled ids whose hash falls below a threshold set for ``sample_rows`` rows on average, and no more than that
    ever reaches the driver, as bags of word hashes from one pass over the texts. A document with several labels counts as
    toxic if one says so. Copies of a text are one example, so that a large group of copies does not make its words telling.
    """
    own = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    share = min(1.0, sample_rows / max(1, own.count()))
    picked = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(share * (1 << 20)))
    picked = picked.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max(F.col("toxic").cast("double")).alias("_y"))
    sample = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.col("text").cast("string").alias("_text")).join(F.broadcast(picked), F.col("_doc") == F.col("_id"))  # bounded by the sample
    once = sample.groupBy(F.coalesce("_text", F.lit("")).alias("_own")).agg(F.min("_id").alias("_id"), F.max("_y").alias("_y"))
    sample = checkpointed(once.select("_id", "_y", F.col("_own").alias("_text")))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = list(bags(batch.column(2).to_pylist()))
            terms = pa.array([b[0].view(np.int64) for b in made], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), terms, pa.array([b[1] for b in made], pa.list_(pa.int64()))], ["id", "y", "terms", "times"])

    rows = sample.mapInArrow(counted, "id long, y double, terms array<long>, times array<long>").orderBy("id", "y", F.hash("terms")).toArrow()
    examples = [(np.asarray(t.values).astype(np.int64).view(np.uint64), np.asarray(n.values).astype(np.int64)) for t, n in zip(rows.column(2), rows.column(3), strict=True)]
    return build(rows.column(0).to_pylist(), rows.column(1).to_pylist(), examples, k)


def _groups(vectors: list, most: int, most_terms: int = 100_000) -> Iterator[list]:
    """The vectors in order, in groups of up to so many with up to so many terms, or one longer one."""
    held, size = [], 0
    for vector in vectors:
        if held and (len(held) == most or size + len(vector[0]) > most_terms):
            yield held
            held, size = [], 0
        held.append(vector)
        size += len(vector[0])
    if held:
        yield held


def score(docs: DataFrame, index: Index, k: int = 15, batch: int = 64) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence_ids, evidence_cosines`` for each row of ``docs(doc_id, text)``.

    Null and empty texts, and texts without a word that any example has, have no neighbours: their score is the calibrated base rate, their
    evidence empty. Equal texts have equal scores. Repeated rows are scored each; an empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by the sample
    names = ["doc_id", "held_out", "score", "predicted", "evidence_ids", "evidence_cosines"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for rows in slices(batches):
            vectors = [own.vector(b) for b in bags([t or "" for t in rows.column(2).to_pylist()])]
            near = [found for group in _groups(vectors, batch) for found in own.nearest(group, k)]
            scores = np.array([own.score(own.vote(*found)) for found in near])
            columns = [pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32)), pa.array([own.ids[e] for e, _ in near], pa.list_(pa.int64())), pa.array([c for _, c in near], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *columns], names)

    schema = "doc_id long, held_out boolean, score double, predicted int, evidence_ids array<long>, evidence_cosines array<double>"
    return docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string")).mapInArrow(run, schema)
