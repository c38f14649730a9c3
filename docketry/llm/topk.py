"""Exact top-k inner products over vectors in order of their length.

Vectors are scaled to integers, so scores are exact. All vectors are range-partitioned by descending length into bands. The longest ones give
every query a first k-th best score. A query meets a band only if the band's lengths can reach that score (Cauchy-Schwarz); within
a band it goes through vectors by descending length, adds up the products of the coordinates of an SVD rotation, leading ones first, and drops a
pair once its partial sum and the product of the two remaining lengths cannot reach the k-th best score any more. Pairs that are left get their
integer score. Rotated sums only prune, with a margin far above their rounding.

Queries are written in blocks of a bounded number, by the length that a vector needs to be of use to them; vectors are sent once for each block, in passes
of a bounded number of blocks, so a pass moves a fixed multiple of the table, whatever its size. Nothing but the rotation (the square of
the dimension) and the longest vectors (a parameter) is broadcast.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.operators.durable import delete, shared_folder, written

_NONE = -(2**63) + 1
_LONG = 2**63 - 1


def scaled(vector: Column, scale: float = 256.0) -> Column:
    """The vector with ``floor(scale * x)`` for each component, as longs; null for vectors that are null or hold nulls or anything not finite.

    A scaled component beyond 31 bits is an error, as scores might pass 64 bits.
    """
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.when(F.abs(x.cast("double") * F.lit(float(scale))) < F.lit(float(2**31)), F.floor(x.cast("double") * F.lit(float(scale)))).otherwise(F.raise_error(F.lit("a scaled component passes 31 bits")).cast("long")))
    return F.when(vector.isNotNull() & good, whole)


def _matrix(vectors, dimension: int) -> np.ndarray:
    """Rows of packed 32-bit components."""
    return np.frombuffer(b"".join(vectors), np.int32).reshape(-1, dimension)


def _packed(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("v")
        out = np.zeros((batch.num_rows, dimension), np.int32)
        sizes = np.diff(lists.offsets.to_numpy())
        rows = np.repeat(np.arange(batch.num_rows), sizes)
        columns = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[rows, columns] = lists.flatten().to_numpy()
        squares = (out.astype(np.int64) ** 2).sum(axis=1)
        whole = pa.array([row.tobytes() for row in out], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("asks"), pa.array(squares, pa.int64()), whole], ["vec_id", "asks", "square", "v"])


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer products of all rows with all rows: as doubles where these are exact, else as longs."""
    most = float((left.astype(float) ** 2).sum(axis=1).max(initial=0)) * float((right.astype(float) ** 2).sum(axis=1).max(initial=0))
    if most < 2.0**104:  # by Cauchy-Schwarz no partial sum passes 2^52
        return (left.astype(float) @ right.T.astype(float)).astype(np.int64)
    return left.astype(np.int64) @ right.T.astype(np.int64)


def _row_products(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, at_once: int = 1 << 15) -> np.ndarray:
    """Integer products of row i[n] with row j[n]."""
    parts = [np.einsum("nd,nd->n", left[i[k : k + at_once]].astype(np.int64), right[j[k : k + at_once]].astype(np.int64)) for k in range(0, len(i), at_once)]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


class Best:
    """The k best (score, smallest id) of each of n queries so far."""

    def __init__(self, n: int, k: int, floor: np.ndarray) -> None:
        self.n, self.k, self.floor = n, k, floor
        self.query = np.empty(0, np.int64)
        self.score, self.vec, self.row = (np.empty(0, np.int64) for _ in range(3))

    def add(self, query: np.ndarray, score: np.ndarray, vec: np.ndarray, row: np.ndarray) -> None:
        query, score, vec, row = (np.concatenate([a, b]) for a, b in ((self.query, query), (self.score, score), (self.vec, vec), (self.row, row)))
        order = np.lexsort((row, vec, -score, query))
        query = query[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        order, query, place = order[place < self.k], query[place < self.k], place[place < self.k]
        self.query, self.score, self.vec, self.row = query, score[order], vec[order], row[order]
        last = place == self.k - 1
        self.floor[query[last]] = np.maximum(self.floor[query[last]], self.score[last])


def _search(vectors: np.ndarray, vec: np.ndarray, row: np.ndarray, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, rotation: np.ndarray, k: int, at_once: int = 2048, asked: int = 1024) -> Best:
    """The k best vectors of each query that reach its floor; ``own`` is the row that is the query itself."""
    length, wanted = np.sqrt((vectors.astype(float) ** 2).sum(axis=1)), np.sqrt((queries.astype(float) ** 2).sum(axis=1))
    order = np.argsort(-length, kind="stable")
    vectors, vec, row, length = vectors[order], vec[order], row[order], length[order]
    best, dimension = Best(len(queries), k, floor.copy()), queries.shape[1]
    turned_queries = queries @ rotation
    cuts = [dimension * step // 4 for step in range(5)]
    rest = [np.sqrt(np.maximum((turned_queries[:, c:] ** 2).sum(axis=1), 0)) for c in cuts[1:]]
    for at in range(0, len(vectors), at_once):
        part = slice(at, at + at_once)
        alive = np.flatnonzero(wanted * length[at] * (1 + 1e-9) + 1e-3 >= best.floor)
        if not len(alive):
            break  # vectors further on are no longer
        turned = vectors[part] @ rotation
        left = [np.sqrt(np.maximum((turned[:, c:] ** 2).sum(axis=1), 0)) for c in cuts[1:]]
        for first in range(0, len(alive), asked):
            who = alive[first : first + asked]
            margin = 1e-3 + 1e-9 * wanted[who] * length[at]
            sums = np.zeros((len(who), len(turned)))
            for step in range(4):
                piece = slice(cuts[step], cuts[step + 1])
                sums += turned_queries[who, piece] @ turned[:, piece].T
                open_pairs = sums + rest[step][who][:, None] * left[step][None, :] >= (best.floor[who] - margin)[:, None]
                if open_pairs.mean() < 0.02:
                    break
            q, v = np.nonzero(open_pairs)
            other = own[who[q]] != row[part][v]
            q, v = q[other], v[other]
            score = _row_products(queries, vectors[part], who[q], v)
            enough = score >= best.floor[who[q]]
            best.add(who[q][enough], score[enough], vec[part][v[enough]], row[part][v[enough]])
    return best


def top_k(rows: DataFrame, asks: Column, k: int = 5, scale: float = 256.0, head: int = 2048, band_components: int = 1 << 22, query_components: int = 1 << 19, blocks_a_pass: int = 2) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``rows(vec_id, embedding)`` with ``asks`` its k best among all other rows.

    The score is the integer inner product of the vectors scaled by :func:`scaled`. Ties go to the smaller vec_id, those without one last. Vectors that are null
    or hold nulls or what is not finite take no part; a shorter vector counts as if filled up with zeros, so an empty one scores 0. Repeated rows are
    rows of their own: each asks and each may be found, also by its copies. A query without any other row gives no rows, and so does an empty table.
    Other columns are ignored. ``head`` vectors, the longest, are broadcast; a band has about ``band_components`` components, a block of queries ``query_components``.
    """
    spark = rows.sparkSession
    taken = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.coalesce(asks, F.lit(False)).alias("asks"), scaled(F.col("embedding"), scale).alias("v")).where("v is not null")
    n, n_queries, dimension = taken.agg(F.count("*"), F.count_if("asks"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    answer = "query_id long, rank int, vec_id long, score long"
    if not n_queries:
        return spark.createDataFrame([], answer)
    dimension = max(dimension, 1)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bands = max(parts, math.ceil(n * dimension / band_components))
    packed = taken.mapInArrow(lambda batches: _packed(batches, dimension), "vec_id long, asks boolean, square long, v binary")
    ranged = packed.repartitionByRange(bands, F.desc("square"), F.xxhash64("vec_id", "v")).select("*", F.spark_partition_id().alias("band"), F.monotonically_increasing_id().alias("row"))
    table, folder = written(ranged.sortWithinPartitions(F.desc("square"), "row"))
    used = [folder]

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimension, dimension))
        for batch in batches:
            part = _matrix(batch.column("v").to_pylist(), dimension).astype(float)
            total += part.T @ part
        yield pa.RecordBatch.from_arrays([pa.array(range(dimension), pa.int32()), pa.array([line.tobytes() for line in total], pa.binary())], ["i", "line"])

    def summed(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": frame["i"].iloc[:1], "line": [np.sum([np.frombuffer(line) for line in frame["line"]], axis=0).tobytes()]})

    lines = table.select("v").mapInArrow(gram, "i int, line binary").groupBy("i").applyInPandas(summed, "i int, line binary").collect()  # as many as dimensions
    moments = np.stack([np.frombuffer(line) for _, line in sorted((r.i, r.line) for r in lines)])
    rotation = np.ascontiguousarray(np.linalg.eigh(moments)[1][:, ::-1])  # the right singular vectors of all vectors, greatest first

    longest = table.orderBy(F.desc("square"), "row").limit(head).select("row", "v").collect()
    head_rows, head_vectors = np.array([r.row for r in longest], np.int64), _matrix([bytes(r.v) for r in longest], dimension)
    shared = spark.sparkContext.broadcast((rotation, head_rows, head_vectors))

    def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, known, vectors = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                own = part.column("row").to_numpy()
                scores = _products(_matrix(part.column("v").to_pylist(), dimension), vectors)
                scores[own[:, None] == known[None, :]] = _NONE
                floor = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(own), _NONE)
                length = np.sqrt(part.column("square").to_numpy().astype(float))
                need = np.where(floor > 0, floor / np.maximum(length, 1.0), 0.0)
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("vec_id"), part.column("v"), pa.array(floor, pa.int64()), pa.array(need)], ["q", "query_id", "qv", "floor", "need"])

    try:
        asked = table.where("asks").select("row", "vec_id", "square", "v").mapInArrow(seeded, "q long, query_id long, qv binary, floor long, need double")
        blocks = math.ceil(n_queries * dimension / query_components)
        queries, folder = written(asked.repartitionByRange(blocks, F.desc("need"), "q").withColumn("block", F.spark_partition_id()))
        used.append(folder)

        def cell(key: tuple, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
            if not len(vectors) or not len(queries):
                return pd.DataFrame({"q": [], "vec": [], "row": [], "score": []}).astype("int64")
            best = _search(_matrix(vectors["v"], dimension), vectors["vec"].to_numpy(), vectors["row"].to_numpy(), _matrix(queries["qv"], dimension), queries["q"].to_numpy(), queries["floor"].to_numpy(), shared.value[0], k)
            return pd.DataFrame({"q": queries["q"].to_numpy()[best.query], "vec": best.vec, "row": best.row, "score": best.score})

        results = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
        used.append(results)
        vectors = table.select("band", "row", "square", "v", F.coalesce("vec_id", F.lit(_LONG)).alias("vec"))
        for first in range(0, blocks, blocks_a_pass):
            now = queries.where(F.col("block").between(first, first + blocks_a_pass - 1))
            needs = {r.block: r.need for r in now.groupBy("block").agg(F.min("need").alias("need")).collect()}  # at most blocks_a_pass rows
            reach = [F.when(F.sqrt(F.col("square").cast("double")) * (1 + 1e-9) + 1e-6 >= F.lit(need), F.lit(block)) for block, need in needs.items()]
            if not reach:
                continue
            sent = vectors.select("*", F.explode(F.array_compact(F.array(*reach))).alias("block")).drop("square")
            met = now.select("q", "qv", "floor", "block", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band"))
            sent, met = (side.repartition(parts, "block", "band") for side in (sent, met))  # a cell is much work in few bytes, so cells aren't put together by size
            pairs = sent.groupBy("block", "band").cogroup(met.groupBy("block", "band")).applyInPandas(cell, "q long, vec long, row long, score long")
            pairs.write.mode("append").parquet(results)
        found = spark.read.schema("q long, vec long, row long, score long").parquet(results)
        order = Window.partitionBy("q").orderBy(F.desc("score"), "vec", "row")
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)  # of each query k rows a band at most
        found, _ = written(found.join(queries.select("q", "query_id"), "q").join(table.select("row", "vec_id"), "row").select("query_id", "rank", "vec_id", "score"))
    finally:
        for folder in used:
            delete(spark, folder)
    return found
