"""Slices of Arrow batches, and connected components over edge tables."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.operators.durable import delete, written


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of so many rows (without copying), so that few texts at a time are Python objects.

    When the last is done, a worker gives freed memory back: it lives on for later tasks, and what it keeps is missing elsewhere.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    trim()


def trim() -> None:
    """Gives memory that was freed back to the operating system, where its library can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def components(edges: DataFrame, most_rounds: int = 200) -> DataFrame:
    """``id, component`` for every node of ``edges(a, b)`` (longs): the smallest id it is connected to.

    Alternating stars (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014): in the large star each node
    hangs its greater neighbours on its smallest neighbour, in the small star its smaller ones. Edges are at most as many
    after a step as before; rounds grow with the logarithm of the longest path. Every step is a written table, of a size that the planner knows; minima are
    aggregates with a partial form and are written before they are joined: a join of two plain exchanges is one whose skewed partitions adaptive
    execution splits, so a hub of any degree is spread over tasks.
    """
    spark, used = edges.sparkSession, []

    def table(df: DataFrame) -> DataFrame:
        out, folder = written(df)
        used.append(folder)
        return out

    now = table(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = table(both.groupBy(F.col("a").alias("_n")).agg(F.least(F.min("b"), F.first("a")).alias("_m")))
        large = both.where(F.col("b") > F.col("a")).join(least, F.col("a") == F.col("_n")).select(F.col("b").alias("a"), F.col("_m").alias("b")).where("a != b")
        large = table(large.distinct())
        least = table(large.groupBy(F.col("a").alias("_n")).agg(F.min("b").alias("_m")))
        joined = large.join(least, F.col("a") == F.col("_n"))
        small = joined.select(F.explode(F.array(F.struct("a", F.col("_m").alias("b")), F.struct(F.col("b").alias("a"), F.col("_m").alias("b")))).alias("e")).select("e.*")
        now = table(small.where("a != b").distinct())
        while len(used) > 1:  # all but the last
            delete(spark, used.pop(0))
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components were not stable after {most_rounds} rounds")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
