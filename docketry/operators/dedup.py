"""Files to documents: exclusions, one document for each content hash, its names and its first copy with a text."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.functions.text import basename


def without_excluded(files: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Files whose hash is not on the exclusion list. This comes before anything is named or written."""
    return files.join(exclusions.select("sha256").distinct(), "sha256", "left_anti")


def documents(files: DataFrame) -> DataFrame:
    """One row for each hash of ``files(path, sha256, text_path)``: ``sha256, first_path, filenames, original_path, text_path``.

    ``filenames`` are the distinct base names in path order; ``original_path`` and ``text_path`` are of the first copy, by path,
    that has a text. The names of a hash are reduced to distinct names with their first path before they are collected, so
    copies under one name, however many, leave one entry.
    """
    text_at = F.when(F.col("text_path").isNotNull(), F.struct("path", "text_path"))
    named = files.groupBy("sha256", basename(F.col("path")).alias("name")).agg(F.min("path").alias("first"), F.min(text_at).alias("with_text"))
    out = named.groupBy("sha256").agg(
        F.min("first").alias("first_path"), F.array_sort(F.collect_list(F.struct("first", "name"))).alias("names"), F.min("with_text").alias("with_text")
    )
    return out.select(
        "sha256", "first_path", F.transform("names", lambda x: x["name"]).alias("filenames"), F.col("with_text.path").alias("original_path"), F.col("with_text.text_path").alias("text_path")
    )


def missing_texts(files: DataFrame, docs: DataFrame) -> DataFrame:
    """Files without a text whose document has none from any copy either."""
    return files.where("text_path is null").join(docs.where("text_path is not null").select("sha256"), "sha256", "left_anti").select("path", "sha256")


def run_summary(files: DataFrame, exclusions: DataFrame, docs: DataFrame, written: DataFrame) -> DataFrame:
    """One row: files, excluded files, distinct documents, documents written."""
    parts = {"files": files, "excluded": files.join(exclusions.select("sha256").distinct(), "sha256", "left_semi"), "distinct_documents": docs, "written": written}
    counts = [part.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, part in parts.items()]
    every = functools.reduce(DataFrame.unionByName, counts)
    return every.agg(*[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in parts])
