"""Plans of what to link, upload, remove or refuse. They only say what is to be done; applying them is up to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mirror_plan(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """``name, target, action`` from ``wanted(name, target)`` and ``existing(name, target)``: link, keep or remove."""
    w, e = wanted.select("name", F.col("target").alias("_wanted")), existing.select("name", F.col("target").alias("_existing"), F.lit(True).alias("_there"))
    both = w.withColumn("_asked", F.lit(True)).join(e, "name", "full_outer")
    action = F.when(F.col("_asked").isNull(), "remove").when(F.col("_there") & F.col("_wanted").eqNullSafe(F.col("_existing")), "keep").otherwise("link")
    return both.select("name", F.coalesce("_wanted", "_existing").alias("target"), action.alias("action"))


def bucket_plan(local: DataFrame, remote: DataFrame, least: int) -> DataFrame:
    """``name, action`` (copy, keep, delete) of a mirror by size only. Raises ValueError if there are fewer than ``least`` local files."""
    guard_count(local, least)
    both = local.select("name", F.col("size").alias("_local")).join(remote.select("name", F.col("size").alias("_remote")), "name", "full_outer")
    action = F.when(F.col("_local").isNull(), "delete").when(F.col("_local") == F.col("_remote"), "keep").otherwise("copy")
    return both.select("name", action.alias("action"))


def guard_count(files: DataFrame, least: int) -> int:
    """The number of files, if it is at least ``least``; a mirror of a half-built tree would delete the rest of the remote one."""
    n = files.limit(least).count() if least > 0 else 0
    if n < least:
        raise ValueError(f"{n} files; refusing with fewer than {least}")
    return n


def checksum_report(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """``filename, status`` for ``files(filename, sha256)`` and a manifest: ok, mismatch, missing or unlisted."""
    both = manifest.select("filename", F.col("sha256").alias("_listed")).join(files.select("filename", F.col("sha256").alias("_found")), "filename", "full_outer")
    status = F.when(F.col("_found").isNull(), "missing").when(F.col("_listed").isNull(), "unlisted").when(F.col("_listed") == F.col("_found"), "ok").otherwise("mismatch")
    return both.select("filename", status.alias("status"))


def manifest_of(files: DataFrame) -> DataFrame:
    """``sha256, filename`` of ``files(filename, sha256)``, by name."""
    return files.select("sha256", "filename").orderBy("filename")


def pending(jobs: DataFrame, done: DataFrame, key: str, limit: int | None = None, order: str | None = None) -> DataFrame:
    """Jobs without a finished output; the first ``limit`` of them in order, if asked for."""
    left = jobs.join(done.select(key).distinct(), key, "left_anti")
    return left.orderBy(order or key).limit(limit) if limit is not None else left
