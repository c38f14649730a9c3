"""Publishing: the mirror of linked files and the data that site pages show."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.functions.category import STATEMENT
from docketry.functions.dates import display_day
from docketry.functions.display import drop_url
from docketry.operators.durable import checkpointed
from docketry.operators.rollup import site_counts
from docketry.operators.syncplan import mirror_plan
from docketry.sources.trees import dealt, file_tree
from docketry.sources.writers import write_links


def existing_links(spark, folder: str) -> DataFrame:
    """``name, inode`` of the files in a mirror folder, which the workers mount. Names are listed once and looked up by all tasks."""

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame({"name": rows["path"], "inode": [str(os.stat(os.path.join(folder, name)).st_ino) for name in rows["path"]]}, dtype=object)

    os.makedirs(folder, exist_ok=True)
    names = file_tree(spark, folder).where(~F.col("path").contains("/")).select("path")
    return dealt(names).mapInPandas(look_up, "name string, inode string")


def link_plan(corpus: DataFrame, spark, pdf_dir: str, folder: str) -> DataFrame:
    """``name, target, action``: what to link, keep or remove so that the folder holds each document's file under its public name.

    Files are looked up by the workers, which mount both folders; no row of the corpus reaches the driver.
    """

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield rows.assign(target=[str(os.stat(os.path.join(pdf_dir, path)).st_ino) for path in rows["path"]])

    wanted = corpus.select(F.col("filename").alias("name"), F.col("original_path").alias("path"))
    inodes = wanted.mapInPandas(look_up, "name string, path string, target string")
    plan = mirror_plan(inodes.select("name", "target"), existing_links(spark, folder).withColumnRenamed("inode", "target"))
    return plan.join(wanted, "name", "left").select("name", F.col("path").alias("target"), "action")


def apply_links(plan: DataFrame, pdf_dir: str, folder: str) -> dict[str, int]:
    """Carries out a link plan by the workers, which mount both folders; how many were linked, kept and removed."""
    os.makedirs(folder, exist_ok=True)
    plan = checkpointed(plan)  # so that what is being linked and removed does not change the plan
    write_links(plan, pdf_dir, folder)
    return {"link": 0, "keep": 0, "remove": 0} | {r.action: r["count"] for r in plan.groupBy("action").count().collect()}


def site_data(corpus: DataFrame) -> DataFrame:
    """One row: counts of disclosures and statements, and the years."""
    return site_counts(corpus, STATEMENT)


def drop_table(drops: DataFrame, drops_url: str) -> DataFrame:
    """The drops as the home page lists them, newest first, ties by name."""
    rows = drops.orderBy(F.desc("date"), F.desc("filename"))
    return rows.select("filename", display_day(F.col("date").cast("date")).alias("received"), "custodian", "notes", drop_url(F.col("url"), drops_url, F.col("filename")).alias("href"))
