"""Getting texts: which files still need one, which way, and what comes of it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.operators.durable import checkpointed
from docketry.operators.rollup import complete_documents, page_rollup
from docketry.sources.files import as_texts, ocr_jobs, page_images, recognise, text_layers
from docketry.sources.tables import DEFAULT_KIND, STATEMENT_KIND


def pending_jobs(files: DataFrame, texts: DataFrame, limit: int | None = None) -> DataFrame:
    """``pdf, dest_dir, stem, drop`` of the files without a finished text, by path; the first ``limit`` of them, taken before any split.

    A text in either format is finished; timestamps play no part.
    """
    done = texts.select(F.col("dir").alias("dest_dir"), "stem").distinct()
    jobs = ocr_jobs(files).join(done, ["dest_dir", "stem"], "left_anti").select("pdf", "dest_dir", "stem", "drop")
    return jobs.orderBy("pdf").limit(limit) if limit is not None else jobs


def split_jobs(jobs: DataFrame, drops: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Jobs to recognise, and jobs of statement drops, whose text layer is tried first."""
    kinds = drops.select(F.col("drop").alias("_drop"), F.col("kind").alias("_kind"))
    marked = jobs.join(kinds, F.col("drop") == F.col("_drop"), "left").withColumn("_kind", F.coalesce("_kind", F.lit(DEFAULT_KIND)))
    return marked.where(F.col("_kind") != STATEMENT_KIND).select(jobs.columns), marked.where(F.col("_kind") == STATEMENT_KIND).select(jobs.columns)


@dataclass
class Ingested:
    """Texts from text layers, complete recognised documents, and the jobs that stay pending."""

    layered: DataFrame
    recognised: DataFrame
    failed: DataFrame

    def texts(self) -> DataFrame:
        """All texts in the form that is written, scanned and built into a corpus: text layers as ``txt``, recognised documents as ``md``."""
        return as_texts(self.layered, "txt").unionByName(as_texts(self.recognised, "md", "markdown"))


def ingest(jobs: DataFrame, contents: DataFrame, drops: DataFrame, render: Callable[[bytes], list[bytes]], infer: Callable[[list[bytes]], list[dict]], batch_pages: int = 8, command: tuple[str, ...] = ("pdftotext", "-q", "-layout")) -> Ingested:
    """Texts of ``jobs`` from ``contents(path, content)``.

    Statements without a usable text layer join the jobs to recognise. A document comes out whole or not at all: rows of documents that miss a
    page or were in a failed batch are left out and their jobs reported. The extractor and the model see each document once, however often what follows
    looks at their results, as these are written once they are known.
    """
    to_recognise, statements = split_jobs(jobs, drops)
    layers = checkpointed(text_layers(contents.join(statements.select(F.col("pdf").alias("path")), "path", "left_semi"), command))
    layered = layers.where("text is not null").select(F.col("path").alias("pdf"), "text")
    rejected = layers.where("text is null").select(F.col("path").alias("pdf"))
    images = contents.join(to_recognise.select("pdf").unionByName(rejected).select(F.col("pdf").alias("path")), "path", "left_semi")
    pages = page_images(images, render)
    results = checkpointed(recognise(pages.where("not error"), infer, batch_pages))
    expected = results.groupBy("doc").agg(F.max("expected_pages").alias("expected_pages"))
    done = complete_documents(page_rollup(results), expected).withColumnRenamed("doc", "pdf").drop("failed")
    finished = layered.select("pdf").unionByName(done.select("pdf"))
    return Ingested(layered, done, jobs.join(finished, "pdf", "left_anti").select("pdf"))


def throughput(done: DataFrame, seconds: float) -> DataFrame:
    """One row ``documents, pages, minutes, seconds_per_page`` of recognised documents that took so long; times with one decimal, no pages as one."""
    counted = done.agg(F.count("*").alias("documents"), F.coalesce(F.sum("num_pages"), F.lit(0)).alias("pages"))
    return counted.select("documents", "pages", F.round(F.lit(seconds / 60), 1).alias("minutes"), F.round(F.lit(float(seconds)) / F.greatest("pages", F.lit(1)), 1).alias("seconds_per_page"))


def failure_report(failed: DataFrame, shown: int = 20) -> list[str]:
    """The first failures by path, and how many more there are."""
    failed = checkpointed(failed)
    names = [r.pdf for r in failed.orderBy("pdf").limit(shown).collect()]
    more = failed.count() - len(names)
    return names + ([f"and {more} more"] if more > 0 else [])
