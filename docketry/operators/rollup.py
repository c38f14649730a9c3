"""Pages to documents: totals, ordered text, completeness and failed batches; and tallies for the site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.functions.dates import year_of
from docketry.operators.durable import numbered


def page_rollup(pages: DataFrame, key: str = "doc") -> DataFrame:
    """One row for each document of ``pages(doc, page_num, markdown, html, token_count, num_chunks, num_images, error)``.

    Texts are joined in page order; a document with an error on any page has ``failed`` set.
    """

    def joined(name: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_num", F.coalesce(name, F.lit("")).alias("t")))), lambda x: x["t"]), "")

    facts = F.struct("page_num", "token_count", "num_chunks", "num_images")
    return pages.groupBy(key).agg(
        F.count("*").alias("num_pages"), F.sum("token_count").alias("total_token_count"), F.sum("num_chunks").alias("total_chunks"), F.sum("num_images").alias("total_images"),
        F.array_sort(F.collect_list(facts)).alias("pages"), joined("markdown").alias("markdown"), joined("html").alias("html"), F.bool_or(F.coalesce("error", F.lit(False))).alias("failed"),
    )


def batched(pages: DataFrame, order: list[str], size: int = 8) -> DataFrame:
    """``pages`` with the number of the inference batch each is in: runs of ``size`` pages across documents, within its partition ``part``."""
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return pages.withColumn("batch", F.floor(place / size).cast("long"))


def poison_batches(pages: DataFrame) -> DataFrame:
    """``pages(part, batch, ..., error)`` with the error of any page spread over its batch: a failed batch gives no result at all."""
    whole = Window.partitionBy("part", "batch")
    return pages.withColumn("error", F.max(F.coalesce("error", F.lit(False))).over(whole))


def complete_documents(rollup: DataFrame, expected: DataFrame, key: str = "doc") -> DataFrame:
    """Rolled-up documents that have all of ``expected(doc, expected_pages)`` and no failure; the others stay pending."""
    return rollup.join(expected, key).where((F.col("num_pages") == F.col("expected_pages")) & ~F.col("failed")).drop("expected_pages")


def tally(docs: DataFrame, by: str) -> DataFrame:
    return docs.groupBy(by).agg(F.count("*").alias("n"))


def site_counts(corpus: DataFrame, statement_label: str) -> DataFrame:
    """One row: disclosures (whatever is not of the statement category, null too), statements, and the years with documents, newest first."""
    is_statement = F.coalesce(F.col("category") == statement_label, F.lit(False))
    return corpus.agg(
        F.count_if(~is_statement).alias("disclosure_count"), F.count_if(is_statement).alias("statement_count"), F.reverse(F.array_sort(F.collect_set(year_of(F.col("date"))))).alias("years")
    )


def years(corpus: DataFrame) -> DataFrame:
    return corpus.select(year_of(F.col("date")).alias("year")).where("year is not null").distinct().orderBy(F.desc("year"))


def numbered_paths(items: DataFrame, path: str = "path", order: str = "arrival") -> DataFrame:
    """``items`` with the nth repeat (from the second) of a path told apart by `` (n)`` before its ``.pdf``, as ``unique_path``."""
    rows = numbered(items, path, [order], "_n")
    suffixed = F.regexp_replace(F.col(path), F.lit(r"(?i)\.pdf\z"), F.format_string(" (%d).pdf", "_n"))
    return rows.select(*items.columns, F.when(F.col("_n") > 1, suffixed).otherwise(F.col(path)).alias("unique_path"))
