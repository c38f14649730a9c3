"""The words of a form itself, found as the lines that nearly all of its filled-in copies share, and taken out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.text import line_key, strip

# A line is the form's if it is in this share of at least so many copies.
THRESHOLD = 0.95
MIN_TEXTS = 20


def lines_of(text: Column) -> Column:
    """The lines of a text; what ends with a line end has no further, empty line."""
    return F.split(F.regexp_replace(text, r"\n\z", ""), "\n")


def line_frequencies(docs: DataFrame, group: str, text: str) -> DataFrame:
    """``group, line, n_docs``: in how many texts of its group a non-empty line (by its key) is; repeats in a text count once."""
    keys = F.array_distinct(F.filter(F.transform(lines_of(F.col(text)), line_key), lambda k: k != ""))
    return docs.select(group, F.explode(keys).alias("line")).groupBy(group, "line").agg(F.count("*").alias("n_docs"))


def common_lines(docs: DataFrame, group: str = "drop", text: str = "fulltext", threshold: float = THRESHOLD, min_texts: int = MIN_TEXTS, members: DataFrame | None = None) -> DataFrame:
    """``group, line`` of the lines in at least ``ceil(threshold * n)`` of a group's n texts, for groups of ``min_texts`` or more.

    Lines are counted with partial aggregation, so a group of any size is spread over tasks; sizes are one row for each group, counted on
    ``members`` (the same rows without their texts) if these are at hand, so that texts are not read for it.
    """
    sizes = (members or docs).groupBy(F.col(group).alias("_group")).agg(F.count("*").alias("_n"))
    counted = line_frequencies(docs, group, text).join(sizes, F.col(group).eqNullSafe(F.col("_group")))
    enough = F.col("n_docs") >= F.ceil(F.col("_n").cast("double") * F.lit(float(threshold)))
    return counted.where((F.col("_n") >= min_texts) & enough).select(group, "line")


def without_lines(text: Column, common: Column) -> Column:
    """A text without the lines whose keys are in an array; runs of empty lines shrink to one. A null array takes none."""
    kept = F.filter(lines_of(text), lambda x: ~F.coalesce(F.array_contains(common, line_key(x)), F.lit(False)))
    return strip(F.regexp_replace(F.array_join(kept, "\n"), r"\n{3,}", "\n\n"))


def strip_boilerplate(docs: DataFrame, group: str = "drop", text: str = "fulltext", threshold: float = THRESHOLD, min_texts: int = MIN_TEXTS, members: DataFrame | None = None) -> DataFrame:
    """``docs`` with its group's common lines taken out of ``text``.

    Common lines make one row for each group (an array no longer than a text by its threshold), so texts are not exploded for the removal.
    """
    found = common_lines(docs, group, text, threshold, min_texts, members).groupBy(F.col(group).alias("_group")).agg(F.collect_set("line").alias("_common"))
    joined = docs.join(found, F.col(group).eqNullSafe(F.col("_group")), "left")
    return joined.select(*[without_lines(F.col(text), F.col("_common")).alias(text) if c == text else F.col(c) for c in docs.columns])
