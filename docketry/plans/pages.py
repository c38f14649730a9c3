"""The published pages as rows of path and content, ready to be written as files: a home page of counts and drops, a search page of facets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.dates import display_day
from docketry.functions.display import delimit, drop_url, slugify
from docketry.operators.search import escape_html
from docketry.plans.publish import site_data

STATEMENTS = "statements of financial interests"


def _text(value: str | Column) -> Column:
    return escape_html(F.lit(value) if isinstance(value, str) else value)


def drop_items(drops: DataFrame, drops_url: str) -> DataFrame:
    """One row ``html``: an item for each drop, newest first, ties by name. Drops are a dimension, a row for each zip."""
    day = F.col("date").cast("date")
    link = F.concat(F.lit('<time datetime="'), day.cast("string"), F.lit('"><a href="'), _text(drop_url(F.col("url"), drops_url, F.col("filename"))), F.lit('">'), display_day(day), F.lit("</a></time>"))
    notes = F.when(F.coalesce("notes", F.lit("")) != "", F.concat(F.lit("<p>"), _text(F.col("notes")), F.lit("</p>"))).otherwise("")
    item = F.concat(F.lit("<li>"), link, F.lit("<b>"), _text(F.coalesce("custodian", F.lit(""))), F.lit("</b>"), notes, F.lit("</li>"))
    rows = drops.select(day.alias("day"), "filename", item.alias("item"))
    return rows.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("day", "filename", "item")), asc=False), lambda x: x["item"]), "").alias("html"))


def home_page(corpus: DataFrame, drops: DataFrame, drops_url: str, title: str) -> DataFrame:
    """``path, content`` of the home page: how many disclosures and statements there are, and the drops they came in."""
    counts = site_data(corpus)
    head = F.concat(F.lit("<h1>"), _text(title), F.lit("</h1><p>"), delimit(F.col("disclosure_count")), F.lit(" disclosures, "), delimit(F.col("statement_count")), F.lit(f" {STATEMENTS}</p>"))
    page = F.concat(head, F.lit("<ol>"), drop_items(drops, drops_url).scalar(), F.lit("</ol>"))
    return counts.select(F.lit("index.html").alias("path"), page.cast("binary").alias("content"))


def search_page(corpus: DataFrame, categories: DataFrame, title: str) -> DataFrame:
    """``path, content`` of the search page: a box for each of ``categories(ord, value, slug)`` in their order and for each year of the corpus, newest first."""

    def box(slug: Column, value: Column) -> Column:
        return F.concat(F.lit('<label><input type="checkbox" value="'), slug, F.lit('" data-value="'), _text(value), F.lit('">'), _text(value), F.lit("</label>"))

    boxes = categories.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", box(F.col("slug"), F.col("value")).alias("box")))), lambda x: x["box"]), "").alias("html"))
    years = F.array_join(F.transform("years", lambda y: box(slugify(y), y)), "")
    page = F.concat(F.lit("<h1>"), _text(title), F.lit('</h1><form><fieldset data-filter="category">'), boxes.scalar(), F.lit('</fieldset><fieldset data-filter="year">'), years, F.lit("</fieldset></form>"))
    return site_data(corpus).select(F.lit("search/index.html").alias("path"), page.cast("binary").alias("content"))
