"""The corpus build as one plan: exclude, deduplicate, name, attach texts, strip boilerplate, extract, project."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry import schemas
from docketry.functions.category import STATEMENT, category
from docketry.functions.dates import filing
from docketry.functions.filer import filer
from docketry.functions.text import drop_of, fulltext, safe_name
from docketry.operators.boilerplate import strip_boilerplate
from docketry.operators.dedup import documents, without_excluded
from docketry.operators.durable import checkpointed
from docketry.operators.naming import unique_names
from docketry.sources.files import with_text_paths
from docketry.sources.tables import DEFAULT_KIND, STATEMENT_KIND


def named_documents(files: DataFrame, exclusions: DataFrame) -> DataFrame:
    """One named row for each distinct document of ``files(path, sha256, text_path)``, with or without a text.

    Names are given before documents without a text go, so a text that comes later does not rename others.
    """
    docs = documents(without_excluded(files, exclusions)).withColumn("safe", safe_name(F.col("filenames"))).select("*", "safe.*").drop("safe")
    names = unique_names(docs, "sha256", "first_path").withColumnRenamed("sha256", "_sha")
    return docs.join(names, F.col("sha256") == F.col("_sha")).drop("_sha", "stem", "ext")


def with_drops(docs: DataFrame, drops: DataFrame) -> DataFrame:
    """``docs(drop, ...)`` with their drop's ``custodian, kind, _agency, _year``; the kind is the default one where there is none."""
    about = drops.select(F.col("drop").alias("_drop"), "custodian", F.col("kind").alias("_kind"), F.col("agency").alias("_agency"), F.col("year").alias("_year"))
    joined = docs.join(about, F.col("drop") == F.col("_drop"), "left")
    return joined.withColumn("kind", F.coalesce("_kind", F.lit(DEFAULT_KIND))).drop("_drop", "_kind")


def with_fulltext(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """``docs(text_path, ...)`` with the ``fulltext`` of their text; both sides are sent and sorted.

    Texts that tasks read from files have no size that the planner could know: it measures the paths that were sent to the tasks, takes the texts for as little, and
    all of them would go to the driver to be broadcast.
    """
    own = texts.select(F.col("text_path").alias("_tp"), fulltext(F.col("text"), F.col("ext")).alias("fulltext"))
    return docs.join(own.hint("merge"), F.col("text_path") == F.col("_tp")).drop("_tp")


def build_corpus(files: DataFrame, texts: DataFrame, drops: DataFrame, exclusions: DataFrame, as_of: datetime.date) -> DataFrame:
    """The corpus table and ``first_path`` (its order) from ``files(path, sha256)`` and the outputs of the other sources.

    Files and documents are narrow rows that are written once they are known, so the contents of files are read in one pass, however often what
    follows looks at the rows. Texts are joined then, so copies do not carry them, and written with their documents, as those of statements are read a second
    time for their common lines. Drops and exclusions are small tables whose join strategy is left to their measured size.
    """
    placed = checkpointed(with_text_paths(files, texts))
    named = named_documents(placed, exclusions).where("text_path is not null").withColumn("drop", drop_of(F.col("original_path")))
    named = checkpointed(with_drops(named, drops))
    docs = checkpointed(with_fulltext(named, texts))
    none = F.lit(None).cast("string")

    plain = docs.where(F.col("kind") != STATEMENT_KIND)
    plain = plain.withColumn("_filing", filing(F.col("filenames"), F.col("original_path"), F.col("fulltext"), F.lit(as_of.year))).withColumn("_filer", filer(F.col("fulltext")))
    plain = plain.withColumns({
        "category": category(F.col("fulltext")), "date": F.col("_filing.date"), "date_source": F.col("_filing.date_source"),
        "name": F.col("_filer.name"), "title": F.col("_filer.title"), "parsed_agency": F.col("_filer.agency"),
    })
    statement = F.col("kind") == STATEMENT_KIND
    forms = strip_boilerplate(docs.where(statement), "drop", "fulltext", members=named.where(statement))
    forms = forms.withColumns({"category": F.lit(STATEMENT), "date": F.col("_year").cast("string"), "date_source": F.lit("drop"), "name": none, "title": none, "parsed_agency": none})

    columns = ["first_path", "kind", "filename", "custodian", "category", "date", "date_source", "filenames", "original_path", "sha256", "fulltext", "name", "title", "_agency", "parsed_agency"]
    both = plain.select(*columns).unionByName(forms.select(*columns))
    both = both.withColumn("agency", F.coalesce("_agency", "parsed_agency")).withColumnRenamed("filenames", "original_filenames").withColumnRenamed("sha256", "sha256sum")
    return both.select("first_path", "kind", *[f.name for f in schemas.CORPUS.fields])
