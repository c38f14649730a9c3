"""Small tables that are read on the driver (drop metadata, exclusions, manifests) and the JSON corpus."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry import schemas
from docketry.functions.category import CATEGORIES
from docketry.operators.durable import delete, written
from docketry.plans.request import slugify
from docketry.sources.trees import opened
from docketry.sources.writers import staged

DEFAULT_KIND, STATEMENT_KIND = "disclosure", "sfi"
_KNOWN = ("custodian", "kind", "agency", "year", "url", "notes")


def load_yaml(path: str) -> Any:
    """YAML by the usual library, or JSON (which YAML contains) where that is not installed."""
    store, place = opened(path)
    with store.open_input_stream(place) as file:
        text = file.read().decode("utf-8")
    try:
        import yaml
    except ImportError:
        return json.loads(text)
    return yaml.safe_load(text)


def drop_metadata(spark: SparkSession, entries: dict[str, dict | None]) -> DataFrame:
    """Drop metadata by drop name; an entry without fields is empty, and unknown fields go to ``extra``."""
    rows = []
    for name, fields in (entries or {}).items():
        fields = fields or {}
        extra = {k: str(v) for k, v in fields.items() if k not in _KNOWN}
        rows.append((name.removesuffix(".zip"), *(fields.get(k) if k == "year" or fields.get(k) is None else str(fields[k]) for k in ("custodian", "kind", "agency", "year", "url", "notes")), extra))
    return spark.createDataFrame(rows, schemas.DROPS)


def exclusions(spark: SparkSession, hashes: list[str]) -> DataFrame:
    return spark.createDataFrame([(h,) for h in dict.fromkeys(hashes or [])], schemas.EXCLUSIONS)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``sha256, filename`` of a checksum manifest, two blanks between."""
    found = spark.read.text(path)
    return found.select(F.regexp_extract("value", r"^([0-9a-f]{64})\s+\*?(.+)$", 1).alias("sha256"), F.regexp_extract("value", r"^([0-9a-f]{64})\s+\*?(.+)$", 2).alias("filename")).where("sha256 <> ''")


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CORPUS).json(path)


def read_corpus_metadata(spark: SparkSession, path: str) -> DataFrame:
    """One row for each drop of the corpus metadata document."""
    return spark.read.schema(schemas.CORPUS_METADATA).option("multiLine", True).json(path).select(F.explode("drops").alias("d")).select("d.*")


def categories(spark: SparkSession, configured: list[str] | None = None) -> DataFrame:
    """``ord, value, slug`` of the categories in display order. A configured list with other labels is an error, not silence."""
    if configured is not None and sorted(configured) != sorted(CATEGORIES):
        raise ValueError(f"categories differ from those that documents are given: {sorted(set(configured) ^ set(CATEGORIES))}")
    return spark.createDataFrame([(k, v, slugify(v)) for k, v in enumerate(configured or CATEGORIES)], "ord int, value string, slug string")


def category_usage(dimension: DataFrame, rows: DataFrame) -> DataFrame:
    """``ord, value, slug, documents, known``: each category of ``dimension`` with its rows in ``rows(category)``, and categories of rows that it lacks (``known`` false).

    A label that differs between the two would show as a facet without matches; here it is a row of its own.
    """
    counts = rows.groupBy(F.col("category").alias("_value")).agg(F.count("*").alias("documents"))
    both = dimension.join(counts, F.col("value").eqNullSafe(F.col("_value")), "full_outer")
    return both.select("ord", F.coalesce("value", "_value").alias("value"), "slug", F.coalesce("documents", F.lit(0)).alias("documents"), F.col("ord").isNotNull().alias("known"))


def checked_drops(listing: DataFrame, metadata: DataFrame) -> DataFrame:
    """``filename, date`` and the metadata of each drop, by name. Raises ValueError unless names are valid and both sides agree.

    Both tables have one row for each drop.
    """
    named = metadata.withColumn("filename", F.concat("drop", F.lit(".zip"))).withColumn("_described", F.lit(True))
    both = listing.withColumn("_listed", F.lit(True)).join(named, "filename", "full_outer")
    wrong = both.where("_listed is null or _described is null or not valid").select("filename", F.coalesce("valid", F.lit(True)).alias("valid"), "_listed", "_described").orderBy("filename").limit(20).collect()
    if wrong:
        reasons = [f"{r.filename}: " + ("no metadata" if r._described is None else "no such zip" if r._listed is None else "not named YYYY-MM-DD-agency.zip") for r in wrong]
        raise ValueError("; ".join(reasons))
    return both.drop("_listed", "_described", "valid", "drop").orderBy("filename")


def write_corpus(corpus: DataFrame, path: str, files: int | None = None) -> None:
    """JSON lines with explicit nulls, in first-path order from part to part; as many files as the sort has ranges, or so many.

    A sort samples its rows before it sends them, so they are a table of their own for that time and are not made twice.
    """
    columns = [f.name for f in schemas.CORPUS.fields]
    rows, folder = written(corpus)
    try:
        ordered = rows.orderBy("first_path").select(*columns)
        (ordered.coalesce(files) if files else ordered).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    finally:
        delete(corpus.sparkSession, folder)


def write_corpus_metadata(drops: DataFrame, path: str) -> None:
    """One pretty-printed JSON document of all drops, put in place by a rename. A row for each drop reaches the driver."""
    rows = []
    for r in drops.orderBy("filename").collect():
        fields = {k: v for k, v in r.asDict().items() if v is not None and k != "extra"}
        rows.append({"filename": r["filename"], "date": str(r["date"])} | {k: v for k, v in fields.items() if k not in ("filename", "date")} | (r["extra"] or {}))
    folder, _, name = path.rpartition("/")
    with staged(folder or ".") as place:
        place(name, iter([json.dumps({"drops": rows}, indent=2, ensure_ascii=False).encode()]))
