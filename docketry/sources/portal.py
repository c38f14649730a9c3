"""A paged REST portal as a data source: ``spark.read.format("portal_items")``."""

from __future__ import annotations

import json
import os
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from docketry import schemas
from docketry.functions.display import portal_path
from docketry.operators.rollup import numbered_paths

PAGE = 100


def fetch_items(base: str, filter_: str, page: int = PAGE) -> Iterator[dict]:
    """Items one page after the other, until a page is not full. A local directory stands in for the portal as ``<start>.json`` files."""
    start = 1
    while True:
        if "://" in base:
            query = urllib.parse.urlencode({"filter": filter_, "limit": page, "startindex": start})
            with urllib.request.urlopen(f"{base}?{query}") as answer:
                features = json.load(answer)["features"]
        else:
            path = os.path.join(base, f"{start}.json")
            features = []
            if os.path.exists(path):
                with open(path, encoding="utf-8") as file:
                    features = json.load(file)["features"]
        yield from features
        if len(features) < page:
            return
        start += page


class PortalItems(DataSource):
    """Options: ``url`` (or a directory of pages), ``filter``, ``page``. A page's end is only known by asking, so one reader pages on."""

    @classmethod
    def name(cls) -> str:
        return "portal_items"

    def schema(self):
        return "arrival int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.PORTAL_ITEM.fields)

    def reader(self, schema) -> DataSourceReader:
        return PortalReader(self.options)


class PortalReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        items = fetch_items(self.options["url"], self.options.get("filter", ""), int(self.options.get("page", PAGE)))
        for n, item in enumerate(items):
            properties = item.get("properties") or {}
            yield n, str(item["id"]), (properties.get("title"), properties.get("name"))


def portal_items(spark: SparkSession, url: str, filter_: str = "", page: int = PAGE) -> DataFrame:
    """``arrival, id, path, unique_path`` of the portal's items: where each is filed, repeats told apart by number."""
    spark.dataSource.register(PortalItems)
    items = spark.read.format("portal_items").options(url=url, filter=filter_, page=str(page)).load()
    placed = items.select("arrival", "id", portal_path(F.col("properties.title"), F.col("properties.name")).alias("path"))
    return numbered_paths(placed, "path", "arrival")


def fetch_missing(items: DataFrame, have: DataFrame, fetch: Callable[[str], bytes]) -> DataFrame:
    """``unique_path, content, error`` of the items whose path is not in ``have(unique_path)``, by a given fetch of an item id.

    Rows are written as a table, whose commit makes them visible whole; an item that fails has an error and is asked for again next time.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, item in zip(batch["unique_path"], batch["id"], strict=True):
                try:
                    content, error = fetch(item), None
                except Exception as problem:  # kept in the row; the others go on
                    content, error = None, str(problem)
                yield pd.DataFrame({"unique_path": [path], "content": [content], "error": [error]})

    pending = items.join(have.select("unique_path").distinct(), "unique_path", "left_anti").select("unique_path", "id")
    return pending.mapInPandas(run, "unique_path string, content binary, error string")
