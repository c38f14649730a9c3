"""The registry of queries: each by its function's name, with its SQL if there is one."""

from __future__ import annotations

import contextlib
import hashlib
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

from docketry.operators.durable import delete, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
_MADE: set[str] = set()


def registered(sql: str | None = None):
    """Adds a query by its function's name, with its SQL if there is one."""

    def add(query: Callable[[SparkSession, str], DataFrame]):
        QUERIES[query.__name__] = query
        if sql:
            ORACLE_SQL[query.__name__] = sql
        return query

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@contextlib.contextmanager
def fresh(spark: SparkSession, name: str) -> Iterator[str]:
    """A new folder in the shared folder for what a query makes in one run, gone afterwards."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        delete(spark, folder)


def made_once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[str], None]) -> str:
    """The folder of inputs that queries of one session share (files that stand for the tables, the search index), in the shared folder; made when first asked for.

    No query's outcome is kept this way: see :func:`fresh`.
    """
    digest = hashlib.md5(sf_dir.encode()).hexdigest()[:12]
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}-{digest}-{name}"
    if folder not in _MADE:
        delete(spark, folder)  # what a failed attempt may have left
        make(folder)
        _MADE.add(folder)
    return folder
