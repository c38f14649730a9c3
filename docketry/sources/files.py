"""File sources: PDF trees, extracted texts, drop listings, text layers and page images."""

from __future__ import annotations

import subprocess
import tempfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry import schemas
from docketry.functions.text import basename, drop_of, extension, stem
from docketry.sources.trees import digests, file_tree, read_contents, with_text


def _pdfs(spark: SparkSession, root: str) -> DataFrame:
    """``path, size`` of all PDFs inside drops, whatever the case of their extension; names that begin with a dot are skipped."""
    return file_tree(spark, root, r"(?is).*\.pdf").where(F.col("path").contains("/"))


def scan_contents(spark: SparkSession, root: str) -> DataFrame:
    """``path, content`` of all PDFs inside drops."""
    return read_contents(_pdfs(spark, root), root)


def scan_pdfs(spark: SparkSession, root: str) -> DataFrame:
    """``path, sha256`` of all PDFs inside drops; files of any size, as their contents are no rows."""
    return digests(_pdfs(spark, root), root)


def scan_texts(spark: SparkSession, root: str) -> DataFrame:
    """``dir, stem, ext, text_path, text`` of the extracted texts (``md`` or ``txt``); an empty file is an empty text."""
    rows = with_text(file_tree(spark, root, r"(?s).*\.(?:md|txt)"), root).select(F.col("path").alias("text_path"), "text")
    name = basename(F.col("text_path"))
    return rows.select(F.regexp_replace("text_path", r"/[^/]*$", "").alias("dir"), stem(name).alias("stem"), F.lower(F.substring(extension(name), 2, 10)).alias("ext"), "text_path", "text")


def with_text_paths(files: DataFrame, texts: DataFrame) -> DataFrame:
    """``files(path, ...)`` with ``text_path``: ``<path without extension>/<stem>.md``, or else ``.txt``."""
    name = basename(F.col("path"))
    ext = F.length(extension(name))
    best = texts.groupBy(F.col("dir").alias("_dir"), F.col("stem").alias("_stem")).agg(F.min(F.struct("ext", "text_path")).alias("_best"))
    keyed = files.withColumn("_d", F.substr("path", F.lit(1), F.length("path") - ext)).withColumn("_s", stem(name))
    joined = keyed.join(best, (F.col("_d") == F.col("_dir")) & (F.col("_s") == F.col("_stem")), "left")
    return joined.select(*files.columns, F.col("_best.text_path").alias("text_path"))


def drop_listing(spark: SparkSession, folder: str) -> DataFrame:
    """``filename, date, valid`` of the zips in a folder, by name; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder).select(basename(F.col("path")).alias("filename"))
    day = F.regexp_extract("filename", r"^(\d{4}-\d{2}-\d{2})-.+\.zip\z", 1)
    return found.select("filename", F.try_to_date(F.nullif(day, F.lit("")), "yyyy-MM-dd").alias("date")).withColumn("valid", F.col("date").isNotNull()).orderBy("filename")


def pages_of_text_layer(text: Column, least: int = 10) -> Column:
    """The pages (an array) of a form-feed separated text layer; null if there are none or any has fewer than ``least`` signs."""
    pages = F.split(text, "\f", -1)
    pages = F.slice(pages, F.lit(1), F.greatest(F.size(pages) - 1, F.lit(0)))
    full = F.forall(pages, lambda p: F.length(F.regexp_replace(p, r"\s", "")) >= least)
    return F.when((F.size(pages) > 0) & full, pages)


def text_layers(pdfs: DataFrame, command: tuple[str, ...] = ("pdftotext", "-q", "-layout"), least: int = 10) -> DataFrame:
    """``path, text`` of ``pdfs(path, content)`` by an external extractor; null where it fails or a page is no text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for content in batch["content"]:
                with tempfile.NamedTemporaryFile(suffix=".pdf") as file:  # the tool reads files; it is gone with the row
                    file.write(content)
                    file.flush()
                    try:
                        done = subprocess.run([*command, file.name, "-"], capture_output=True, check=False)
                        texts.append(done.stdout.decode("utf-8", "replace") if done.returncode == 0 else None)
                    except OSError:
                        texts.append(None)
            yield pd.DataFrame({"path": batch["path"], "raw": texts})

    raw = pdfs.select("path", "content").mapInPandas(run, "path string, raw string")
    return raw.select("path", F.array_join(pages_of_text_layer(F.col("raw"), least), "\n").alias("text"))


#: About how many bytes of images, or pages of results, are put together before they are handed on: a frame for each document or batch costs more than its rows.
_AT_ONCE, _PAGES_AT_ONCE = 1 << 24, 1024


def page_images(pdfs: DataFrame, render: Callable[[bytes], list[bytes]]) -> DataFrame:
    """``path, page_num, num_pages, image, error`` by a given renderer; a document that fails or has no page gives one error row."""

    columns = ["path", "page_num", "num_pages", "image", "error"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    images = list(render(content))
                except Exception:  # whatever the renderer raises is the document's failure, kept in its row
                    images = []
                n = len(images)
                rows += [(path, k + 1, n, image, n == 0) for k, image in enumerate(images or [None])]
                held += sum(map(len, images))
                if held >= _AT_ONCE:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=columns)

    return pdfs.select("path", "content").mapInPandas(run, "path string, page_num int, num_pages int, image binary, error boolean")


def recognise(pages: DataFrame, infer: Callable[[list[bytes]], list[dict]], batch_pages: int = 8) -> DataFrame:
    """Page results of ``pages(path, page_num, num_pages, image)`` by a given model, in batches across documents.

    ``infer`` takes images and gives for each a dict of markdown, html, token_count, num_chunks and num_images. If it raises or
    gives another number of results, all pages of the batch are errors, and their documents stay pending.
    """
    schema = "doc string, page_num int, expected_pages int, markdown string, html string, token_count int, num_chunks int, num_images int, error boolean"
    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    empty = {"markdown": None, "html": None, "token_count": 0, "num_chunks": 0, "num_images": 0}

    def flush(queue: list[tuple]) -> list[dict]:
        try:
            results = infer([image for *_, image in queue])
            failed = len(results) != len(queue)
        except Exception:  # the batch is marked, the others go on
            results, failed = [], True
        return [{"doc": path, "page_num": n, "expected_pages": total, "error": failed, **(empty if failed else results[k])} for k, (path, n, total, _) in enumerate(queue)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queue: list[tuple] = []
        rows: list[dict] = []
        for batch in batches:
            for row in zip(batch["path"], batch["page_num"], batch["num_pages"], batch["image"], strict=True):
                queue.append(row)
                if len(queue) == batch_pages:
                    rows += flush(queue)
                    queue = []
                if len(rows) >= _PAGES_AT_ONCE:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
        if queue:
            rows += flush(queue)
        if rows:
            yield pd.DataFrame(rows, columns=names)

    return pages.select("path", "page_num", "num_pages", "image").mapInPandas(run, schema)


def ocr_jobs(files: DataFrame) -> DataFrame:
    """``pdf, dest_dir, stem`` of each file: its text goes to a directory of its own."""
    name = basename(F.col("path"))
    return files.select(F.col("path").alias("pdf"), F.substr("path", F.lit(1), F.length("path") - F.length(extension(name))).alias("dest_dir"), stem(name).alias("stem"), drop_of(F.col("path")).alias("drop"))


def as_texts(found: DataFrame, ext: str, text: str = "text") -> DataFrame:
    """``found(pdf, <text>)`` in the form of :func:`scan_texts`: each text's place is that of its PDF, in a directory of its own."""
    name = basename(F.col("pdf"))
    directory = F.substr("pdf", F.lit(1), F.length("pdf") - F.length(extension(name)))
    path = F.concat(directory, F.lit("/"), stem(name), F.lit("." + ext))
    return found.select(directory.alias("dir"), stem(name).alias("stem"), F.lit(ext).alias("ext"), path.alias("text_path"), F.col(text).alias("text"))


def write_texts(texts: DataFrame, folder: str) -> None:
    """Appends texts (``dir, stem, ext, text_path, text``) as a table by drop. The commit makes rows visible whole, so what is there is complete."""
    texts.select(*[f.name for f in schemas.TEXTS.fields]).withColumn("drop", drop_of(F.col("text_path"))).write.mode("append").partitionBy("drop").parquet(folder)


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """What :func:`write_texts` wrote, in the form of :func:`scan_texts`."""
    return spark.read.schema(schemas.TEXTS).parquet(folder).select(*[f.name for f in schemas.TEXTS.fields])


def checksummed(files: DataFrame) -> DataFrame:
    """``filename, sha256`` of ``files(path, content)``."""
    return files.select(basename(F.col("path")).alias("filename"), F.sha2("content", 256).alias("sha256"))
