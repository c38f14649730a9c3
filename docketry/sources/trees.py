"""Trees of files: a distributed listing as a Python data source, and their contents, digests and bytes read by the tasks."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_CHUNK = 1 << 20


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, given as a path or URI, and the folder's path in it."""
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    if "://" in folder:
        store, path = fs.FileSystem.from_uri(folder)
        return store, path.rstrip("/")
    return fs.LocalFileSystem(), folder.rstrip("/")


def _entries(store: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    """What lies in one folder, without names that begin with a dot."""
    return [e for e in store.get_file_info(fs.FileSelector(folder)) if not e.base_name.startswith(".")]


class _Subtrees(InputPartition):
    def __init__(self, folders: list[tuple[str, bool]]) -> None:
        self.folders = folders  # with whether what lies below is meant too


class _TreeReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.root, self.name, self.parts = options["root"], options.get("name", r"(?s).*"), int(options.get("parts", "64"))

    def partitions(self) -> list[InputPartition]:
        """Drops; where these are fewer than asked for, the folders in them, so that what is listed here is two levels at most."""
        store, top = opened(self.root)
        if store.get_file_info(top).type != fs.FileType.Directory:
            raise FileNotFoundError(f"{self.root} is no folder")
        whole, own = [e.path for e in _entries(store, top) if e.type == fs.FileType.Directory], [top]
        if 0 < len(whole) < self.parts:
            own += whole
            whole = [e.path for drop in whole for e in _entries(store, drop) if e.type == fs.FileType.Directory]
        folders = [(f, False) for f in own] + [(f, True) for f in whole]
        n = min(len(folders), max(self.parts, 4096))
        return [_Subtrees(folders[k::n]) for k in range(n)]

    def read(self, partition: _Subtrees) -> Iterator[pa.RecordBatch]:
        store, top = opened(self.root)
        wanted = re.compile(self.name)
        paths: list[str] = []
        sizes: list[int] = []
        for folder, below in partition.folders:
            left = [folder]
            while left:
                for entry in _entries(store, left.pop()):
                    if entry.type == fs.FileType.Directory:
                        if below:
                            left.append(entry.path)
                    elif wanted.fullmatch(entry.base_name):
                        paths.append(entry.path[len(top) :].lstrip("/"))
                        sizes.append(entry.size or 0)
                    if len(paths) == 4096:
                        yield _listed(paths, sizes)
                        paths, sizes = [], []
        yield _listed(paths, sizes)


def _listed(paths: list[str], sizes: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], ["path", "size"])


class FileTree(DataSource):
    """``path, size`` of the files below ``root`` whose whole name matches the expression ``name``; ``path`` is below the root."""

    @classmethod
    def name(cls) -> str:
        return "file_tree"

    def schema(self) -> str:
        return "path string, size long"

    def reader(self, schema) -> DataSourceReader:
        return _TreeReader(dict(self.options))


def file_tree(spark: SparkSession, root: str, name: str = r"(?s).*", parts: int | None = None) -> DataFrame:
    """``path, size`` of the files below a folder, listed by the tasks: one for each drop or, where drops are few, for each folder in them.

    The driver lists two levels of folders at most and sees no file. Empty files and names that begin with ``_`` are there; names that begin with a dot are not.
    """
    spark.dataSource.register(FileTree)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.read.format("file_tree").option("root", root).option("name", name).option("parts", str(parts)).load()


def dealt(files: DataFrame) -> DataFrame:
    """Rows that are little themselves but stand for much work, dealt evenly to tasks; planning by size would put them together."""
    return files.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def chunks(file, size: int = _CHUNK) -> Iterator[bytes]:
    while part := file.read(size):
        yield part


def read_contents(files: DataFrame, root: str, at_once: int = 1 << 24) -> DataFrame:
    """``files(path, ...)`` below a root with their ``content``; a row holds one file, a batch about ``at_once`` bytes of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = opened(root)
        paths: list[str] = []
        contents: list[bytes] = []
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with store.open_input_file(f"{top}/{path}") as file:
                    contents.append(file.read())
                paths.append(path)
                if sum(map(len, contents[-1:])) >= at_once or len(paths) == 256 or sum(map(len, contents)) >= at_once:
                    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])
                    paths, contents = [], []
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])

    return dealt(files.select("path")).mapInArrow(run, "path string, content binary")


def digests(files: DataFrame, root: str) -> DataFrame:
    """``path, sha256`` of ``files(path, ...)`` below a root, of any size: read in chunks, and no content becomes a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = opened(root)
        for batch in batches:
            paths, found = batch.column("path"), []
            for path in paths.to_pylist():
                digest = hashlib.sha256()
                with store.open_input_file(f"{top}/{path}") as file:
                    for part in chunks(file):
                        digest.update(part)
                found.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([paths, pa.array(found, pa.string())], ["path", "sha256"])

    return dealt(files.select("path")).mapInArrow(run, "path string, sha256 string")


def with_text(files: DataFrame, root: str) -> DataFrame:
    """``path, text`` of ``files(path, ...)`` below a root; an empty file is an empty text."""
    return read_contents(files, root).select("path", F.col("content").cast("string").alias("text"))
