"""Writers of whole files and of links, as data source writers: a task stages each file under a name of its own attempt, then renames it.

So of two attempts of a task, or one that is killed, a reader sees whole files only; what attempts leave staged goes when the job commits or aborts.
"""

from __future__ import annotations

import contextlib
import os
import posixpath
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from docketry.sources.trees import opened

_STAGING = ".staged"


def _checked(path: str) -> str:
    """A path that stays below its folder."""
    if path.startswith("/") or ".." in path.split("/") or not path.strip("/"):
        raise ValueError(f"{path!r} does not lie below the folder")
    return path


@contextlib.contextmanager
def staged(folder: str, job: str = "") -> Iterator[Callable[[str, Iterator[bytes]], None]]:
    """Gives a function that writes a file below the folder from chunks; it has its name once the chunks have ended well."""
    store, top = opened(folder)
    own = f"{top}/{_STAGING}{job}/{uuid.uuid4().hex}"
    made: set[str] = set()
    store.create_dir(own, recursive=True)

    def place(path: str, parts: Iterator[bytes]) -> None:
        target = f"{top}/{_checked(path)}"
        if (parent := posixpath.dirname(target)) not in made:
            store.create_dir(parent, recursive=True)
            made.add(parent)
        with store.open_output_stream(f"{own}/file") as file:
            for part in parts:
                file.write(part)
        store.move(f"{own}/file", target)

    try:
        yield place
    finally:
        with contextlib.suppress(OSError):
            store.delete_dir(own)
        with contextlib.suppress(OSError):
            if not job and not store.get_file_info(fs.FileSelector(posixpath.dirname(own))):
                store.delete_dir(posixpath.dirname(own))


class _Writer(DataSourceArrowWriter):
    """What both writers share: a staging folder of the job, removed when it ends."""

    def __init__(self, options: dict[str, str]) -> None:
        self.options, self.folder, self.job = options, options["folder"], f"-{uuid.uuid4().hex}"

    def _cleared(self) -> None:
        store, top = opened(self.folder)
        with contextlib.suppress(OSError):
            store.delete_dir(f"{top}/{_STAGING}{self.job}")

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        self._cleared()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._cleared()


class _FileWriter(_Writer):
    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        with staged(self.folder, self.job) as place:
            for batch in iterator:
                for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                    place(path.as_py(), iter([content.as_py() or b""]))
        return WriterCommitMessage()


class _LinkWriter(_Writer):
    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        _, top = opened(self.folder)
        _, pdfs = opened(self.options["files"])
        own = f"{top}/{_STAGING}{self.job}/{uuid.uuid4().hex}"
        os.makedirs(own, exist_ok=True)
        for batch in iterator:
            for name, target, action in zip(*(batch.column(c).to_pylist() for c in ("name", "target", "action")), strict=True):
                path = os.path.join(top, _checked(name))
                if action == "remove":
                    with contextlib.suppress(FileNotFoundError):
                        os.remove(path)
                else:
                    os.link(os.path.join(pdfs, target), f"{own}/link")
                    os.replace(f"{own}/link", path)  # the old link is there until the new one is
                    with contextlib.suppress(FileNotFoundError):
                        os.remove(f"{own}/link")  # where both were links of one file, renaming does nothing
        return WriterCommitMessage()


class WholeFiles(DataSource):
    """Rows ``path, content`` become files below the option ``folder``."""

    @classmethod
    def name(cls) -> str:
        return "whole_files"

    def schema(self) -> str:
        return "path string, content binary"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _FileWriter(dict(self.options))


class Links(DataSource):
    """Rows ``name, target, action`` make (``link``) or drop (``remove``) hard links in the option ``folder`` to what lies below the option ``files``."""

    @classmethod
    def name(cls) -> str:
        return "hard_links"

    def schema(self) -> str:
        return "name string, target string, action string"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _LinkWriter(dict(self.options))


def write_files(files: DataFrame, folder: str) -> None:
    """Writes ``files(path, content)`` as files below a folder that the tasks reach. A file has its name only once it is whole."""
    files.sparkSession.dataSource.register(WholeFiles)
    store, top = opened(folder)
    store.create_dir(top, recursive=True)
    files.select("path", F.col("content").cast("binary").alias("content")).write.format("whole_files").option("folder", folder).mode("append").save()


def write_links(plan: DataFrame, files: str, folder: str) -> None:
    """Carries out the links and removals of ``plan(name, target, action)`` by the tasks, which mount both folders."""
    plan.sparkSession.dataSource.register(Links)
    rows = plan.where("action in ('link', 'remove')").select("name", "target", "action")
    rows.write.format("hard_links").option("folder", folder).option("files", files).mode("append").save()
