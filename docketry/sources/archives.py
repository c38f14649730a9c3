"""Zip archives: members are listed from the central directory by range reads, dealt to tasks one by one, and read as streams."""

from __future__ import annotations

import bz2
import hashlib
import struct
import zipfile
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.sources.trees import dealt, file_tree, opened
from docketry.sources.writers import staged

_MEMBER = "zip string, drop string, path string, at long, packed long, size long, method int, crc long, flags int"
_HEADER = struct.Struct("<4s5H3L2H")


def zip_members(spark: SparkSession, zips: str) -> DataFrame:
    """One row for each file in the zips of a folder: its ``zip``, ``drop``, ``path`` and where its bytes lie. No member is read.

    A central directory is read by one task, from the end of its zip; names are read as UTF-8 where the zip says so.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = opened(zips)
        for batch in batches:
            for name in batch.column("path").to_pylist():
                drop = name.removesuffix(".zip")
                with store.open_input_file(f"{top}/{name}") as file, zipfile.ZipFile(file) as archive:
                    rows = [
                        {"zip": name, "drop": drop, "path": f"{drop}/{e.filename}", "at": e.header_offset, "packed": e.compress_size, "size": e.file_size, "method": e.compress_type, "crc": e.CRC, "flags": e.flag_bits}
                        for e in archive.infolist()
                        if not e.is_dir()
                    ]
                for k in range(0, len(rows), 4096):
                    yield pa.RecordBatch.from_pylist(rows[k : k + 4096], schema)

    schema = pa.schema([(n, pa.string()) for n in ("zip", "drop", "path")] + [(n, pa.int64()) for n in ("at", "packed", "size")] + [("method", pa.int32()), ("crc", pa.int64()), ("flags", pa.int32())])
    found = file_tree(spark, zips, r"(?s).*\.zip").where(~F.col("path").contains("/"))
    return dealt(found.select("path")).mapInArrow(run, _MEMBER)


def member_stream(file: BinaryIO, at: int, packed: int, size: int, method: int, crc: int, flags: int) -> Iterator[bytes]:
    """The bytes of a member in chunks, from an open zip. Raises ``BadZipFile`` unless length and checksum are right at the end."""
    if flags & 1:
        raise zipfile.BadZipFile("the member is encrypted")
    file.seek(at)
    head = _HEADER.unpack(file.read(_HEADER.size))
    if head[0] != b"PK\x03\x04":
        raise zipfile.BadZipFile("there is no member where the directory says")
    file.seek(at + _HEADER.size + head[-2] + head[-1])
    if method == zipfile.ZIP_STORED:
        unpack = None
    elif method == zipfile.ZIP_DEFLATED:
        unpack = zlib.decompressobj(-zlib.MAX_WBITS)
    elif method == zipfile.ZIP_BZIP2:
        unpack = bz2.BZ2Decompressor()
    else:
        raise zipfile.BadZipFile(f"compression {method} is not read")
    left, n, check = packed, 0, 0
    while left:
        part = file.read(min(left, 1 << 18))
        if not part:
            raise zipfile.BadZipFile("the zip ends within a member")
        left -= len(part)
        for out in [part] if unpack is None else _unpacked(unpack, part):
            n, check = n + len(out), zlib.crc32(out, check)
            yield out
    if (n, check) != (size, crc):
        raise zipfile.BadZipFile("a member's length or checksum is wrong")


def _unpacked(unpack, part: bytes, most: int = 1 << 20) -> Iterator[bytes]:
    """What so many bytes unpack to, a bounded piece at a time."""
    if hasattr(unpack, "unconsumed_tail"):
        while part:
            if out := unpack.decompress(part, most):
                yield out
            part = unpack.unconsumed_tail
            if unpack.eof:
                return
    else:
        while not unpack.eof:
            if out := unpack.decompress(part, most):
                yield out
            part = b""
            if unpack.needs_input:
                return


def _each(batches: Iterator[pa.RecordBatch], zips: str) -> Iterator[tuple[dict, Iterator[bytes]]]:
    """Members with their streams; a zip stays open while its members follow one another."""
    store, top = opened(zips)
    name, file = None, None
    try:
        for batch in batches:
            for row in batch.to_pylist():
                if row["zip"] != name:
                    if file:
                        file.close()
                    name, file = row["zip"], store.open_input_file(f"{top}/{row['zip']}")
                yield row, member_stream(file, *(row[k] for k in ("at", "packed", "size", "method", "crc", "flags")))
    finally:
        if file:
            file.close()


def unzip(spark: SparkSession, zips: str) -> DataFrame:
    """``drop, path, content`` of the files in drop zips. A member is one row, so it must fit into one; :func:`extract` takes any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, stream in _each(batches, zips):
            yield pa.RecordBatch.from_arrays([pa.array([row["drop"]]), pa.array([row["path"]]), pa.array([b"".join(stream)], pa.binary())], ["drop", "path", "content"])

    return dealt(zip_members(spark, zips)).mapInArrow(run, "drop string, path string, content binary")


def member_digests(spark: SparkSession, zips: str) -> DataFrame:
    """``drop, path, size, sha256`` of the files in drop zips, of any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, stream in _each(batches, zips):
            digest = hashlib.sha256()
            for part in stream:
                digest.update(part)
            yield pa.RecordBatch.from_arrays([pa.array([row["drop"]]), pa.array([row["path"]]), pa.array([row["size"]], pa.int64()), pa.array([digest.hexdigest()])], ["drop", "path", "size", "sha256"])

    return dealt(zip_members(spark, zips)).mapInArrow(run, "drop string, path string, size long, sha256 string")


def extract(spark: SparkSession, zips: str, folder: str) -> DataFrame:
    """Writes the files in drop zips below a folder, as streams, and gives ``drop, path, size, sha256`` of what was written as a table made once.

    A file has its name only once it is whole and its checksum is right; an attempt that ends early leaves nothing under a file's name.
    """
    from docketry.operators.durable import checkpointed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with staged(folder) as place:
            for row, stream in _each(batches, zips):
                digest = hashlib.sha256()

                def hashed(stream: Iterator[bytes] = stream, digest=digest) -> Iterator[bytes]:
                    for part in stream:
                        digest.update(part)
                        yield part

                place(row["path"], hashed())
                yield pa.RecordBatch.from_arrays([pa.array([row["drop"]]), pa.array([row["path"]]), pa.array([row["size"]], pa.int64()), pa.array([digest.hexdigest()])], ["drop", "path", "size", "sha256"])

    return checkpointed(dealt(zip_members(spark, zips)).mapInArrow(run, "drop string, path string, size long, sha256 string"))


