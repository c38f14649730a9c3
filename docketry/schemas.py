"""Explicit schemas of everything that is read or written; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I = T.StringType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


FILES = _struct(("path", _S), ("sha256", _S))
TEXTS = _struct(("dir", _S), ("stem", _S), ("ext", _S), ("text_path", _S), ("text", _S))
DROPS = _struct(("drop", _S), ("custodian", _S), ("kind", _S), ("agency", _S), ("year", _I), ("url", _S), ("notes", _S), ("extra", T.MapType(_S, _S)))
EXCLUSIONS = _struct(("sha256", _S))
MANIFEST = _struct(("sha256", _S), ("filename", _S))
JOBS = _struct(("pdf", _S), ("dest_dir", _S), ("stem", _S))
PAGE = _struct(("page_num", _I), ("page_box", T.ArrayType(_I)), ("token_count", _I), ("num_chunks", _I), ("num_images", _I))
OCR_METADATA = _struct(("file_name", _S), ("num_pages", _I), ("total_token_count", _I), ("total_chunks", _I), ("total_images", _I), ("pages", T.ArrayType(PAGE)))
PORTAL_ITEM = _struct(("id", _S), ("properties", _struct(("title", _S), ("name", _S))))
CORPUS = _struct(
    ("filename", _S), ("custodian", _S), ("category", _S), ("date", _S), ("date_source", _S), ("original_filenames", T.ArrayType(_S)),
    ("original_path", _S), ("sha256sum", _S), ("fulltext", _S), ("name", _S), ("title", _S), ("agency", _S),
)
CORPUS_METADATA = _struct(("drops", T.ArrayType(_struct(("filename", _S), ("date", _S), ("custodian", _S), ("notes", _S), ("kind", _S), ("year", _I), ("url", _S), ("agency", _S)))))
INDEX_RECORD = _struct(
    ("url", _S), ("content", _S), ("language", _S), ("meta", T.MapType(_S, _S)), ("filters", T.MapType(_S, T.ArrayType(_S))), ("sort", T.MapType(_S, _S))
)
