"""Interleaved document sequences: text and media in reading order, with payloads found by digest.

HTML is parsed to an ordered array of items; a media item holds a reference (``sha256:`` and the payload's digest), its
caption and its position. Payloads live in a media table, one row for each digest, as grey-scale images of one byte
a sample (binary PGM, 64 samples a row). Sequences meet payloads, or what was computed from them, by a join on the digest;
positions travel with the items, so order and captions stay aligned.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm._shared import slices
from docketry.operators.durable import checkpointed, delete, shared_folder

ROW = 64
ITEM = "struct<position:int,kind:string,text:string,ref:string,caption:string>"
_ITEM_ARROW = pa.list_(pa.struct([("position", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("ref", pa.string()), ("caption", pa.string())]))
_MEDIA_TAGS = {"img": "image", "video": "video", "audio": "audio", "source": "media"}
_SILENT = {"script", "style", "template", "noscript", "title", "head"}
_BREAKS = {"p", "div", "br", "li", "ul", "ol", "tr", "table", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section", "figure", "blockquote", "nav", "hr", "pre"}


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.items: list[dict] = []
        self.words: list[str] = []
        self.caption: list[str] | None = None
        self.figure: list[int] = []
        self.inside_figure = self.silent = 0

    def flush(self) -> None:
        if text := " ".join("".join(self.words).split()):
            self.items.append({"kind": "text", "text": text, "ref": None, "caption": None})
        self.words.clear()

    def handle_starttag(self, tag, attrs):
        if tag in _SILENT:
            self.silent += tag != "head"
        if tag in _BREAKS:
            self.flush()
        if tag == "figure":
            self.inside_figure += 1
            self.figure = []
        if tag == "figcaption":
            self.flush()
            self.caption = []
        own = dict(attrs)
        if tag in _MEDIA_TAGS and own.get("src"):
            self.flush()
            if self.inside_figure:
                self.figure.append(len(self.items))
            self.items.append({"kind": _MEDIA_TAGS[tag], "text": None, "ref": own["src"], "caption": own.get("alt") or own.get("title")})

    def handle_endtag(self, tag):
        if tag in _SILENT and tag != "head" and self.silent:
            self.silent -= 1
        if tag == "figcaption" and self.caption is not None:
            text = " ".join("".join(self.caption).split())
            for k in self.figure:
                self.items[k]["caption"] = text or self.items[k]["caption"]
            if text and not self.figure:
                self.items.append({"kind": "text", "text": text, "ref": None, "caption": None})
            self.caption = None
        if tag in _BREAKS:
            self.flush()
        if tag == "figure" and self.inside_figure:
            self.inside_figure -= 1

    def handle_data(self, data):
        if not self.silent:
            (self.words if self.caption is None else self.caption).append(data)


def parse(html: str | None) -> list[dict]:
    """The ordered items of an HTML text: runs of text and media references with captions; null gives none."""
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    reader.flush()
    return [{"position": k, **item} for k, item in enumerate(reader.items)]


def sequences(pages: DataFrame, id_column: str = "page_id", html_column: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id, items`` and the kept columns for each row: the parsed sequence. Repeated rows are parsed each; other columns are ignored; an empty table gives no rows."""
    rows = pages.select(F.col(id_column).cast("long").alias("id"), F.col(html_column).cast("string").alias("_html"), *keep)
    kept = "".join(f", {f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[2:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            items = [parse(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(items, _ITEM_ARROW), *batch.columns[2:]], ["id", "items", *keep])

    return rows.mapInArrow(run, f"id long, items array<{ITEM}>{kept}")


def resolve(sequences_: DataFrame, media: DataFrame) -> DataFrame:
    """``id, position, kind, text, caption, ref`` and the media table's columns, one row for each item.

    ``media`` has one row for each ``digest``. A reference that is no ``sha256:`` digest, or one without a payload, stays as an
    item with null media columns. A digest that very many items refer to is split by adaptive execution where ``media`` is a written table.
    Empty sequences and empty tables give no rows. Further columns of the sequences stay.
    """
    more = [c for c in sequences_.columns if c not in ("id", "items")]
    items = sequences_.select("id", F.explode("items").alias("item"), *more).select("id", "item.*", *more)
    items = items.withColumn("_digest", F.nullif(F.regexp_extract("ref", "^sha256:([0-9a-f]{64})$", 1), F.lit("")))
    return items.join(media, F.col("_digest") == media["digest"], "left").drop("_digest")


def padded(text: Column) -> Column:
    """A text's UTF-8 bytes and then zeros, up to a positive multiple of a row."""
    data = F.coalesce(text.cast("string"), F.lit("")).cast("binary")
    n = F.octet_length(data)
    fill = F.greatest(F.ceil(n / ROW), F.lit(1)) * ROW - n
    return F.concat(data, F.unhex(F.repeat(F.lit("00"), fill.cast("int"))))


def to_media(payload: bytes) -> bytes:
    """A payload of whole rows as a binary grey-scale image."""
    return b"P5\n%d %d\n255\n" % (ROW, len(payload) // ROW) + payload


def from_media(media: bytes) -> memoryview:
    """The samples of a stored image, by its header."""
    head = re.match(rb"P5\s(\d+)\s(\d+)\s255\s", media[:64])
    if not head or len(media) != head.end() + int(head[1]) * int(head[2]):
        raise ValueError("not a binary grey-scale image of one byte a sample")
    return memoryview(media)[head.end() :]


def features(samples: memoryview) -> str:
    """Mean, deviation, entropy, a histogram of 16 levels in tenths of a percent, and a 64-bit average hash."""
    values = np.frombuffer(samples, np.uint8)
    counts = np.bincount(values, minlength=256)
    share = counts[counts > 0] / len(values)
    levels = np.arange(256)
    mean = float(counts @ levels) / len(values)
    deviation = max(0.0, float(counts @ (levels * levels)) / len(values) - mean * mean) ** 0.5
    histogram = np.rint(counts.reshape(16, 16).sum(1) * 1000 / len(values)).astype(int).tolist()
    cells = values.reshape(ROW, -1).mean(1)
    bits = int("".join("1" if c > mean else "0" for c in cells.tolist()), 2)
    return f"mean={mean:.4f};sd={deviation:.4f};entropy={float(-(share * np.log2(share)).sum()):.4f};hist={','.join(map(str, histogram))};ahash={bits:016x}"


_FACTS = {"digest": "string", "payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long", "media_sha256": "string", "feature": "string"}


def store_media(payloads: DataFrame, folder: str, remembered: int = 100_000) -> DataFrame:
    """The media table ``digest, media`` of ``payloads(digest, payload)``, written to a folder and read back from there.

    Each payload is put into its stored form where it lies: payloads are not shuffled. A task writes a digest once (as long as it is among
    the ``remembered`` last ones), so a digest that lies in several tasks has several equal rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[str] = set()
        for batch in slices(batches):
            digests, media = [], []
            for digest, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if digest not in met:
                    if len(met) >= remembered:
                        met.clear()
                    met.add(digest)
                    digests.append(digest)
                    media.append(to_media(payload.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.string()), pa.array(media, pa.binary())], ["digest", "media"])

    stored = payloads.select("digest", "payload").mapInArrow(run, "digest string, media binary")
    stored.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    return payloads.sparkSession.read.schema("digest string, media binary").parquet(folder)


def media_facts(media: DataFrame) -> DataFrame:
    """Facts of the samples read back from a media table, one row for each digest.

    Only facts move. Equal rows of a digest are one after partial aggregation, mostly before the shuffle. The facts are written as a table,
    from which a join with references can split a digest that very many of them have.
    """
    kinds = [{"string": pa.string(), "long": pa.int64()}[kind] for kind in _FACTS.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for digest, stored in zip(batch.column(0), batch.column(1), strict=True):
                held = stored.as_py()
                back = from_media(held)
                rows.append((digest.as_py(), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-ROW:]), len(held), hashlib.sha256(held).hexdigest(), features(back)))
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], list(_FACTS))

    found = media.select("digest", "media").mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in _FACTS.items()))
    facts = F.max(F.struct(*list(_FACTS)[1:])).alias("facts")
    return checkpointed(found.groupBy("digest").agg(facts).select("digest", "facts.*"))


def as_page(text: Column, digest: Column, caption: Column) -> Column:
    """A text as an HTML page: its lines are paragraphs, and after the first one stands the figure of its payload, with a caption."""
    escaped = F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    figure = F.concat(F.lit('<figure><img src="sha256:'), digest, F.lit('"><figcaption>'), caption, F.lit("</figcaption></figure>"))
    first, rest = F.substring_index(escaped, "\n", 1), F.replace(escaped, F.lit("\n"), F.lit("</p><p>"))
    return F.concat(F.lit("<article><p>"), first, F.lit("</p>"), figure, F.lit("<p>"), F.substr(rest, F.length(first) + 1), F.lit("</p></article>"))


def document_media(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, position, n_items, caption`` for each row.

    Each document is a page of its lines with a figure after the first, which refers to the document's payload by digest. The payloads go
    to a media table in ``folder`` (by default one in the shared folder that is removed when its facts are written); the parsed sequence's
    media item, with its position among the ``n_items`` items and its caption, meets what is read back from there by the digest. Null and empty texts have a
    payload of one row of zeros; repeated rows and equal texts share a payload and its facts; an empty table gives no rows; other
    columns of ``docs(doc_id, text)`` are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("_text"), padded(F.col("text")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    where = folder or f"{shared_folder(spark)}/media-{uuid.uuid4().hex}"
    facts = media_facts(store_media(rows, where))
    if folder is None:
        delete(spark, where)
    caption = F.concat(F.lit("document "), F.coalesce(F.col("doc_id").cast("string"), F.lit("without a number")))
    pages = rows.select("doc_id", as_page(F.col("_text"), F.col("digest"), caption).alias("html"), F.octet_length("_text").cast("long").alias("n_bytes"))
    parsed = sequences(pages, "doc_id", "html", ("n_bytes",))
    references = parsed.select("id", F.filter("items", lambda x: x["ref"].isNotNull()).alias("items"), "n_bytes", F.size("items").cast("long").alias("n_items"))  # texts end here
    found = resolve(references, facts)
    return found.select(F.col("id").alias("doc_id"), "n_bytes", *list(_FACTS)[1:], "position", "n_items", "caption")
