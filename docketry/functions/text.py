"""Text normalisation as column expressions: markup to words, white space, line keys, file names."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Tags that end a line, and tags that separate cells.
LINE_TAGS = "p|br|div|tr|table|thead|tbody|h\\d|li|ul|ol"
CELL_TAGS = "td|th"
# The entities that are decoded; all other names are left as they stand.
ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}

#: What stripping removes at either end: NUL, tab, line feed, vertical tab, form feed, carriage return, blank.
_EDGE = r"[\x00\t\n\x0B\f\r ]+"
_ENTITY = r"&(?:amp|lt|gt|quot|apos|#0*[0-9]{1,7}|#[xX]0*[0-9A-Fa-f]{1,6});"


def strip(text: Column) -> Column:
    """Without white space and NULs at both ends."""
    return F.regexp_replace(F.regexp_replace(text, f"^{_EDGE}", ""), f"{_EDGE}\\z", "")


def strip_tags(html: Column) -> Column:
    """Markup to blanks and line ends: comments, line tags, unclosed line tags, cell tags, all other tags, in this order."""
    steps = (
        (r"(?s)<!--.*?-->", " "),
        (rf"(?i)</?(?:{LINE_TAGS})\b[^>]*>", "\n"),
        (r"(?i)<(?:br|hr)\b/?(?!>)", "\n"),
        (rf"(?i)</?(?:{CELL_TAGS})\b[^>]*>", " "),
        (r"<[^>]+>", " "),
    )
    for pattern, to in steps:
        html = F.regexp_replace(html, pattern, to)
    return html


def unescape_html(text: Column) -> Column:
    """Named (five) and numeric entities decoded in a single pass, so that what they stand for is not decoded again."""
    found = F.regexp_extract_all(text, F.lit(f"({_ENTITY})"), F.lit(1))
    between = F.split(text, _ENTITY, -1)

    def decoded(entity: Column) -> Column:
        decimal = F.regexp_extract(entity, r"^&#0*([0-9]+);$", 1)
        sixteen = F.regexp_extract(entity, r"^&#[xX]0*([0-9A-Fa-f]+);$", 1)
        point = F.when(decimal != "", F.conv(decimal, 10, 16)).when(sixteen != "", F.upper(sixteen))
        padded = F.lpad(point, 8, "0")
        valid = (padded < "00110000") & ~padded.between("0000D800", "0000DFFF")
        out = F.when(point.isNotNull() & valid, F.decode(F.unhex(F.when(valid, padded).otherwise("00000020")), "UTF-32"))
        for name, to in ENTITIES.items():
            out = F.when(entity == f"&{name};", to).otherwise(out)
        return F.coalesce(out, entity)

    return F.array_join(F.zip_with(between, F.concat(F.transform(found, decoded), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")


def squeeze_whitespace(text: Column) -> Column:
    """Blanks, tabs and no-break spaces to one blank, lines stripped, at most one empty line in a row."""
    text = F.regexp_replace(text, "[ \t\u00a0]+", " ")
    text = F.regexp_replace(text, r"(?dm)^[\x00\t\x0B\f\r ]+|[\x00\t\x0B\f\r ]+$", "")
    return strip(F.regexp_replace(text, r"\n{3,}", "\n\n"))


def plain_text(markdown: Column) -> Column:
    """Markdown with embedded HTML to words: tags, entities, tags again, then headings, bold, images and links."""
    text = strip_tags(unescape_html(strip_tags(markdown)))
    steps = (
        (r"(?dm)^\s{0,3}#+\s+", ""),
        (r"(?s)(\*\*|__)(.+?)\1", "$2"),
        (r"\\?\*{2,}", ""),
        (r"!\[[^\]]*\]\([^)]*\)", " "),
        (r"\[([^\]]*)\]\([^)]*\)", "$1"),
    )
    for pattern, to in steps:
        text = F.regexp_replace(text, pattern, to)
    return squeeze_whitespace(text)


def fulltext(text: Column, extension: Column) -> Column:
    """``md`` is reduced to words; any other text only has its white space squeezed."""
    return F.when(extension == "md", plain_text(text)).otherwise(squeeze_whitespace(text))


def line_key(line: Column) -> Column:
    """A line as it is compared: white space runs as one blank, none at the ends."""
    return strip(F.regexp_replace(line, r"\s+", " "))


def edges(pattern: str) -> str:
    """The pattern with each word boundary spelt out by Unicode letters, digits and ``_``: what ``\\b`` takes for a letter differs by version of Java.

    A boundary that begins a pattern, a group or an alternative stands before a word, any other after one.
    """
    word = r"[\p{L}\p{N}_]"

    def spelt(found: re.Match) -> str:
        begins = re.search(r"(?:^|\||\((?:\?[a-z]*:|\?[a-z]+\))?)\Z", pattern[: found.start()])
        return f"(?<!{word})" if begins else f"(?!{word})"

    return re.sub(r"\\b", spelt, pattern)


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(name: Column) -> Column:
    """A file name without its last extension; a leading dot begins no extension."""
    return F.regexp_extract(name, r"(?s)^(.+?)(?:\.[^.]*)?$", 1)


def extension(name: Column) -> Column:
    """The last extension with its dot, or empty."""
    return F.regexp_extract(name, r"(?s)^.+?(\.[^.]+)$", 1)


def drop_of(relative_path: Column) -> Column:
    """The first directory of a path."""
    return F.element_at(F.split(relative_path, "/"), 1)


def relative_path(path: Column, root: str) -> Column:
    """A path without the root directory before it."""
    prefix = root.rstrip("/") + "/"
    return F.when(path.startswith(prefix), F.substr(path, F.lit(len(prefix) + 1))).otherwise(path)


def longest(names: Column) -> Column:
    """The first of the longest strings of an array; null for an empty one."""
    longer = lambda n, best: best.isNull() | (F.length(n) > F.length(best))
    return F.reduce(names, F.lit(None).cast("string"), lambda best, n: F.when(longer(n, best), n).otherwise(best))


@F.pandas_udf(StringType())
def without_marks(text: pd.Series) -> pd.Series:
    """Letters without their combining marks (canonical decomposition has no SQL function)."""
    return text.map(lambda s: s if s is None or s.isascii() else "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn"))


def safe_stem(name: Column) -> Column:
    """A file name's stem reduced to ASCII letters, digits, ``_`` and ``-``; ``document`` if nothing is left."""
    out = without_marks(stem(name))
    for pattern, to in ((r"[\s.]+", "_"), (r"[^A-Za-z0-9_-]", ""), (r"_{2,}", "_"), (r"^[_-]+", ""), (r"_\z", "")):
        out = F.regexp_replace(out, pattern, to)
    return F.when(out == "", "document").otherwise(out)


def safe_name(names: Column) -> Column:
    """Struct (stem, ext) of the longest of a document's file names."""
    name = longest(names)
    return F.struct(safe_stem(name).alias("stem"), F.lower(extension(name)).alias("ext"))
