"""Small formatting expressions of the published site."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketry.functions.text import strip


def delimit(number: Column) -> Column:
    """The trailing run of digits of a number's text grouped by thousands with commas."""
    return F.regexp_replace(number.cast("string"), r"(?<=\d)(?=(?:\d{3})+\z)", ",")


def slugify(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", "-"), r"^-+|-+\z", "")


def drop_url(url: Column, drops_url: str, filename: Column) -> Column:
    """A drop's own address, or its place below ``drops_url`` if it has none (or an empty one)."""
    return F.coalesce(F.nullif(url, F.lit("")), F.concat(F.lit(drops_url.rstrip("/") + "/"), F.url_encode(filename)))


def file_url(base: str, filename: Column) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), filename)


def page_links(current: Column, total: Column, around: int = 2) -> Column:
    """The page numbers shown on a page (array of int): the first, the last and ``around`` on either side of it; null stands for a gap."""
    near = F.array(F.lit(1), total, *[current + k for k in range(-around, around + 1)])
    numbers = F.array_sort(F.array_distinct(F.filter(F.transform(near, lambda n: n.cast("int")), lambda n: n.between(1, total))))
    return F.flatten(F.transform(numbers, lambda n, i: F.when((i > 0) & (n - F.try_element_at(numbers, i) > 1), F.array(F.lit(None).cast("int"), n)).otherwise(F.array(n))))


def portal_path(title: Column, name: Column) -> Column:
    """Where a portal item is filed: by year with its day and name if the title has them in either form, else ``undated/``.

    Titles read ``... YYYY/MM/DD - Name`` or ``... YYYYMMDD-Last-First``; dashes inside the first name become blanks.
    """
    title = strip(title)
    slashed = [F.regexp_extract(title, r"(\d{4})/(\d{2})/(\d{2})\s*-\s*(.+)\z", g) for g in range(1, 5)]
    compact = [F.regexp_extract(title, r"(\d{4})(\d{2})(\d{2})-([^-]+)-(.+)\z", g) for g in range(1, 6)]

    def path(year: Column, month: Column, day: Column, who: Column) -> Column:
        return F.concat(year, F.lit("/"), year, F.lit("-"), month, F.lit("-"), day, F.lit(" "), F.replace(strip(who), F.lit("/"), F.lit("")), F.lit(".pdf"))

    first_last = F.concat(F.replace(compact[4], F.lit("-"), F.lit(" ")), F.lit(" "), compact[3])
    return (
        F.when(slashed[0] != "", path(*slashed))
        .when(compact[0] != "", path(*compact[:3], first_last))
        .otherwise(F.concat(F.lit("undated/"), name))
    )
