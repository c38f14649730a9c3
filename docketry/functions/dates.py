"""When a document was filed, as text of whatever precision there is: a day, a month or a year."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketry.functions.bind import let
from docketry.functions.text import edges, stem

# Month abbreviations in order, full names, and a further usual abbreviation.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
MONTH_NAMES = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
SEPT = "sept"
# Years that dates may have, the first plausible year of a name, and how far a stamp may be from its folder.
FIRST_YEAR, LAST_YEAR = 1990, 2099
FIRST_PLAUSIBLE_YEAR = 2000
STAMP_YEARS = 1

_ANY_MONTH = f"(?:{'|'.join(MONTHS)})[a-z]*"
ISO_DAY = r"\b((?:19|20)\d{2})[-.](\d{1,2})[-.](\d{1,2})\b"
US_DAY = r"\b(\d{1,2})[./-](\d{1,2})[./-](\d{2,4})\b"
NAMED_MONTH = rf"(?iu)(?<!\d)(20\d{{2}})[ _.,-]+({'|'.join((*MONTH_NAMES, *MONTHS, SEPT))})(?![a-z])"
NAMED_YEAR = r"(?<!\d)(20\d{2})(?!\d)"
STAMP = rf"(?iu)\b((?:19|20)\d{{2}})[ \t]+({_ANY_MONTH})[ \t]*-?[ \t]*(\d{{1,2}})[ \t]*[AP]M"
FOLDER_YEAR = r"/((?:19|20)\d{2})/"
FOLDER_MONTH = rf"/(?:\d{{1,2}}[ \t]+)?((?iu:{_ANY_MONTH}))[ \t]+((?:19|20)\d{{2}})"


def month_number(name: Column) -> Column:
    """1 to 12 from a name's first three letters; null for none."""
    return F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(name, 1, 3))).cast("int"), F.lit(0))


def calendar_day(year: Column, month: Column, day: Column) -> Column:
    """A date from digits, or null if there is no such day or its year is out of range.

    Years of at most two digits below 50 are of this century, others of the last one.
    """
    y = year.try_cast("int")
    y = y + F.when(F.length(year) > 2, 0).when(y < 50, 2000).otherwise(1900)
    made = F.try_to_date(F.format_string("%04d-%02d-%02d", y, month.cast("int"), day.cast("int")), "yyyy-MM-dd")
    return F.when(y.between(FIRST_YEAR, LAST_YEAR), made)


def _everywhere(text: Column, pattern: str, order: tuple[int, int, int]) -> Column:
    """Days read at every place where the pattern matches, overlapping ones too."""
    groups = [F.regexp_extract_all(text, F.lit(f"(?={edges(pattern)})"), F.lit(g)) for g in order]
    return F.transform(F.arrays_zip(*[g.alias(n) for g, n in zip(groups, "ymd", strict=True)]), lambda m: calendar_day(m["y"], m["m"], m["d"]))


def candidates(name: Column) -> Column:
    """All days a name (without extension) could be read as: ISO readings, then American ones."""
    found = F.concat(_everywhere(name, ISO_DAY, (1, 2, 3)), _everywhere(name, US_DAY, (3, 1, 2)))
    return F.filter(found, lambda d: d.isNotNull())


def stamp_date(text: Column) -> Column:
    """The day of the first received stamp; null if there is none or it is no day."""
    part = [F.regexp_extract(text, edges(STAMP), g) for g in (1, 2, 3)]
    return F.when(part[0] != "", calendar_day(part[0], month_number(part[1]).cast("string"), part[2]))


def folder(path: Column) -> Column:
    """Struct (year, month) of the first directory or name that names a month, or else of a year directory."""
    month, month_year, year = F.regexp_extract(path, FOLDER_MONTH, 1), F.regexp_extract(path, FOLDER_MONTH, 2), F.regexp_extract(path, FOLDER_YEAR, 1)
    whole = F.when(month_year != "", month_year).when(year != "", year).try_cast("int")
    return F.struct(whole.alias("year"), F.when(month_year != "", month_number(month)).alias("month"))


def filename_date(names: Column, year: Column, month: Column, stamp: Column) -> Column:
    """The reading nearest the stamp, else the earliest, of those in the folder's year and, if any is, in its month."""
    days = F.array_distinct(F.flatten(F.transform(names, lambda n: candidates(stem(n)))))
    in_year = F.filter(days, lambda d: year.isNull() | (F.year(d) == year))

    def nearest(days: Column) -> Column:
        return F.array_min(F.transform(days, lambda d: F.struct(F.coalesce(F.abs(F.datediff(d, stamp)), F.lit(0)).alias("far"), d.alias("day"))))["day"]

    def in_month(days: Column) -> Column:
        return F.when(F.exists(days, lambda d: F.month(d) == month), F.filter(days, lambda d: F.month(d) == month)).otherwise(days)

    return let(let(in_year, in_month), nearest)


def plausible(year: Column, as_of_year: Column) -> Column:
    return year.between(F.lit(FIRST_PLAUSIBLE_YEAR), as_of_year)


def filename_month(names: Column, year: Column, as_of_year: Column) -> Column:
    """Struct (year, month) of the first plausible month in words that agrees with the folder's year; null for none."""

    def months(name: Column) -> Column:
        found = F.arrays_zip(*[F.regexp_extract_all(stem(name), F.lit(NAMED_MONTH), F.lit(g)).alias(n) for g, n in ((1, "y"), (2, "m"))])
        return F.transform(found, lambda m: F.struct(m["y"].cast("int").alias("year"), month_number(m["m"]).alias("month")))

    every = F.flatten(F.transform(names, months))
    fits = F.filter(every, lambda m: plausible(m["year"], as_of_year) & (year.isNull() | (m["year"] == year)))
    return F.get(fits, F.lit(0))


def filename_year(names: Column, as_of_year: Column) -> Column:
    every = F.flatten(F.transform(names, lambda n: F.transform(F.regexp_extract_all(stem(n), F.lit(NAMED_YEAR), F.lit(1)), lambda y: y.cast("int"))))
    return F.get(F.filter(every, lambda y: plausible(y, as_of_year)), F.lit(0))


def filing(names: Column, path: Column, text: Column, as_of_year: Column) -> Column:
    """Struct (date, date_source): the first of file name day, received stamp, named month, folder month, folder year, named year."""

    def out(date: Column, source: str) -> Column:
        return F.struct(date.cast("string").alias("date"), F.lit(source).alias("date_source"))

    def told(place: Column, stamp: Column, day: Column) -> Column:
        year, month = place["year"], place["month"]
        near = stamp.isNotNull() & (year.isNull() | (F.abs(F.year(stamp) - year) <= STAMP_YEARS))

        def by_folder(named: Column) -> Column:
            bare = filename_year(names, as_of_year)
            return (
                F.when(named.isNotNull(), out(F.format_string("%04d-%02d", named["year"], named["month"]), "filename"))
                .when(month.isNotNull(), out(F.format_string("%04d-%02d", year, month), "folder"))
                .when(year.isNotNull(), out(year, "folder"))
                .otherwise(let(bare, lambda y: F.when(y.isNotNull(), out(y, "filename"))))
            )

        rest = let(filename_month(names, year, as_of_year), by_folder)
        none = F.struct(F.lit(None).cast("string").alias("date"), F.lit(None).cast("string").alias("date_source"))
        return F.when(day.isNotNull(), out(day, "filename")).when(near, out(stamp, "received_stamp")).otherwise(F.coalesce(rest, none))

    def with_day(place: Column, stamp: Column) -> Column:
        return let(filename_date(names, place["year"], place["month"], stamp), lambda day: told(place, stamp, day))

    return let(folder(path), lambda place: let(stamp_date(text), lambda stamp: with_day(place, stamp)))


def year_of(date: Column) -> Column:
    """The year of a partial date, as text."""
    return F.substring(date, 1, 4)


def display_date(date: Column) -> Column:
    """A partial date for readers: ``Jan 4, 2026``, ``Jan 2026`` or ``2026``; empty for null."""
    parts = F.split(date, "-")
    short = F.element_at(F.array(*[F.lit(m.capitalize()) for m in MONTHS]), F.greatest(F.least(F.get(parts, F.lit(1)).try_cast("int"), F.lit(12)), F.lit(1)))
    size = F.size(parts)
    return F.coalesce(
        F.when(size >= 3, F.concat(short, F.lit(" "), F.get(parts, F.lit(2)).try_cast("int").cast("string"), F.lit(", "), F.get(parts, F.lit(0)))).when(size == 2, F.concat(short, F.lit(" "), F.get(parts, F.lit(0)))).otherwise(date),
        F.lit(""),
    )


def display_day(day: Column) -> Column:
    """A whole date as ``Apr 9, 2026``."""
    return F.date_format(day, "MMM d, yyyy")
