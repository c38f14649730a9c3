"""The filer's name, title and agency from a form's labelled fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketry.functions.bind import let
from docketry.functions.category import TIME_STAMP
from docketry.functions.text import edges, strip

_ALONE = r"(?=\s*(?::|\z))"
# Labels at a line's start. A bare label counts only within so many lines after the name's.
NAME = rf"(?iu:^(?:Name of (?:(?:elected |non-elected |special )?(?:state |public |municipal |county )?(?:employee|official)|Faculty Member)|Name{_ALONE}))"
TITLE = r"(?iu:^(?:Title ?(?:or|/) ?Position|Public official position))"
AGENCY = rf"(?iu:^(?:(?:County |Municipal |State )?Agency ?/ ?Department|(?:County |Municipal |State )Agency{_ALONE}))"
BARE_TITLE = rf"(?iu:^Title{_ALONE})"
BARE_AGENCY = rf"(?iu:^(?:Agency|Department){_ALONE})"
NEAR_LINES = 6
# What shows, in a value's place, that the field was left blank.
BLANK = "|".join(
    (NAME, TITLE, AGENCY, BARE_TITLE, BARE_AGENCY, r"(?iu:^(?:Office|Public office|Agency address|Course Number|Fill in|Check one)\b)", r"^[A-Z ]+ INFORMATION\b", r"^[-_.\\\s]*\z", r"^\d{1,4}\s+[A-Z]{3}\b")
)
# Stamps, marks and instructions among the fields.
NOISE = "|".join(
    (
        r"This is [“\"]my State Agency\.?[”\"]\.?", r"(?iu:Please provide information about your [^.\n]*position\.)", r"(?iu:\[insert (?:name|title)\])", TIME_STAMP,
        r"[A-Z ]+ EMPLOYEE INFORMATION|PUBLIC OFFICIAL INFORMATION|RECEIVED|STATE ETHICS COMMISSION", r"\[?REDACTED\]?",
    )
)


def _first(lines: Column, pattern: str) -> Column:
    """The place (from 1) of the first line that matches; null for none."""
    return F.nullif(F.array_position(F.transform(lines, lambda x: x.rlike(pattern)), F.lit(True)).cast("int"), F.lit(0))


def _after_label(line: Column, label: str) -> Column:
    return F.regexp_replace(F.regexp_replace(line, label, ""), r"^[\s:]+", "")


def _value(lines: Column, at: Column, label: str) -> Column:
    """What follows the label in its line, or else the next line; null if that is a sign of a blank field."""

    def following(rest: Column) -> Column:
        return F.regexp_replace(F.when(rest == "", F.get(lines, at)).otherwise(rest), r"^[\s:]+", "")

    return let(let(_after_label(F.get(lines, at - 1), label), following), lambda found: F.when(~found.rlike(edges(BLANK)), found))


def filer(text: Column) -> Column:
    """Struct (name, title, agency); a field that is not there or left blank is null."""
    cleaned = F.split(F.regexp_replace(text, NOISE, " "), "\n")
    lines_ = F.filter(F.transform(cleaned, lambda x: strip(F.regexp_replace(x, " {2,}", " "))), lambda x: x != "")

    def fields(lines: Column, name: Column) -> Column:
        def labelled(label: str, bare: str) -> Column:
            near = F.slice(lines, F.coalesce(name, F.lit(0)) + 1, F.lit(NEAR_LINES))
            by_name = F.when(name.isNotNull(), name + _first(near, bare))
            return let(F.coalesce(_first(lines, label), by_name), lambda at: _value(lines, at, f"{label}|{bare}"))

        return F.struct(_value(lines, name, NAME).alias("name"), labelled(TITLE, BARE_TITLE).alias("title"), labelled(AGENCY, BARE_AGENCY).alias("agency"))

    return let(lines_, lambda lines: let(_first(lines, NAME), lambda name: fields(lines, name)))
