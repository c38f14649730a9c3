"""A document's category from its form title, or else from the provisions it cites."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketry.functions.bind import let
from docketry.functions.text import edges, strip

# The categories in display order.
FINANCIAL_INTEREST = "Financial Interest"
TRAVEL_AND_GIFTS = "Travel & Gifts"
APPEARANCE_OF_CONFLICT = "Appearance of Conflict"
STATEMENT = "Statement of Financial Interests"
OTHER = "Other"
CATEGORIES = (FINANCIAL_INTEREST, TRAVEL_AND_GIFTS, APPEARANCE_OF_CONFLICT, OTHER, STATEMENT)

# Patterns of form titles, tried in this order.
TITLES = (
    (TRAVEL_AND_GIFTS, r"TRAVEL|ATTENDANCE AT AN EVENT|HOSPITALITY|HONORARIUM|GIFT|EXPENSES|RECONCILIATION STATEMENT"),
    (OTHER, r"UNCOMPENSATED POSITION|OF ELECTION OR APPOINTMENT|PART-TIME POSITION|FAMILY MEMBERS"),
    (APPEARANCE_OF_CONFLICT, r"APPEARANCE OF CONFLICT"),
    (FINANCIAL_INTEREST, r"FINANCIAL INTEREST"),
)
# Citations, tried in this order.
_SECTION = r"(?:§+|\bs\.|\bsec(?:tion|\.)?)\s*"
CITATIONS = (
    (FINANCIAL_INTEREST, rf"(?iu){_SECTION}(?:1\s*\(o\)|6(?![B\d.])|7\b|13\b|19\b|20\b)|CMR\s*6\.(?:05|06|07|13|25|26)"),
    (TRAVEL_AND_GIFTS, r"(?iu)CMR\s*5\.0[68]|honorari"),
    (APPEARANCE_OF_CONFLICT, r"(?iu)23\s*\(?b\)?\s*\(?3"),
)
# Words that are no prose, in which the signs of a citation can stand by chance: checksums and access keys, addresses.
KEY = r"(?<![A-Za-z0-9])(?:[0-9a-f]{16,}+|[0-9A-F]{16,}+|A[KS]IA[0-9A-Z]{16})(?![A-Za-z0-9])"
ADDRESS = r"(?<![\p{L}\p{N}_.%+-])[\p{L}\p{N}_.%+-]++@[\w-]++\.[\w.-]++"
# What scanning leaves in titles. The time stamp is used by the field extraction too; the redaction mark is not, which there has a case.
TIME_STAMP = r"(?:\d{2,4}\s+)?[A-Z]{3,4}\s*-?\s*\d+\s*[AP]M\s*\d+\s*:\s*\d+"
REDACTION = r"(?iu:\[?REDACTED\]?)"
NOISE = (REDACTION, r"RECEIVED|(?:STATE )?ETHICS COMMISSION", TIME_STAMP, r"\([^)]*\)")
TITLE_START = r"^(?:DISCLOSURE (?:BY|OF|UNDER)|RECONCILIATION STATEMENT)\b"


def form_title(text: Column) -> Column:
    """The first upper-case title line and the line after it, without noise; null for none."""
    for pattern in NOISE:
        text = F.regexp_replace(text, pattern, " ")
    cleaned = F.transform(F.split(text, "\n"), lambda x: strip(F.regexp_replace(F.regexp_replace(x, r"\*", ""), " {2,}", " ")))

    def title(lines: Column) -> Column:
        found = F.array_position(F.transform(lines, lambda x: x.rlike(edges(TITLE_START)) & (x == F.upper(x))), F.lit(True)).cast("int")
        return let(found, lambda at: F.when(at > 0, F.concat(F.get(lines, at - 1), F.lit(" "), F.coalesce(F.get(lines, at), F.lit("")))))

    return let(F.filter(cleaned, lambda x: x != ""), title)


def cites(text: Column, pattern: str) -> Column:
    """Whether a text matches outside of its keys and addresses; these are taken out only where the whole text matches, which few do."""
    prose = F.regexp_replace(text, f"{KEY}|{ADDRESS}", "#")
    return text.rlike(edges(pattern)) & prose.rlike(edges(pattern))


def category(text: Column) -> Column:
    """The category of a document's text; ``Other`` where neither title nor citation tells, and for null."""

    def told(title: Column) -> Column:
        by_title = by_citation = F.when(F.lit(False), F.lit(OTHER))
        for label, pattern in TITLES:
            by_title = by_title.when(title.rlike(pattern), label)
        for label, pattern in CITATIONS:
            by_citation = by_citation.when(cites(text, pattern), label)
        return F.when(title.isNotNull(), by_title.otherwise(OTHER)).otherwise(by_citation.otherwise(OTHER))

    return let(form_title(text), told)
