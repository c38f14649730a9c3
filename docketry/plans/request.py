"""The search state and what follows from it without data: URLs, page numbers, summary sentences."""

from __future__ import annotations

import re
from collections import OrderedDict
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from typing import Any
from urllib.parse import parse_qsl, urlencode, urlsplit

# Results on a page, page links on either side, sort names (the first is the default).
PAGE_SIZE = 20
PAGE_LINKS = 2
SORTS = ("relevance", "newest", "oldest")
#: How a facet's selection reads in the summary.
SCOPES = {"category": " in ", "year": " from "}


def slugify(text: str) -> str:
    """Lower case, runs of anything but letters and digits as one dash, none at the ends."""
    return re.sub(r"[\W_]+", "-", text.lower()).strip("-")


@dataclass(frozen=True)
class SearchRequest:
    query: str = ""
    filters: dict[str, tuple[str, ...]] = field(default_factory=dict)
    sort: str = SORTS[0]
    page: int = 1

    @property
    def cache_key(self) -> tuple:
        """What the result set depends on; the page does not."""
        return self.query, self.sort, tuple((name, tuple(self.filters.get(name, ()))) for name in SCOPES)


def parse_url(url: str, options: dict[str, Sequence[str]]) -> SearchRequest:
    """The request of a URL or query string; ``options`` has each facet's values in display order.

    Unknown and repeated slugs are dropped and the display order kept; an unknown sort is the default; a page that is no positive
    number is the first.
    """
    query = urlsplit(url).query if "?" in url else url.removeprefix("?")
    values: dict[str, str] = {}
    for name, value in parse_qsl(query, keep_blank_values=True):
        values.setdefault(name, value)
    filters = {}
    for name in SCOPES:
        slugs = set(values.get(name, "").split(","))
        filters[name] = tuple(v for v in options.get(name, ()) if slugify(v) in slugs)
    leading = re.match(r"\s*([+-]?\d+)", values.get("page", "1"))
    page = int(leading[1]) if leading else 1
    sort = values.get("sort", SORTS[0])
    return SearchRequest(values.get("q", "").strip(), filters, sort if sort in SORTS else SORTS[0], max(1, page))


def url_for(request: SearchRequest, options: dict[str, Sequence[str]], target: str = "/search/") -> str:
    """The URL of a request, without what is default."""
    pairs = [("q", request.query)] if request.query else []
    for name in SCOPES:
        if chosen := [slugify(v) for v in options.get(name, ()) if v in request.filters.get(name, ())]:
            pairs.append((name, ",".join(chosen)))
    if request.sort != SORTS[0]:
        pairs.append(("sort", request.sort))
    if request.page > 1:
        pairs.append(("page", str(request.page)))
    return f"{target}?{urlencode(pairs)}" if pairs else target


def page_numbers(current: int, total: int) -> list[int | None]:
    """First, last and the pages around the current one; None stands for a gap."""
    near = {1, total, *range(current - PAGE_LINKS, current + PAGE_LINKS + 1)}
    out: list[int | None] = []
    for n in sorted(x for x in near if 1 <= x <= total):
        if out and n - out[-1] > 1:  # type: ignore[operator]
            out.append(None)
        out.append(n)
    return out


def selected(filters: dict[str, tuple[str, ...]]) -> int:
    """How many facet values are ticked."""
    return sum(len(v) for v in filters.values())


def summary(request: SearchRequest, total: int, shown: int) -> str:
    """The sentence over the results: their number, the query, the selection and the range shown."""
    noun, asked = ("result", f" for {request.query}") if request.query else ("disclosure", "")
    scope = "".join(word + " or ".join(request.filters[name]) for name, word in SCOPES.items() if request.filters.get(name))
    if not total:
        return f"No {noun}s{asked}{scope}."
    last = max(1, -(-total // PAGE_SIZE))
    first = (min(request.page, last) - 1) * PAGE_SIZE + 1
    return f"{total:,} {noun}{'' if total == 1 else 's'}{asked}{scope} · showing {first:,}–{first + shown - 1:,}"


class ResultCache:
    """Result sets by request, the least recently used dropped first; a run that was overtaken by a newer one is not kept. ``dropped`` gets each result that leaves."""

    def __init__(self, size: int = 16, dropped: Callable[[Any], None] = lambda result: None):
        self.size, self.kept, self.token, self.dropped = size, OrderedDict(), 0, dropped

    def get(self, request: SearchRequest, run: Callable[[SearchRequest], Any]) -> Any:
        key = request.cache_key
        if key in self.kept:
            self.kept.move_to_end(key)
            return self.kept[key]
        self.token += 1
        mine = self.token
        out = run(replace(request, page=1))
        if mine == self.token:
            self.kept[key] = out
            while len(self.kept) > self.size:
                self.dropped(self.kept.popitem(last=False)[1])
        return out
