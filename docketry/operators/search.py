"""Faceted full-text search: index records and postings, matching, ranking, facet counts, paging.

Documents are numbered where they are written, and postings are rows of a term and a block of document numbers, with each document's frequency, length and
positions (as gaps) in arrays, and the largest part of a score in the block. Rows lie in ranges of (term, block), so the postings of a term of all documents are
spread over files, and a query reads those of its terms alone (a pushed-down filter). A sorted dictionary of terms with their stems serves prefixes and
inflections. The first page by relevance needs only blocks whose largest parts can reach it (after Ding and Suel, "Faster Top-k Document Retrieval Using
Block-Max Indexes", 2011).
Ranking, left open by the data model, is BM25 (Robertson and Zaragoza, "The Probabilistic Relevance Framework", 2009); ties go by
file name. Undated documents come last in either date order.
"""

from __future__ import annotations

import contextlib
import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from docketry.functions.dates import display_date, year_of
from docketry.functions.display import page_links
from docketry.functions.stem import common_start, stem, stems
from docketry.functions.text import longest
from docketry.operators.durable import checkpointed, delete, written
from docketry.plans.request import PAGE_SIZE, ResultCache, SearchRequest

FACETS = ("category", "year")
_TOKEN = r"[\p{L}\p{N}]+"


def _present(values: dict[str, Column]) -> Column:
    """A map without the entries that are null or empty."""
    pairs = F.create_map(*[x for name, value in values.items() for x in (F.lit(name), value)])
    return F.map_filter(pairs, lambda k, v: v.isNotNull() & (v != ""))


def index_records(corpus: DataFrame, base_url: str) -> DataFrame:
    """One index record for each corpus row: url, content, language, meta, filters and sort."""
    base = base_url.rstrip("/")
    title = F.coalesce(F.nullif(longest(F.col("original_filenames")), F.lit("")), F.col("filename"))
    category = F.create_map(F.lit("category"), F.array("category"))
    dated = F.col("date").isNotNull() & (F.col("date") != "")
    meta = {"title": title, "name": F.col("name"), "position": F.col("title"), "agency": F.col("agency"), "filename": F.col("filename"), "category": F.col("category"), "date": F.col("date")}
    return corpus.select(
        F.concat(F.lit(base + "/"), "filename").alias("url"), F.coalesce("fulltext", F.lit("")).alias("content"), F.lit("en").alias("language"),
        _present(meta).alias("meta"), F.when(dated, F.map_concat(category, F.create_map(F.lit("year"), F.array(year_of(F.col("date")))))).otherwise(category).alias("filters"),
        _present({"date": F.col("date")}).alias("sort"),
    )


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({_TOKEN})"), F.lit(1))


#: Documents of a block, as a power of two.
BLOCK_BITS = 10


def _part(tf: Column, length: Column, average: Column, k1: float, b: float) -> Column:
    """A posting's part of a BM25 score, but for the term's weight."""
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / F.greatest(average, F.lit(1e-9))))


@dataclass
class Index:
    """``blocks(term, block, n, cf, part, docs, tfs, lengths, starts, gaps)``, ``terms(term, df, cf, stem)``, ``totals(n, average, k1, b)`` and ``entries(doc, url, length, ...the record)``.

    ``loaded`` terms have their blocks in memory, see :meth:`preloaded`.
    """

    blocks: DataFrame
    terms: DataFrame
    totals: DataFrame
    entries: DataFrame
    loaded: frozenset[str] = frozenset()
    memory: DataFrame | None = None

    @staticmethod
    def read(spark, folder: str) -> Index:
        return Index(*(spark.read.parquet(f"{folder}/{part}") for part in ("blocks", "terms", "totals", "entries")))

    def of(self, terms: list[str]) -> DataFrame:
        """The blocks of some terms, from memory if all of them are there."""
        blocks = self.memory if self.memory is not None and self.loaded.issuperset(terms) else self.blocks
        return blocks.where(F.col("term").isin(terms))

    @property
    def postings(self) -> DataFrame:
        """``term, doc, tf, gaps``, a row for each term of each document."""
        return _unpacked(self.blocks, "term", gaps=True)

    @contextlib.contextmanager
    def preloaded(self, query: str, most: int = 1_000_000, least_letters: int = 2) -> Iterator[Index]:
        """The index with the postings of a query that is still being typed in memory, until the block is left.

        In memory are its terms and, from ``least_letters`` on, terms that begin like the last one, commonest first, as long as all of them
        have no more than ``most`` postings. Searches for other terms read the written index.
        """
        words, _ = parse_query(query)
        asked = F.col("term").isin(words)
        begun = F.col("term").startswith(words[-1]) if words and len(words[-1]) >= least_letters else F.lit(False)
        found = self.terms.where(asked | begun).orderBy(F.desc(asked), F.desc("df"), "term").limit(1000).select("term", "df").collect()
        chosen, held = [], 0
        for row in found:
            held += row.df
            if held > most:
                break
            chosen.append(row.term)
        memory = self.blocks.where(F.col("term").isin(chosen)).cache()
        try:
            memory.count()
            yield replace(self, loaded=frozenset([*chosen, *(w for w in words if w not in {r.term for r in found})]), memory=memory)
        finally:
            memory.unpersist()


def _unpacked(blocks: DataFrame, *keep: str, gaps: bool = False) -> DataFrame:
    """``doc, tf, length`` of each posting with some columns of its block; its ``gaps`` too if they are needed."""
    arrays = ["docs", "tfs", "lengths"]
    if gaps:
        own = F.transform(F.arrays_zip("starts", "tfs"), lambda x: F.slice("gaps", x["starts"] + 1, x["tfs"]))
        blocks, arrays = blocks.withColumn("gaps", own), [*arrays, "gaps"]
    rows = blocks.select(*keep, "block", F.explode(F.arrays_zip(*arrays)).alias("p"))
    doc = F.shiftleft("block", BLOCK_BITS) + F.col("p.docs")
    return rows.select(*keep, doc.alias("doc"), F.col("p.tfs").alias("tf"), F.col("p.lengths").alias("length"), *([F.col("p.gaps").alias("gaps")] if gaps else []))


#: Documents, frequencies, lengths, where each document's gaps begin, and the gaps of all of them; flat arrays, as nested ones take several times the room.
_ARRAYS = ("docs", "tfs", "lengths", "starts", "gaps")
#: What is sent: the documents, frequencies, lengths and gaps of some postings of a block one after another in one array.
_SENT = "term string, block long, first int, n int, data array<int>"
_BLOCK = "term string, block long, n int, cf long, part double, " + ", ".join(f"{name} array<int>" for name in _ARRAYS)
#: Places that a row that is sent has at most, unless one document has more: ranges have rows in equal numbers, so rows must not differ much in size.
_PIECE = 64


def _lists(ends: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def _chunks(batches: Iterator[pa.RecordBatch], at_once: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Postings of ``doc, length, words`` put together by block and term as far as they come together, about so many words at a time."""
    for batch in batches:
        sizes, first = batch.column("length").to_numpy(), 0
        while first < batch.num_rows:
            size = max(1, int(np.searchsorted(np.cumsum(sizes[first:]), at_once, side="right")))
            yield from _together(batch.slice(first, size))
            first += size


def _together(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    words = batch.column("words")
    sizes, doc = np.diff(words.offsets.to_numpy()), batch.column("doc").to_numpy()
    encoded = words.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(sizes)), sizes)
    at, block = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes), (doc >> BLOCK_BITS)[row]
    order = np.lexsort((encoded.indices.to_numpy(), block))  # stable: documents and places stay in order
    term, block, row, at = encoded.indices.to_numpy()[order], block[order], row[order], at[order].astype(np.int32)
    if not len(row):
        return
    chunk = np.ones(len(row), bool)
    chunk[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
    posting = chunk.copy()
    posting[1:] |= row[1:] != row[:-1]
    gaps = np.where(posting, at, np.diff(at, prepend=np.int32(0)))
    starts, firsts = np.flatnonzero(posting), np.flatnonzero(chunk)
    own, ends = row[starts], np.append(np.searchsorted(starts, firsts), len(starts))
    begun = starts - np.repeat(firsts, np.diff(ends))
    each = [doc[own] & ((1 << BLOCK_BITS) - 1), np.diff(starts, append=len(row)), batch.column("length").to_numpy()[own], begun]
    lists = [_lists(ends, values) for values in each]
    lists.append(_lists(np.append(firsts, len(row)), gaps))
    out = pa.RecordBatch.from_arrays([encoded.dictionary.take(pa.array(term[firsts])), pa.array(block[firsts]), *lists], ["term", "block", *_ARRAYS])
    for at in range(0, out.num_rows, 8192):
        yield out.slice(at, 8192)


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy()


def _sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks as rows to send, cut between documents so that a row has about ``_PIECE`` places at most."""
    for batch in _chunks(batches):
        docs, tfs, lengths, gaps, starts = (_flat(batch, name) for name in ("docs", "tfs", "lengths", "gaps", "starts"))
        sizes = np.diff(batch.column("docs").offsets.to_numpy())
        owner, first = np.repeat(np.arange(batch.num_rows), sizes), np.cumsum(sizes) - sizes
        piece = np.ones(len(docs), bool)
        piece[1:] = (owner[1:] != owner[:-1]) | ((starts + tfs - 1)[1:] // _PIECE != (starts + tfs - 1)[:-1] // _PIECE)
        piece[first] = True
        begin = np.flatnonzero(piece)
        n = np.diff(begin, append=len(docs))
        places = np.add.reduceat(tfs, begin)
        ends = np.append(0, np.cumsum(3 * n + places))
        data = np.empty(ends[-1], np.int32)
        each = np.arange(len(docs)) - np.repeat(begin, n) + np.repeat(ends[:-1], n)
        for k, values in enumerate((docs, tfs, lengths)):
            data[each + np.repeat(k * n, n)] = values
        gap_ends = np.cumsum(places)
        data[np.arange(len(gaps)) - np.repeat(gap_ends - places, places) + np.repeat(ends[:-1] + 3 * n, places)] = gaps
        of = pa.array(owner[begin])
        out = pa.RecordBatch.from_arrays([batch.column("term").take(of), batch.column("block").take(of), pa.array(docs[begin], pa.int32()), pa.array(n, pa.int32()), _lists(ends, data)], ["term", "block", "first", "n", "data"])
        for at in range(0, out.num_rows, 8192):
            yield out.slice(at, 8192)


def _joined(batches: Iterator[pa.RecordBatch], average: float, k1: float, b: float) -> Iterator[pa.RecordBatch]:
    """The blocks of rows that were sent and come sorted by term, block and first document."""
    left = None
    for batch in batches:
        rows = pa.Table.from_batches([batch] if left is None else [left, batch]).combine_chunks().to_batches()
        if not rows:
            continue
        rows = rows[0]
        term, block = rows.column("term").dictionary_encode().indices.to_numpy(), rows.column("block").to_numpy()
        begins = np.ones(rows.num_rows, bool)
        begins[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        last = int(np.flatnonzero(begins)[-1])  # further rows of the last block may come
        left = rows.slice(last)
        if last:
            yield _blocks(rows.slice(0, last), np.flatnonzero(begins[:last]), average, k1, b)
    if left is not None:
        yield _blocks(left, np.array([0]), average, k1, b)


def _blocks(rows: pa.RecordBatch, begins: np.ndarray, average: float, k1: float, b: float) -> pa.RecordBatch:
    n, data = rows.column("n").to_numpy(), _flat(rows, "data")
    sizes = np.diff(rows.column("data").offsets.to_numpy())
    place, n_here = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes), np.repeat(n, sizes)
    docs, tfs, lengths = (data[(place >= k * n_here) & (place < (k + 1) * n_here)] for k in range(3))
    gaps = data[place >= 3 * n_here]
    docs_at, gaps_at = (np.append(0, np.cumsum(x))[np.append(begins, rows.num_rows)] for x in (n, sizes - 3 * n))
    starts = np.cumsum(tfs, dtype=np.int64) - tfs
    starts -= np.repeat(starts[docs_at[:-1]], np.diff(docs_at))
    parts = np.maximum.reduceat(tfs * (k1 + 1) / (tfs + k1 * (1 - b + b * lengths / max(average, 1e-9))), docs_at[:-1])
    lists = [_lists(docs_at, x) for x in (docs, tfs, lengths, starts)] + [_lists(gaps_at, gaps)]
    of = pa.array(begins)
    facts = [rows.column("term").take(of), rows.column("block").take(of), pa.array(np.diff(docs_at), pa.int32()), pa.array(np.diff(gaps_at), pa.int64()), pa.array(parts)]
    return pa.RecordBatch.from_arrays([*facts, *lists], ["term", "block", "n", "cf", "part", *_ARRAYS])


def write_index(records: DataFrame, folder: str, ranges: int | None = None, k1: float = 1.2, b: float = 0.75) -> None:
    """The index of ``records(url, content, filters, meta, sort, ...)`` below a folder.

    A task puts the postings of its own documents together by block and term, as arrays; these are sent once, in ranges of term and block, as rows of about one
    size, so that ranges are of one size too and a term of all documents lies in as many as it fills. As many ranges as asked for, or as the session's shuffles have.
    The rows are a table of their own until they have been sent, as ranges are found from a sample of all rows, for which texts would be taken apart once more.
    """
    spark = records.sparkSession
    entries = records.withColumn("length", F.size(tokens(F.col("content")))).withColumn("doc", F.monotonically_increasing_id())
    entries.write.mode("overwrite").parquet(f"{folder}/entries")
    entries = spark.read.parquet(f"{folder}/entries")  # numbers hold from here on
    totals = entries.agg(F.count("*").alias("n"), F.coalesce(F.avg("length"), F.lit(0.0)).alias("average"))
    totals.withColumns({"k1": F.lit(k1), "b": F.lit(b)}).write.mode("overwrite").parquet(f"{folder}/totals")
    average = float(spark.read.parquet(f"{folder}/totals").select("average").first()[0])
    words, rows = written(entries.select("doc", "length", tokens(F.col("content")).alias("words")).mapInArrow(_sent, _SENT))
    try:
        ranged = words.repartitionByRange(*([ranges] if ranges else []), "term", "block")
        blocks = ranged.sortWithinPartitions("term", "block", "first").mapInArrow(lambda batches: _joined(batches, average, k1, b), _BLOCK)
        # Small row groups, so that a query skips most of a file and the blocks of a frequent term are dealt to tasks.
        blocks.write.mode("overwrite").option("parquet.block.size", 1 << 24).parquet(f"{folder}/blocks")
    finally:
        delete(spark, rows)
    known = spark.read.parquet(f"{folder}/blocks").groupBy("term").agg(F.sum("n").alias("df"), F.sum("cf").alias("cf"))
    known.repartitionByRange("term").withColumn("stem", stems(F.col("term"))).sortWithinPartitions("term").write.mode("overwrite").parquet(f"{folder}/terms")


def parse_query(query: str) -> tuple[list[str], list[list[str]]]:
    """The distinct lower-case terms of a query, and its quoted phrases as lists of terms."""
    import regex

    phrases = [found for quoted in re.findall(r'"([^"]*)"', query) if (found := regex.findall(_TOKEN, quoted.lower()))]
    return list(dict.fromkeys(regex.findall(_TOKEN, query.lower()))), [p for p in phrases if len(p) > 1]


def _idf(n: Column, df: Column) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def _answers(index: Index, words: list[str], inflected: bool, begun: bool) -> DataFrame:
    """``word, df`` and the block of the blocks whose terms answer each word of a query, by its place."""
    if not inflected and not begun:
        blocks = index.of(words)
        df = blocks.groupBy(F.col("term").alias("_t")).agg(F.sum("n").alias("df"))
        place = F.array_position(F.array(*map(F.lit, words)), F.col("term")).cast("int") - 1
        return blocks.withColumn("word", place).join(df, F.col("term") == F.col("_t")).drop("_t")
    answers, starts = [], []
    for k, word in enumerate(words):
        this = F.col("term") == word
        if inflected:
            this = this | (F.col("stem") == stem(word))
        if begun and k == len(words) - 1:
            this = this | F.col("term").startswith(word)
        answers.append(F.when(this, F.lit(k)))
        starts.append(F.col("term").startswith(common_start(word) if inflected else word))
    near = functools.reduce(lambda x, y: x | y, starts)  # pushed down to both tables, which are sorted by term
    known = index.terms.where(near).select(F.col("term").alias("_t"), "df", F.explode(F.array_compact(F.array(*answers))).alias("word"))
    return index.blocks.where(near).join(known, F.col("term") == F.col("_t")).drop("_t")


def _scored(index: Index, hits: DataFrame, words: list[str]) -> DataFrame:
    k1, b = index.totals.select("k1").scalar(), index.totals.select("b").scalar()
    rows = hits.withColumn("_p", F.col("idf") * _part(F.col("tf"), F.col("length"), index.totals.select("average").scalar(), k1, b))
    found = rows.groupBy("doc", "word").agg(F.sum("_p").alias("_p")).groupBy("doc").agg(F.sum("_p").alias("score"), F.count("*").alias("_words"))
    return found.where(F.col("_words") == len(words)).select("doc", F.round("score", 9).alias("score"))  # sums of any order are one score


def _with_phrase(answers: DataFrame, words: list[str], phrase: list[str]) -> DataFrame:
    """``doc`` of the documents in which the words of a phrase follow one another. A word may be in it twice.

    The blocks of the words meet by their number, and all documents of one are looked at together, as arrays; what a task holds is one block of documents.
    """
    steps = [words.index(w) for w in phrase]

    def run(table: pa.Table) -> pa.Table:
        placed = {word: [] for word in steps}
        for row in range(table.num_rows):
            docs, tfs, gaps = (table.column(name)[row].values.to_numpy(zero_copy_only=False) for name in ("docs", "tfs", "gaps"))
            at, first = np.cumsum(gaps, dtype=np.int64), np.cumsum(tfs) - tfs
            placed[table.column("word")[row].as_py()].append((np.repeat(docs.astype(np.int64) << 32, tfs), at - np.repeat(at[first] - gaps[first], tfs)))
        found = None
        for step, word in enumerate(steps):
            begins = np.concatenate([(doc + at - step)[at >= step] for doc, at in placed[word]] or [np.empty(0, np.int64)])
            found = np.unique(begins) if found is None else np.intersect1d(found, begins)
        block = table.column("block")[0].as_py()
        return pa.table({"doc": pa.array(np.unique(found >> 32) + (block << BLOCK_BITS), pa.int64())})

    rows = answers.where(F.col("word").isin(steps)).select("block", "word", "docs", "tfs", "gaps")
    return rows.groupBy("block").applyInArrow(run, "doc long")


def matching(index: Index, query: str, inflected: bool = False, begun: bool = False) -> DataFrame:
    """``doc, score`` of the documents that have every term and, side by side, every quoted phrase; all documents for no terms.

    ``inflected`` takes words of the same English stem for a term, ``begun`` those that begin like the last one, as it may still be typed.
    """
    words, phrases = parse_query(query)
    if not words:
        return index.entries.select("doc", F.lit(0.0).alias("score"))
    answers = _answers(index, words, inflected, begun)
    hits = _unpacked(answers, "word", "df").withColumn("idf", _idf(index.totals.select("n").scalar(), F.col("df")))
    found = _scored(index, hits, words)
    for phrase in phrases:
        found = found.join(_with_phrase(answers, words, phrase), "doc", "left_semi")
    return found


def matches(index: Index, query: str, inflected: bool = False, begun: bool = False) -> DataFrame:
    """``url, score`` of :func:`matching`."""
    return index.entries.select("doc", "url").join(matching(index, query, inflected, begun), "doc").select("url", "score")


@dataclass
class Best:
    """Rows ``doc, url, filename, score`` of the best matches, how many blocks of documents have all terms, and how many were read."""

    rows: list[Row]
    blocks: int
    read: int


def best_matches(index: Index, query: str, size: int = PAGE_SIZE, filters: dict[str, tuple[str, ...]] | None = None, first: int = 8) -> Best:
    """The best ``size`` matches of a query's terms by relevance, ties by file name and address, without reading what cannot be among them.

    Blocks of documents go by the sum of their terms' largest parts; once ``size`` matches score more than the next block can, the rest is left unread.
    Phrases and null queries have no bound, so they are not for this. At most ``size`` rows and the numbers of one round's blocks reach the driver.
    """
    words, phrases = parse_query(query)
    if not words or phrases:
        raise ValueError("only terms outside of phrases have bounds")
    blocks = index.of(words)
    weight = {r.term: r.w for r in blocks.groupBy("term").agg(F.sum("n").alias("df")).select("term", _idf(index.totals.select("n").scalar(), F.col("df")).alias("w")).collect()}
    if len(weight) < len(words):
        return Best([], 0, 0)
    weighted = F.element_at(F.create_map(*[x for t, w in weight.items() for x in (F.lit(t), F.lit(w))]), F.col("term"))
    bounds = blocks.groupBy("block").agg(F.sum(weighted * F.col("part")).alias("bound"), F.count("*").alias("_n")).where(F.col("_n") == len(words)).select("block", F.round("bound", 8).alias("bound"))
    total, read, rows, after, step = bounds.count(), 0, [], None, first
    place = F.array_position(F.array(*map(F.lit, words)), F.col("term")).cast("int") - 1
    narrow = index.entries.where(facet_condition(filters or {})).select("doc", "url", F.element_at("meta", F.lit("filename")).alias("filename"))
    while True:
        left = bounds if after is None else bounds.where((F.col("bound") < after[0]) | ((F.col("bound") == after[0]) & (F.col("block") > after[1])))
        now = left.orderBy(F.desc("bound"), "block").limit(step).collect()
        if len(rows) == size:
            now = [r for r in now if r.bound + 1e-6 >= rows[-1].score]
        if not now:
            return Best(rows, total, read)
        numbers = [r.block for r in now]
        hits = _unpacked(blocks.where(F.col("block").isin(numbers)), "term").select(place.alias("word"), weighted.alias("idf"), "doc", "tf", "length")
        inside = functools.reduce(lambda x, y: x | y, [F.col("doc").between(k << BLOCK_BITS, ((k + 1) << BLOCK_BITS) - 1) for k in numbers])
        found = _scored(index, hits, words).join(narrow.where(inside), "doc").select("doc", "url", "filename", "score")
        rows = sorted([*rows, *found.orderBy(F.desc("score"), "filename", "url").limit(size).collect()], key=lambda r: (-r.score, r.filename is not None, r.filename or "", r.url))[:size]
        read, after, step = read + len(now), (now[-1].bound, now[-1].block), min(2 * step, 256)


def facet_condition(filters: dict[str, tuple[str, ...]], but: str | None = None) -> Column:
    """OR within a facet, AND across facets; a facet without a selection does not filter, nor does the one left out."""
    out = F.lit(True)
    for name in FACETS:
        if name != but and filters.get(name):
            out = out & F.coalesce(F.arrays_overlap(F.element_at("filters", F.lit(name)), F.array(*map(F.lit, filters[name]))), F.lit(False))
    return out


def candidates(index: Index, query: str, inflected: bool = False, begun: bool = False) -> DataFrame:
    """The matches of a query with what filters, sorting and counting need, before any filter; texts stay where they are."""
    return _numbered_candidates(index, query, inflected, begun).drop("doc")


def _numbered_candidates(index: Index, query: str, inflected: bool, begun: bool) -> DataFrame:
    narrow = index.entries.select("doc", "url", "filters", "sort", F.element_at("meta", F.lit("filename")).alias("filename"))
    return narrow.join(matching(index, query, inflected, begun), "doc")


def facet_counts(found: DataFrame, filters: dict[str, tuple[str, ...]]) -> DataFrame:
    """``facet, value, n``: for each value, the matches it has under the other facets' selections, whatever its own facet has.

    The matches are read once: each has a bit for every facet whose selection it fails, and counts for a facet if it has no other bit.
    """
    failed = F.lit(0)
    for k, name in enumerate(FACETS):
        failed = failed + F.when(facet_condition({name: filters.get(name, ())}), 0).otherwise(1 << k)

    def own(k: int, name: str) -> Column:
        values = F.transform(F.element_at("filters", F.lit(name)), lambda v: F.struct(F.lit(name).alias("facet"), v.alias("value")))
        return F.when(F.col("_failed").bitwiseAND(~(1 << k)) == 0, values)

    values = F.flatten(F.array_compact(F.array(*[own(k, name) for k, name in enumerate(FACETS)])))
    return found.withColumn("_failed", failed).select(F.explode(values).alias("v")).groupBy("v.facet", "v.value").agg(F.count("*").alias("n"))


def facet_options(dimension: DataFrame, counts: DataFrame, filters: dict[str, tuple[str, ...]]) -> DataFrame:
    """``facet, value, n, checked, disabled`` for every value of ``dimension(facet, value)``: no matches and not ticked is disabled."""
    checked = F.lit(False)
    for name in FACETS:
        if filters.get(name):
            checked = checked | ((F.col("facet") == name) & F.col("value").isin(*filters[name]))
    joined = dimension.join(counts, ["facet", "value"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return joined.withColumn("checked", checked).withColumn("disabled", (F.col("n") == 0) & ~F.col("checked"))


def order_by(sort: str) -> list[Column]:
    date = F.element_at("sort", F.lit("date"))
    first = {"relevance": F.desc("score"), "newest": date.desc_nulls_last(), "oldest": date.asc_nulls_last()}[sort]
    return [first, F.asc("filename"), F.asc("url")]


def after_row(sort: str, key: float | str | None, filename: str | None, url: str) -> Column:
    """Whether a match comes after one of that score (or date), file name and address, in the order of :func:`order_by`."""
    name, low = F.col("filename"), F.lit(filename).cast("string")
    later = F.when(low.isNull(), name.isNotNull()).otherwise(F.coalesce(name > low, F.lit(False))) | (name.eqNullSafe(low) & (F.col("url") > url))
    if sort == "relevance":
        return (F.col("score") < F.lit(key)) | ((F.col("score") == F.lit(key)) & later)
    date, last = F.element_at("sort", F.lit("date")), F.lit(key).cast("string")
    beyond = date < last if sort == "newest" else date > last
    return F.when(last.isNull(), date.isNull() & later).otherwise(F.coalesce(beyond, F.lit(True)) | (date.eqNullSafe(last) & later))


def search(index: Index, request: SearchRequest, after: tuple[float | str | None, str | None, str] | None = None, inflected: bool = False, begun: bool = False) -> tuple[DataFrame, DataFrame, int, int]:
    """One page of results, the facet counts, the total, and the number of the page shown (the last one if past the end).

    The matches are found once, as narrow rows that are written; count, page and facets read these. The page is the top of them,
    and only its records are read. ``after`` (score or date, file name and address of the last row of the page before) asks for the page
    that follows it, for which no row of the earlier pages is sorted again.
    """
    found = checkpointed(_numbered_candidates(index, request.query, inflected, begun))
    chosen = found.where(facet_condition(request.filters))
    total = chosen.count()
    page = min(request.page, max(1, -(-total // PAGE_SIZE)))
    ranked = chosen.where(after_row(request.sort, *after)) if after else chosen
    ranked = ranked.orderBy(*order_by(request.sort)).offset(0 if after else PAGE_SIZE * (page - 1)).limit(PAGE_SIZE).select("doc", "score")
    terms, _ = parse_query(request.query)
    page_rows = {r.doc: r.score for r in ranked.collect()}  # at most a page
    scores = F.create_map(*[F.lit(x) for pair in page_rows.items() for x in pair]) if page_rows else F.lit(None).cast("map<bigint,double>")
    asked = functools.reduce(lambda x, y: x | y, [F.col("doc") == doc for doc in page_rows], F.lit(False))
    shown = index.entries.where(asked).withColumn("score", F.element_at(scores, F.col("doc")))  # a pushed-down filter: entries lie in order of their numbers
    shown = shown.withColumn("filename", F.element_at("meta", F.lit("filename"))).orderBy(*order_by(request.sort))
    rows = shown.select("url", shown_title().alias("title"), details().alias("details"), (excerpt(F.col("content"), terms) if terms else F.lit(None).cast("string")).alias("excerpt"), "score")
    return rows, facet_counts(found, request.filters), total, page


class ResultSets:
    """Matches of the latest searches over an index, as narrow written tables: further pages of a request read its table, and find no match again.

    A table is deleted when ``size`` newer requests have taken its place, or by :meth:`release`. Requests that differ in their page alone are one.
    """

    def __init__(self, index: Index, size: int = 16):
        self.index, self.runs = index, 0
        self._cache = ResultCache(size, self._drop)

    def _drop(self, result: tuple[DataFrame, str, int]) -> None:
        delete(self.index.entries.sparkSession, result[1])

    def _run(self, asked: SearchRequest) -> tuple[DataFrame, str, int]:
        self.runs += 1
        chosen = candidates(self.index, asked.query).where(facet_condition(asked.filters))
        table, folder = written(chosen.select("url", "filename", "score", "sort"))
        return table, folder, table.count()

    def page(self, asked: SearchRequest) -> tuple[DataFrame, int, int, bool]:
        """``url, score`` of one page's rows, the total, the page shown (the last one if past the end), and whether matches had to be found.

        The rows are written for themselves, so they outlive their request's table.
        """
        before = self.runs
        table, _, total = self._cache.get(asked, self._run)
        page = min(asked.page, max(1, -(-total // PAGE_SIZE)))
        rows = table.orderBy(*order_by(asked.sort)).offset(PAGE_SIZE * (page - 1)).limit(PAGE_SIZE).select("url", "score")
        return checkpointed(rows), total, page, self.runs > before

    def release(self) -> None:
        """Deletes all tables."""
        while self._cache.kept:
            self._drop(self._cache.kept.popitem()[1])


def listing_pages(totals: DataFrame, size: int = PAGE_SIZE, at_once: int = 4096) -> DataFrame:
    """A row for each page of each listing of ``totals(..., total)``, whose other columns stay: ``page``, ``pages``, ``first`` and ``last`` (row numbers) and ``links`` (see :func:`display.page_links`).

    An empty or null listing has one page without rows. Page numbers are made in two steps of ``at_once`` each, so no row holds all of a long listing's.
    """
    total = F.coalesce("total", F.lit(0)).cast("long")
    rows = totals.withColumn("_n", total).withColumn("pages", F.greatest(F.lit(1), F.ceil(F.col("_n") / size)).cast("int"))
    rows = rows.withColumn("_start", F.explode(F.sequence(F.lit(1), F.col("pages"), F.lit(at_once))))
    rows = rows.withColumn("page", F.explode(F.sequence(F.col("_start"), F.least(F.col("pages"), F.col("_start") + at_once - 1))))
    first = F.least(F.col("_n"), (F.col("page").cast("long") - 1) * size + 1)
    rows = rows.withColumn("first", first).withColumn("last", F.least(F.col("_n"), F.col("page").cast("long") * size))
    return rows.withColumn("links", page_links(F.col("page"), F.col("pages"))).drop("_n", "_start")


def _meta(name: str) -> Column:
    return F.element_at("meta", F.lit(name))


def shown_title() -> Column:
    """An index record's title, or else its file name, or else its address."""
    return F.coalesce(F.nullif(_meta("title"), F.lit("")), F.nullif(_meta("filename"), F.lit("")), F.col("url"))


def details() -> Column:
    """An index record's date, name, category, position and agency, those that it has, in one line."""
    parts = F.array(display_date(_meta("date")), _meta("name"), _meta("category"), _meta("position"), _meta("agency"))
    return F.array_join(F.filter(parts, lambda x: x.isNotNull() & (x != "")), " · ")


def escape_html(text: Column) -> Column:
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(sign), F.lit(entity))
    return text


def _densest(gaps: Column, sizes: Column, reach: int) -> Column:
    """Where the first stretch of ``reach`` signs that holds the most matches begins, at a match; 0 if there is none.

    ``gaps`` are the lengths of what lies before, between and behind the matches, ``sizes`` those of the matches. A stretch that grows by a
    match or slides by one, and so never shrinks, passes over them once.
    """

    def of(pairs: Column) -> Column:
        def step(state: Column, pair: Column) -> Column:
            start = state["end"] + pair["gap"]
            slides = start - state["at"] >= reach
            after = state["at"] + F.get(pairs, state["k"])["size"] + F.get(pairs, state["k"] + 1)["gap"]
            return F.struct(
                (start + pair["size"]).alias("end"), F.when(slides, state["k"] + 1).otherwise(state["k"]).alias("k"), F.when(slides, after).otherwise(state["at"]).alias("at"),
                F.when(slides | pair["size"].isNull(), state["best"]).otherwise(state["at"]).alias("best"),
            )

        zero = F.lit(0)
        return F.reduce(pairs, F.struct(zero.alias("end"), zero.alias("k"), F.get(pairs, zero)["gap"].alias("at"), zero.alias("best")), step, lambda state: state["best"])

    pairs = F.zip_with(gaps, sizes, lambda gap, size: F.struct(gap.alias("gap"), size.alias("size")))  # the last one has no size
    return F.get(F.transform(F.array(pairs), of), F.lit(0))  # so the pairs are made once


def excerpt(content: Column, terms: list[str], width: int = 200) -> Column:
    """A window of the escaped text where the terms stand closest, with the terms in ``<mark>``.

    A quarter of the window lies before the first of the matches that it is chosen for. It is split at its matches before anything is escaped, so that entities are never taken for words.
    """
    any_term = rf"(?iu)(?<![\p{{L}}\p{{N}}])({'|'.join(re.escape(t) for t in sorted(terms, key=len, reverse=True))})(?![\p{{L}}\p{{N}}])"
    lengths = F.transform(F.split(content, any_term, -1), F.length), F.transform(F.regexp_extract_all(content, F.lit(any_term), F.lit(1)), F.length)
    at = F.greatest(_densest(*lengths, width - width // 4) + 1 - width // 4, F.lit(1))
    window = F.substr(content, at, F.lit(width))
    between, found = F.split(window, any_term, -1), F.regexp_extract_all(window, F.lit(any_term), F.lit(1))
    marked = F.transform(found, lambda x: F.concat(F.lit("<mark>"), escape_html(x), F.lit("</mark>")))
    return F.array_join(F.zip_with(F.transform(between, escape_html), F.concat(marked, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
