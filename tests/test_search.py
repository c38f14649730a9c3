import math
import os
import random
import re
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from docketry import schemas
from docketry.functions import stem
from docketry.functions.display import page_links
from docketry.operators import search
from docketry.plans import request
from docketry.plans.request import SearchRequest, page_numbers, parse_url, summary, url_for

OPTIONS = {"category": ("Financial Interest", "Travel & Gifts", "Other"), "year": ("2026", "2025")}


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rows = [
        ("a.pdf", "Other", "2026-01-04", ["a long.pdf", "a.pdf"], "Real estate in <Springton> & a real deal", "Roe", None, "Parks"),
        ("b.pdf", "Travel & Gifts", "2025", ["b.pdf"], "estate of the real kind", None, "Clerk", None),
        ("c.pdf", "Other", None, [], "real estate real estate", "", None, None),
        ("d.pdf", "Financial Interest", "2025-07", ["d.pdf"], None, None, None, None),
    ]
    full = [(f, None, c, d, None, o, f, None, t, n, p, g) for f, c, d, o, t, n, p, g in rows]
    corpus = spark.createDataFrame(full, schemas.CORPUS)
    folder = str(tmp_path_factory.mktemp("index"))
    search.write_index(search.index_records(corpus, "https://files/"), folder, ranges=2)
    return search.Index.read(spark, folder)


def found(index, query):
    return {r.url.rsplit("/", 1)[1] for r in search.matches(index, query).collect()}


def test_matching(index):
    assert found(index, "real estate") == {"a.pdf", "b.pdf", "c.pdf"}
    assert found(index, '"real estate"') == {"a.pdf", "c.pdf"}
    assert found(index, '"estate real" kind') == set()
    assert found(index, "REAL kind") == {"b.pdf"}
    assert found(index, "") == {"a.pdf", "b.pdf", "c.pdf", "d.pdf"}
    assert found(index, "nothing") == set()


def test_records(index):
    rows = {r.url: r for r in index.entries.collect()}
    a, c = rows["https://files/a.pdf"], rows["https://files/c.pdf"]
    assert a.meta == {"title": "a long.pdf", "name": "Roe", "agency": "Parks", "filename": "a.pdf", "category": "Other", "date": "2026-01-04"}
    assert a.filters == {"category": ["Other"], "year": ["2026"]} and c.filters == {"category": ["Other"]} and c.sort == {} and c.meta["title"] == "c.pdf"


def counts(index, query, **filters):
    return {(r.facet, r.value): r.n for r in search.facet_counts(search.candidates(index, query), filters).collect()}


def test_facets_leave_their_own_selection_out_and_come_after_the_phrase(index):
    assert counts(index, "real estate") == {("category", "Other"): 2, ("category", "Travel & Gifts"): 1, ("year", "2026"): 1, ("year", "2025"): 1}
    assert counts(index, '"real estate"') == {("category", "Other"): 2, ("year", "2026"): 1}
    picked = {"category": ("Travel & Gifts",), "year": ("2025",)}
    assert counts(index, "", **picked) == {("category", "Travel & Gifts"): 1, ("category", "Financial Interest"): 1, ("year", "2025"): 1}


def test_facet_counts_equal_rerun_totals(index):
    base = search.candidates(index, "")
    filters = {"year": ("2025", "2026")}
    for row in search.facet_counts(base, filters).where("facet = 'category'").collect():
        assert base.where(search.facet_condition(filters | {"category": (row.value,)})).count() == row.n


def test_options(spark, index):
    dimension = spark.createDataFrame([("category", v) for v in OPTIONS["category"]] + [("year", "2024")], "facet string, value string")
    some = search.facet_counts(search.candidates(index, "kind"), {"year": ("2024",)})
    out = {r.value: (r.n, r.checked, r.disabled) for r in search.facet_options(dimension, some, {"year": ("2024",)}).collect()}
    assert out == {"Financial Interest": (0, False, True), "Travel & Gifts": (0, False, True), "Other": (0, False, True), "2024": (0, True, False)}


def test_pages(index):
    rows, _, total, page = search.search(index, SearchRequest("real estate", {}, "oldest", 9))
    shown = [(r.title, r.details, r.excerpt) for r in rows.collect()]
    assert (total, page) == (3, 1) and [s[0] for s in shown] == ["b.pdf", "a long.pdf", "c.pdf"]
    assert shown[1][1:] == ("Jan 4, 2026 · Roe · Other · Parks", "<mark>Real</mark> <mark>estate</mark> in &lt;Springton&gt; &amp; a <mark>real</mark> deal")
    rows, _, _, _ = search.search(index, SearchRequest("", {"category": ("Other",)}, "newest"))
    assert [(r.title, r.excerpt) for r in rows.collect()] == [("a long.pdf", None), ("c.pdf", None)]
    best = search.search(index, SearchRequest("estate"))[0].collect()
    assert best[0].title == "c.pdf"


def test_excerpts_mark_words_and_not_entities(spark):
    rows = [("R&D <amp> of A&amp;B",), ("nothing here",), ("amp",), ("x" * 300 + " amp " + "y" * 300,)]
    out = [r.e for r in spark.createDataFrame(rows, "content string").select(search.excerpt(F.col("content"), ["amp", "d"]).alias("e")).collect()]
    assert out[:3] == ["R&amp;<mark>D</mark> &lt;<mark>amp</mark>&gt; of A&amp;<mark>amp</mark>;B", "nothing here", "<mark>amp</mark>"]
    assert out[3] == "x" * 49 + " <mark>amp</mark> " + "y" * 146


def test_excerpts_show_where_words_stand_closest(spark):
    def plain(text, words, reach=150):
        at = [m.start() for m in re.finditer(rf"(?<!\w)({'|'.join(words)})(?!\w)", text)]
        best = max(at, key=lambda a: (sum(a <= b < a + reach for b in at), -a), default=0)
        return re.sub(rf"(?<!\w)({'|'.join(words)})(?!\w)", r"<mark>\1</mark>", text[max(0, best - 50) :][:200])

    draw = random.Random(5)
    texts = ["", "😀" * 70 + " amp " + "z" * 200, "amp " + "y" * 400 + " amp d amp", "amp" + " z" * 73 + " d amp", "z" * 149 + " d amp" + " z" * 73 + " amp d"]
    texts += [" ".join(draw.choice(["amp", "d", *["z" * draw.randrange(1, 60)] * draw.randrange(1, 9)]) for _ in range(draw.randrange(1, 120))) for _ in range(60)]
    out = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, None])], "k int, content string").select("k", search.excerpt(F.col("content"), ["amp", "d"]).alias("e")).orderBy("k").collect()
    assert [r.e for r in out] == [plain(t, ["amp", "d"]) for t in texts] + [None]


def test_terms_are_pushed_down_to_the_written_index(index):
    plan = search.matches(index, "real")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,real)" in plan or "In(term, [real])" in plan


def test_state():
    assert parse_url("?q=%20x%20&category=other,travel-gifts,other,zzz&year=2025&sort=toString&page=abc", OPTIONS) == SearchRequest("x", {"category": ("Travel & Gifts", "Other"), "year": ("2025",)}, "relevance", 1)
    assert parse_url("/search/?page=-1", OPTIONS).page == 1 and parse_url("?page=3x", OPTIONS).page == 3 and parse_url("", OPTIONS).sort == "relevance"
    asked = SearchRequest('a "b c"', {"category": ("Travel & Gifts",), "year": ()}, "newest", 2)
    assert url_for(asked, OPTIONS) == "/search/?q=a+%22b+c%22&category=travel-gifts&sort=newest&page=2"
    assert parse_url(url_for(asked, OPTIONS), OPTIONS) == asked and url_for(SearchRequest(), OPTIONS) == "/search/"
    assert page_numbers(5, 10) == [1, None, 3, 4, 5, 6, 7, None, 10] and page_numbers(2, 3) == [1, 2, 3]
    assert summary(SearchRequest("x", {"category": ("A", "B"), "year": ("2024",)}), 0, 0) == "No results for x in A or B from 2024."
    assert summary(SearchRequest(page=2), 6883, 20) == "6,883 disclosures · showing 21–40" and summary(SearchRequest("q"), 1, 1) == "1 result for q · showing 1–1"
    assert request.selected({"category": ("a", "b"), "year": ("c",)}) == 3


def test_cache_is_by_query_and_skips_overtaken_runs():
    cache, runs = request.ResultCache(2), []

    def run(r):
        runs.append(r.query)
        if r.query == "slow":
            cache.get(SearchRequest("fast"), run)
        return r.query

    assert cache.get(SearchRequest("a", page=1), run) == cache.get(SearchRequest("a", page=2), run) == "a" and runs == ["a"]
    cache.get(SearchRequest("slow"), run)
    cache.get(SearchRequest("fast"), run)
    cache.get(SearchRequest("slow"), run)
    assert runs == ["a", "slow", "fast", "slow"]


def test_page_links_are_those_of_requests(spark):
    rows = [(c, t) for t in range(1, 15) for c in range(1, t + 1)]
    got = spark.createDataFrame(rows, "c int, t int").select("c", "t", page_links(F.col("c"), F.col("t")).alias("links")).collect()
    assert {(r.c, r.t): r.links for r in got} == {(c, t): page_numbers(c, t) for c, t in rows}


def test_pages_of_listings(spark):
    totals = spark.createDataFrame([("a", 41), ("b", 0), ("c", None), ("d", 20), (None, 10**5)], "name string, total long")
    got = {}
    for r in search.listing_pages(totals, at_once=7).collect():
        got.setdefault(r.name, {})[r.page] = (r.pages, r.first, r.last, r.links)
    assert got["a"] == {1: (3, 1, 20, [1, 2, 3]), 2: (3, 21, 40, [1, 2, 3]), 3: (3, 41, 41, [1, 2, 3])}
    assert got["b"] == got["c"] == {1: (1, 0, 0, [1])} and got["d"] == {1: (1, 1, 20, [1])}
    assert sorted(got[None]) == list(range(1, 5001)) and got[None][300] == (5000, 5981, 6000, page_numbers(300, 5000))
    assert search.listing_pages(totals.where("false")).count() == 0


def test_result_sets_are_found_once_and_released(spark, index):
    kept = search.ResultSets(index, 1)
    asked = SearchRequest("real estate", {}, "newest")
    rows, total, page, ran = kept.page(asked)
    assert [r.url.rsplit("/", 1)[1] for r in rows.collect()] == ["a.pdf", "b.pdf", "c.pdf"] and (total, page, ran) == (3, 1, True)
    again, total, page, ran = kept.page(replace(asked, page=9))
    assert (again.count(), total, page, ran) == (3, 3, 1, False)
    folder = next(iter(kept._cache.kept.values()))[1]
    assert os.path.isdir(folder)
    assert kept.page(SearchRequest("nowhere"))[1:] == (0, 1, True) and not os.path.exists(folder)
    assert rows.count() == 3 and kept.page(asked)[3]  # the page outlived its table, which is made again
    kept.release()
    assert not kept._cache.kept and kept.page(asked)[3]
    kept.release()


def records(spark, texts):
    rows = [(f"https://f/{k:05}", t, {"filename": f"{k % 37:03}"}, {"category": ["A" if k % 3 else "B"], **({"year": [str(2000 + k % 5)]} if k % 4 else {})}, {"date": str(2000 + k % 5)} if k % 4 else {}) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "url string, content string, meta map<string,string>, filters map<string,array<string>>, sort map<string,string>")


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """An index of 5,000 documents in several blocks, with a term that all have; the texts too."""
    pick = random.Random(4)
    texts = [" ".join(["all", *pick.choices(["tax", "taxes", "taxing", "town", "towns", "gift", "gifted", "report"], weights=[9, 1, 1, 5, 2, 3, 1, 7], k=pick.randint(1, 12)), *(["filler"] * pick.choice([0, 0, 5, 90]))]) for _ in range(5000)]
    folder = str(tmp_path_factory.mktemp("wide"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "300")  # so that blocks come in several chunks
    search.write_index(records(spark, texts).repartition(3, "url").sortWithinPartitions("url"), folder, ranges=64)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    return search.Index.read(spark, folder), texts, folder


def by_hand(texts, groups):
    """Scores of the documents that have a term of each group."""
    bags = [Counter(re.findall(r"\w+", t)) for t in texts]
    df, n = Counter(t for b in bags for t in b), len(texts)
    average = sum(map(len, map(str.split, texts))) / n
    out = {}
    for k, bag in enumerate(bags):
        if all(any(t in bag for t in g) for g in groups):
            length = sum(bag.values())
            parts = [math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * bag[t] * 2.2 / (bag[t] + 1.2 * (0.25 + 0.75 * length / average)) for g in groups for t in g if t in bag]
            out[f"https://f/{k:05}"] = round(sum(parts), 6)
    return out


def test_a_term_of_all_documents_lies_in_several_files(spark, wide):
    index, texts, folder = wide
    rows = index.blocks.where("term = 'all'").withColumn("file", F.input_file_name()).collect()
    assert len({r.file for r in rows}) > 1 and sum(r.n for r in rows) == 5000 and max(r.n for r in rows) <= 1 << search.BLOCK_BITS
    got = {(r.term, r.df, r.cf) for r in index.terms.collect()}
    bags = [Counter(t.split()) for t in texts]
    assert got == {(t, sum(t in b for b in bags), sum(b[t] for b in bags)) for t in set().union(*bags)}
    assert index.postings.count() == sum(map(len, bags))
    row = index.postings.join(index.entries.where("url = 'https://f/00007'").select("doc"), "doc").where("term = 'all'").first()
    assert row.gaps == [0] and row.tf == 1


def test_index_is_built_with_one_exchange_of_tokens(spark, wide, monkeypatch):
    plans = []
    frame = type(spark.range(1))
    plain = frame.sortWithinPartitions
    monkeypatch.setattr(frame, "sortWithinPartitions", lambda self, *a: plans.append(self._jdf.queryExecution().executedPlan().toString()) or plain(self, *a))
    search.write_index(records(spark, ["a b", "b c"]), os.path.join(wide[2], "again"), ranges=2)
    assert plans[0].count("Exchange ") == 1 and "rangepartitioning(term" in plans[0]


def test_texts_are_taken_apart_once_for_the_ranges(spark, tmp_path, monkeypatch):
    plain, calls = search._sent, str(tmp_path / "calls")

    def counted(batches):
        os.makedirs(f"{calls}/{os.urandom(8).hex()}")
        yield from plain(batches)

    monkeypatch.setattr(search, "_sent", counted)
    search.write_index(records(spark, ["a b", "b c"]).coalesce(1), str(tmp_path / "index"), ranges=2)
    assert len(os.listdir(calls)) == 1
    assert {(r.term, r.df) for r in search.Index.read(spark, str(tmp_path / "index")).terms.collect()} == {("a", 1), ("b", 2), ("c", 1)}


@pytest.mark.parametrize("at_once", [1, 7, 1000])
def test_postings_of_a_batch_in_slices_of_any_size(at_once):
    import pyarrow as pa

    pick = random.Random(at_once)
    texts = {doc: pick.choices(["a", "b", "ü", "c"], k=pick.choice([0, 1, 9, 30])) for doc in [5, 6, 1023, 1024, 1025, 1 << 33]}
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.int64()), pa.array([len(t) for t in texts.values()], pa.int32()), pa.array(texts.values(), pa.list_(pa.string()))], ["doc", "length", "words"])
    rows = [r for out in search._chunks(iter([batch.slice(0, 2), batch.slice(2)]), at_once) for r in out.to_pylist()]
    got = sorted((r["term"], (r["block"] << search.BLOCK_BITS) + d, n, size, tuple(r["gaps"][s : s + n])) for r in rows for d, n, size, s in zip(r["docs"], r["tfs"], r["lengths"], r["starts"], strict=True))
    places = {(t, doc): [k for k, w in enumerate(words) if w == t] for doc, words in texts.items() for t in set(words)}
    assert got == sorted((t, doc, len(at), len(texts[doc]), tuple([at[0], *(y - x for x, y in zip(at, at[1:], strict=False))])) for (t, doc), at in places.items())


@pytest.mark.parametrize(("query", "inflected", "begun", "groups"), [
    ("tax TOWN", False, False, [["tax"], ["town"]]), ("taxes town", True, False, [["tax", "taxes", "taxing"], ["town", "towns"]]), ("all ta", False, True, [["all"], ["tax", "taxes", "taxing"]]),
    ("gifts tow", True, True, [["gift", "gifted"], ["town", "towns"]]), ("none tax", True, True, [["none"], ["tax"]]),
])
def test_scores_of_words_inflections_and_beginnings(wide, query, inflected, begun, groups):
    index, texts, _ = wide
    got = {r.url: round(r.score, 6) for r in search.matches(index, query, inflected, begun).collect()}
    assert got == pytest.approx(by_hand(texts, groups), abs=2e-6) and (got or "none" in query)


def test_phrases_by_gaps(wide, spark):
    index, texts, _ = wide
    for phrase in ("tax tax", "all town", "town gift town"):
        expected = {f"https://f/{k:05}" for k, t in enumerate(texts) if f" {phrase} " in f" {t} "}
        assert {r.url for r in search.matches(index, f'"{phrase}"').collect()} == expected and expected


def test_best_matches_equal_the_full_ranking_and_read_less(wide):
    index, texts, _ = wide
    for query, filters in (("tax gift", {}), ("all", {}), ("gifted taxing towns", {"category": ("B",)}), ("report town", {"year": ("2001", "2003")}), ("none", {})):
        found = search.candidates(index, query).where(search.facet_condition(filters))
        full = found.orderBy(*search.order_by("relevance")).limit(7).collect()
        best = search.best_matches(index, query, 7, filters, first=1)
        assert [(r.url, r.score) for r in best.rows] == [(r.url, r.score) for r in full]
        assert best.read <= best.blocks
    with pytest.raises(ValueError, match="phrases"):
        search.best_matches(index, '"a b"')


def test_best_matches_leave_blocks_unread(spark, tmp_path):
    texts = ["rare " * (20 if k < 1000 else 1) + "x " * 50 for k in range(6000)]
    search.write_index(records(spark, texts).coalesce(1), str(tmp_path), ranges=2)
    best = search.best_matches(search.Index.read(spark, str(tmp_path)), "rare", 5, first=1)
    assert best.blocks == 6 and best.read == 1 and len(best.rows) == 5


@pytest.mark.parametrize("sort", ["relevance", "newest", "oldest"])
def test_pages_after_a_row_follow_one_another(wide, sort):
    index, _, _ = wide
    found = search.candidates(index, "taxes gift")
    full = [r.url for r in found.orderBy(*search.order_by(sort)).collect()]
    seen, last = [], None
    while True:
        rows = found.where(search.after_row(sort, *last)) if last else found
        page = rows.orderBy(*search.order_by(sort)).limit(61).collect()
        if not page:
            break
        seen += [r.url for r in page]
        last = (page[-1].score if sort == "relevance" else page[-1].sort.get("date"), page[-1].filename, page[-1].url)
    assert seen == full and len(full) > 100
    one = search.search(index, SearchRequest("taxes gift", {}, sort))[0].collect()
    key = found.where(F.col("url") == one[-1].url).first()
    two = search.search(index, SearchRequest("taxes gift", {}, sort), (key.score if sort == "relevance" else key.sort.get("date"), key.filename, key.url))[0]
    assert [r.url for r in one] + [r.url for r in two.collect()] == full[:40]


def test_facets_read_the_matches_once(wide):
    found = search.candidates(wide[0], "taxes")
    plan = search.facet_counts(found, {"category": ("A",)})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") == 0 and plan.count("Generate explode") == found._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") + 1


def test_preloaded_terms_are_bounded_and_let_go(wide):
    index, texts, _ = wide
    with index.preloaded("all ta") as warm:
        assert warm.loaded == {"all", "ta", "tax", "taxes", "taxing"} and warm.memory.is_cached
        got = {r.url: r.score for r in search.matches(warm, "all taxing").collect()}
        assert "InMemoryTableScan" in search.matches(warm, "taxing")._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryTableScan" not in search.matches(warm, "gift")._jdf.queryExecution().executedPlan().toString()
        assert {r.url for r in search.matches(warm, "gift").limit(3).collect()}
    assert not warm.memory.is_cached and got == {r.url: r.score for r in search.matches(index, "all taxing").collect()}
    with index.preloaded("all t") as letter, index.preloaded("all ta", most=5200) as few:
        assert letter.loaded == {"all", "t"} and few.loaded == {"all", "ta"}
    with index.preloaded("") as none:
        assert search.matches(none, "").count() == 5000


def test_stems():
    # The examples of the published rules.
    pairs = "caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster bled bled motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall hissing hiss fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit rational ration valenci valenc digitizer digit conformabli conform radicalli radic differentli differ vileli vile analogousli analog vietnamization vietnam predication predic operator oper feudalism feudal decisiveness decis hopefulness hope callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic formative form formalize formal electriciti electr electrical electr hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust dependent depend adoption adopt homologou homolog communism commun activate activ angulariti angular homologous homolog effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll".split()
    assert [(w, stem.stem(w)) for w in pairs[::2]] == list(zip(pairs[::2], pairs[1::2], strict=True))
    assert [stem.stem(w) for w in ("as", "été", "x1s", "")] == ["as", "été", "x1s", ""]
    assert all(w.startswith(stem.common_start(w)) for w in pairs)


def test_ranges_are_of_one_size_though_a_term_is_most_of_the_texts(spark, tmp_path):
    texts = [" ".join(["the"] * 40 + [f"w{k}"]) for k in range(3000)]
    search.write_index(records(spark, texts).coalesce(1), str(tmp_path), ranges=4)
    sizes = [r.n for r in search.Index.read(spark, str(tmp_path)).blocks.groupBy(F.input_file_name()).agg(F.sum("cf").alias("n")).collect()]
    assert sum(sizes) == 3000 * 41 and max(sizes) < 0.7 * sum(sizes)


@pytest.mark.parametrize("at_once", [1, 3, 1000])
def test_blocks_are_joined_across_batches_of_rows_that_were_sent(at_once, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(search, "_PIECE", 4)
    pick = random.Random(at_once)
    texts = {doc: pick.choices(["a", "b", "ü"], k=pick.choice([1, 9, 30])) for doc in [5, 6, 7, 1023, 1024, 1 << 33]}
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.int64()), pa.array([len(t) for t in texts.values()], pa.int32()), pa.array(texts.values(), pa.list_(pa.string()))], ["doc", "length", "words"])
    sent = pa.Table.from_batches(list(search._sent(iter([batch.slice(0, 2), batch.slice(2)]))))
    assert all(sum(r["data"][r["n"] + 1 : 2 * r["n"]]) <= 4 for r in sent.to_pylist())  # but for the first document's
    ordered = sent.sort_by([("term", "ascending"), ("block", "ascending"), ("first", "ascending")]).combine_chunks()
    rows = [r for out in search._joined(iter(ordered.to_batches(max_chunksize=at_once)), 9.5, 1.2, 0.75) for r in out.to_pylist()]
    assert len({(r["term"], r["block"]) for r in rows}) == len(rows)
    got = {(r["term"], (r["block"] << search.BLOCK_BITS) + d): (size, tuple(r["gaps"][s : s + n])) for r in rows for d, n, size, s in zip(r["docs"], r["tfs"], r["lengths"], r["starts"], strict=True)}
    places = {(t, doc): [k for k, w in enumerate(words) if w == t] for doc, words in texts.items() for t in set(words)}
    assert got == {(t, doc): (len(texts[doc]), tuple([at[0], *(y - x for x, y in zip(at, at[1:], strict=False))])) for (t, doc), at in places.items()}
    for r in rows:
        assert r["n"] == len(r["docs"]) and r["cf"] == len(r["gaps"]) and r["part"] == pytest.approx(max(n * 2.2 / (n + 1.2 * (0.25 + 0.75 * size / 9.5)) for n, size in zip(r["tfs"], r["lengths"], strict=True)))


def test_phrases_are_found_by_blocks_and_not_by_rows_of_places(index):
    plan = search.matching(index, '"real estate"')._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "posexplode" not in plan


def test_records_of_a_page_are_read_by_their_numbers(index):
    rows = search.search(index, request.SearchRequest("real"))[0]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc," in plan and rows.count() > 0
