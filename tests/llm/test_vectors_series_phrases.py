"""Exact top-k search, penalised change points and collocations against brute force."""

import itertools
import math
import random
import re
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketry.llm import changepoints, collocations, topk

VECTORS = "vec_id long, embedding array<float>, label int, row string, score string, band string, v string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, 1, "clash", "clash", "clash", "clash") for i, e in rows], VECTORS)


def best_by_hand(rows, every, k):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in e]) for i, e in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for a, (query, q) in enumerate(kept):
        if query is None or query % every:
            continue
        scores = [(sum(x * y for x, y in zip(q, e, strict=False)), i) for b, (i, e) in enumerate(kept) if a != b]
        scores.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out += [(query, rank, i, score) for rank, (score, i) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


def searched(spark, rows, every=5, k=3, **options):
    found = topk.top_k(vectors(spark, rows), F.col("vec_id") % every == 0, k, **options)
    return sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()), key=repr)


@pytest.mark.parametrize("spread", ["equal", "steep"])
def test_search_equals_brute_force(spark, spread):
    pick = np.random.default_rng(3)
    made = pick.normal(size=(300, 12)) * (1 if spread == "equal" else np.exp(pick.normal(size=(300, 1)) * 2))
    rows = [(i, [float(x) for x in e]) for i, e in enumerate(made)]
    assert searched(spark, rows, head=16, band_components=240, query_components=120) == best_by_hand(rows, 5, 3)


def test_search_with_ties_repeats_and_broken_vectors(spark):
    same = [0.5, -0.25, 0.125]
    rows = [(i, same) for i in range(40)] + [(5, same), (5, [1.0, 1.0, 1.0]), (None, same), (10, None), (15, [None, 1.0, 1.0]), (20, [float("nan"), 1.0, 0.0]), (25, [float("inf"), 0.0, 0.0]), (30, []), (35, [2.0]), (7, [0.0, 0.0, 0.0])]
    assert searched(spark, rows, head=4) == best_by_hand(rows, 5, 3)


def test_search_of_few_or_no_rows(spark):
    assert searched(spark, []) == []
    assert searched(spark, [(5, [1.0])]) == []
    assert searched(spark, [(1, [1.0]), (2, [1.0])]) == []
    assert searched(spark, [(5, [1.0]), (1, [-1.0])]) == [(5, 1, 1, -65536)]
    assert searched(spark, [(5, []), (10, [])]) == [(10, 1, 5, 0), (5, 1, 10, 0)]


def test_pruning_drops_most_exact_products(monkeypatch):
    pick = np.random.default_rng(5)
    base = (pick.normal(size=(4000, 32)) * np.exp(pick.normal(size=(4000, 1))) * 256).astype(np.int32)
    counts = []
    plain = topk._row_products
    monkeypatch.setattr(topk, "_row_products", lambda a, b, i, j: counts.append(len(i)) or plain(a, b, i, j))
    rotation = np.linalg.eigh(base.astype(float).T @ base)[1][:, ::-1]
    ids = np.arange(4000)
    best = topk._search(base, ids, ids, base[:50], ids[:50], np.full(50, topk._NONE), rotation, 5, at_once=256)
    exact = base[:50].astype(np.int64) @ base.T.astype(np.int64)
    exact[np.arange(50), np.arange(50)] = topk._NONE
    for q in range(50):
        assert sorted(best.score[best.query == q]) == sorted(np.sort(exact[q])[-5:])
    assert sum(counts) < 50 * 4000 / 10


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(5, [7_000_001.0, 3.0]), (1, [7_000_003.0, 5.0]), (2, [7_000_001.0, 9.0])]
    assert searched(spark, rows, k=2) == best_by_hand(rows, 5, 2)
    with pytest.raises(Exception, match="31 bits"):
        searched(spark, [(5, [1e9]), (1, [1.0])])


def cheapest(values, least=5, penalty=10_000):
    """All divisions of a short series: cost, segments and starts from the last backwards decide."""
    n = len(values)

    def cost(a, b):
        part, m = values[a:b], b - a
        spread = 1 + (m * sum(x * x for x in part) - sum(part) ** 2) // (m * m)
        return m * math.floor(1000 * math.log(spread)), sum(part), spread

    found = []
    for k in range(0, n // least):
        for cuts in itertools.combinations(range(1, n), k):
            edges = [0, *cuts, n]
            if k == 0 or all(b - a >= least for a, b in itertools.pairwise(edges)):
                found.append((sum(cost(a, b)[0] for a, b in itertools.pairwise(edges)) + penalty * k, k, edges[:-1][::-1]))
    total, k, starts = min(found or [(cost(0, n)[0], 0, [0])])
    edges = [*starts[::-1], n]
    return total, [(a, b - a, *(cost(a, b)[x] for x in (1, 2, 0))) for a, b in itertools.pairwise(edges)]


def test_segments_equal_all_divisions():
    pick = random.Random(2)
    series = [[pick.choice([0, 1, 5, 400]) * (1 + (i > 11)) for i in range(n)] for n in [1, 2, 4, 5, 9, 10, 11, 17, 22, 23]] + [[0] * 20, [7] * 20, [0] * 10 + [9] * 10, [0, 90] * 10]
    for penalty in (0, 500, 10_000):
        for values, (starts, sums, spreads, costs, total) in zip(series, changepoints.segment([np.array(s) for s in series], 5, penalty), strict=True):
            expected, parts = cheapest(values, 5, penalty)
            assert total == expected
            assert [(int(a), int(n), int(s), int(v), int(c)) for a, n, s, v, c in zip(starts, np.diff([*starts, len(values)]), sums, spreads, costs, strict=True)] == parts


def test_segments_of_numbers_beyond_64_bits():
    values = [3 * 10**12, 1, 10**12, 5, 7, 10**3, 10**3, 10**3, 10**3, 10**3 + 1]
    (_, sums, _, _, total), (expected, parts) = changepoints.segment([np.array(values)])[0], cheapest(values)
    assert total == expected and [int(s) for s in sums] == [p[2] for p in parts]


LINES = "vendor_id long, quantity int, flag string, shipped_at timestamp_ntz, key string, day string, total string, sale_id long"


def test_vendor_series(spark):
    day = lambda n: datetime(2024, 1, 1, 13) + timedelta(days=n)
    rows = [(1, 3, "kept", day(n)) for n in range(8)] + [(1, 3, "kept", day(0))] * 2 + [(1, 5000, "swapped", day(n)) for n in range(20, 30)]
    rows += [(2, 4, "kept", day(3)), (None, 1, "kept", day(1)), (None, 1, "kept", day(9)), (3, None, "kept", day(0)), (3, 5, "kept", None), (3, 5, "returned", day(0)), (3, 5, None, day(0))]
    frame = spark.createDataFrame([(*r, "clash", "clash", "clash", 0) for r in rows], LINES)
    found = {}
    for r in changepoints.vendor_change_points(frame).orderBy("vendor_id", "segment_no").collect():
        found.setdefault(r.vendor_id, []).append(r)
    assert set(found) == {None, 1, 2}
    values = [0] * 30
    for v, q, flag, at in rows:
        if v == 1:
            values[(at.date() - day(0).date()).days] += q
    total, parts = cheapest(values)
    first = (day(0).date() - datetime(1970, 1, 1).date()).days
    assert [(r.first_day - first, r.n_days, r.total, r.spread, r.cost) for r in found[1]] == parts
    assert {(r.n_segments, r.best_cost) for r in found[1]} == {(len(parts), total)}
    assert len(parts) > 1 and [r.segment_no for r in found[1]] == list(range(1, len(parts) + 1))
    assert [(r.n_days, r.total, r.spread, r.cost, r.best_cost) for r in found[2]] == [(1, 4, 1, 0, 0)]
    assert sum(r.total for r in found[None]) == 2 and sum(r.n_days for r in found[None]) == 9
    assert changepoints.vendor_change_points(frame.where("vendor_id = 3")).count() == 0


def phrases_by_hand(rows, longest, least, most, absorbed):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        plain = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", plain):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    kept = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    found = {}
    for (lang, w), a in kept.items():
        if any(v >= absorbed * a for (other, longer), v in kept.items() if other == lang and len(longer) > len(w) and any(longer[i : i + len(w)] == w for i in range(len(longer)))):
            continue
        score, _, left, right = min((10**6 * a * a // (counts[lang, w[:c]] * counts[lang, w[c:]]), c, counts[lang, w[:c]], counts[lang, w[c:]]) for c in range(1, len(w)))
        found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, rank, p.decode(), -a, left, right, totals[lang], -s) for lang, own in found.items() for rank, (s, a, p, left, right) in enumerate(sorted(own)[:most], 1))


def phrases(spark, rows, **options):
    frame = spark.createDataFrame([(lang, text, "clash", "clash", 1) for lang, text in rows], "lang string, text string, phrase string, score string, n long")
    found = collocations.collocations(frame, **options)
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found.collect())


@pytest.mark.parametrize(("longest", "salts"), [(2, 1), (3, 3), (4, 2)])
def test_collocations_equal_brute_force(spark, longest, salts):
    pick = random.Random(longest)
    words = ["New", "york", "City", "the", "of", "a", "É", "é", "漢", "x1", "state", "U.S.", "end?"]
    rows = [(pick.choice(["en", "en", "en", "fr", None, "und"]), pick.choice([" ", "\t", "  "]).join(pick.choice([words[:3], [pick.choice(words)]])[0] if pick.random() < 0.2 else pick.choice(words) for _ in range(pick.randint(0, 60)))) for _ in range(150)]
    rows += [("en", "new york city state " * 30), ("en", None), ("fr", ""), ("fr", " .\n, "), ("en", "aaa aaa aaa " * 20)] + [("de", "immer wieder gleich. ")] * 12
    options = {"longest": longest, "least": 6, "most": 40, "absorbed": 0.5}
    assert phrases(spark, rows, salts=salts, **options) == phrases_by_hand(rows, **options)


def test_collocations_of_nothing(spark):
    assert phrases(spark, []) == []
    assert phrases(spark, [("en", "one two three")]) == []
    assert phrases(spark, [(None, None)]) == []


def test_a_full_filter_changes_no_count(spark):
    rows = [("en", "the quick fox and the quick dog. " * 8), ("en", "a b c d e f g " * 3)]
    frame = spark.createDataFrame(rows, "lang string, text string")
    tables, totals = collocations.levels(frame, 3, 5, most_bits=1 << 6)
    got = {(r.phrase, r.n) for t in tables for r in t.collect()}
    exact, _ = collocations.levels(frame, 3, 5)
    assert got == {(r.phrase, r.n) for t in exact for r in t.collect()} and ("the quick", 16) in got


@pytest.mark.parametrize("at_once", [8, 50, 333])
def test_texts_longer_than_a_run_are_counted_whole(at_once):
    import pyarrow as pa

    pick = random.Random(at_once)
    texts = ["".join(pick.choice(["ab", "c", " ", " ", ".", "def ", "\t"]) for _ in range(200)) for _ in range(5)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "fr", "en", "en", "fr"]), pa.array([t.encode() for t in texts])], ["lang", "text"])
    everything = collocations.Phrases(np.full(1, 2**64 - 1, np.uint64), 64)
    for k in (1, 2, 3, 4):
        got, expected = Counter(), Counter()
        for lang, plain in collocations.runs_of(iter([batch]), k - 1, at_once):
            found, counts = collocations.counted(lang, plain, k, everything)
            got.update({(lang, p): int(n) for p, n in zip(found.to_pylist(), counts, strict=True)})
        for lang, text in zip(["en", "fr", "en", "en", "fr"], texts, strict=True):
            for piece in text.split("."):
                words = piece.split()
                expected.update((lang, " ".join(words[i : i + k])) for i in range(len(words) - k + 1))
        assert got == expected


def test_distinct_rows_of_large_numbers():
    columns = [np.array([2**40, 2**40, 1, 2**40]), np.array([5, 5, 2, 6]), np.array([1, 1, 1, 1])]
    found, counts = collocations._distinct(columns, 2**41)
    assert sorted(zip(*[c.tolist() for c in found], counts.tolist(), strict=True)) == [(1, 2, 1, 1), (2**40, 5, 1, 2), (2**40, 6, 1, 1)]
