import itertools
import random
import re
from collections import Counter

import pytest

from docketry.llm import _shared, ngramjoin


def brute(rows, n=5, threshold=0.8):
    def grams(text):
        words = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())
        return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()

    sets = [grams(t) if k is not None else set() for k, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
            links[a] += 1
            links[b] += 1
            parent[root(a)] = root(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), doc_id), doc_id) if doc_id is not None else None
    return sorted(((doc_id, least[root(k)], links[k]) for k, (doc_id, _) in enumerate(rows)), key=repr)


def case(seed, n=120):
    pick = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = [None, "", "...", "one", "One!", "a b c", "a b c d e", "a b c d e f"]
    base = [pick.choices(vocabulary, k=pick.randint(6, 90)) for _ in range(12)]
    passage = pick.choices(vocabulary, k=60)
    while len(texts) < n:
        words = list(pick.choice(base))
        for _ in range(pick.choice([0, 0, 1, 1, 2, 5])):
            words[pick.randrange(len(words))] = pick.choice(vocabulary)
        if pick.random() < 0.2:
            words += passage
        texts.append(" ".join(words))
    return [(1000 - k, t) for k, t in enumerate(texts)]


def test_band_choice_meets_the_recall():
    for threshold, recall in ((0.8, 0.999), (0.5, 0.9), (0.9, 0.99), (0.8, 0.5)):
        bands, rows = ngramjoin.choose_bands(threshold, recall)
        assert 1 - (1 - threshold**rows) ** bands >= recall and bands * rows <= 128


@pytest.mark.parametrize("options", [{}, {"block_members": 3}, {"block_grams": 300}])
def test_against_brute_force(documents, options):
    rows = case(len(options))
    out = ngramjoin.near_duplicates(documents(rows), recall=0.99999, most_hashes=400, **options)
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in out.collect()), key=repr) == brute(rows)


def test_repeated_rows_null_ids_and_empty(documents):
    rows = [(1, "x y z"), (1, "x y z"), (2, "X, y z!"), (None, "x y z"), (3, "q")]
    out = sorted(((r.doc_id, r.class_id, r.n_links) for r in ngramjoin.near_duplicates(documents(rows)).collect()), key=repr)
    assert out == sorted([(1, 1, 2), (1, 1, 2), (2, 1, 2), (None, None, 0), (3, 3, 0)], key=repr)
    assert ngramjoin.near_duplicates(documents([])).count() == 0


def test_one_document_of_each_group_stays(documents):
    rows = [*case(7), (None, "no id"), (None, "no id"), (2000, "x y z"), (2000, "x y z"), (2001, "x y z"), (2002, "q q"), (2002, "other text")]
    table = documents(rows)
    out = ngramjoin.deduplicated(table, recall=0.99999, most_hashes=400)
    assert out.columns == table.columns
    classes = {(d, c) for d, c, _ in brute([r for r in rows if r[0] is not None and (r[1] or "").strip(" .")])}
    expected = Counter(c for _, c in {(c, c) for _, c in classes}) + Counter([None, None]) + Counter(d for d, t in rows if d is not None and not (t or "").strip(" .")) + Counter([2002])
    assert Counter(r.doc_id for r in out.collect()) == expected


def test_long_text_and_components(documents, spark):
    long = " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000))
    out = {r.doc_id: (r.class_id, r.n_links) for r in ngramjoin.near_duplicates(documents([(1, long), (2, long + " more"), (3, "short")])).collect()}
    assert out == {1: (1, 1), 2: (1, 1), 3: (3, 0)}
    chain = spark.createDataFrame([(k, k + 1) for k in range(0, 40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    found = {r.id: r.component for r in _shared.components(chain).collect()}
    assert found == {k: 0 for k in range(41)} | {100: 100, 101: 100}
    assert _shared.components(chain.limit(0)).count() == 0


def test_a_chain_is_verified_by_bucket(documents, monkeypatch):
    """Windows that slide over one long text: a single group of candidates, in which only neighbours are alike."""
    rows = [(k, " ".join(f"w{i}" for i in range(5 * k, 5 * k + 120))) for k in range(140)] + [(200 + k, "dense " + " ".join(f"v{i}" for i in range(80)) + f" own{k}") for k in range(30)]
    seen = []
    placed = ngramjoin._placed
    monkeypatch.setattr(ngramjoin, "_placed", lambda *a: seen.append(placed(*a)) or seen[-1])
    out = ngramjoin.near_duplicates(documents(rows), block_members=4)
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in out.collect()), key=repr) == brute(rows)
    bands = {r.first_id: [p.band for p in r.places] for r in seen[0].collect()}
    assert all(min(bands[k]) >= 0 for k in range(140)) and all(bands[200 + k] == [-1] for k in range(30))


def test_too_few_hashes_are_refused():
    with pytest.raises(ValueError, match="recall"):
        ngramjoin.choose_bands(0.2, 0.999, most=10)
