import hashlib
import random

import pytest
import regex
import xxhash

from docketry.llm import spotsigs

ANCHORS = set(spotsigs.ANCHORS)


def signatures(text):
    plain = regex.sub(r"[^\p{L}\p{N}]+", " ", (text or "").lower()).strip(" ")
    words, out = plain.split(" "), set()
    for k, word in enumerate(words):
        chain = [w for w in words[k + 1 :] if w not in ANCHORS][:2]
        if word in ANCHORS and len(chain) == 2:
            out.add("\x01" + " ".join([word, *chain]))
    return {xxhash.xxh64(s.encode(), seed=42).intdigest() & 0xFFFFFFFF for s in out or {"whole text: " + plain}}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, new, following = signatures(text), signatures(edited), signatures(after)
        show = lambda s: "".join(f"{x:08x}" for x in sorted(s))
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), show(own), show(new), round(jaccard(own, new), 12), round(jaccard(own, following), 12)))
    return out


def texts(n, seed):
    pick = random.Random(seed)
    words = ["the", "of", "und", "le", "el", "cat", "dog", "Haus", "été", "🙂", "x1", "a", "river"]
    return [None, "", "the the the", "the of a", "漢字 the cat, dog", "the " * 300 + "cat dog"] + [" ".join(pick.choices(words, k=pick.randint(1, 50))) for _ in range(n)]


@pytest.mark.parametrize("block_rows", [4096, 9])
def test_against_brute_force(documents, block_rows):
    pick = random.Random(block_rows)
    ids = pick.sample(range(-1000, 1000), 50) + pick.sample(range(10**15, 10**15 + 9), 6)
    rows = list(zip(ids, texts(50, block_rows), strict=False))
    got = [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 12), round(r.near_next, 12)) for r in spotsigs.fingerprints(documents(rows), block_rows).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_edge_cases(documents):
    only = spotsigs.fingerprints(documents([(1, "abcd")])).first()
    assert only.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and only.near_next == 1.0
    out = spotsigs.fingerprints(documents([(None, "x"), (None, "x"), (3, "y"), (3, "y"), (3, "z"), (-(2**63), "m"), (2**63 - 1, "q")])).collect()
    assert len(out) == 7
    assert spotsigs.fingerprints(documents([])).count() == 0
    same = spotsigs.fingerprints(documents([(k, t) for k, t in enumerate([None, "", "", "the cat sat", "the cat sat"])])).collect()
    assert len({r.fingerprint for r in same}) == 2


def test_near_pairs(documents):
    pick = random.Random(9)
    base = [[pick.choice(["the", "of", "a", *[f"w{k}" for k in range(200)]]) for _ in range(400)] for _ in range(6)]
    rows = []
    for k in range(60):
        words = list(pick.choice(base))
        for _ in range(pick.choice([0, 1, 1, 2])):
            words[pick.randrange(400)] = "the" if pick.random() < 0.5 else f"n{k}"
        rows.append((k, " ".join(words)))
    pairs, members = spotsigs.near_pairs(documents([*rows, (60, rows[0][1]), (None, "x")]), 0.8)
    sets = {k: signatures(t) for k, t in rows}
    sets[60] = sets[0]
    least = {k: min(j for j in sets if sets[j] == s) for k, s in sets.items()}
    assert {r.doc_id: r.class_id for r in members.collect()} == least
    reps = sorted(set(least.values()))
    expected = {(a, b) for a in reps for b in reps if a < b and jaccard(sets[a], sets[b]) >= 0.8 - 1e-9}
    assert {(r.a, r.b) for r in pairs.collect()} == expected and expected


def test_near_pairs_of_nothing(documents):
    pairs, members = spotsigs.near_pairs(documents([]))
    assert pairs.count() == members.count() == 0
    pairs, members = spotsigs.near_pairs(documents([(1, None), (2, ""), (2, ""), (3, "the cat sat")]))
    assert pairs.count() == 0 and sorted((r.doc_id, r.class_id) for r in members.collect()) == [(1, 1), (2, 1), (2, 1), (3, 3)]


def test_blocks_of_many_tasks(documents):
    rows = [(k * 3, f"the word{k} of text{k % 50} and {k}") for k in range(200)]
    few = spotsigs.with_next(documents(rows), block_rows=16, task_rows=40)
    ahead = {r._id: r._next_text for r in few.collect()}
    assert ahead == {k * 3: rows[k - 1][1] for k in range(200)}


def test_one_id_of_many_rows_is_many_blocks(documents):
    """A third of the rows has one id, a third none: all in small blocks, each row before the next by falling hash, and the edge ids keep their places."""
    from pyspark.sql import functions as F

    rows = [(7, f"same {k}") for k in range(300)] + [(None, f"none {k}") for k in range(300)] + [(k * 5, f"own {k}") for k in range(300)] + [(2**63 - 1, f"last {k}") for k in range(90)] + [(-(2**63), "first")]
    docs = documents(rows)
    blocks, n = spotsigs._blocks(docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash")), 16)
    sizes = [r["count"] for r in blocks.groupBy("_block").count().collect()]
    assert n == len(rows) and max(sizes) <= 48 and sum(sizes) == n
    few, _ = spotsigs._blocks(docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash")), 1, most=100)
    assert few.select("_block").distinct().count() <= 200
    signed = lambda t: (lambda h: h - 2**64 if h >= 2**63 else h)(xxhash.xxh64(t.encode(), seed=42).intdigest())
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -signed(r[1])))
    expected = {order[k]: order[(k + 1) % len(order)][1] for k in range(len(order))}
    got = {(r._id, r._text): r._next_text for r in spotsigs.with_next(docs, block_rows=16, task_rows=100).collect()}
    assert got == expected


def test_no_python_in_the_plan(documents):
    plan = spotsigs.fingerprints(documents([(1, "a")]))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "MapInArrow"))
