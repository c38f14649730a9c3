import hashlib
import math
import random
import re

from docketry.llm import mixing

SCHEMA = "doc_id long, source string, text string, target long, size string"


def brute(rows, weights=(3, 1, 2), share=1.5, repeats=2):
    size = lambda t: len(re.findall(mixing.WORD, t or ""))
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = {s: sum(size(r[2]) for r in rows if r[1] == s) for s in sources}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    left, targets, free = share * sum(sizes.values()), {}, set(sources)
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > repeats * sizes[s]}
        if not over:
            targets |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            targets[s] = repeats * sizes[s]
        left -= sum(targets[s] for s in over)
        free -= over
    out = []
    for s in sources:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: (hashlib.md5(("" if r[0] is None else str(r[0])).encode()).hexdigest(), size(r[2])))
        taken, at, stop = [0] * len(own), 0, math.floor(targets[s] + 1e-6)
        for _ in range(repeats):
            for k, r in enumerate(own):
                taken[k] += max(0, min(size(r[2]), stop - at))
                at += size(r[2])
        out += [(r[0], size(r[2]), sizes[s], round(targets[s], 6), taken[k]) for k, r in enumerate(own)]
    return sorted(out, key=repr)


def got(frame):
    return sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in frame.collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, 5, "clash") for r in rows], SCHEMA)


def test_against_brute_force(spark):
    pick = random.Random(3)
    for case in range(4):
        sources = ["a", "b", "c", "é", None, "Z"][: 2 + case]
        rows = [(k, pick.choice([*sources, "a", "a"]), pick.choice([None, "", "x", "one two\tthree", "w " * pick.randint(1, 40), "nb\xa0sp x"])) for k in range(60)]
        for block_rows in (4096, 8):
            assert got(mixing.mix(table(spark, rows), block_rows=block_rows)) == brute(rows)


def test_skewed_targets_are_reshared(spark):
    rows = [(k, "tiny", "x") for k in range(3)] + [(100 + k, "huge", "y " * 50) for k in range(20)] + [(200, "mid", "z " * 30)]
    out = got(mixing.mix(table(spark, rows)))
    assert out == brute(rows)
    assert sum(r[4] for r in out) == math.floor(1.5 * sum(r[1] for r in out))
    assert all(r[4] <= 2 * r[1] for r in out)


def test_repeated_rows_nulls_and_empty(spark):
    rows = [(1, "a", "x y")] * 3 + [(None, None, "q w e"), (2, "b", None)]
    assert got(mixing.mix(table(spark, rows))) == brute(rows)
    assert mixing.mix(table(spark, rows).limit(0)).count() == 0
    only_empty = [(1, "a", ""), (2, None, None)]
    assert got(mixing.mix(table(spark, only_empty))) == brute(only_empty)


def test_documents_of_the_mix(spark):
    rows = [(k, "ab"[k % 2], "w%d " % k * (k + 1)) for k in range(12)]
    mixed = mixing.mixed_documents(table(spark, rows))
    assert mixed.columns == ["doc_id", "source", "text", "target", "size"]
    words = {}
    for r in mixed.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(re.findall(mixing.WORD, r.text))
    assert words == {r[0]: r[4] for r in brute(rows) if r[4]}


def test_the_cut_is_where_the_budget_ends(spark):
    """The kept pieces, in order of finish time, are exactly the head of the global order that the budget pays for."""
    pick = random.Random(9)
    rows = [(k, pick.choice(["a", "b", "b", "b", None]), "w " * pick.randint(0, 30)) for k in range(80)]
    narrow = table(spark, rows)
    scheduled = mixing.schedule(narrow, mixing.words(mixing.F.col("text")), block_rows=8)
    pieces = sorted(tuple(p) for r in scheduled.select(mixing.quanta(2).alias("q")).collect() for p in r.q)
    budget = sum(math.floor(t + 1e-6) for t in {(r._source, r.target) for r in scheduled.collect()} for t in [t[1]])
    at, spent = mixing.cut(scheduled, 2, stretches=7).first()["cut"], 0
    for piece in pieces:
        if spent + piece[3] > budget:
            break
        spent += piece[3]
    assert tuple(at["at"]) == piece and at["left"] == budget - spent and piece[0] > 1
    finished = {}
    for finish, source, begins, n in pieces:
        if finish <= 1:
            finished[source] = finished.get(source, 0) + n
    assert sum(finished.values()) == budget


def test_edges_of_the_mix(spark):
    rows = [(1, "a", "x y")] * 3 + [(None, None, "q w e"), (2, "b", None), (3, "b", "  "), (4, "b", "é " * 50_000)]
    mixed = mixing.mixed_documents(table(spark, rows))
    got_words = {}
    for r in mixed.collect():
        got_words[r.doc_id] = got_words.get(r.doc_id, 0) + len(re.findall(mixing.WORD, r.text))
    expected = {}
    for r in brute(rows):
        expected[r[0]] = expected.get(r[0], 0) + r[4]
    assert got_words == {k: v for k, v in expected.items() if v}
    assert mixing.mixed_documents(table(spark, rows).limit(0)).count() == 0
