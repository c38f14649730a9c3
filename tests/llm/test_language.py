import random
import zlib

import numpy as np

from docketry.llm import langid

WORDS = {"en": "the of and house river green running under small bright", "de": "der die und haus fluss grün laufen unter klein straße", "fr": "le la les maison rivière vert courant sous petit lumière"}


def text(language, pick, n=30):
    return " ".join(pick.choices(WORDS[language].split(), k=n))


def rows(n=300, seed=4):
    pick = random.Random(seed)
    out = []
    for k in range(n):
        language = pick.choice(list(WORDS))
        out.append((k, text(language, pick), language, "s"))
    return out


def grams(value, n):
    letters = "".join(c if c.isalpha() else " " for c in value.lower())
    return [w for w in (" " * (n - 1) + " ".join(letters.split()) + " " * (n - 1),)][0]


def test_gram_hashes_follow_the_text():
    a, owner = langid.gram_hashes(["Ab c", "ab, c", "x"], 4)
    by = [sorted(a[owner == k].tolist()) for k in range(3)]
    assert by[0] == by[1] and len(by[2]) >= 1 and set(by[2]).isdisjoint(by[0])
    whole, _ = langid.gram_hashes(["ab c"], 4)
    assert len(whole) == len(grams("ab c", 4)) - 3


def test_filters_hold_every_language_of_a_gram_and_correct_false_positives():
    pick = np.random.default_rng(1)
    profiles = {x: langid.mixed(pick.integers(0, 1 << 63, 3000, np.uint64)) for x in "abc"}
    profiles["b"][:1000] = profiles["a"][:1000]
    model = langid.build(profiles, list("abc"), 4, slot_bits=13, hashes=2)
    for k, x in enumerate("abc"):
        found = np.full(3000, np.uint64((1 << 64) - 1))
        for at in model.slots(profiles[x]):
            found &= model.masks[0][at]
        assert ((found >> np.uint64(k)) & np.uint64(1)).all()
    strange = langid.mixed(pick.integers(0, 1 << 63, 200_000, np.uint64))
    found = np.full(len(strange), np.uint64((1 << 64) - 1))
    for at in model.slots(strange):
        found &= model.masks[0][at]
    for k in range(3):
        assert abs(((found >> np.uint64(k)) & np.uint64(1)).mean() - model.false_rate[k]) < 0.01


def test_more_than_64_languages():
    profiles = {f"l{k}": np.arange(k * 10, k * 10 + 10, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for k in range(70)}
    model = langid.build(profiles, sorted(profiles), 4, slot_bits=16, hashes=2)
    assert model.masks.shape[0] == 2
    assert all(model.false_rate < 1e-4)


def test_held_out_accuracy_and_edge_cases(documents):
    table = documents([*rows(), (1000, None, "en", "s"), (1001, "", "en", "s"), (1002, "12 34 !", "de", "s"), (1003, "é", None, "s"), (None, "the house of the river", None, None), (5, "der fluss und das haus " * 3000, "de", "s")])
    out = langid.identify(table).collect()
    assert len(out) == 306
    truth = {r[0]: r[2] for r in rows()}
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 20 and all(r.lang_pred == truth[r.doc_id] for r in held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)
    odd = {r.doc_id: (r.lang_pred, r.score) for r in out if r.doc_id is None or r.doc_id >= 1000}
    assert odd[1000] == odd[1001] == odd[1002] == ("und", 0.0) and odd[1003][0] in WORDS and odd[None][0] == "en"
    assert all(0 <= r.score <= 1 for r in out)


def test_predictions_do_not_look_at_other_columns(documents):
    base = documents(rows())
    model = langid.fit(base)
    from pyspark.sql import functions as F

    changed = base.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy"))
    pairs = [sorted((r.doc_id, r.lang_pred, r.score) for r in langid.identify(t, model).collect()) for t in (base, changed)]
    assert pairs[0] == pairs[1]


def test_nothing_to_learn(documents):
    assert langid.identify(documents([])).count() == 0
    out = langid.identify(documents([(1, "abc", None, "s")])).first()
    assert (out.lang_pred, out.score) == ("und", 0.0)


def test_rejection_keeps_clean_documents(documents):
    table = documents([*rows(60), (900, "1 2 3", "en", "s"), (901, None, "en", "s"), (902, "ωωω ψψψ ξξξ", "en", "s")])
    out = langid.accepted(table, langid.fit(documents(rows())))
    assert out.columns == table.columns
    assert {r.doc_id for r in out.collect()} == set(range(60))


def test_the_filter_grows_with_the_profiles_and_never_drops_a_language():
    profiles = {"a": langid.mixed(np.arange(100_000, dtype=np.uint64)), "b": langid.mixed(np.arange(7, dtype=np.uint64))}
    model = langid.build(profiles, ["a", "b"], 4, slot_bits=4, hashes=3)
    assert model.masks.shape[1] == 1 << 21 and model.false_rate[0] < 0.01
    try:
        langid.build(profiles, ["a", "b"], 4, slot_bits=4, hashes=3, most_bytes=1 << 20)
        raise AssertionError("no error")
    except ValueError as error:
        assert "2 languages" in str(error)


def brute_languages(rows, n=4, min_share=0.01, min_ratio=0.34, bits=18, hashes=3):
    """Predictions by sets of n-grams and one Bloom filter for each language, from what the docstrings say."""
    mask64 = (1 << 64) - 1

    def mixed(v):
        v = (v ^ (v >> 30)) * 0xBF58476D1CE4E5B9 & mask64
        v = (v ^ (v >> 27)) * 0x94D049BB133111EB & mask64
        return v ^ (v >> 31)

    def grams_of(value):
        words = "".join(c if c.isalpha() else " " for c in value.lower()).split()
        plain = " " * (n - 1) + " ".join(words) + " " * (n - 1) if words else ""
        return [plain[i : i + n] for i in range(len(plain) - n + 1)]

    def slots(gram):
        h = 0
        for c in gram:
            h = (h * 0x9E3779B97F4A7C15 + ord(c)) & mask64
        h = mixed(h)
        return [(mixed((h + (k * 0x632BE59BD9B4E019 & mask64)) & mask64) if k else h) >> (64 - bits) for k in range(hashes)]

    learn = [(t, lang) for k, t, lang in rows if zlib.crc32(str(k).encode()) % 5 and lang is not None and t is not None]
    languages = sorted({x for _, x in learn}, key=lambda x: (-sum(y == x for _, y in learn), x))
    rates = {}
    for x in languages:
        own = [set(grams_of(t)) for t, y in learn if y == x]
        seen = {}
        for s in own:
            for g in s:
                seen[g] = seen.get(g, 0) + 1
        rates[x] = {g: c / len(own) for g, c in seen.items() if c >= max(2.0, len(own) * min_share)}
    filters = {}
    for x in languages:
        top = lambda g: max(r.get(g, 0) for r in rates.values())
        filters[x] = {s for g, r in rates[x].items() if r >= min_ratio * top(g) for s in slots(g)}
    out = {}
    for k, t, _ in rows:
        found = grams_of(t or "")
        if not found:
            out[k] = ("und", 0.0)
            continue
        shares = []
        for x in languages:
            false = (len(filters[x]) / (1 << bits)) ** hashes
            share = sum(all(s in filters[x] for s in slots(g)) for g in found) / len(found)
            shares.append((share - false) / (1 - false))
        best = max(range(len(languages)), key=lambda i: (round(shares[i], 12), -i))
        out[k] = (languages[best], min(1.0, max(0.0, shares[best])))
    return out


def test_against_brute_force(documents):
    table = rows(150, 9)
    pick = random.Random(3)
    table += [(200 + k, text(pick.choice(["en", "de"]), pick, 5) + " " + text("fr", pick, 4), pick.choice(["en", "fr", None]), "s") for k in range(40)]
    table += [(300, None, "en", "s"), (301, "", "de", "s"), (302, "12 ,", "fr", "s"), (303, "q", None, "s"), (304, "the the the", "en", "s")]
    expected = brute_languages([r[:3] for r in table])
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(documents(table)).collect()}
    assert set(got) == set(expected)
    for k, (language, share) in expected.items():
        assert got[k][0] == language and abs(got[k][1] - share) < 1e-9, (k, got[k], expected[k])


def test_accepting_from_an_empty_table(documents):
    model = langid.fit(documents(rows(60)))
    assert langid.accepted(documents([]), model).count() == 0 and langid.accepted(documents([])).count() == 0
