import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docketry.llm import packing, tokencount

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_are_the_librarys(library, odd_texts):
    whole, tiny = tokencount.TokenCounter(PATH), tokencount.TokenCounter(PATH, chunk=7)
    expected = [len(ids(library, t)) for t in odd_texts]
    assert whole.counts(odd_texts) == expected
    assert tiny.counts(odd_texts) == expected


def test_every_code_point(library):
    points = [chr(k) for k in [*range(1, 0xD800), *range(0xE000, 0x30000, 7)]]
    texts = ["a" + "".join(f"1{p}{p} b{p}c\n{p} " for p in points[i : i + 50]) for i in range(0, len(points), 50)]
    counter = tokencount.counter(PATH)
    assert counter.counts(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_transducer_agrees_with_merging_and_survives_a_full_cache():
    ranks, _ = tokencount.load_vocabulary(PATH)
    machine = tokencount.Transducer(tokencount.load_merges(PATH)[0], max_states=50, max_words=5)
    pick = random.Random(1)
    for _ in range(400):
        word = bytes(pick.choice(b" aeinrstth\xc3\xa9") for _ in range(pick.randint(1, 40)))
        assert machine.count(word) == len(tokencount.bpe(word, ranks))


SIGNS = ["a", "e", "in", "the", " ", "  ", "\n", "\u00a0", "'", "''", "s", "re", "l", "ve", "'ll", "1", "23", "-", "!'", "漢", "字", "é", "🙂"]


def stretches(pick, counter, text):
    """The state maps of a text cut anywhere, with entries that may be wrong guesses."""
    maps, at = [], 0
    while at < len(text):
        part = text[at : at + pick.randint(1, 12)]
        border = counter._borders(part) if pick.random() < 0.7 else None
        if border:
            own = tokencount.Bordered(counter.reader, part[: border[0]], part[border[1] :])
            inside = part[border[0] : border[1]]
            own.inner = counter.counts([inside])[0]
        else:
            own = tokencount.Unbroken(counter.reader, part)
        for _ in range(pick.randint(0, 2)):
            own[counter.reader.read("".join(pick.choices(SIGNS, k=3)))[0]]
        maps.append(own)
        at += len(part)
    return maps


def test_state_maps_compose_in_any_bracketing(library):
    counter = tokencount.counter(PATH)
    pick = random.Random(2)
    for _ in range(400):
        text = "".join(pick.choices(SIGNS, k=pick.randint(1, 60)))
        maps = stretches(pick, counter, text)
        while len(maps) > 1:
            k = pick.randrange(len(maps) - 1)
            maps[k : k + 2] = [maps[k].then(maps[k + 1])]
        state, emitted = maps[0][tokencount.START]
        assert emitted + counter.reader.due(state) == len(ids(library, text)), text


def test_prefix_scan_counts_every_beginning(library):
    counter = tokencount.counter(PATH)
    pick = random.Random(3)
    for _ in range(60):
        text = "".join(pick.choices(SIGNS, k=80))
        cuts = list(range(5, len(text) + 5, 5))
        maps = [tokencount.Unbroken(counter.reader, text[c - 5 : c]) for c in cuts]
        ends = [m[tokencount.START] for m in tokencount.prefix_scan(maps)]
        assert [n + counter.reader.due(state) for state, n in ends] == [len(ids(library, text[:c])) for c in cuts]


def test_entries_meet_soon_in_long_words():
    counter = tokencount.TokenCounter(PATH)
    own = tokencount.Unbroken(counter.reader, "abcdefgh" * 1000)
    own[tokencount.START]
    read, asked = counter.reader.read, []
    counter.reader.read = lambda text, state: asked.append(len(text)) or read(text, state)
    entry = read("xyz")[0]
    found = own[entry]
    assert sum(asked) <= 512 and found == read("abcdefgh" * 1000, entry)


def test_offsets_of_chunks(library, odd_texts):
    counter = tokencount.TokenCounter(PATH, chunk=9)
    mixed = "".join(random.Random(6).choices([*SIGNS, "<|endoftext|>"], k=900))
    for text in [*odd_texts, mixed, "don't " * 50]:
        found = counter.offsets(text)
        assert [before for _, before in found] == [len(ids(library, text[:start])) for start, _ in found]
        assert bool(found) == bool(text)


def test_offsets_of_documents(documents, library, odd_texts):
    long = "one two " * 5000
    out = tokencount.token_offsets(documents([(1, long), (2, None), (3, ""), (4, "x"), (4, "x")]), PATH).collect()
    assert sorted((r.doc_id, r.chunk_no, r.start, r.tokens_before) for r in out) == [
        *[(1, k, at, len(ids(library, long[:at]))) for k, at in enumerate(range(0, len(long), 8192))], (4, 0, 0, 0), (4, 0, 0, 0)
    ]
    assert tokencount.token_offsets(documents([]), PATH).count() == 0


def test_pairs_and_entries_are_told_as_merging_does():
    merges, _ = tokencount.load_merges(PATH)
    ranks, _ = tokencount.load_vocabulary(PATH)
    machine = tokencount.Transducer(merges)
    pick = random.Random(4)
    tokens = sorted(machine.tokens, key=machine.tokens.get)
    for token in pick.sample(tokens, 3000):
        assert machine.begins(machine.tokens[token]) == (tokencount.bpe(token, ranks) == [token])
    common = tokens[: 256 + 600]
    for _ in range(20_000):
        left, right = pick.choice(common), pick.choice(common)
        assert machine.joins(machine.tokens[left], machine.tokens[right]) == (tokencount.bpe(left + right, ranks) == [left, right])


def test_small_merge_lists_with_repeats():
    """Alphabets of two signs, where equal merges meet themselves."""
    pick = random.Random(5)
    for _ in range(60):
        merges, known = [], [b"a", b"b"]
        for _ in range(pick.randint(1, 8)):
            pair = (pick.choice(known), pick.choice(known))
            if pair[0] + pair[1] not in known:
                merges.append(pair)
                known.append(pair[0] + pair[1])
        ranks = {pair: k for k, pair in enumerate(merges)}
        machine = tokencount.Transducer(merges, max_states=30)

        def merge(word, ranks=ranks):
            parts = [word[i : i + 1] for i in range(len(word))]
            while pairs := [(ranks[x], i) for i, x in enumerate(zip(parts, parts[1:], strict=False)) if x in ranks]:
                _, at = min(pairs)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            return parts

        for _ in range(100):
            word = bytes(pick.choice(b"ab") for _ in range(pick.randint(1, 30)))
            assert machine.count(word) == len(merge(word)), (merges, word)


def test_long_words_without_a_border(library):
    """Runs that no certain border cuts, at the real chunk size and a small one."""
    pick = random.Random(7)
    texts = ["".join(pick.choice("漢字仮名交文水火木金土") for _ in range(30_000)), " " + "a" * 70_000, "x'" + "ab" * 30_000, "!" * 66_000 + "'s", " " * 50_000, "\n\t " * 20_000 + "end", "1" * 40_000, "…" * 9000 + " " * 9000 + "é" * 9000, "'re" + "b" * 40_000]
    expected = [len(ids(library, t)) for t in texts]
    assert tokencount.TokenCounter(PATH).counts(texts) == expected
    assert tokencount.TokenCounter(PATH, chunk=100, room=1000).counts(texts) == expected
    mixed = "".join(pick.choice(["漢字、", "don't ", "x''s", "12ab", " \n ", "'ll", "a'", "-'ve", "\u00a0", "<|endoftext|>"]) for _ in range(20_000))
    assert tokencount.TokenCounter(PATH, chunk=64).counts([mixed]) == [len(ids(library, mixed))]


def test_files_that_cannot_be_followed_are_refused(tmp_path):
    import json

    with open(PATH, encoding="utf-8") as file:
        data = json.load(file)
    for change in ({"ignore_merges": True}, {"dropout": 0.1}, {"end_of_word_suffix": "</w>"}, {"byte_fallback": True}):
        (tmp_path / "t.json").write_text(json.dumps(data | {"model": data["model"] | change}))
        with pytest.raises(ValueError, match="byte-level"):
            tokencount.TokenCounter(str(tmp_path / "t.json"))
    (tmp_path / "t.json").write_text(json.dumps(data | {"added_tokens": [data["added_tokens"][0] | {"lstrip": True}]}))
    with pytest.raises(ValueError, match="look around"):
        tokencount.TokenCounter(str(tmp_path / "t.json"))
    twice = data["model"] | {"merges": [*data["model"]["merges"], [data["model"]["merges"][0][0] + data["model"]["merges"][0][1][:1], ""]]}
    (tmp_path / "t.json").write_text(json.dumps(data | {"model": twice}))
    with pytest.raises(ValueError, match="several merges"):
        tokencount.TokenCounter(str(tmp_path / "t.json"))


def test_token_count_table(documents, odd_texts, library):
    out = tokencount.token_counts(documents([(k if k else None, t) for k, t in enumerate(odd_texts)]), PATH, limit=30).collect()
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in out)
    assert got == [(k, len((t or "").encode()), len(ids(library, t)), len(ids(library, t)) > 30) for k, t in enumerate(odd_texts)]
    assert tokencount.token_counts(documents([]), PATH).count() == 0


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        tokencount.TokenCounter(public_tokenizers.path("word_bpe_49k.json"))


def check_layout(totals, pieces, window):
    by_sequence, by_document = collections.defaultdict(list), collections.defaultdict(list)
    for k, start, length, sequence, offset in pieces:
        assert length > 0
        by_sequence[sequence].append((offset, length))
        by_document[k].append((start, length))
    for k, total in enumerate(totals):
        at = 0
        for start, length in sorted(by_document[k]):
            assert start == at
            at += length
        assert at == total
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_packing_without_padding():
    pick = random.Random(3)
    for _ in range(200):
        totals = [pick.choice([1, 2, 5, 512, 1023, 1024, 1025, pick.randint(1, 5000)]) for _ in range(pick.randint(0, 40))]
        assert check_layout(totals, packing.pack(totals, 1024), 1024) == 0


def test_least_squares_is_optimal():
    target = np.zeros(9)
    target[[1, 3, 4, 5, 7]] = [3, 5, 4, 6, 2]
    columns = [(1, 7), (3, 5), (4, 4), (1, 3, 4)]
    x = packing.nonnegative_least_squares(columns, target, sweeps=5000)
    matrix = np.array([[c.count(a) for c in columns] for a in range(9)], float)
    gradient = matrix.T @ (matrix @ x - target)
    assert (x >= 0).all() and (gradient > -1e-3).all() and abs(gradient @ x) < 1e-2


def test_packed_table(documents, odd_texts, library):
    table = documents([(k, t) for k, t in enumerate(odd_texts)] + [(7, "again"), (None, "no id")])
    out = packing.pack_documents(table, PATH, block_tokens=4000).collect()
    expected = collections.Counter()
    for k, t in [*enumerate(odd_texts), (7, "again"), (None, "no id")]:
        expected[k, len(ids(library, t)) + 1] += len(ids(library, t)) + 1
    got = collections.Counter()
    for r in out:
        got[r.doc_id, r.doc_tokens] += r.length
    assert got == expected
    streams = {k: np.array([*ids(library, t), 0], "<u4") for k, t in enumerate(odd_texts) if k != 7}
    for r in out:
        if r.doc_id in streams:
            assert r.ids_crc32 == zlib.crc32(streams[r.doc_id][r.start : r.start + r.length].tobytes())
    sequences = collections.defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack_documents(documents([]), PATH).count() == 0
