"""Token counts from a tokenizer compiled to a finite-state transducer.

A byte-level BPE file is compiled, on demand, to a deterministic transducer over bytes. Its state after a
prefix of a word is what decides all that follows: the longest suffix of the prefix that can still grow into a
vocabulary entry and, at each place inside that suffix, the last token of the encoding that ends there with its
token count relative to the prefix's. Reading a byte moves to the next state and emits the *change* of the
token count, so the emissions along a word add up to its count. Determinism rests on two facts about BPE: an
encoding without its last token is the encoding of the shorter text, and a sequence is an encoding exactly when
every neighbouring pair in it is the encoding of its own bytes (Berglund and van der Merwe, "Formalizing BPE
Tokenization", 2023). Whether a pair is one is told by undoing its merges, latest first: no merge over the middle may have
been due before.

Words are told apart by a second small automaton over kinds of signs; a state of the whole is its mode, the signs it has read but not decided on, and the
transducer's state in the open word. Texts are cut into chunks, and a chunk is summarised by its state map: entry state to exit state and emitted tokens.
Where a chunk has a certain word border, its exit does not depend on its entry, and what lies between its first and last such border is counted
for many chunks in one array pass, each distinct word once. A map holds the states that can occur: what a look at the signs before the chunk leaves
open; an entry it does not hold is read when it is met, only as far as it differs from one that it holds. Maps compose associatively, so the chunks of a text,
whatever words lie across them, are joined by a prefix scan.
"""

from __future__ import annotations

import functools
import itertools
import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm._shared import slices

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3


@functools.cache
def char_classes() -> np.ndarray:
    """The class of each code point: letter, number, white space or other, by the Unicode properties."""
    import regex

    table = np.zeros(0x110000, np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for found in regex.finditer(pattern, points):
            own = np.frombuffer(found[0].encode("utf-32-le"), "<u4")
            table[own] = kind
    return table


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def load_merges(path: str) -> tuple[list[tuple[bytes, bytes]], dict[str, int]]:
    """The merges of a byte-level BPE file in their order, and the special strings with their ids.

    Raises ValueError for a file of another kind, whose words or merges the transducer would not follow: other models and splitting
    rules, normalizers, random or skipped merges, marks inside or at the end of words, special strings that take their surroundings with them.
    """
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    model, pre = data["model"], data["pre_tokenizer"] or {}
    if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or data["normalizer"]:
        raise ValueError(f"{path}: not a plain byte-level BPE tokenizer")
    if odd := [k for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback") if model.get(k)]:
        raise ValueError(f"{path}: not a plain byte-level BPE tokenizer ({', '.join(odd)})")
    if odd := [t["content"] for t in data["added_tokens"] if t.get("lstrip") or t.get("rstrip") or t.get("single_word")]:
        raise ValueError(f"{path}: not a plain byte-level BPE tokenizer (special strings that look around: {odd})")
    back = byte_alphabet()
    merges = [tuple(bytes(back[c] for c in side) for side in (merge if isinstance(merge, list) else merge.split(" "))) for merge in model["merges"]]
    if len({left + right for left, right in merges}) < len(merges):
        raise ValueError(f"{path}: not a plain byte-level BPE tokenizer (several merges for one entry)")
    return merges, {t["content"]: t["id"] for t in data["added_tokens"]}


def load_vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Vocabulary entries with their merge rank (lower merges first; single bytes below every merge), and the special strings with their ids."""
    merges, specials = load_merges(path)
    ranks = {bytes([b]): -256 + b for b in range(256)}
    return ranks | {left + right: rank for rank, (left, right) in enumerate(merges)}, specials


def bpe(word: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The plain merge procedure: join the neighbours of lowest rank, leftmost first, until none can be."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        best, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if best == 1 << 60:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    """The lazily compiled transducer of one list of merges. At ``max_states`` compiled states it starts afresh, from the state it is in.

    Tokens are numbered: single bytes by value, then merges in their order.
    """

    def __init__(self, merges: list[tuple[bytes, bytes]], max_states: int = 400_000, max_words: int = 1_000_000):
        self.max_states, self.max_words = max_states, max_words
        self.tokens = {bytes([b]): b for b in range(256)} | {left + right: 256 + k for k, (left, right) in enumerate(merges)}
        self.halves = [(b, b) for b in range(256)] + [(self.tokens[left], self.tokens[right]) for left, right in merges]
        self.merged = {pair: 256 + k for k, pair in enumerate(self.halves[256:])}
        self.growing = {t[:k] for t in self.tokens for k in range(len(t))}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[bytes, int] = {}
        self._reset(self.START)

    START = (b"", (None,), (0,))

    def _reset(self, state: tuple) -> int:
        self.states = [self.START, state] if state != self.START else [state]
        self.ids, self.edges = {s: k for k, s in enumerate(self.states)}, {}
        return len(self.states) - 1

    def joins(self, left: int, right: int) -> bool:
        """Whether two tokens side by side are the encoding of their bytes."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            known = self.pairs[left, right] = self._undone(left, right)
        return known

    def _undone(self, left: int, right: int) -> bool:
        due = 1 << 60  # merges before this one have been made
        while True:
            if self.merged.get((left, right), due) < due:
                return False
            if left > right:
                due, left = left, self.halves[left][1]
            elif right > 255:
                due, right = right + 1, self.halves[right][0]  # of equal merges the left one comes first
            else:
                return True
            if left < 256 and right < 256:
                return self.merged.get((left, right), due) >= due

    def begins(self, token: int) -> bool:
        """Whether a token is the encoding of its own bytes."""
        known = self.pairs.get((-1, token))
        if known is None:
            left, right = self.halves[token]
            known = self.pairs[-1, token] = token < 256 or (self.begins(left) and self.begins(right) and self._first_over(left, right) == token)
        return known

    def _first_over(self, left: int, right: int) -> int | None:
        """The merge that joins two encodings in the middle if none is due over it before."""
        last = self.merged.get((left, right))
        due = last if last is not None else 0
        while left > 255 or right > 255:
            if left > right:
                due, left = min(due, left), self.halves[left][1]
            else:
                due, right = min(due, right + 1), self.halves[right][0]
            if self.merged.get((left, right), due) < due:
                return None
        return last

    def _step(self, state: int, byte: int) -> tuple[int, int]:
        suffix, last, count = self.states[state]
        grown = suffix + bytes([byte])
        size = len(grown)
        for k in range(size):  # the token that ends here begins k bytes back
            token = self.tokens.get(grown[size - k - 1 :])
            if token is not None and (self.begins(token) if last[k] is None else self.joins(last[k], token)):
                break
        else:
            raise ValueError("the vocabulary does not cover every byte")
        change = count[k] + 1
        keep = 0
        while grown[keep:] not in self.growing:
            keep += 1
        m = size - keep
        open_ = [grown[size - j :] in self.growing for j in range(1, m + 1)]  # whether a later token can begin j bytes back; what was there matters only then
        ends = [t if o else 0 for t, o in zip(last[:m], open_, strict=True)]
        counts = [c - change if o else 0 for c, o in zip(count[:m], open_, strict=True)]
        while ends and not open_[len(ends) - 1]:
            ends.pop()
            counts.pop()
        after = (grown[size - len(ends) :], (token, *ends), (0, *counts))
        if (to := self.ids.get(after)) is None:
            if len(self.states) >= self.max_states:
                return self._reset(after), change
            to = self.ids[after] = len(self.states)
            self.states.append(after)
        self.edges[state << 8 | byte] = to, change
        return to, change

    def enter(self, content: tuple) -> int:
        """The number of a state given by its content, which stays the same when numbers start afresh."""
        number = self.ids.get(content)
        if number is None:
            if len(self.states) >= self.max_states:
                return self._reset(content)
            number = self.ids[content] = len(self.states)
            self.states.append(content)
        return number

    def run(self, data: bytes, state: int = 0) -> tuple[int, int]:
        """The state after reading some bytes of a word, and the tokens emitted on the way."""
        total, edges = 0, self.edges
        for byte in data:
            edge = edges.get(state << 8 | byte)
            if edge is None:
                edge, edges = self._step(state, byte), self.edges
            state = edge[0]
            total += edge[1]
        return state, total

    def count(self, word: bytes) -> int:
        """Tokens of one word (a piece that merges never cross)."""
        if (known := self.words.get(word)) is not None:
            return known
        total = self.run(word)[1]
        if len(word) <= 64:
            if len(self.words) >= self.max_words:
                self.words.clear()
            self.words[word] = total
        return total


def word_starts(codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where words begin in concatenated texts: the automaton of the byte-level splitting rule, as array passes.

    ``begins`` marks the first code point of each text. Words are runs of letters, of numbers or of other signs,
    each with one blank before it if there is one; white space runs give up their last character when something
    follows; an apostrophe that begins a word takes the English endings s, t, m, d, re, ve and ll with it.
    """
    n = len(codes)
    kind = char_classes()[codes]
    starts = begins.copy()
    starts[1:] |= kind[1:] != kind[:-1]
    runs = starts.copy()
    same_text = ~begins[1:]
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & same_text)
    starts[last] = True
    starts[last + 1] = codes[last] != 0x20
    quote = np.flatnonzero((codes == 0x27) & starts)
    quote = quote[quote < n - 1]
    quote = quote[runs[quote + 1] & ~begins[quote + 1] & (kind[quote + 1] == LETTER)]
    if len(quote):
        padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
        fresh = np.concatenate([begins, np.ones(3, bool)])
        one, two = padded[quote + 1], np.where(fresh[quote + 2], 0, padded[quote + 2])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((np.isin(one, [ord("r"), ord("v")]) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))) & ~short
        for at, size in ((quote[short], 2), (quote[long], 3)):
            starts[at + 1] = False
            after = at + size
            starts[after[after < n]] = True
    return starts


class State(NamedTuple):
    """Where a reader of texts is: the kind of the open word (or FRESH, QUOTE), signs read but not decided on, and the transducer's state in the word."""

    mode: int
    pending: str
    word: tuple


#: Modes beside the kinds of signs: no word is open; an apostrophe that begins a word (and r, v or l after it) is undecided.
FRESH, QUOTE = 4, 5
START = State(FRESH, "", Transducer.START)


class Reader:
    """The automaton of the splitting rule over the transducer: reads texts from state to state and emits token counts."""

    def __init__(self, machine: Transducer):
        self.machine = machine

    def due(self, state: State) -> int:
        """What is emitted if no sign follows, or one that certainly begins another word."""
        if state.mode == SPACE:
            return self.machine.run(state.pending.encode(), self.machine.enter(state.word))[1]
        return sum(self.machine.count(sign.encode()) for sign in state.pending)

    def read(self, text: str, state: State = START) -> tuple[State, int]:
        """The state after a text, and the tokens emitted on the way."""
        if not text:
            return state, 0
        run, count, total = self.machine.run, self.machine.count, 0
        mode, pending, q = state.mode, state.pending, self.machine.enter(state.word)
        kinds = char_classes()[np.frombuffer(text.encode("utf-32-le"), "<u4")]
        edges = [0, *(np.flatnonzero(kinds[1:] != kinds[:-1]) + 1).tolist(), len(text)]
        for at, end in itertools.pairwise(edges):
            kind, part = int(kinds[at]), text[at:end]
            if mode == QUOTE:
                if kind == LETTER:
                    letters = pending[1:] + part
                    size = 1 if letters[0] in "stmd" else 2 if letters[:2] in ("re", "ve", "ll") else 0
                    if not size and letters in ("r", "v", "l"):
                        pending += part
                        continue
                    total += count(("'" + letters[:size]).encode())
                    mode, pending, part = FRESH, "", letters[size:]
                    if not part:
                        continue
                elif kind == OTHER and pending == "'":
                    mode, pending, part = FRESH, "", "'" + part
                else:
                    total += sum(count(sign.encode()) for sign in pending)
                    mode, pending = FRESH, ""
            if kind == SPACE:  # the last one may be the next word's
                q, emitted = run((pending + part[:-1]).encode(), q if mode == SPACE else 0)
                mode, pending = SPACE, part[-1]
                total += emitted
                continue
            blank = mode == SPACE and pending == " "
            if mode == SPACE and not blank:
                total += count(pending.encode())
            if mode != kind:
                if part == "'" and not blank:
                    mode, pending, q = QUOTE, "'", 0
                    continue
                q = 0
                if blank:
                    part = " " + part
            q, emitted = run(part.encode(), q)
            mode, pending = kind, ""
            total += emitted
        return State(mode, pending, Transducer.START if mode in (FRESH, QUOTE) else self.machine.states[q]), total


class StateMap:
    """Entry state to (exit state, emitted tokens) of a stretch of text, for the entries that can occur; others are found when they are asked for."""

    __slots__ = ("known",)

    def __init__(self) -> None:
        self.known: dict[State, tuple[State, int]] = {}

    def __getitem__(self, entry: State) -> tuple[State, int]:
        found = self.known.get(entry)
        if found is None:
            found = self.known[entry] = self._found(entry)
        return found

    def _found(self, entry: State) -> tuple[State, int]:
        raise NotImplementedError

    def then(self, after: StateMap) -> StateMap:
        """Both stretches as one."""
        return Composed(self, after)


class Composed(StateMap):
    """The map of two neighbouring stretches."""

    __slots__ = ("after", "before")

    def __init__(self, before: StateMap, after: StateMap):
        super().__init__()
        self.before, self.after = before, after
        for entry in list(before.known):
            self[entry]

    def _found(self, entry: State) -> tuple[State, int]:
        middle, first = self.before[entry]
        out, second = self.after[middle]
        return out, first + second


class Bordered(StateMap):
    """A chunk with a certain border: ``inner`` tokens from its first to its last one, and one exit for all entries."""

    __slots__ = ("head", "inner", "reader", "tail")

    def __init__(self, reader: Reader, head: str, tail: str):
        super().__init__()
        self.reader, self.head, self.inner = reader, head, 0
        self.tail = reader.read(tail)

    def _found(self, entry: State) -> tuple[State, int]:
        state, emitted = self.reader.read(self.head, entry)
        return self.tail[0], emitted + self.reader.due(state) + self.inner + self.tail[1]


class Unbroken(StateMap):
    """A chunk without a certain border. States soon forget how they began, so a further entry is read until it is where a known one is."""

    __slots__ = ("chunk", "reader")

    def __init__(self, reader: Reader, chunk: str):
        super().__init__()
        self.reader, self.chunk = reader, chunk

    def _found(self, entry: State) -> tuple[State, int]:
        like = next(iter(self.known), None)
        own, other, ahead = entry, like, 0
        for at in range(0, len(self.chunk), 64):
            part = self.chunk[at : at + 64] if like is not None else self.chunk
            own, emitted = self.reader.read(part, own)
            ahead += emitted
            if like is None:
                break
            other, emitted = self.reader.read(part, other)
            ahead -= emitted
            if own == other:
                out, total = self.known[like]
                return out, total + ahead
        return own, ahead + (self.known[like][1] if like is not None else 0)


def prefix_scan(maps: list[StateMap]) -> list[StateMap]:
    """The composition of the first 1, 2, ... maps, by pairwise halving."""
    if len(maps) < 2:
        return maps
    pairs = prefix_scan([a.then(b) for a, b in zip(maps[::2], maps[1::2], strict=False)])
    return [maps[0], *(pairs[i // 2] if i % 2 else pairs[i // 2 - 1].then(maps[i]) for i in range(1, len(maps)))]


#: Certain word borders: white space after something else, and changes between letters, numbers and other signs with no apostrophe beside.
_BORDER = (
    r"(?<=\P{White_Space})(?=\p{White_Space})|(?<=\p{L})(?=[^\p{L}\p{White_Space}'])|(?<=\p{N})(?=[^\p{N}\p{White_Space}'])|(?<=[^\p{L}\p{N}\p{White_Space}'])(?=[\p{L}\p{N}])"
)


class TokenCounter:
    """Counts tokens of texts as the tokenizer file's library would, without begin, end or added specials."""

    def __init__(self, path: str, chunk: int = 1 << 13, room: int = 1 << 20):
        import regex

        merges, self.specials = load_merges(path)
        self.machine, self.chunk, self.room = Transducer(merges), chunk, room
        self.reader = Reader(self.machine)
        self._special = regex.compile("|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True))) if self.specials else None
        self._border = regex.compile(_BORDER)

    def _counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each non-empty text, all in one pass in which each distinct word is counted once."""
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        begins = np.zeros(len(codes), bool)
        begins[first] = True
        at = np.flatnonzero(word_starts(codes, begins))
        if joined.isascii():
            data, edges = joined.encode(), np.append(at, len(codes))
        else:
            widths = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
            data, edges = joined.encode(), np.concatenate([[0], np.cumsum(widths)])[np.append(at, len(codes))]
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.ascontiguousarray(edges, np.int64)), pa.py_buffer(data)]).dictionary_encode()
        known, count = self.machine.words, self.machine.count
        own = []
        for word in words.dictionary.to_pylist():
            size = known.get(word)
            own.append(count(word) if size is None else size)
        return np.add.reduceat(np.array(own, np.int64)[words.indices.to_numpy()], np.searchsorted(at, first))

    def _borders(self, chunk: str) -> tuple[int, int] | None:
        """The first and the last certain border inside a chunk."""
        found = self._border.search(chunk, 1)
        if not found:
            return None
        back = found
        for size in (64, 1024, len(chunk)):
            for later in self._border.finditer(chunk, max(found.start(), len(chunk) - size)):
                back = later
            if back is not found or size >= len(chunk):
                break
        return found.start(), back.start()

    def _entry(self, before: str) -> State:
        """The state that a look at the last signs before a chunk leaves: certain after a border among them, else the likely one."""
        border = self._borders(before) if len(before) > 1 else None
        return self.reader.read(before[border[1] :] if border else before)[0]

    def _maps(self, piece: str, add) -> list[StateMap]:
        """The state maps of a piece's chunks. ``add(text, map)`` has what lies between a chunk's borders counted and added to the map's ``inner`` later."""
        maps: list[StateMap] = []
        for at in range(0, len(piece), self.chunk):
            chunk = piece[at : at + self.chunk]
            border = self._borders(chunk)
            if border is None:
                maps.append(Unbroken(self.reader, chunk))
                continue
            a, b = border
            maps.append(Bordered(self.reader, chunk[:a], chunk[b:]))
            if b > a:
                add(chunk[a:b], maps[-1])
        return maps

    def _scan(self, piece: str, maps: list[StateMap]) -> list[StateMap]:
        """The maps of all beginnings of a piece, once what lies between borders is counted."""
        for k, own in enumerate(maps):
            own[self._entry(piece[max(0, k * self.chunk - 64) : k * self.chunk]) if k else START]
        return prefix_scan(maps)

    def _pieces(self, text: str) -> tuple[list[str], list[str]]:
        """A text's pieces between special strings, and these."""
        if self._special and any(s in text for s in self.specials):
            return self._special.split(text), self._special.findall(text)
        return [text], []

    def offsets(self, text: str | None) -> list[tuple[int, int]]:
        """Where each chunk of a text begins (code points) and the tokens of the text before it, by the scan over the chunks' state maps.

        Chunks begin afresh after special strings. Null and empty texts have none.
        """
        out, start, done = [], 0, 0
        pieces, marks = self._pieces(text or "")
        for k, piece in enumerate(pieces):
            waiting: list[tuple[str, Bordered]] = []
            maps = self._maps(piece, lambda inside, own, waiting=waiting: waiting.append((inside, own)))
            for i in range(0, len(waiting), 64):  # array passes of bounded size
                part = waiting[i : i + 64]
                for (_, own), n in zip(part, self._counts([inside for inside, _ in part]).tolist(), strict=True):
                    own.inner = n
            ends = [done]
            for whole in self._scan(piece, maps):
                state, emitted = whole[START]
                ends.append(done + emitted + self.reader.due(state))
            out += [(start + i * self.chunk, before) for i, before in enumerate(ends[: len(maps)])]
            start, done = start + len(piece), ends[-1]
            if k < len(marks):
                start, done = start + len(marks[k]), done + 1
        return out

    def counts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; null counts as empty."""
        out = [0] * len(texts)
        batch: list[str] = []
        owner: list[int | Bordered] = []
        room = self.room

        def flush() -> None:
            nonlocal room
            if batch:
                for own, n in zip(owner, self._counts(batch).tolist(), strict=True):
                    if isinstance(own, Bordered):
                        own.inner = n
                    else:
                        out[own] += n
                batch.clear()
                owner.clear()
            room = self.room

        def add(text: str, own: int | Bordered) -> None:
            nonlocal room
            if len(text) > room:
                flush()
            batch.append(text)
            owner.append(own)
            room -= len(text)

        chains: list[tuple[int, str, list[StateMap]]] = []
        for k, text in enumerate(texts):
            if not text:
                continue
            pieces, marks = self._pieces(text)
            out[k] += len(marks)
            for piece in pieces:
                if len(piece) > self.chunk:
                    chains.append((k, piece, self._maps(piece, add)))
                elif piece:
                    add(piece, k)
        flush()
        for k, piece, maps in chains:  # the last map of the scan is the whole piece's
            state, emitted = self._scan(piece, maps)[-1][START]
            out[k] += emitted + self.reader.due(state)
        return out


@functools.cache
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs(doc_id, text)``.

    One narrow pass: no shuffle, and besides the rows' own texts memory bounded by an array pass over ``room`` characters, the transducer's
    caches. The path must be readable on the executors. Null and empty texts have 0 bytes and 0 tokens; repeated rows are counted each;
    an empty table gives no rows; other columns are ignored, whatever their names.
    """
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer_path)
        for batch in slices(batches):
            tokens = np.array(own.counts(batch.column(1).to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(tokens), pa.array(tokens > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return narrow.mapInArrow(run, schema)


def token_offsets(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, chunk_no, start, tokens_before`` for each chunk of ``docs(doc_id, text)``: where long texts can be cut, and the tokens of what lies before.

    ``start`` counts code points; ``tokens_before`` is the count of the text up to there as the library gives it. One narrow pass. Null and empty texts have no chunk; repeated rows
    are listed each; an empty table gives no rows; other columns are ignored.
    """
    schema = "doc_id long, chunk_no int, start long, tokens_before long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer_path)
        for batch in slices(batches, 64):
            ids, found = batch.column(0).to_pylist(), map(own.offsets, batch.column(1).to_pylist())
            rows = [(i, k, start, before) for i, chunks in zip(ids, found, strict=True) for k, (start, before) in enumerate(chunks)]
            columns = zip(*rows, strict=True) if rows else ([], [], [], [])
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "chunk_no", "start", "tokens_before"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
