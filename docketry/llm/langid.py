"""Language identification by bit-sliced Bloom filters over character n-grams.

One bit per language: a slot of the filter is a mask, and the masks of an n-gram's slots, and-ed, hold every language
whose profile has the n-gram. Over a text, the number of n-grams with a language's bit is its count; a filter whose
slots are filled to the share p by the language answers yes for p**k of all foreign n-grams, so the count is corrected
to (count / n - p**k) / (1 - p**k). The language of the largest corrected share is the answer.

A language's profile holds the n-grams found in at least ``min_share`` of its sampled documents, and there at least
``min_ratio`` times as often as in any other language.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm._shared import slices
from docketry.llm.tokencount import LETTER, char_classes

UNDETERMINED = "und"
_BATCH = 1 << 20
#: The bits of each byte.
_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from all learning; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finalizer of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def batches_of(texts: list[str], most: int = _BATCH) -> Iterator[tuple[int, list[str]]]:
    """The texts in order, by groups of up to so many characters or one longer text, with the first one's index."""
    begin = size = 0
    for k, text in enumerate(texts):
        if k > begin and size + len(text) > most:
            yield begin, texts[begin:k]
            begin, size = k, 0
        size += len(text)
    if begin < len(texts):
        yield begin, texts[begin:]


def gram_hashes(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all character n-grams, and the index of the text each belongs to.

    Texts are lower-cased, each run of other signs than letters is one blank, and blanks stand at both ends, so that a
    text with one letter has an n-gram.
    """
    lowered = [text.lower() for text in texts]
    pad = n - 1
    codes = np.frombuffer((" " * pad).join(["", *lowered, ""]).encode("utf-32-le"), "<u4")
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered)) + pad
    begin = np.cumsum(sizes) - sizes
    owner = np.concatenate([np.repeat(np.arange(len(lowered)), sizes), np.full(pad, len(lowered) - 1)])
    letter = char_classes()[codes] == LETTER
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    for k in range(pad):  # the blanks before each text and at the end
        keep[begin + k] = True
        keep[len(codes) - 1 - k] = True
    codes, owner = np.where(letter, codes, 32)[keep].astype(np.uint64), owner[keep]
    count = max(0, len(codes) - n + 1)
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + count]
    return mixed(out), owner[:count]


@dataclass
class LanguageModel:
    """Languages (most frequent first), the filter's masks (words x slots) and each language's false positive rate."""

    languages: list[str]
    masks: np.ndarray
    false_rate: np.ndarray
    n: int
    hashes: int

    def slots(self, grams: np.ndarray) -> Iterator[np.ndarray]:
        bits = np.uint64(self.masks.shape[1].bit_length() - 1)
        for k in range(self.hashes):
            yield (mixed(grams + np.uint64(k * 0x632BE59BD9B4E019 & (1 << 64) - 1)) if k else grams) >> (np.uint64(64) - bits)

    def shares(self, texts: list[str]) -> np.ndarray:
        """Each text's corrected share of n-grams in each language's profile (texts x languages)."""
        out = np.zeros((len(texts), len(self.languages)))
        for begin, part in batches_of(texts):
            grams, owner = gram_hashes(part, self.n)
            total = np.bincount(owner, minlength=len(part)).astype(float)
            rows = slice(begin, begin + len(part))
            for word, masks in enumerate(self.masks):
                found = np.full(len(grams), np.uint64((1 << 64) - 1))
                for at in self.slots(grams):
                    found &= masks[at]
                for first in range(64 * word, min(64 * word + 64, len(self.languages)), 8):  # eight languages by one count of their byte of the masks
                    byte = ((found >> np.uint64(first % 64)) & np.uint64(255)).astype(np.int64)
                    seen = np.bincount(owner * 256 + byte, minlength=len(part) * 256).reshape(len(part), 256)
                    n = min(8, len(self.languages) - first)
                    out[rows, first : first + n] = (seen @ _BITS)[:, :n] / np.maximum(total, 1)[:, None]
        return (out - self.false_rate) / (1 - self.false_rate)


def build(profiles: dict[str, np.ndarray], languages: list[str], n: int, slot_bits: int, hashes: int, most_filled: float = 0.25, most_bytes: int = 1 << 28) -> LanguageModel:
    """The filter of the profiles, with so many slots (at least 2**slot_bits) that no language fills more than ``most_filled`` of them.

    Raises ValueError if the filter would be larger than ``most_bytes``: it is broadcast, and no language is left out to make it fit.
    """
    words = max(1, -(-len(languages) // 64))
    largest = max((len(profiles.get(x, ())) for x in languages), default=0)
    slot_bits = max(slot_bits, math.ceil(math.log2(max(1.0, largest * hashes / most_filled))))
    if (size := words * 8 << slot_bits) > most_bytes:
        raise ValueError(f"{len(languages)} languages with up to {largest} n-grams need a filter of {size} bytes, more than {most_bytes}")
    model = LanguageModel(languages, np.zeros((words, 1 << slot_bits), np.uint64), np.zeros(len(languages)), n, hashes)
    for k, language in enumerate(languages):
        word, bit = divmod(k, 64)
        for at in model.slots(profiles.get(language, np.zeros(0, np.uint64))):
            np.bitwise_or.at(model.masks[word], at, np.uint64(1 << bit))
        filled = ((model.masks[word] >> np.uint64(bit)) & np.uint64(1)).mean()
        model.false_rate[k] = min(0.999, filled**hashes)
    return model


def fit(docs: DataFrame, n: int = 4, sample_docs: int = 1500, min_share: float = 0.01, min_ratio: float = 0.34, slot_bits: int = 18, hashes: int = 3) -> LanguageModel:
    """Learns from ``docs(doc_id, text, lang)`` that are not held out and have a language.

    A language's sample is the rows whose id's hash falls below a threshold set for ``sample_docs`` rows on average
    (all rows of a rarer language). A profile has at most 1 / min_share times the n-grams of an average document. The languages, a small set of
    labels, and their profiles reach the driver; n-grams are extracted once.
    """
    usable = docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    languages = [r["lang"] for r in counts]
    if not languages:
        return build({}, [], n, slot_bits, hashes)
    share = F.element_at(F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, sample_docs / r["count"]))]), F.col("lang"))
    sample = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20)).select("lang", "text")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            owners, texts = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_pylist()
            for begin, part in batches_of(texts):
                hashes_, owner = gram_hashes(part, n)
                pairs = np.unique(np.rec.fromarrays([hashes_, owner]))
                for language in sorted(set(owners[begin : begin + len(part)])):
                    own = pairs.f0[(owners[begin : begin + len(part)] == language)[pairs.f1]]
                    values, docs_ = np.unique(own, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([language] * len(values), pa.string()), pa.array(values.view(np.int64)), pa.array(docs_.astype(np.int64))], ["lang", "gram", "docs"])

    spread = sample.repartition(docs.sparkSession.sparkContext.defaultParallelism)  # the sample is bounded, and few files may hold it
    found = spread.mapInArrow(grams, "lang string, gram long, docs long").groupBy("lang", "gram").agg(F.sum("docs").alias("docs"))
    sizes = sample.groupBy("lang").agg(F.count("*").alias("sampled"))  # of narrow rows
    rates = found.join(sizes, "lang").where(F.col("docs") >= F.greatest(F.lit(2.0), F.col("sampled") * min_share))
    profile = rates.select("lang", "gram", (F.col("docs") / F.col("sampled")).alias("rate")).toArrow()
    lang, gram, rate = (profile.column(k).to_numpy(zero_copy_only=False) for k in range(3))
    order, inverse = np.unique(gram, return_inverse=True)
    top = np.zeros(len(order))
    np.maximum.at(top, inverse, rate)
    fits = rate >= min_ratio * top[inverse]
    return build({x: gram[fits & (lang == x)].astype(np.int64).view(np.uint64) for x in languages}, languages, n, slot_bits, hashes)


def predict(docs: DataFrame, model: LanguageModel, keep: tuple[str, ...] = ("doc_id",), names: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """The kept columns with the predicted language and its corrected share (0 to 1) for each row of ``docs``.

    Only the text is looked at. Null texts and texts without a letter are ``und`` with score 0, as is every text if
    nothing could be learned; without any evidence the most frequent language is given, with score 0. Repeated rows are
    judged each; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of the filter's fixed size
    kept = docs.select(*keep).schema.fields
    at, inner = len(kept), [f"_k{i}" for i in range(len(kept))]
    text_at = keep.index("text") if "text" in keep and kept[keep.index("text")].dataType.simpleString() == "string" else at + 1
    made = [*inner, "_language", "_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        languages = np.array([*own.languages, UNDETERMINED], object)
        for batch in slices(batches):
            lettered = batch.column(at).to_numpy(zero_copy_only=False).astype(bool)
            best, score = np.full(len(lettered), len(own.languages)), np.zeros(len(lettered))
            if own.languages and lettered.any():
                texts = batch.column(text_at).filter(pa.array(lettered)).to_pylist()
                shares = own.shares(texts)
                best[lettered] = shares.argmax(1)
                score[lettered] = np.clip(shares.max(1), 0, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(languages[best], pa.string()), pa.array(score)], names=made)

    schema = ", ".join([f"{c} {f.dataType.simpleString()}" for c, f in zip(inner, kept, strict=True)] + ["_language string", "_score double"])
    text = F.col("text").cast("string")
    own_text = [text.alias("_text")] if text_at > at else []
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, inner, strict=True)], F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("_lettered"), *own_text)
    return rows.mapInArrow(run, schema).toDF(*keep, *names)


def identify(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row, with a model learned from the table itself by default."""
    out = predict(docs, model or fit(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, model: LanguageModel | None = None, min_score: float = 0.1) -> DataFrame:
    """The rows of ``docs`` whose language could be told: not ``und``, and a score of ``min_score`` at least.

    Null and empty texts and those without a letter go, rows without an id are judged like all others, repeated rows each; an empty table
    gives no rows; all columns stay as they are.
    """
    names = tuple(docs.columns)
    out = predict(docs, model or fit(docs), names, ("__lang_pred", "__lang_score"))
    return out.where((F.col("__lang_pred") != UNDETERMINED) & (F.col("__lang_score") >= min_score)).select(*names)
