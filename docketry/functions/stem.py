"""English word stems by Porter's rules ("An algorithm for suffix stripping", 1980), for dictionaries of distinct words."""

from __future__ import annotations

import functools
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The suffixes of the published steps 2, 3 and 4, with what replaces them.
_STEP_2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble"}
_STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
_STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")

_STEP_2, _STEP_3 = ({s: table[s] for s in sorted(table, key=len, reverse=True)} for table in (_STEP_2, _STEP_3))  # the longest that fits counts
_STEP_4 = tuple(sorted(_STEP_4, key=len, reverse=True))

_WORD = re.compile(r"[a-z]{3,}")


def _shape(word: str) -> str:
    """``c`` or ``v`` for each letter; y is a vowel after a consonant."""
    out = ""
    for letter in word:
        out += "v" if letter in "aeiou" or (letter == "y" and out.endswith("c")) else "c"
    return out


def _measure(word: str) -> int:
    return len(re.findall("v+c+", _shape(word)))


def _closed(word: str) -> bool:
    """Whether a word ends consonant, vowel, consonant, the last not w, x or y."""
    return _shape(word).endswith("cvc") and word[-1] not in "wxy"


def _replaced(word: str, table: dict[str, str]) -> str:
    for suffix in table:
        if word.endswith(suffix):
            base = word[: -len(suffix)]
            return base + table[suffix] if _measure(base) > 0 else word
    return word


@functools.lru_cache(maxsize=1 << 16)
def stem(word: str) -> str:
    """The stem of a lower-case word; what is not all ASCII letters, or shorter than three, is its own."""
    if not _WORD.fullmatch(word):
        return word
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    elif cut := next((n for suffix, n in (("ed", 2), ("ing", 3)) if word.endswith(suffix) and "v" in _shape(word[:-n])), 0):
        word = word[:-cut]
        if word.endswith(("at", "bl", "iz")) or (_measure(word) == 1 and _closed(word)):
            word += "e"
        elif len(word) > 1 and word[-1] == word[-2] and _shape(word).endswith("cc") and word[-1] not in "lsz":
            word = word[:-1]
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _replaced(_replaced(word, _STEP_2), _STEP_3)
    suffix = next((s for s in _STEP_4 if word.endswith(s)), "")
    if suffix and _measure(word[: -len(suffix)]) > 1 and (suffix != "ion" or word[-4] in "st"):
        word = word[: -len(suffix)]
    if word.endswith("e") and (_measure(word[:-1]) > 1 or (_measure(word[:-1]) == 1 and not _closed(word[:-1]))):
        word = word[:-1]
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


def common_start(word: str) -> str:
    """What all words of one stem begin with: the stem but for its last letter, which rules may change."""
    return stem(word)[:-1] if _WORD.fullmatch(word) else word


def stems(words: Column) -> Column:
    """The stems of a column of distinct words."""

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        return column.map(stem)

    return run(words)
