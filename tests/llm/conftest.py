import random

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, class_id string, _text string"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table of documents, with further columns whose names clash with what operators make."""

    def make(rows):
        full = []
        for row in rows:
            doc_id, text, *rest = row
            lang, source = [*rest, None, "s"][:2] if len(rest) < 2 else rest[:2]
            full.append((doc_id, text, lang, source, len(text or ""), "clash", "clash", "clash", "clash"))
        return spark.createDataFrame(full, DOCUMENT)

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and blank texts, ties, long runs, rare signs, special strings."""
    pick = random.Random(11)
    signs = ["a", "the ", "É", "ß", "1", "٣", " ", "\n", "\t", "'s", "''", "漢", "🙂", "_", "%41", "\x00", "<|endoftext|>", "&amp;", "—"]
    mixed = ["".join(pick.choices(signs, k=pick.randint(1, 60))) for _ in range(60)]
    return [None, "", " ", "\n\n", "x", "12 34", "a" * 5000, " " * 3000, "word " * 4000, "same text here", "same text here", *mixed]
