import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """documents(rows of (doc_id, text[, lang[, source]])) -> DataFrame, with columns that clash with the operators' own."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s0", len(r[1] or "")) for r in rows]
        frame = spark.createDataFrame(full, SCHEMA).repartition(partitions)
        for name in ("rk", "key", "size", "kept", "id", "_text", "pid", "n_words", "spans", "keep_lang"):
            frame = frame.selectExpr("*", f"'clash' AS {name}")
        return frame

    return make


@pytest.fixture
def sentence():
    """sentence(n, seed) -> n words of made-up text"""
    syllables = ["ba", "ko", "ri", "tel", "mon", "su", "ver", "da", "nix", "po", "la", "gre"]

    def make(n, seed=0):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))

    return make


#: Texts that every operator on documents must take: null, empty, blanks, ties, repeated rows, null ids, non-ASCII, one very long word.
@pytest.fixture
def odd_rows(sentence):
    long = sentence(6000, 5)
    return [(1, None), (2, ""), (3, " \t\n\x0b "), (4, "one"), (4, "one"), (5, sentence(40, 1)), (6, sentence(40, 1)), (7, sentence(40, 1)),
            (None, sentence(40, 1)), (None, None), (8, "Élan žlutý 日本 語 x " + sentence(30, 2), None, None), (9, long),
            (10, long + " extra"), (11, "x" * 3_000_000), (12, "\n\n".join([sentence(12, 3)] * 4), "de", None)]
