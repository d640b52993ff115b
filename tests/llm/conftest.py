from __future__ import annotations

import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long, note string"


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text[, lang]) as a documents table with an extra column."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), "kept") for r in rows]
        return spark.createDataFrame(full, DOC)

    return make


VOCABULARY = [f"{a}{b}" for a in "ka lo mi ne pu ra so té wü ñi".split() for b in "ba cent dor el fir gus".split()]


def words(n: int, seed: int) -> list[str]:
    return random.Random(seed).choices(VOCABULARY, k=n)


# Nulls, empty and blank texts, ties, repeated rows, a null id and a long text.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t"),
    (4, "One."),
    (4, "One."),
    (5, "One."),
    (None, "no id " * 20),
    (6, "line\nline\n\nother line of words\nline"),
    (7, " ".join(words(30_000, 1))),
    (8, "a\tb  c\x1cd <|endoftext|> é😀 x's y"),
]
