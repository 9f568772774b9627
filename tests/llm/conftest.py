"""Small tables with awkward rows, shared by the operators' tests."""

from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "size int, key string, ids string, block string, ranges string, signed string, row string"
)


def frame(spark, texts, ids=None, sources=None):
    """Documents with extra columns whose names the operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    sources = ["s"] * len(texts) if sources is None else sources
    rows = [
        (i, t, "en", s, len(t) if t is not None else None, 7, "k", "x", "b", "r", "s", "w")
        for i, t, s in zip(ids, texts, sources)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    parts = ["tion", "er", "an", "the", "ou", "st", "ré", "lich", "ing", "a", "o", "qu"]
    return " ".join("".join(draw.choices(parts, k=draw.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="session")
def awkward_texts():
    """Null, empty, blank, one word, long, repeated and multi-byte texts."""
    long = prose(1, 4000)
    return [None, "", " \n\t", "word", long, long, prose(2, 60), "日本語 テスト \x00 é", "a" * 3000, prose(2, 60)]
