from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from conftest import frame
from tokenizers import Tokenizer

from shelfwise.llm import bpe, queries
from shelfwise.llm.common import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Vocabulary(file.read())


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


TEXTS = [
    "don't you're I'll we've 'tis ''s it's' 's  x", "  \n a  b\t c   d e ", "a" * 999, "<|endoftext|>hi<|endoftext|><|endoftext|> x",
    "\x1c\x1d a\x85b", "日本語 テスト 123４５", "'r 're're", "'", "I'llama 've", "\x00\x00a", "🙂🙂 é",
]


def test_ids_equal_the_library(library, vocabulary, awkward_texts):
    texts = TEXTS + [t or "" for t in awkward_texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.encode_texts(texts, vocabulary)] == [ids_of(library, t) for t in texts]


def test_random_texts(library, vocabulary):
    draw = random.Random(1)
    signs = [*"ab' \n\tstlrevmd1!.é漢", "  ", "'s", "'ll", "<|endoftext|>"]
    texts = ["".join(draw.choices(signs, k=draw.randint(0, 40))) for _ in range(3000)]
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.encode_texts(texts, vocabulary)] == [ids_of(library, t) for t in texts]
    assert np.frombuffer(bpe.one_by_one(texts[7], vocabulary), "<u4").tolist() == ids_of(library, texts[7])


def test_round_trip_and_columns(spark, awkward_texts):
    encoded = bpe.encode(frame(spark, awkward_texts), PATH)
    assert encoded.columns.count("ids") == 1 and "block" in encoded.columns
    decoded = {r["doc_id"]: r["decoded"] for r in bpe.decode(encoded, PATH).collect()}
    assert [decoded[i] for i in range(len(awkward_texts))] == [t or "" for t in awkward_texts]
    assert bpe.encode(frame(spark, ["x"]).limit(0), PATH).count() == 0


def test_broken_ids_decode_with_replacement_signs(spark, vocabulary):
    half = bpe.encode_texts(["é"], vocabulary)[0]
    lone = int(vocabulary.byte_ids[0xC3])
    table = spark.createDataFrame([(1, bytearray(np.array([lone], "<u4").tobytes())), (2, bytearray(half)), (3, None)], "id int, ids binary")
    assert {r["id"]: r["decoded"] for r in bpe.decode(table, PATH).collect()} == {1: "�", 2: "é", 3: ""}


def test_query_equals_the_library(spark, small, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries.op4_bpe(spark, small).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = ids_of(library, texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
