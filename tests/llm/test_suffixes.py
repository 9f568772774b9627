from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from conftest import frame, prose

from shelfwise.llm import queries, suffixes


def brute(texts, least=400):
    raw = [(t or "").encode() for t in texts]
    counts = Counter(t[i : i + least] for t in raw for i in range(len(t) - least + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - least + 1):
            if counts[t[i : i + least]] > 1:
                gone[i : i + least] = b"\1" * least
        kept = bytes(b for b, x in zip(t, gone) if not x)
        out.append((len(t), kept, sum(1 for i, x in enumerate(gone) if x and (not i or not gone[i - 1]))))
    return out


def found(docs, **options):
    rows = {r["doc_id"]: (r["n_bytes"], bytes(r["kept"]), len(r["spans"])) for r in suffixes.remove_repeats(docs, **options).collect()}
    return [rows[i] for i in sorted(rows)]


def corpus():
    shared, hot = prose(1, 140), prose(2, 90)
    texts = [f"{prose(10 + i, 30)} {shared[i : i + 450]} {prose(50 + i, 30)}" for i in range(12)]
    texts += [f"{prose(200 + i, 9)} {hot} {prose(300 + i, 9)}" for i in range(25)]
    texts += [prose(3, 200), prose(3, 200), shared * 3, "é" * 500, "x" * 401, "y" * 400, "z" * 1000, "ab" * 700]
    return texts


@pytest.mark.parametrize("options", [{}, {"many_windows": 2}])
def test_equals_brute_force(spark, options):
    assert found(frame(spark, corpus()), **options) == brute(corpus())


def test_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 700)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 3000)
    assert found(frame(spark, corpus()), least=100) == brute(corpus(), 100)


def test_awkward_rows(spark, awkward_texts):
    assert found(frame(spark, awkward_texts)) == brute(awkward_texts)
    assert found(frame(spark, ["x"]).limit(0)) == []
    twice = frame(spark, [prose(5, 200), prose(6, 200)], ids=[1, 1])
    twice = twice.unionByName(twice.limit(1))
    assert sorted(len(r["spans"]) for r in suffixes.remove_repeats(twice).collect()) == [0, 1, 1]
    nulls = suffixes.remove_repeats(frame(spark, [prose(5, 200), prose(5, 200)], ids=[None, None])).collect()
    assert [len(r["kept"]) for r in nulls] == [0, 0]


def test_breadth_first_expansion_equals_brute_force():
    draw = random.Random(3)
    for _ in range(150):
        least, signs = draw.choice([8, 9, 12, 20, 40]), draw.choice([b"a", b"ab", b"abc"])
        base = bytes(draw.choices(signs, k=draw.randint(0, 120)))
        texts = []
        for _ in range(draw.randint(1, 6)):
            a = draw.randint(0, len(base))
            middle = base[a : draw.randint(a, len(base))]
            texts.append(bytes(draw.choices(b"xyz\0", k=draw.randint(1, 15))) + middle + bytes(draw.choices(signs, k=draw.randint(0, 20))))
        counts = Counter(t[i : i + least] for t in texts for i in range(len(t) - least + 1))
        expected = [[i for i in range(len(t) - least + 1) if counts[t[i : i + least]] > 1] for t in texts]
        assert [s.tolist() for s in suffixes.repeated_starts(texts, least)] == expected


def test_query_equals_brute_force(spark, small):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect())
    expected = {i: (n, n - len(k), s, hashlib.sha256(k).hexdigest()) for (i, _), (n, k, s) in zip(rows, brute([t for _, t in rows]))}
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in queries.op10_suffixes(spark, small).collect()}
    assert got == expected


def test_key_filter_leaves_out_no_key(spark):
    from shelfwise.llm.common import key_filter, with_maybe

    rows = spark.createDataFrame([(str(i) if i % 7 else None, i * i) for i in range(3000)], "doc_id string, text_key long")
    entered = rows.filter("text_key % 5 = 0")
    asked = with_maybe(rows, key_filter(entered, ["doc_id", "text_key"]), ["doc_id", "text_key"], "maybe")
    assert asked.columns == ["doc_id", "text_key", "maybe"] and asked.count() == 3000
    assert asked.filter("text_key % 5 = 0 and not maybe").count() == 0
    assert asked.filter("text_key % 5 <> 0 and maybe").count() < 30
    none = with_maybe(rows, key_filter(entered.limit(0), ["doc_id", "text_key"]), ["doc_id", "text_key"], "maybe")
    assert none.filter("maybe").count() == 0
