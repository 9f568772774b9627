from __future__ import annotations

import hashlib
import re
import time

import pytest
import xxhash
from conftest import frame, prose
from pyspark.sql import functions as F

from shelfwise.llm import fingerprints, queries


UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\U00020000-\U000323af"
WORDS = re.compile(f"[{UNSPACED}]|[^ \\t\\n\\x0b\\x0c\\r{UNSPACED}]+")


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def pieces(text):
    """Runs of words that end where the hash of a word and the one before divides by six, cut again after 48 words."""
    words = WORDS.findall(text)
    hashes = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in words]
    runs, run = [], []
    for i, (w, h) in enumerate(zip(words, hashes)):
        run.append(w)
        before = hashes[i - 1] if i else 0
        if (h ^ (before >> 3)) % 6 == 0 or i == len(words) - 1:
            runs += [tuple(run[k : k + 48]) for k in range(0, len(run), 48)]
            run = []
    return set(runs)


def likeness(a, b):
    a, b = pieces(a), pieces(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    texts = [t or "" for _, t in order]
    out = {}
    for k, (i, text) in enumerate(zip((i for i, _ in order), texts)):
        following = texts[(k + 1) % len(texts)]
        n = len(text) // 3
        edited = text[: len(text) - n] + following[:n]
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), likeness(text, edited), likeness(text, following))
    return out


def found(docs):
    return {r["doc_id"]: (r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in fingerprints.report(docs).collect()}


def assert_close(a, b):
    assert a.keys() == b.keys()
    for i in a:
        assert a[i][:2] == b[i][:2] and a[i][2:] == pytest.approx(b[i][2:], abs=1e-12), i


def test_awkward_rows_equal_brute_force(spark, awkward_texts):
    ids = [5, 17, 3, 900, 44, 45, 46, None, 1, 2]
    assert_close(found(frame(spark, awkward_texts, ids)), expected(list(zip(ids, awkward_texts))))


def test_buckets_join_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "BUCKET_BYTES", 500)
    texts = [prose(i, 40) for i in range(60)]
    ids = [i * i for i in range(60)]
    assert_close(found(frame(spark, texts, ids)), expected(list(zip(ids, texts))))


def test_one_document_none_and_repeated_ids(spark):
    assert_close(found(frame(spark, ["abcdef ghi"], [4])), expected([(4, "abcdef ghi")]))
    assert found(frame(spark, ["x"]).limit(0)) == {}
    rows = fingerprints.report(frame(spark, ["a b", "a b", "c"], [1, 1, 1])).collect()
    assert len(rows) == 3 and len({r["fingerprint"] for r in rows}) == 2


@pytest.mark.parametrize("unlike", [0, 3, 20, 60, 400])
def test_wider_sketches_recover_larger_differences(spark, unlike):
    a = [f"common {i}" for i in range(150)] + [f"left {i}" for i in range(unlike)]
    b = [f"common {i}" for i in range(150)] + [f"right {i}" for i in range(unlike // 2)]
    table = spark.createDataFrame([(a, b)], "a array<string>, b array<string>")
    hashed = lambda c: F.transform(c, lambda p: fingerprints.let(F.shiftleft(F.xxhash64(p), 16), fingerprints.marked))
    table = table.select(hashed("a").alias("a"), hashed("b").alias("b"))
    sketches = [fingerprints.sketch(F.col(c), fingerprints.WIDTH) for c in "ab"]
    got = table.select(fingerprints.difference(F.col("a"), F.col("b"), *sketches).alias("d")).first()["d"]
    assert (got["plus"], got["minus"]) == (unlike, unlike // 2)


def test_narrow_sketch_gives_up_instead_of_guessing(spark):
    values = F.transform(F.sequence(F.lit(1), F.lit(300)), lambda i: fingerprints.let(F.shiftleft(F.xxhash64(i), 16), fingerprints.marked))
    empty = F.array().cast("array<bigint>")
    cells = fingerprints.subtracted(fingerprints.sketch(values, 16), fingerprints.sketch(empty, 16))
    assert spark.range(1).select(fingerprints.peeled(cells, 16).alias("p")).first()["p"] is None


def test_plan_has_no_python_and_query_equals_brute_force(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    result = queries.op6_fingerprints(spark, small)
    assert "Python" not in result._jdf.queryExecution().executedPlan().toString()
    assert_close({r["doc_id"]: (r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in result.collect()}, expected(rows))


def alike(spark, pairs):
    """likeness of pairs of texts and their digests' Jaccard coefficient."""
    table = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "id int, a string, b string")
    table = table.select("id", *[fingerprints.digests(F.col(c)).alias(c) for c in "ab"])
    sketches = [fingerprints.sketch(F.col(c), fingerprints.WIDTH) for c in "ab"]
    exact = F.size(F.array_intersect("a", "b")) / F.size(F.array_union("a", "b"))
    rows = table.select("id", fingerprints.likeness(F.col("a"), F.col("b"), *sketches).alias("got"), exact.alias("exact")).collect()
    return [(r["got"], r["exact"]) for r in sorted(rows)]


def test_near_copies_are_near(spark):
    texts = [prose(i, 400 if i else 9000) for i in range(20)]
    ahead = alike(spark, [(t, f"new {t}") for t in texts])
    replaced = alike(spark, [(t, " ".join(f"w{k}" if k % 50 == 7 else w for k, w in enumerate(t.split()))) for t in texts])
    for got, exact in ahead + replaced:
        assert got == pytest.approx(exact, abs=1e-12)
    assert min(got for got, _ in ahead) > 0.9
    assert sum(got for got, _ in replaced) / len(replaced) > 0.7
    unspaced = "".join(chr(0x4E00 + k * k % 5003) for k in range(600))
    assert alike(spark, [(unspaced, f"日{unspaced}")])[0][0] > 0.9


def test_edited_texts_and_order_with_pieces_cut_by_content(spark, awkward_texts):
    ids = [5, 17, 3, 900, 44, 45, 46, None, 1, 2]
    rows = {r["doc_id"]: r for r in fingerprints.report(frame(spark, awkward_texts, ids)).collect()}
    for i, (length, digest, *_) in expected(list(zip(ids, awkward_texts))).items():
        assert (rows[i]["n_chars"], rows[i]["edited_sha256"]) == (length, digest)
    assert rows[900]["near_next"] < 0.5 < rows[44]["near_edited"]


def test_words_of_spaced_and_unspaced_texts(spark, awkward_texts):
    texts = [t or "" for t in awkward_texts] + ["", " ", " a  b\t\n", "\x0b\x0ca\x1cb c d\x85e\r", "ab 日本 c", "日", "ไทย x", " 𠀀y ", "a\x00b"]
    rows = frame(spark, texts)
    plain = F.regexp_extract_all(F.col("text"), F.lit(fingerprints.PIECE_WORD), F.lit(0))
    assert rows.select(fingerprints.words_of(F.col("text")).alias("w"), plain.alias("p")).filter("w <> p or w is null").count() == 0


def test_words_between_blanks_are_split_without_the_pattern_of_words(spark):
    """Texts without unspaced signs are cut by a plain split: the pattern of words costs more than twice as much."""
    rows = frame(spark, [" ".join(f"word{i % 97}" for i in range(60_000))] * 8).repartition(1).localCheckpoint()

    def seconds(words):
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            rows.select(F.sum(F.size(words(F.col("text"))))).collect()
            runs.append(time.perf_counter() - start)
        return min(runs)

    assert seconds(fingerprints.words_of) < seconds(lambda t: F.regexp_extract_all(t, F.lit(fingerprints.PIECE_WORD), F.lit(0)))
