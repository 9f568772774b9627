from __future__ import annotations

import pytest
from conftest import frame, prose
from pyspark.sql import functions as F

from oracle import connect, differences
from shelfwise.llm import mixing, queries


def mixed(docs, **options):
    return {r["doc_id"]: r["mix"] for r in mixing.mix(docs, **options).select("doc_id", "mix").collect()}


def water(sizes, weights=(5, 2, 1), most=3):
    """Targets by resharing the excess until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = [s for s in rest if share[s] > most * sizes[s] + 1e-9]
        if not above:
            return capped | share
        capped |= {s: most * sizes[s] for s in above}


@pytest.mark.parametrize("buckets", [4096, 3])
def test_targets_and_taken_words(spark, buckets):
    sources = ["b", "a", None, "c", "é"]
    texts = [prose(i, 5 + (i * 7) % 60) for i in range(100)] + [None, "", "one"]
    source = [sources[0] if i % 3 == 0 else sources[i % 5] for i in range(100)] + ["a", "tiny", "d"]
    rows = mixed(frame(spark, texts, sources=source), buckets=buckets)
    sizes = {}
    for text, s in zip(texts, source):
        sizes[s] = sizes.get(s, 0) + len((text or "").split())
    targets = water(sizes)
    for s, total in sizes.items():
        own = [rows[i] for i in range(len(texts)) if source[i] == s]
        assert all(r["source_size"] == total and r["target"] == pytest.approx(targets[s]) for r in own)
        assert sum(r["taken"] for r in own) == round(targets[s])
        whole = int(targets[s] // total) if total else 0
        assert all(whole * r["size"] <= r["taken"] <= min(3, whole + 1) * r["size"] for r in own)
        assert sum(0 < r["taken"] - whole * r["size"] < r["size"] for r in own) <= 1
    assert rows == mixed(frame(spark, texts, sources=source).repartition(5), buckets=buckets)


def test_awkward_rows(spark, awkward_texts):
    docs = frame(spark, awkward_texts)
    rows = mixing.mix(docs)
    assert rows.columns == [*docs.columns, "mix"] and rows.count() == len(awkward_texts)
    assert mixing.mix(docs, into="key").schema["key"].dataType.names == ["size", "source_size", "target", "taken"]
    assert mixing.mix(docs.limit(0)).count() == 0
    again = docs.unionByName(docs)
    assert sum(r["mix"]["taken"] for r in mixing.mix(again).collect()) == mixing.mix(again).first()["mix"]["source_size"]
    assert all(r["mix"]["taken"] == 0 for r in mixing.mix(frame(spark, [None, "", " "])).collect())


def test_better_documents_come_first_more_often(spark):
    texts = [prose(i, 20) if i % 2 else "zzzzzzzzzzzzzzzzzzzzzzzzzzz " * 20 for i in range(400)] + [prose(1000 + i, 20) for i in range(100)]
    rows = mixed(frame(spark, texts, sources=["b"] * 400 + ["a"] * 100))
    good, bad = (sum(rows[i]["taken"] > 0 for i in range(400) if i % 2 == k) for k in (1, 0))
    assert good > 1.5 * bad


def test_repeated_rows_of_the_mix(spark):
    docs = frame(spark, [prose(i, 10) for i in range(30)], sources=["a"] * 3 + ["b"] * 27)
    rows = mixed(docs)
    counts = {r["doc_id"]: r["count"] for r in mixing.repeated(mixing.mix(docs)).groupBy("doc_id").count().collect()}
    assert counts == {i: round(r["taken"] / r["size"]) for i, r in rows.items() if r["taken"] * 2 >= r["size"] and round(r["taken"] / r["size"])}
    assert mixing.repeated(mixing.mix(docs)).columns == docs.columns


def test_query_agrees_with_sql(spark, small):
    assert differences(queries.op9_mixing(spark, small), connect(small), queries.ORACLE_SQL["op9_mixing"]) is None
