from __future__ import annotations

import random
from itertools import combinations

import pytest
from conftest import frame, prose

from shelfwise.llm import components, jaccard, queries


def shingles(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    links = {k: set() for k in range(len(sets))}
    for a, b in combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if sets[a][0] is not None and sets[b][0] is not None and x and y and 5 * len(x & y) >= 4 * len(x | y):
            links[a].add(b)
            links[b].add(a)
    out = []
    for k, (i, _) in enumerate(sets):
        seen, front = {k}, [k]
        while front:
            for n in links[front.pop()] - seen:
                seen.add(n)
                front.append(n)
        out.append((i, min(sets[n][0] for n in seen) if i is not None else None, len(links[k])))
    return out


def edited(text, changes, seed):
    draw, words = random.Random(seed), text.split()
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"new{draw.random()}"
    return " ".join(words)


def found(docs, **options):
    return sorted(map(tuple, jaccard.join(docs, **options).collect()), key=str)


def corpus():
    base, other = prose(1, 120), prose(2, 80)
    texts = [base, base, *(edited(base, 1, s) for s in range(30)), other, edited(other, 1, 3), edited(other, 8, 4)]
    return texts + [prose(100 + i, 50) for i in range(40)]


@pytest.mark.parametrize("block", [1024, 5])
def test_links_and_classes_equal_brute_force(spark, block):
    texts = corpus()
    assert found(frame(spark, texts), block_sets=block) == sorted(brute(list(enumerate(texts))), key=str)


def test_awkward_rows(spark, awkward_texts):
    ids = [9, 8, 7, 6, 5, 4, None, 2, 1, 0]
    rows = list(zip(ids, awkward_texts))
    assert found(frame(spark, awkward_texts, ids)) == sorted(brute(rows), key=str)
    assert found(frame(spark, ["x"]).limit(0)) == []
    assert found(frame(spark, [None, ""])) == [(0, 0, 0), (1, 1, 0)]


def test_one_of_each_keeps_clean_rows(spark, awkward_texts):
    docs = frame(spark, corpus() + awkward_texts)
    kept = sorted(r["doc_id"] for r in jaccard.one_of_each(docs).collect())
    wanted = sorted({c for _, c, _ in brute(list(enumerate(corpus() + awkward_texts)))})
    assert kept == wanted
    again = docs.unionByName(docs.limit(3))
    assert sorted(r["doc_id"] for r in jaccard.one_of_each(again).collect()) == wanted
    assert jaccard.one_of_each(docs).columns == docs.columns


def test_prefixes_shorten_to_the_target_recall():
    length = jaccard.prefix_length(0.8, 16, 8, 0.999)
    assert 1 - (1 - 0.8**length) ** 16 >= 0.999 > 1 - (1 - 0.8 ** (length + 1)) ** 16


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(5, 5), (None, 3), (7, None)]
    rows = dict(map(tuple, components.components(spark.createDataFrame(links, "u long, v long")).collect()))
    assert rows == {**{i: 0 for i in range(41)}, 100: 100, **{200 + i: 100 for i in range(50)}}


def test_query_equals_brute_force(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op8_jaccard(spark, small).collect()), key=str) == sorted(brute(rows), key=str)


def test_one_of_each_carries_columns_of_any_name(spark):
    text = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text, "a", "b"), (2, text, "c", "d"), (3, "other words that stand here alone", "e", "f")], "doc_id long, text string, gone string, twice string")
    assert sorted(tuple(r)[2:] for r in jaccard.one_of_each(docs).collect()) == [("a", "b"), ("e", "f")]
