"""Filter audit against the checking SQL and brute force over every order."""

from __future__ import annotations

import random
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle import connect, differences
from shelfwise.llm import filter_audit, queries


def test_gallop_unions_and_differences_equal_sets():
    for seed in range(300):
        draw = random.Random(seed)
        lists = [
            np.array(sorted(draw.sample(range(draw.choice([30, 3000, 100_000])), draw.randint(0, 30))), np.int64) for _ in range(draw.randint(0, 5))
        ]
        assert filter_audit.union(lists).tolist() == sorted(set().union(*map(set, map(np.ndarray.tolist, lists)))) if lists else True
        for ids in lists:
            target, at = draw.randint(0, 100_000), draw.randint(0, len(ids))
            place = filter_audit.gallop(ids, target, at)
            assert place == max(at, int(np.searchsorted(ids, target)))
            assert filter_audit.difference(ids, lists[0]).tolist() == sorted(set(ids.tolist()) - set(lists[0].tolist()))


@pytest.mark.parametrize("folder", ["small", "medium"])
def test_query_equals_sql(spark, request, folder):
    path = request.getfixturevalue(folder)
    assert differences(queries.QUERIES["op11_filter_audit"](spark, path), connect(path), queries.ORACLE_SQL["op11_filter_audit"]) is None


def brute_force(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails = []
    for i, text, _ in docs:
        text = text or ""
        words = [w for w in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in text).split(" ") if w]
        f = {"A"} if len(words) < 100 else set()
        f |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
        f |= {"C"} if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text) else set()
        f |= {"D"} if set(text) & set("#$%&*|") else set()
        f |= {"E"} if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs) else set()
        fails.append(f)
    out = {}
    for part in {lang or "" for *_, lang in docs}:
        rows = [(i, f) for (i, _, lang), f in zip(docs, fails) if (lang or "") == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = rows
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                shapley[x] += len(gone)
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(x in f for _, f in rows) - len(gone), sum(f == {x} for _, f in rows),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                )
        for key in list(out):
            if key[0] == part and len(out[key]) == 6:
                out[key] += (shapley[key[1][key[2] - 1]],)
    return out


def test_awkward_rows_equal_brute_force(spark, awkward_texts, monkeypatch):
    monkeypatch.setattr(filter_audit, "RANGE", 4)
    texts = [*awkward_texts, "SHOUT OUT LOUD", "a|b", "word", "word", None, "Ünï" * 40, " ".join(map(str, range(120)))]
    docs = [(i % 13 if i % 7 else None, t, [None, "", "en", "de"][i % 4]) for i, t in enumerate(texts)]
    docs += docs[:4]
    labels = [(1, 1, 0), (1, 0, 1), (2, 0, 1), (3, None, None), (None, 1, 1), (5, 1, 1), (5, 1, 1), (99, 1, 1)]
    names = "doc_id long, text string, lang string, part string, range string, rows string, digest string, id string, first string"
    frame = spark.createDataFrame([(*d, "p", "r", "n", "d", "i", "f") for d in docs], names)
    marks = spark.createDataFrame([(*m, "g") for m in labels], "doc_id long, quality int, toxic int, good string")
    columns = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in columns) for r in filter_audit.audit(frame, marks).collect()}
    assert found == brute_force(docs, labels)


def test_empty_tables_and_own_filters(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty, marks).count() == 0
    docs = spark.createDataFrame([(1, "x", "en"), (2, None, "en"), (3, "xy", "en")], "doc_id long, text string, lang string")
    own = lambda: {"P": F.col("text") == "x", "Q": F.col("text").contains("x")}
    rows = {(r["filter_order"], r["step"]): (r["kept"], r["removed"]) for r in filter_audit.audit(docs, marks, own, copies=None).collect()}
    assert rows == {("PQ", 1): (2, 1), ("PQ", 2): (1, 1), ("QP", 1): (1, 2), ("QP", 2): (1, 0)}
