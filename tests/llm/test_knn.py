from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from oracle import connect, differences
from shelfwise.llm import knn, queries

SCHEMA = "vec_id long, embedding array<float>, label int, v string, cell string"


def brute(rows, k):
    usable = {
        i: [math.floor(64 * float(x)) for x in v]
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for q, a in usable.items():
        if q % 20 == 0:
            scored = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in usable.items() if i != q]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def found(spark, rows, **options):
    table = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)
    return sorted(map(tuple, knn.search(table, F.col("vec_id") % 20 == 0, **options).collect()))


@pytest.mark.parametrize("salted", [{}, {"block_rows": 25, "query_rows": 2, "pivots": 5}])
def test_equals_brute_force_with_ties_and_unusable_rows(spark, salted):
    draw = random.Random(4)
    rows = [(i, [round(draw.gauss(0, 1), 1) for _ in range(4)]) for i in range(130)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(130, 190)]  # one hot vector, many ties
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [math.nan, 0.0, 0.0, 0.0]), (203, [math.inf, 0.0, 0.0, 0.0])]
    rows += [(204, [2.0, 1.0]), (None, [1.0, 1.0, 1.0, 1.0]), rows[3], rows[20]]
    expected = brute([r for r in rows if r[0] != 204] + [(204, [2.0, 1.0, 0.0, 0.0])], 20)
    assert found(spark, rows, **salted) == expected


def test_clustered_data_is_pruned_and_exact(spark):
    draw = random.Random(5)
    rows = [(i, [8.0 * (i % 4 == j) + draw.gauss(0, 0.1) for j in range(4)]) for i in range(200)]
    assert found(spark, rows, k=3, pivots=4) == brute(rows, 3)


def test_few_rows_and_none(spark):
    assert found(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 64 * 128)]
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, [(1, [1.0]), (2, [3.0])]) == []  # no query
    assert found(spark, []) == []
    assert found(spark, [(0, None), (20, [])]) == []


def test_query_agrees_with_sql(spark, small):
    assert differences(queries.op1_knn(spark, small), connect(small), queries.ORACLE_SQL["op1_knn"]) is None
