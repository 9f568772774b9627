from __future__ import annotations

import re

import numpy as np
import corpus_pipeline
import __spark_entry__ as entry_point
from shelfwise.llm import mixing, queries, toxicity
from test_pii import luhn


def test_registered_queries_and_sql():
    names = entry_point.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_stages_pass_documents_on(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        seen[name] = (before, docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns

    ids = {n: ({r["doc_id"] for r in a.collect()}, {r["doc_id"] for r in b.collect()}) for n, (a, b) in seen.items()}
    model = toxicity.train(seen["toxicity"][0], spark.read.parquet(f"{small}/labels.parquet"))
    rejected = {r["doc_id"] for r in seen["toxicity"][0].collect() if model.score(r["text"], {}) >= toxicity.THRESHOLD}
    assert ids["toxicity"][0] - ids["toxicity"][1] == rejected

    from shelfwise.llm import jaccard

    classes = {r["class_id"] for r in jaccard.join(seen["near_copies"][0]).collect()}
    assert ids["near_copies"][1] == classes and seen["near_copies"][1].count() == len(classes)

    texts = {r["doc_id"]: r["text"] for r in seen["personal_data"][1].collect()}
    for row in seen["personal_data"][0].collect():
        for value in re.findall(r"(?<!\w)(?:\d{16}|\+1 \(\d{3}\) \d{3}-\d{4})(?!\w)", row["text"]):
            if "+" in value or luhn(value):
                assert value not in texts[row["doc_id"]]
    assert ids["personal_data"][0] == ids["personal_data"][1]

    taken = {r["doc_id"]: r["mix"] for r in mixing.mix(seen["mixing"][0]).collect()}
    times = {r["doc_id"]: r["count"] for r in seen["mixing"][1].groupBy("doc_id").count().collect()}
    assert all(times.get(i, 0) == int(m["taken"] / m["size"] + 0.5) for i, m in taken.items() if m["size"])

    assert all(r["n_tokens"] == len(np.frombuffer(r["ids"], "<u4")) > 0 for r in seen["bpe"][1].collect())
