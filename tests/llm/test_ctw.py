from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import frame, prose

from shelfwise.llm import ctw, queries


class Tree:
    """Brute force: context trees kept in dictionaries, weighted recursively."""

    def __init__(self, texts):
        self.counts = Counter()
        for data in texts:
            for context, byte in self.steps(data):
                for bit in range(8):
                    node = (1 << bit) | (byte >> (8 - bit))
                    for depth in range(ctw.DEPTH + 1):
                        self.counts[context[:depth], node, (byte >> (7 - bit)) & 1] += 1
        self.children = {}
        for context, node, _ in self.counts:
            if context:
                self.children.setdefault((context[:-1], node), set()).add(context)
        self.known = {}

    @staticmethod
    def steps(data):
        padded = bytes([255]) * ctw.DEPTH + data + bytes([255])
        for i in range(ctw.DEPTH, len(padded)):
            yield padded[i - ctw.DEPTH : i][::-1], padded[i]

    def weigh(self, context, node):
        if (context, node) not in self.known:
            a, b = self.counts[context, node, 0], self.counts[context, node, 1]
            own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
            if len(context) == ctw.DEPTH:
                self.known[context, node] = (own, own, (a, b))
            else:
                below = sum(self.weigh(c, node)[1] for c in self.children.get((context, node), ()))
                self.known[context, node] = (own - below, float(np.logaddexp(own, below)) - math.log(2), (a, b))
        return self.known[context, node]

    def score(self, data):
        total = 0.0
        for context, byte in self.steps(data):
            for bit in range(8):
                node, one = (1 << bit) | (byte >> (8 - bit)), (byte >> (7 - bit)) & 1
                p = None
                for depth in range(ctw.DEPTH, -1, -1):
                    ratio, _, (a, b) = self.weigh(context[:depth], node)
                    here = ((b if one else a) + 0.5) / (a + b + 1)
                    if p is None:
                        p = here
                    else:
                        own = 1 / (1 + math.exp(min(700, -ratio)))
                        p = own * here + (1 - own) * p
                total += math.log10(p)
        return total


def trained(i):
    return zlib.crc32(str(i).encode()) % 10 != 0


def check(rows, texts):
    folded = {i: (t or "").encode().lower() for i, t in texts.items()}
    counts = Counter(w for i, t in folded.items() if trained(i) for w in [*t.split(), b""])
    tokens, distinct = sum(counts.values()), len(counts)
    tree = Tree([t for i, t in folded.items() if trained(i)])
    assert len(rows) == len(texts)
    for row in rows:
        words = [*folded[row["doc_id"]].split(), b""]
        base = sum(math.log10((counts[w] + 0.1) / (tokens + 0.1 * (distinct + 1))) for w in words)
        assert row["held_out"] == (not trained(row["doc_id"]))
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(words), sum(counts[w] > 0 for w in words), tokens)
        assert row["base_score"] == pytest.approx(base, abs=1e-6)
        assert row["score"] == pytest.approx(tree.score(folded[row["doc_id"]]), rel=1e-6)


def test_equals_brute_force(spark, awkward_texts):
    texts = [t if t is None or len(t) < 800 else t[:800] for t in awkward_texts] + [prose(i, 25).upper() for i in range(30)]
    check(ctw.report(frame(spark, texts)).collect(), dict(enumerate(texts)))


def test_blocks_and_shards_do_not_matter(spark, monkeypatch):
    texts = [prose(i, 30) for i in range(40)]
    monkeypatch.setattr(ctw, "BLOCK_BYTES", 700)
    monkeypatch.setattr(ctw, "SHARD_GRAMS", 300)
    check(ctw.report(frame(spark, texts)).collect(), dict(enumerate(texts)))


def test_chances_add_up(spark):
    codes, _ = ctw.gram_codes([prose(3, 50).encode()])
    codes, counts = np.unique(codes, return_counts=True)
    context = codes[5] >> np.uint64(8) << np.uint64(8)
    every = np.unique(np.concatenate((codes, context | np.arange(256, dtype=np.uint64))))
    weights = np.zeros(len(every))
    weights[np.searchsorted(every, codes)] = counts
    chances, levels = ctw.shard_levels(every, weights)
    import pandas as pd

    roots = pd.concat(
        pd.DataFrame({"nearest": (x.keys >> np.uint64(16)).astype(int), "node": (x.keys & np.uint64(255)).astype(int),
                      "zeros": x.zeros, "ones": x.ones, "weighted": x.weighted}) for x in levels
    ).groupby(["nearest", "node"], as_index=False).sum()
    logs = ctw.log_chances(every, chances, ctw.top_levels(roots))
    of_context = np.searchsorted(every, context | np.arange(256, dtype=np.uint64))
    assert (10 ** logs[of_context]).sum() == pytest.approx(1, abs=1e-9)


def test_no_training_rows_and_no_rows(spark):
    docs = frame(spark, ["ab", None], [1, 2])
    from pyspark.sql import functions as F

    rows = {r["doc_id"]: r for r in ctw.score(docs.withColumn("train", F.lit(False))).collect()}
    assert rows[1]["score"] == pytest.approx(3 * 8 * math.log10(0.5)) and rows[1]["n_known"] == 0 and rows[1]["train_tokens"] == 0
    assert ctw.report(docs.limit(0)).count() == 0


def test_held_out_texts_score_better_than_single_bytes_would(spark, medium):
    rows = [r for r in queries.op7_context_trees(spark, medium).collect() if r["held_out"]]
    lengths = {r["doc_id"]: len(r["text"].encode()) for r in spark.read.parquet(f"{medium}/documents.parquet").collect()}
    bits = -sum(r["score"] for r in rows) * math.log2(10) / sum(lengths[r["doc_id"]] for r in rows)
    assert bits < 2.5


def test_a_block_is_counted_in_small_chunks():
    import tracemalloc

    import pandas as pd

    rows = pd.DataFrame({"text": [prose(i, 400) for i in range(2000)], "train": True, "block": 0})
    tracemalloc.start()
    counted = ctw.block_counts(rows)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    size = rows["text"].str.encode("utf-8").str.len().sum()
    assert size > 4_000_000 and counted["n"][counted["word"].isna()].sum() == size + len(rows)
    assert peak < 70_000_000
