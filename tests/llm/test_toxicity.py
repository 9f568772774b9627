from __future__ import annotations

import random
import zlib

import pytest
from conftest import frame, prose

from shelfwise.llm import queries, toxicity

BAD = ["blargh", "snorkface", "grumbel"]


def held_out(i: int) -> bool:
    return zlib.crc32(str(i).encode()) % 4 == 2


@pytest.fixture(scope="module")
def model(spark):
    draw = random.Random(3)
    texts, marks = [], []
    for i in range(600):
        words = prose(i, 30).split()
        toxic = i % 5 == 0
        if toxic:
            words[draw.randrange(30)] = draw.choice(BAD) + draw.choice(["", "er", "."])
        texts.append(" ".join(words))
        marks.append((i, 1, int(toxic)))
    labels = spark.createDataFrame([*marks, (None, 1, 1), (3, 1, None), (5, 0, 0)], "doc_id long, quality int, toxic int")
    return toxicity.train(frame(spark, texts), labels)


def test_restoring_obfuscated_words(model):
    plain = {w: toxicity.restore(w, model.letters) for w in ("b l a r g h", "bl4rgh", "blaaaargh", "b.l.a.r.g.h", "$norkf@ce", "gruuumb3l")}
    assert set(plain.values()) <= {"blargh", "snorkface", "grumbel"}


def test_obfuscated_words_score_as_plain_ones(model):
    clean = model.score(prose(9000, 30), {})
    for word in ("blargh", "Blargh!", "bl4rgh", "b l a r g h", "blaaaargh", "$norkf@ce"):
        assert model.score(f"{prose(9000, 30)} {word} {prose(9001, 30)}", {}) > max(clean, toxicity.THRESHOLD)
    assert clean < toxicity.THRESHOLD


def test_awkward_rows_get_a_defined_score(spark, model, awkward_texts):
    rows = {r["doc_id"]: r["key"] for r in toxicity.score(frame(spark, awkward_texts), model, "key").collect()}
    assert all(0 <= rows[i] < toxicity.THRESHOLD for i in range(len(awkward_texts)))
    assert rows[0] == rows[1] == rows[2] and rows[4] == rows[5]


def test_no_labels_teach_nothing(spark):
    docs = frame(spark, ["a", "b"])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in toxicity.report(docs, none).collect()] == [0.0, 0.0]
    assert toxicity.report(docs.limit(0), none).count() == 0


def test_labels_of_held_out_rows_are_not_used(spark):
    docs = frame(spark, [f"blargh {i}" if i % 2 else f"fine {i}" for i in range(80)])
    marks = [(i, 1, (i % 2) ^ held_out(i)) for i in range(80)]  # held-out labels say the opposite
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    rows = toxicity.report(docs, labels).collect()
    assert all(r["held_out"] == held_out(r["doc_id"]) for r in rows)
    assert all(r["predicted"] == r["doc_id"] % 2 for r in rows)


def test_query_finds_held_out_toxic_documents(spark):
    folder = "/root/testdata/sf0.1"
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in queries.op5_toxicity(spark, folder).collect() if r["held_out"] and r["doc_id"] in marks]
    hits = sum(r["predicted"] and marks[r["doc_id"]] for r in rows)
    assert hits >= 0.9 * sum(marks[r["doc_id"]] for r in rows) and hits >= 0.9 * sum(r["predicted"] for r in rows)


def test_further_spellings_score_as_plain_ones(model):
    for word in ("bl*rgh", "blarggh", "snorrkface", "(b l a r g h)", '"b  l  a  r  g  h"', "b\tl\ta\tr\tg\th", "b\nl\na\nr\ng\nh", "gr*mbel", "\"$norkf@ce\","):
        assert model.score(f"{prose(9000, 30)} {word} {prose(9001, 30)}", {}) > toxicity.THRESHOLD, word


def test_signs_at_a_words_end_and_masks_stand_for_letters():
    letters = toxicity.Letters()
    for word in ("grass", "mass", "stupid"):
        marked = f"^^{word}$"
        for i in range(len(marked) - 2):
            letters.triples[marked[i : i + 3]] = letters.triples.get(marked[i : i + 3], 0) + 50
            letters.pairs[marked[i : i + 2]] = letters.pairs.get(marked[i : i + 2], 0) + 50
    for token, word in (("gra$$", "grass"), ("mas$", "mass"), ("'ma$$',", "mass"), ("st*pid", "stupid"), ("stuupid", "stupid")):
        assert word in toxicity.forms(token, letters), token


def unpruned(model, text):
    """The score from every token's spellings, all of them restored, without the test of what may reach a stem."""
    import math

    found = []
    for token in toxicity.words_of(text, model.letters):
        best = max((model.weights.get(s, 0.0) for w in toxicity.forms(token, model.letters) for s in toxicity.stems(w)), default=0.0)
        if best > 0:
            found.append(best)
    first, second = (sorted(found, reverse=True) + [0.0, 0.0])[:2]
    x = (1.0, first, second, math.log1p(sum(w > 1 for w in found)))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(model.coefficients, x))))))


def test_scores_equal_brute_force_over_all_spellings(spark, model, awkward_texts):
    draw = random.Random(5)
    spellings = ["bl4rgh", "b*argh", "bl**gh", "b l a r g h", "$norkf@ce", "grum-bel", "gruuumbbel", "blar.gh", "*****", "a" + "*" * 60, "(snorkface!", "bl@rgh!!", "1|1|", "snork", "gr*mb3l*"]
    texts = [t or "" for t in awkward_texts if t is None or len(t) < 5000]
    texts += [f"{prose(k, 20)} {' '.join(draw.choices(spellings, k=3))} {prose(k + 50, 10)}" for k in range(40)]
    for text in texts:
        assert model.score(text, {}) == pytest.approx(unpruned(model, text), abs=1e-12), text


def test_query_scores_equal_brute_force(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{name}.parquet") for name in ("documents", "labels"))
    learned = toxicity.train(docs, labels)
    rows = {r["doc_id"]: r["score"] for r in toxicity.score(docs.select("doc_id", "text"), learned, "score").collect()}
    for r in docs.select("doc_id", "text").collect():
        if learned.coefficients is not None:
            assert rows[r["doc_id"]] == pytest.approx(unpruned(learned, r["text"] or ""), abs=1e-12), r["doc_id"]
