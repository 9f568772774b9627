"""Alignment of two tokenizers against the libraries' own tokens of whole texts."""

from __future__ import annotations

import hashlib
import json
import random
from collections import Counter

import pytest

from conftest import prose
from shelfwise.llm import alignment, queries
from shelfwise.llm.bpe import byte_characters
from shelfwise.llm.common import table, tokenizer_path

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path(A))
    a.encode_special_tokens = True
    vocab = json.load(open(tokenizer_path(A), encoding="utf-8"))["model"]["vocab"]
    characters = byte_characters()
    bytes_a = {i: bytes(characters[c] for c in t) for t, i in vocab.items() if all(c in characters for c in t)}
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(B)), bytes_a


def brute_force(texts, libraries):
    """Whole texts, byte by byte: groups, links and corpus counts."""
    a, b, bytes_a = libraries
    docs = []
    for text in texts:
        groups, links, ids, pieces = [], [], [], []
        if text:
            ids = a.encode(" " + text, add_special_tokens=False).ids
            pieces = b.encode(text)
            raw_a = [bytes_a[i] for i in ids]
            names = [b.id_to_piece(i) for i in pieces]
            raw_b = [bytes([int(n[3:5], 16)]) if len(n) == 6 and n.startswith("<0x") else n.replace("▁", " ").encode() for n in names]
            if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
                ids, pieces = [], []
        ends, end = {}, 0
        for side, (tokens, raws) in enumerate(((ids, raw_a if ids else []), (pieces, raw_b if ids else []))):
            end = 0
            for i, raw in zip(tokens, raws):
                end += len(raw)
                ends.setdefault(end, [[], []])[side].append(i)
        open_a, open_b = [], []
        for end in sorted(ends):
            here_a, here_b = ends[end]
            open_a, open_b = open_a + here_a, open_b + here_b
            if here_a and here_b:
                links += [(x, y) for x in here_a for y in here_b]
                groups.append(f"{','.join(map(str, open_a))}|{','.join(map(str, open_b))}")
                open_a, open_b = [], []
        docs.append((len(ids), len(pieces), groups, links))
    count = Counter(link for d in docs for link in d[3])
    best = Counter()
    for (x, y), n in count.items():
        best[y] = max(best[y], n)
    return [
        (
            n_a, n_b, len(groups), len(links), sum(count[k] == best[k[1]] for k in links), sum(count[k] for k in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for n_a, n_b, groups, links in docs
    ]


def found(docs, **options):
    rows = alignment.align(docs, tokenizer_path(A), tokenizer_path(B), **options).documents.select(*COLUMNS).collect()
    return [tuple(r)[1:] for r in sorted(rows, key=lambda r: r[0])]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 1, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, row long, part string, block string")


AWKWARD = [
    None, "", " ", "  two  blanks ", "▁mark", "plain ▁ inside", "a<s>b</s> <0x41> <|endoftext|> <unk>", "\x00 nul", "tab\tend\r\n next",
    "日本語 テスト é́ ﬁ Å 😀👩‍👩‍👧", "it's we'll they've", "a" * 3000, "nbsp  x 　 y \x1c z \x85 w", "same text here", "same text here",
]


@pytest.mark.parametrize("chunk_bytes", [16_384, 64, 7])
def test_awkward_texts_equal_brute_force(spark, libraries, chunk_bytes):
    texts = [*AWKWARD, prose(1, 3000), prose(2, 300) + "x" * 500 + " " + prose(3, 40), prose(4, 200) + " ▁ " + prose(5, 200)]
    if chunk_bytes < 64:
        texts = texts[:15] + [prose(2, 30) + " " + "x" * 50 + " " + prose(3, 20), prose(4, 20) + " ▁ " + prose(5, 20)]
    assert found(frame(spark, texts), chunk_bytes=chunk_bytes) == brute_force(texts, libraries)


def test_query_equals_brute_force(spark, small, libraries):
    rows = sorted(table(spark, small, "documents").select("doc_id", "text").collect())
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op12_alignment"](spark, small).collect()}
    assert got == dict(zip([r[0] for r in rows], brute_force([r[1] for r in rows], libraries)))


def test_tables_without_tokens_and_null_ids(spark):
    assert found(frame(spark, ["x"]).limit(0)) == []
    assert found(frame(spark, [None, ""])) == [(0,) * 6 + ("",)] * 2
    rows = spark.createDataFrame([(None, "two words"), (None, "two words"), (1, "two words")], "doc_id long, text string")
    result = alignment.report(rows, tokenizer_path(A), tokenizer_path(B)).collect()
    assert sorted(str(r["doc_id"]) for r in result) == ["1", "None", "None"] and {r["count_sum"] for r in result} == {6}


def test_groups_and_pairs_are_given(spark, libraries):
    texts = ["some words align, some don't", prose(7, 400)]
    result = alignment.align(frame(spark, texts), tokenizer_path(A), tokenizer_path(B), keep_groups=True)
    groups = {r["doc_id"]: r["groups"] for r in result.units.filter("part is null").collect()}
    for i, expected in enumerate(brute_force(texts, libraries)):
        assert hashlib.sha256(groups[i].encode()).hexdigest() == expected[-1]
    pairs = result.pairs.collect()
    assert sum(r["count"] for r in pairs) == sum(row[3] for row in brute_force(texts, libraries))
    assert {r["b"] for r in pairs} == {r["b"] for r in pairs if r["best"]}


def pieces_of(draw, n):
    """Random fragments over a made-up pair of token streams, and their groups in one pass."""
    tokens, open_a, open_b, groups = [], [], [], []
    for k in range(n):
        side, shared = draw.random() < 0.5, draw.random() < 0.3 or k == n - 1
        (open_a if side or shared else open_b).append(k)
        if shared:
            open_b.append(k)
        tokens.append((k, "s" if shared else "a" if side else "b"))
        if shared:
            groups.append(f"{','.join(map(str, open_a))}|{','.join(map(str, open_b))}")
            open_a, open_b = [], []
    return tokens, groups


def fragment_of(tokens, part):
    """One fragment and its closed groups."""
    a, b, groups = [], [], []
    for k, kind in tokens:
        if kind in "as":
            a.append(k)
        if kind in "bs":
            b.append(k)
        if kind == "s":
            groups.append((alignment.ids_text(a), alignment.ids_text(b)))
            a, b = [], []
    if not groups:
        return alignment.Fragment(False, part, alignment.ids_text(a), alignment.ids_text(b)), []
    return alignment.Fragment(True, part, *groups[0], alignment.ids_text(a), alignment.ids_text(b)), [f"{x}|{y}" for x, y in groups[1:]]


def test_composition_is_associative_for_any_cuts_and_any_tree():
    for seed in range(200):
        draw = random.Random(seed)
        tokens, groups = pieces_of(draw, draw.randint(1, 40))
        cuts = sorted(draw.sample(range(len(tokens) + 1), draw.randint(0, min(6, len(tokens)))))
        runs = [tokens[i:j] for i, j in zip([0, *cuts], [*cuts, len(tokens)])]
        texts, level = {}, []
        for part, run in enumerate(runs):
            fragment, closed = fragment_of(run, part)
            texts[part, 1] = closed
            level.append(fragment)
        while len(level) > 1:
            at = draw.randrange(len(level) - 1)
            whole, seam = alignment.compose(level[at], level[at + 1])
            if seam:
                texts[seam[0], 0] = [seam[1]]
            level[at : at + 2] = [whole]
        root = level[0]
        assert root.cut and not root.tail_a and not root.tail_b
        texts[root.first_cut, 0] = [f"{root.head_a}|{root.head_b}"]
        assert [g for key in sorted(texts) for g in texts[key]] == groups
