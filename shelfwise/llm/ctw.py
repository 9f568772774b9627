"""Language-model scores by context-tree weighting over bytes.

Every byte is eight binary decisions; each decision has a context tree over the bytes before it,
the nearest first. A node's Krichevsky-Trofimov estimate of its training bits is weighted, half and half,
against the product of its children, so a text's code length mixes the estimates of all depths.
The counts come from the whole training corpus: n-grams are counted in blocks of documents,
added up by a shuffle, and the trees are weighted from the deepest contexts upwards, in shards of
two-byte contexts; only the two top levels, of fixed size, meet on the driver. For scoring, each
block of documents gets the probabilities of just the n-grams and words that occur in it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import learned, pieces, text_or_empty
from shelfwise.session import stored

DEPTH = 4  # bytes of context
TOP = 2  # contexts up to here are weighted in shards, shorter ones at once
END = 255  # no byte of UTF-8; stands before and after every text
BLOCK_BYTES = 24_000_000
CHUNK_BYTES = 500_000  # of text; its codes and their sorting take some sixty times that
SHARD_GRAMS = 300_000
SMOOTHING = 0.1


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x >= 0.5, by Stirling's series eight places up."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - math.log(math.pi) - log_gamma(zeros + ones + 1.0)


def folded(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z in lower case."""
    return (text or "").encode("utf-8", "replace").lower()


def gram_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all (context, byte) pairs of the texts, end marks included, and each text's number of codes.

    A code holds the context from the nearest byte to the farthest, then the byte itself.
    """
    pad = bytes([END]) * DEPTH
    data = np.frombuffer(b"".join(pad + t + bytes([END]) for t in texts), np.uint8).astype(np.uint64)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    codes = data[DEPTH:].copy()
    n = len(codes)
    for back in range(1, DEPTH + 1):
        codes |= data[DEPTH - back : DEPTH - back + n] << np.uint64(8 * (DEPTH + 1 - back))
    keep = np.ones(n, bool)
    ends = np.cumsum(sizes + DEPTH)[:-1] - DEPTH  # the next text's padding follows here
    for k in range(DEPTH):
        keep[ends + k] = False
    return codes[keep], sizes


class Level:
    """Nodes of one depth and bit: (context, bits so far) with estimates and weights."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, depth: int, bit: int, below: Level | None):
        context = codes >> np.uint64(8 * (DEPTH + 1 - depth))
        byte = (codes & np.uint64(255)).astype(np.uint64)
        prefix = np.uint64(1 << bit) | (byte >> np.uint64(8 - bit))
        self.keys, self.of = np.unique((context << np.uint64(8)) | prefix, return_inverse=True)
        self.one = ((byte >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)
        n = len(self.keys)
        self.ones = np.bincount(self.of, counts * self.one, n)
        self.zeros = np.bincount(self.of, counts * ~self.one, n)
        estimate = log_estimate(self.zeros, self.ones)
        if below is None:
            self.own, self.weighted = np.ones(n), estimate
        else:
            parent = ((below.keys >> np.uint64(16)) << np.uint64(8)) | (below.keys & np.uint64(255))
            children = np.bincount(np.searchsorted(self.keys, parent), below.weighted, n)
            self.own, self.weighted = weighed(estimate, children)

    def mixed(self, deeper: np.ndarray | None) -> np.ndarray:
        """Probability of each code's bit, given that of the next deeper context."""
        one = (self.ones + 0.5) / (self.ones + self.zeros + 1)
        here = np.where(self.one, one[self.of], 1 - one[self.of])
        if deeper is None:
            return here
        own = self.own[self.of]
        return own * here + (1 - own) * deeper


def weighed(estimate: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posterior weight of a node's own estimate, and its weighted log probability."""
    own = 1 / (1 + np.exp(np.clip(children - estimate, -700, 700)))
    return own, np.logaddexp(estimate, children) - math.log(2)


def shard_levels(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[Level]]:
    """Of a shard's codes: each code's eight bit probabilities down to depth TOP, and that depth's nodes."""
    chances, roots = np.empty((8, len(codes))), []
    for bit in range(8):
        level, chance = None, None
        for depth in range(DEPTH, TOP - 1, -1):
            level = Level(codes, counts, depth, bit, level)
            chance = level.mixed(chance)
        chances[bit] = chance
        roots.append(level)
    return chances, roots


def top_levels(roots: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """From sums by (nearest byte, node): own weights and estimates of depth 1 and depth 0, in tables of fixed size."""
    zeros, ones, children = (np.zeros((256, 256)) for _ in range(3))
    for table, column in ((zeros, "zeros"), (ones, "ones"), (children, "weighted")):
        table[roots["nearest"], roots["node"]] = roots[column]
    own1, weighted = weighed(log_estimate(zeros, ones), children)
    weighted[zeros + ones == 0] = 0
    one1 = (ones + 0.5) / (zeros + ones + 1)
    zeros, ones = zeros.sum(0), ones.sum(0)
    own0, _ = weighed(log_estimate(zeros, ones), weighted.sum(0))
    return own1, one1, own0, (ones + 0.5) / (zeros + ones + 1)


def log_chances(codes: np.ndarray, chances: np.ndarray, top: tuple[np.ndarray, ...]) -> np.ndarray:
    """log10 probability of each code's byte in its context."""
    own1, one1, own0, one0 = top
    nearest = (codes >> np.uint64(8 * DEPTH)).astype(np.int64)
    byte = (codes & np.uint64(255)).astype(np.int64)
    total = np.zeros(len(codes))
    for bit in range(8):
        node, one = (1 << bit) | (byte >> (8 - bit)), ((byte >> (7 - bit)) & 1).astype(bool)
        p1 = np.where(one, one1[nearest, node], 1 - one1[nearest, node])
        p0 = np.where(one, one0[node], 1 - one0[node])
        p = own1[nearest, node] * p1 + (1 - own1[nearest, node]) * chances[bit]
        total += np.log10(own0[node] * p0 + (1 - own0[node]) * p)
    return total


def chunks(texts: pd.Series) -> Iterator[tuple[slice, list[bytes]]]:
    """Slices of the texts of about CHUNK_BYTES each, with their folded texts."""
    waiting, size = [], 0
    for i, text in enumerate(texts, 1):
        waiting.append(folded(text))
        size += len(waiting[-1])
        if size >= CHUNK_BYTES or i == len(texts):
            yield slice(i - len(waiting), i), waiting
            waiting, size = [], 0


def tally(codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, of = np.unique(codes, return_inverse=True)
    return keys, np.bincount(of, weights, len(keys)).astype(np.int64)


def block_counts(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one block: each n-gram and each word that occurs, with its count in training documents."""
    trains = rows["train"].to_numpy(bool)
    codes, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    words: Counter[bytes] = Counter()
    waiting, size = [], 0
    for part, texts in chunks(rows["text"]):
        new, sizes = gram_codes(texts)
        waiting.append(tally(new, np.repeat(trains[part], sizes)))
        size += len(waiting[-1][0])
        if size > len(codes) or part.stop == len(rows):  # merged when as many wait: each code is sorted a few times only
            waiting.append((codes, counts))
            codes, counts = tally(*map(np.concatenate, zip(*waiting)))
            waiting, size = [], 0
        for text, train in zip(texts, trains[part]):
            found = text.split()
            if train:
                words.update(found)
                words[b""] += 1  # the end
            else:
                words.update(dict.fromkeys(found, 0))
                words[b""] += 0
    block = rows["block"].iloc[0]
    return pd.DataFrame(
        {
            "block": np.full(len(codes) + len(words), block, "int32"),
            "gram": np.concatenate((codes.astype(np.int64), np.zeros(len(words), np.int64))),
            "word": [None] * len(codes) + list(words),
            "n": np.concatenate((counts, np.fromiter(words.values(), np.int64, len(words)))),
        }
    )


def score(docs: DataFrame, train: str = "train") -> DataFrame:
    """Per row: doc_id, train, n_tokens, n_known, train_tokens, base_score, score.

    ``train`` names a boolean column: rows to learn from. ``base_score``: smoothed unigram log10
    probability of the lower-cased words and an end. ``score``: log10 probability of the lower-cased bytes
    and an end under the weighted context trees, learned from all training rows; its counts stay as
    learned while a text is scored. Null texts count as empty: one token, the end. Repeated rows are
    learned from as often as they occur and score alike. Without training rows every bit has
    probability one half and no word is known. An empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_or_empty().alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    blocks = pieces(rows, "text", BLOCK_BYTES)
    blocked = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    counted = stored(blocked.groupBy("block").applyInPandas(block_counts, "block int, gram long, word binary, n long"))

    # One shuffle adds up the counts and gathers the blocks that need them: a block lists a word or n-gram once.
    everywhere = [F.sum("n").alias("count"), F.collect_list("block").alias("blocks")]
    of_word = stored(counted.filter("word is not null").groupBy("word").agg(*everywhere))
    sums = of_word.agg(F.sum("count").alias("tokens"), F.sum((F.col("count") > 0).cast("long")).alias("distinct")).first()
    tokens, distinct = int(sums["tokens"] or 0), int(sums["distinct"] or 0)

    of_gram = stored(counted.filter("word is null").groupBy("gram").agg(*everywhere))
    shards = max(1, math.ceil(of_gram.count() / SHARD_GRAMS))
    context = F.shiftright("gram", 8 * (DEPTH + 1 - TOP))
    sharded = of_gram.select("gram", "count", F.pmod(F.xxhash64(context), F.lit(shards)).alias("shard"))

    def roots(part: pd.DataFrame) -> pd.DataFrame:
        _, levels = shard_levels(part["gram"].to_numpy().astype(np.uint64), part["count"].to_numpy(float))
        return pd.DataFrame(
            {
                "nearest": np.concatenate([(x.keys >> np.uint64(8 * TOP)).astype(np.int32) for x in levels]),
                "node": np.concatenate([(x.keys & np.uint64(255)).astype(np.int32) for x in levels]),
                "zeros": np.concatenate([x.zeros for x in levels]),
                "ones": np.concatenate([x.ones for x in levels]),
                "weighted": np.concatenate([x.weighted for x in levels]),
            }
        )

    top = top_levels(
        sharded.groupBy("shard")
        .applyInPandas(roots, "nearest int, node int, zeros double, ones double, weighted double")
        .groupBy("nearest", "node")
        .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("weighted"))
        .toPandas()
    )

    def chances(part: pd.DataFrame) -> pd.DataFrame:
        codes = part["gram"].to_numpy().astype(np.uint64)
        mixed, _ = shard_levels(codes, part["count"].to_numpy(float))
        return pd.DataFrame({"gram": part["gram"].to_numpy(), "value": log_chances(codes, mixed, top)})

    of_gram_value = sharded.groupBy("shard").applyInPandas(chances, "gram long, value double")
    known = (
        of_gram.select("gram", "blocks")
        .join(of_gram_value, "gram")
        .select(F.explode("blocks").alias("block"), "gram", F.lit(None).cast("binary").alias("word"), "value")
        .unionByName(
            of_word.select(
                F.explode("blocks").alias("block"),
                F.lit(0).cast("long").alias("gram"),
                "word",
                F.col("count").cast("double").alias("value"),
            )
        )
    )
    floor = tokens + SMOOTHING * (distinct + 1)

    def scored(block: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        named = table["word"].notna().to_numpy()
        counts = table["value"][named].to_numpy()
        by_count = {c: math.log10((c + SMOOTHING) / floor) for c in np.unique(counts).tolist()}
        logs = dict(zip(map(bytes, table["word"][named]), map(by_count.__getitem__, counts)))  # words of one count share an object
        codes, value = table["gram"][~named].to_numpy().astype(np.uint64), table["value"][~named].to_numpy()
        order = np.argsort(codes)
        codes, value = codes[order], value[order]
        totals, bases, numbers, knowns = [], [], [], []
        for _, texts in chunks(block["text"]):
            grams, sizes = gram_codes(texts)
            keys, of = np.unique(grams, return_inverse=True)
            totals.append(np.add.reduceat(value[np.searchsorted(codes, keys)][of], np.cumsum(sizes) - sizes))
            for text in texts:
                found = [*map(logs.__getitem__, text.split()), logs[b""]]
                bases.append(math.fsum(found))
                numbers.append(len(found))
                knowns.append(len(found) - found.count(by_count.get(0.0)))
        return pd.DataFrame(
            {
                "doc_id": block["doc_id"],
                "train": block["train"],
                "n_tokens": numbers,
                "n_known": knowns,
                "train_tokens": tokens,
                "base_score": bases,
                "score": np.concatenate(totals) if totals else [],
            }
        )

    return (
        blocked.groupBy("block")
        .cogroup(known.groupBy("block"))
        .applyInPandas(
            scored,
            "doc_id string, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
        .withColumn("doc_id", F.col("doc_id").cast(kind))
    )


def report(docs: DataFrame) -> DataFrame:
    """Scores of all documents, learned from those whose crc32(doc_id as text) mod 10 is not 0."""
    return score(docs.withColumn("train", learned("doc_id", 10, 0))).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
