"""Similarity join of documents by the Jaccard coefficient of their word shingles: a MinHash LSH forest.

Texts with equal shingle sets form one class with one representative. Representatives enter the
tries of a forest by their MinHash signatures; two meet where they share a prefix. Prefixes
are shortened until a pair exactly at the threshold meets in some trie with the target recall, so
that every more similar pair does too. Those who meet are linked in a chain of constant length per row,
never pair by pair; the components of that are verified exactly, in blocks of bounded size, with
all their pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import checkpointed, small_side, unused, with_computed
from shelfwise.llm.components import components
from shelfwise.llm.shingles import mixed, shingles

SIGNED = (
    T.StructType()
    .add("set", T.BinaryType())
    .add("size", T.LongType())
    .add("prefixes", T.ArrayType(T.LongType()))
)
VERIFIED = "id long, root long, links long"
COLUMNS = 8192  # shingles compared at once


def prefix_length(similarity: float, tries: int, longest: int, recall: float) -> int:
    """The longest prefix at which a pair of this similarity meets in one of the tries with the target recall."""
    length = longest
    while length > 1 and 1 - (1 - similarity**length) ** tries < recall:
        length -= 1
    return length


def signature(found: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The least of each hash function over a set of shingles."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):
        least = np.minimum(least, (found[at : at + 2048] * factors[:, None] + offsets[:, None]).min(axis=1))
    return least


def set_key(found: np.ndarray) -> bytes:
    """128 bits of a set of shingles."""
    parts = [np.bitwise_xor.reduce(mixed(found)), np.add.reduce(mixed(found ^ np.uint64(0x5851F42D4C957F2D)))]
    return np.array(parts, np.uint64).tobytes()


def signatures(docs: DataFrame, words: int, tries: int, length: int) -> DataFrame:
    """doc_id, key and size of the shingle set, and one key for each trie's prefix; of an empty set no prefixes."""
    draw = np.random.default_rng(8)
    factors = draw.integers(0, 1 << 63, tries * length, np.uint64) * np.uint64(2) + np.uint64(1)
    offsets = draw.integers(0, 1 << 63, tries * length, np.uint64)

    def compute():
        def sign(texts: list[str | None]) -> list[dict]:
            out = []
            for text in texts:
                found, prefixes = shingles(text, words), []
                if len(found):
                    values = mixed(signature(found, factors, offsets)).reshape(tries, length)
                    prefix = np.arange(1, tries + 1, dtype=np.uint64)
                    for column in values.T:
                        prefix = mixed(prefix ^ column)
                    prefixes = prefix.view(np.int64).tolist()
                out.append({"set": set_key(found), "size": len(found), "prefixes": prefixes})
            return out

        return sign

    signed = with_computed(docs.select("doc_id", "text"), "signed", SIGNED, "text", compute)
    return signed.select("doc_id", "signed.*")


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Common shingles of every two sets of a block."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = uses[column] > 1
    _, column = np.unique(column[shared], return_inverse=True)
    owner = owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (at, at + COLUMNS))
        has = np.zeros((len(sets), min(COLUMNS, int(column[-1]) + 1 - at)), np.float32)
        has[owner[a:b], column[a:b] - at] = 1
        out += has @ has.T
    return out


def verified(ids: list[int], copies: np.ndarray, block: np.ndarray, sets: list[np.ndarray], least: float) -> list[tuple]:
    """(id, root, links) of one block pair: the smallest id reached by links, and the documents linked to."""
    common = intersections(sets)
    size = np.array([len(s) for s in sets], float)
    linked = common >= least * (size[:, None] + size - common) - 1e-9
    np.fill_diagonal(linked, False)
    if block.min() != block.max():  # pairs within one block are another task's
        linked &= block[:, None] != block
    order = np.argsort(ids)
    root = np.arange(len(ids))
    reached = np.zeros(len(ids), bool)
    for start in order:
        if reached[start]:
            continue
        reached[start], front = True, [start]
        while front:
            at = front.pop()
            new = np.flatnonzero(linked[at] & ~reached)
            reached[new], root[new] = True, start
            front += new.tolist()
    links = linked @ copies
    return [(ids[i], ids[root[i]], int(links[i])) for i in range(len(ids))]


def join(
    docs: DataFrame,
    least: float = 0.8,
    words: int = 5,
    tries: int = 16,
    longest: int = 8,
    recall: float = 0.999,
    block_sets: int = 1024,
) -> DataFrame:
    """One row per document: doc_id, class_id, n_links.

    ``n_links``: other documents whose shingle sets have a Jaccard coefficient of at least ``least``.
    ``class_id``: the smallest doc_id that links lead to, over any number of them; the document's own without links.
    Every link reported is verified exactly; of the pairs at the threshold at least ``recall`` are expected
    to be found, of more similar ones more.

    Null and empty texts have no shingles and no links; texts of fewer than ``words`` words are one shingle.
    Rows with a null id link to nothing (class_id null). Repeated rows are copies and count as links; rows
    that share an id belong to one class. An empty table gives an empty result. Other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    signed = checkpointed(signatures(texts, words, tries, prefix_length(least, tries, longest, recall)))
    sets = checkpointed(
        signed.filter("doc_id is not null and size > 0")
        .groupBy("set")
        .agg(F.min(F.struct("doc_id", "prefixes")).alias("first"), F.count("*").alias("copies"))
        .select("set", F.col("first.doc_id").alias("id"), F.col("first.prefixes").alias("prefixes"), "copies")
    )
    meeting = sets.select("id", F.explode("prefixes").alias("prefix"))
    heads = meeting.groupBy("prefix").agg(F.min("id").alias("head"), F.max("id").alias("last")).filter("head <> last")
    candidates = components(meeting.join(heads, "prefix").select(F.col("id").alias("u"), F.col("head").alias("v")))

    members = sets.select("set", "id", "copies").join(candidates, "id")
    counts = candidates.groupBy("component").agg(F.ceil(F.count("*") / block_sets).cast("int").alias("blocks"))
    members = small_side(
        checkpointed(
            members.join(counts, "component")
            .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(
                "set", "id", "copies", "component", "block",
                F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
            )
        )
    )
    shards = max(1, math.ceil(members.count() / block_sets))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shingles(t, words) for t in batch["text"]]
            out = batch.drop(columns="text").assign(shingles=[x.tobytes() for x in found])
            yield out[[set_key(x) == bytes(k) for x, k in zip(found, batch["set"])]]

    hashes = (
        texts.join(members, F.col("doc_id") == F.col("id"))
        .select("set", "id", "copies", "component", "block", "i", "j", "text")
        .mapInPandas(hashed, "set binary, id long, copies long, component long, block int, i int, j int, shingles binary")
        .withColumn("shard", F.pmod(F.xxhash64("component", "i", "j"), F.lit(shards)))
    )

    def verify(shard: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        for _, part in shard.groupby(["component", "i", "j"], sort=False):
            part = part.drop_duplicates(["id", "set"])
            found = [np.frombuffer(x, np.uint64) for x in part["shingles"]]
            rows += verified(part["id"].tolist(), part["copies"].to_numpy(), part["block"].to_numpy(), found, least)
        return pd.DataFrame(rows, columns=["id", "root", "links"]).astype("int64")

    links = checkpointed(hashes.groupBy("shard").applyInPandas(verify, VERIFIED))
    found = links.groupBy("id").agg(F.sum("links").alias("links"))
    classes = components(links.select(F.col("id").alias("u"), F.col("root").alias("v")))
    described = (
        sets.select("set", F.col("id").alias("first"), "copies")
        .join(found.withColumnRenamed("id", "first"), "first", "left")
        .join(classes.withColumnRenamed("id", "first"), "first", "left")
        .select("set", "first", "copies", "links", "component")
    )
    linkable = F.col("doc_id").isNotNull() & (F.col("size") > 0)
    return (
        signed.withColumn("of", F.when(linkable, F.col("set")))
        .join(described.withColumnRenamed("set", "of"), "of", "left")
        .select(
            "doc_id",
            F.when(linkable, F.coalesce("component", "first")).otherwise(F.col("doc_id")).alias("class_id"),
            F.when(linkable, F.col("copies") - 1 + F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        )
    )


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest id; of rows with that id only one.

    Rows with a null id stay, and so do empty texts.
    """
    joined = join(docs, **options)
    gone, twice = unused(docs, "gone"), unused(docs, "twice")
    extra = checkpointed(joined.filter("doc_id <> class_id").select(F.col("doc_id").alias(gone)).distinct())
    again = checkpointed(
        joined.filter("doc_id is not null").groupBy(F.col("doc_id").alias(twice)).count().filter("count > 1").select(twice)
    )
    kept = docs.join(extra, F.col("doc_id") == F.col(gone), "left_anti")
    single = kept.join(again, F.col("doc_id") == F.col(twice), "left_anti")
    repeated = kept.join(again, F.col("doc_id") == F.col(twice), "left_semi").dropDuplicates(["doc_id"])
    return single.unionByName(repeated)
