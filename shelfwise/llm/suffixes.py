"""Removal of repeated byte strings of a minimum length, in and across documents.

Candidates first: of the 64-byte grams inside a string, the one with the least hash is its anchor, so
equal strings have equal anchors at equal offsets. All starts with one anchor form a window; equal
windows are counted by digest, with map-side sums. Windows that occur twice are repeated as a
whole. Where different windows share an anchor, their texts meet in a task, which builds their
Burrows-Wheeler transform and expands intervals breadth-first by backward extension: round after round
the boundaries whose common prefix has just that length are found, and what is left after
``least`` rounds separates suffixes that agree on the whole length. Anchors with very many different
windows are not gathered: there the strings at all starts are counted by digest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import checkpointed, key_filter, text_or_empty, with_maybe
from shelfwise.llm.shingles import BASE, INVERSE, mixed, powers
from shelfwise.session import stored

GRAM = 64
CHUNK_BYTES = 1_000_000
SHARD_BYTES = 1_500_000
MANY_WINDOWS = 3000
BASE_2 = np.uint64(0xD1342543DE82EF95)
INVERSE_2 = np.uint64(pow(int(BASE_2), -1, 1 << 64))
SIDES = 4  # longer grams around an anchor, one of which any two equal strings share
GRAMS = [f"g{j}" for j in range(SIDES)]
WINDOW = "doc_id string, text_key long, anchor long, d1 long, d2 long, first long, last long, " + ", ".join(f"{g} int" for g in GRAMS)
PLACE = 21  # bits for a place within a chunk


def sums(data: np.ndarray, base: np.uint64) -> np.ndarray:
    values = (data.astype(np.uint64) + np.uint64(1)) * powers(base, len(data))
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))


class Digests:
    """Digests of any substrings of a buffer."""

    def __init__(self, data: np.ndarray):
        self.sums = [sums(data, b) for b in (BASE, BASE_2)]
        self.back = [powers(b, len(data) + 1) for b in (INVERSE, INVERSE_2)]

    def of(self, begin: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        return mixed((self.sums[which][end] - self.sums[which][begin]) * self.back[which][begin])


def least_places(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every run of ``width`` keys: suffix minima of blocks against prefix minima of the next."""
    n = len(keys) - width + 1
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    grid = padded.reshape(blocks, width)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def windows(data: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Of a buffer of texts ending at ``ends``: anchor, two digests, first and last start of every window, and ``SIDES`` grams.

    A string of ``least`` bytes reaches some way left of its anchor and the rest of ``least`` right of it. By that way it covers one
    of ``SIDES`` longer grams: two windows share a string only if they share one of these. 0 stands for a gram that no string covers.
    """
    empty = *(np.empty(0, np.uint64) for _ in range(3)), *(np.empty(0, np.int64) for _ in range(2)), np.empty((SIDES, 0), np.int32)
    if len(data) < least:
        return empty
    digests = Digests(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = digests.of(at, at + GRAM, 0)
    keys = (grams & ~np.uint64((1 << PLACE) - 1)) | at.astype(np.uint64)
    anchor = (least_places(keys, least - GRAM + 1) & np.uint64((1 << PLACE) - 1)).astype(np.int64)
    starts = np.arange(len(anchor))
    text = np.searchsorted(ends, starts, side="right")
    valid = starts + least <= ends[text]
    starts, anchor = starts[valid], anchor[valid]
    if not len(starts):
        return empty
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)))
    first = starts[new]
    last = np.append(starts[np.flatnonzero(new)[1:] - 1], starts[-1])
    place, begins = anchor[new], (ends - np.diff(ends, prepend=0))[text[valid][new]]
    stops = ends[text[valid][new]]
    slack = least - GRAM
    sides = []
    for j in range(SIDES):
        near, far = slack * j // SIDES, slack * (j + 1) // SIDES  # a string reaches right by near to far
        begin, end = place - (slack - far), place + GRAM + near
        fits = (begin >= begins) & (end <= stops) & (place - last <= slack - near) & (place - first >= slack - far)
        gram = digests.of(np.where(fits, begin, 0), np.where(fits, end, 0), 1)
        sides.append(np.where(fits, (gram >> np.uint64(32)).astype(np.uint32) | np.uint32(1), np.uint32(0)).view(np.int32))
    shape = ((anchor[new] - first).astype(np.uint64) << np.uint64(32)) | (last - first).astype(np.uint64)
    return (
        grams[anchor[new]],
        mixed(digests.of(first, last + least, 0) ^ shape),
        mixed(digests.of(first, last + least, 1) + shape),
        first,
        last,
        np.stack(sides),
    )


def pieces_of(texts: list[bytes], least: int) -> Iterator[tuple[list[tuple[int, int]], bytes, np.ndarray]]:
    """Buffers of about CHUNK_BYTES: (text, offset) of each part, the bytes, and the parts' ends.

    A longer text is cut into parts that overlap by least - 1 bytes, so that each start is in one part.
    """
    owners: list[tuple[int, int]] = []
    parts: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        for offset in range(0, len(text) - least + 1, CHUNK_BYTES):
            part = text[offset : offset + CHUNK_BYTES + least - 1]
            if size + len(part) > CHUNK_BYTES + least and parts:
                yield owners, b"".join(parts), np.cumsum([len(p) for p in parts])
                owners, parts, size = [], [], 0
            owners.append((i, offset))
            parts.append(part)
            size += len(part)
    if parts:
        yield owners, b"".join(parts), np.cumsum([len(p) for p in parts])


def suffix_order(symbols: np.ndarray, window: np.ndarray, stop: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes, each up to its window's end mark (symbol 0, at ``stop``), ties by window; and ranks by 7 symbols."""
    n = len(symbols)
    place = np.arange(n)
    key = np.zeros(n, np.int64)
    for k in range(7):
        at = np.minimum(place + k, stop)
        key = (key << 9) | symbols[at]
    _, rank = np.unique(key, return_inverse=True)
    short, length = rank, 7
    while length < longest:
        _, rank = np.unique(rank * np.int64(n + 1) + rank[np.minimum(place + length, stop)], return_inverse=True)
        length *= 2
    return np.argsort(rank * np.int64(window[-1] + 1) + window, kind="stable"), short


def repeated_starts(texts: list[bytes], least: int) -> list[np.ndarray]:
    """For each text: the starts of strings of ``least`` bytes that also start elsewhere in these texts."""
    lengths = np.array([len(t) for t in texts])
    ends = np.cumsum(lengths + 1) - 1
    symbols = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int64) + 1
    symbols[ends] = 0
    window = np.repeat(np.arange(len(texts)), lengths + 1)
    n = len(symbols)
    order, short = suffix_order(symbols, window, ends[window], int(lengths.max()) + 1)

    # Backward extension: the suffixes that begin with a sign c, in order, extend those that c precedes, in order.
    transform = np.where(order > 0, symbols[order - 1], 0)
    by_sign = np.argsort(transform, kind="stable")
    by_sign = by_sign[transform[by_sign] > 0]
    position = np.empty(n, np.int64)
    position[order] = np.arange(n)
    target = position[order[by_sign] - 1]
    same = np.flatnonzero(transform[by_sign[1:]] == transform[by_sign[:-1]]) + 1
    left, right, reached = by_sign[same - 1], by_sign[same], target[same]

    # found[i]: the common prefix of suffixes i - 1 and i is known to be shorter than the round.
    found = np.ones(n + 1, bool)
    ranks = short[order]
    tail = (ends[window] - np.arange(n))[order]
    found[1:n] = (ranks[1:] != ranks[:-1]) | (tail[1:] < 7) | (tail[:-1] < 7)
    straight = right == left + 1
    child = np.full(n + 1, n, np.int64)
    child[right[straight]] = reached[straight]
    wide = ~straight & ~found[reached]
    left, right, reached = left[wide], right[wide], reached[wide]
    front = np.flatnonzero(found[:n])  # common prefixes of 0 to 6
    for _ in range(7, least):  # this round: common prefixes of just this length
        at = np.searchsorted(front, left + 1)
        met = (at < len(front)) & (front[np.minimum(at, len(front) - 1)] <= right)
        front = np.unique(np.concatenate((child[front], reached[met])))
        front = front[~found[front]]
        found[front] = True
        if not len(front):
            break
        open_ = ~met & ~found[reached]
        left, right, reached = left[open_], right[open_], reached[open_]
    agrees = ~found[: n + 1]
    agrees[0] = agrees[n] = False
    marked = agrees[:n] | agrees[1 : n + 1]
    marked &= tail >= least
    out = np.zeros(n, bool)
    out[order[marked]] = True
    return [np.flatnonzero(out[e - k : e]) for e, k in zip(ends, lengths)]


def runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Consecutive starts as (first, last)."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) != 1)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), starts[np.append(cut, len(starts) - 1)].tolist()))


def covered(ranges: list[tuple[int, int]], least: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by strings starting in the given ranges."""
    out: list[list[int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + least)
        else:
            out.append([first, last + least])
    return [(a, b) for a, b in out]


def remove_repeats(
    docs: DataFrame, least: int = 400, doc_id: str = "doc_id", text: str = "text", many_windows: int = MANY_WINDOWS
) -> DataFrame:
    """Per row: doc_id, n_bytes, spans (start, end of each removed run, in bytes), kept (the remaining bytes).

    A byte goes if a string of ``least`` bytes (at least 64) that covers it also starts anywhere else in the corpus, the
    same text included; all strings are judged on the input. Null and empty texts have no bytes. Equal
    rows are two documents: what they hold is repeated. Removal may cut a UTF-8 sequence, so ``kept``
    is binary. An empty table gives an empty result. Other columns are ignored.
    """
    kind = docs.schema[doc_id].dataType
    texts = docs.select(F.col(doc_id).cast("string").alias("doc_id"), text_or_empty(text).alias("text")).withColumn(
        "text_key", F.xxhash64("text")
    )

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [t.encode("utf-8", "replace") for t in batch["text"]]
            for owners, data, ends in pieces_of(raw, least):
                anchor, d1, d2, first, last, sides = windows(np.frombuffer(data, np.uint8), ends, least)
                part = np.searchsorted(ends, first, side="right")
                owner = np.array([i for i, _ in owners])[part]
                shift = np.array([o for _, o in owners])[part] - (ends - np.diff(ends, prepend=0))[part]
                yield pd.DataFrame(
                    {
                        "doc_id": batch["doc_id"].to_numpy()[owner],
                        "text_key": batch["text_key"].to_numpy()[owner],
                        "anchor": anchor.view(np.int64),
                        "d1": d1.view(np.int64),
                        "d2": d2.view(np.int64),
                        "first": first + shift,
                        "last": last + shift,
                        **dict(zip(GRAMS, sides)),
                    }
                )

    digest = ["anchor", "d1", "d2"]
    found = stored(texts.mapInPandas(scan, WINDOW))
    counted = found.groupBy(*digest).agg(F.count("*").alias("copies"))
    shared = counted.groupBy("anchor").agg(F.sum("copies").alias("total"), F.count("*").alias("kinds")).filter("total > 1")
    repeated = checkpointed(counted.join(shared, "anchor").select(*digest, "copies", "kinds"))
    hits = checkpointed(found.join(repeated, digest))
    whole = hits.filter("copies > 1").select("doc_id", "text_key", "first", "last")

    # Of windows that share an anchor, only those that share one of the longer grams too can share a string.
    distinct = hits.filter("kinds > 1").dropDuplicates(digest)
    sides = distinct.select(*digest, F.posexplode(F.array(*GRAMS)).alias("side", "gram")).filter("gram <> 0")
    common = sides.groupBy("anchor", "side", "gram").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    wanted = checkpointed(distinct.join(sides.join(common, ["anchor", "side", "gram"], "left_semi").select(*digest).distinct(), digest, "left_semi"))
    size = wanted.agg(F.sum(F.col("last") - F.col("first") + least)).first()[0] or 0
    shards = max(1, math.ceil(size / SHARD_BYTES))
    holder = wanted.select(F.col("doc_id").alias("of"), F.col("text_key").alias("key"), *digest, "kinds", "first", "last")
    # Texts without such a window are left out before the shuffle, as far as a filter of fixed size can tell.
    holding = with_maybe(texts, key_filter(wanted, ["doc_id", "text_key"]), ["doc_id", "text_key"], "maybe").filter("maybe").drop("maybe")
    strings = (
        holding.join(holder, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_key") == F.col("key")))
        .select(
            *digest,
            "kinds",
            F.expr(f"substring(cast(text as binary), cast(first + 1 as int), cast(last - first + {least} as int))").alias("string"),
        )
    )
    strings = checkpointed(strings.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int")))

    def compare(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.drop_duplicates(digest)  # a window of repeated rows comes once for each row
        starts = repeated_starts([bytes(s) for s in shard["string"]], least)
        rows = [(i, a, b) for i, s in enumerate(starts) for a, b in runs(s)]
        of = shard.iloc[[i for i, _, _ in rows]][digest].reset_index(drop=True)
        return of.assign(begin=np.array([a for _, a, _ in rows], "int64"), end=np.array([b for _, _, b in rows], "int64"))

    def every_start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for anchor, d1, d2, string in zip(batch["anchor"], batch["d1"], batch["d2"], batch["string"]):
                digests = Digests(np.frombuffer(bytes(string), np.uint8))
                at = np.arange(len(string) - least + 1)
                yield pd.DataFrame(
                    {
                        "anchor": anchor, "d1": d1, "d2": d2, "begin": at, "end": at,
                        "s1": digests.of(at, at + least, 0).view(np.int64),
                        "s2": digests.of(at, at + least, 1).view(np.int64),
                    }
                )

    ranges = "anchor long, d1 long, d2 long, begin long, end long"
    few = strings.filter(F.col("kinds") <= many_windows).groupBy("shard").applyInPandas(compare, ranges)
    many = strings.filter(F.col("kinds") > many_windows).dropDuplicates(digest).mapInPandas(every_start, ranges + ", s1 long, s2 long")
    twice = many.groupBy("s1", "s2").agg(F.count("*").alias("n")).filter("n > 1").select("s1", "s2")
    partly = few.unionByName(many.join(twice, ["s1", "s2"]).select("anchor", "d1", "d2", "begin", "end"))
    parts = hits.filter("copies = 1 and kinds > 1").join(partly, digest)
    parts = parts.select("doc_id", "text_key", (F.col("first") + F.col("begin")).alias("first"), (F.col("first") + F.col("end")).alias("last"))
    found_ranges = checkpointed(whole.unionByName(parts).distinct())
    marks = (
        found_ranges.groupBy(F.col("doc_id").alias("of"), F.col("text_key").alias("key"))
        .agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans, kept, sizes = [], [], []
            for value, ranges in zip(batch["text"], batch["ranges"]):
                raw = value.encode("utf-8", "replace")
                gone = covered([(r["first"], r["last"]) for r in ranges], least) if ranges is not None else []
                edges = [0, *(x for span in gone for x in span), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
                spans.append([{"start": a, "end": b} for a, b in gone])
                sizes.append(len(raw))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": sizes, "spans": spans, "kept": kept})

    marked = with_maybe(texts, key_filter(found_ranges, ["doc_id", "text_key"]), ["doc_id", "text_key"], "maybe")
    untouched = marked.filter("not maybe").select("doc_id", "text", F.lit(None).cast(marks.schema["ranges"].dataType).alias("ranges"))
    joined = marked.filter("maybe").join(marks, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_key") == F.col("key")), "left")
    return (
        joined.select("doc_id", "text", "ranges").unionByName(untouched)
        .mapInPandas(cut, "doc_id string, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
        .withColumn("doc_id", F.col("doc_id").cast(kind))
    )


def report(docs: DataFrame) -> DataFrame:
    """Per document: sizes and a digest of what is left."""
    return remove_repeats(docs.select("doc_id", "text")).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
