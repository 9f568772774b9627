"""Byte-level BPE encoding and decoding with a pair occurrence index.

A task takes its texts in chunks. Every chunk is cut into pre-tokens, equal pre-tokens are kept
once, and their bytes form one linked list of symbols. The index maps each adjacent pair that has
a rank to all its positions in the chunk; active ranks are applied in ascending order, each to all
its positions at once, and the neighbours' pairs are entered into the lists of their own ranks.
All steps over positions are array operations.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import per_worker, text_or_empty, with_computed

CHUNK_BYTES = 1_000_000
HASH_CHARS = 1_000_000

OTHER, LETTER, NUMBER, SPACE = range(4)


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def character_classes() -> np.ndarray:
    """Letter, number, white space or other, for every code point."""
    classes = np.zeros(0x110000, np.uint8)
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for run in regex.finditer(pattern, everything):
            first, last = ord(run[0][0]), ord(run[0][-1])
            classes[first : last + 1] = kind
    return classes


class Vocabulary:
    """Ranks, merges and byte strings of a byte-level BPE vocabulary file (JSON)."""

    def __init__(self, source: str):
        data = json.loads(source)
        model, characters = data["model"], byte_characters()
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(characters[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.special_pattern = re.compile(
            "(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")"
        ) if self.special else None
        self.byte_ids = np.zeros(256, np.int32)
        for c, b in characters.items():
            self.byte_ids[b] = vocab[c]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.pairs = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in merges], np.int64).reshape(-1, 3)
        keys = self.pairs[:, 0] * len(self.bytes_of) + self.pairs[:, 1]
        self.rank_order = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; the number of merges where a pair has none."""
        keys = left.astype(np.int64) * len(self.bytes_of) + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank_order[at], len(self.keys))


def pre_token_starts(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Marks of the code points at which a pre-token begins; texts begin at ``starts``.

    Runs of letters, of numbers and of other signs each take one blank before them; the
    apostrophe endings stand alone; white space leaves its last character to what follows.
    """
    n = len(points)
    kinds = per_worker("character classes", character_classes)[points]
    marks = np.zeros(n + 1, bool)
    marks[starts] = True
    first_of_text = marks.copy()
    first_of_text[n] = True
    marks[1:n] |= kinds[1:] != kinds[:-1]
    marks[n] = True
    runs = np.flatnonzero(marks)
    begin, end = runs[:-1], runs[1:]
    spaces = (kinds[begin] == SPACE) & ~first_of_text[end]
    last, after = end[spaces] - 1, end[spaces]
    marks[last] = True
    marks[after[points[last] == ord(" ")]] = False

    quote = (kinds[begin] == OTHER) & (end - begin == 1) & (points[begin] == ord("'")) & marks[begin]
    quote &= ~first_of_text[end]
    at = begin[quote]
    stop = end[np.minimum(np.flatnonzero(quote) + 1, len(end) - 1)]  # end of the run after the apostrophe
    one = points[at + 1]
    two = points[np.minimum(at + 2, n - 1)]
    inside = at + 2 < stop
    single = np.isin(one, [ord(c) for c in "stmd"])
    double = inside & (
        (np.isin(one, [ord("r"), ord("v")]) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    )
    letters = kinds[at + 1] == LETTER
    for chosen, length in ((single & letters, 2), (double & letters, 3)):
        marks[at[chosen] + 1] = False
        rest = chosen & (at + length < stop)
        marks[at[rest] + length] = True
    return marks[:n]


def token_keys(points: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit key of each pre-token's bytes, and its length in bytes."""
    widths = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    offsets = np.concatenate(([0], np.cumsum(widths)))
    at = offsets[np.concatenate((np.flatnonzero(marks), [len(points)]))]
    base = np.uint64(0x9E3779B97F4A7C15)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    powers, back = (np.full(len(points) + 1, x, np.uint64) for x in (base, inverse))
    for x in (powers, back):
        x[0] = 1
        np.multiply.accumulate(x, out=x)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((points + np.uint64(1)) * powers[:-1], dtype=np.uint64)))
    first = np.flatnonzero(marks)
    last = np.append(first[1:], len(points))
    keys = (sums[last] - sums[first]) * back[first]
    keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return keys ^ (keys >> np.uint64(32)), np.diff(at)


def apply_ranks(symbols: np.ndarray, word_starts: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Merge all pairs in ascending order of rank; merged-away places become -1."""
    n = len(symbols)
    symbol = np.append(symbols, np.int32(-1))
    following = np.arange(1, n + 2, dtype=np.int32)
    following[word_starts[1:] - 1] = n
    if n:
        following[n - 1] = n
    before = np.arange(-1, n, dtype=np.int32)
    before[word_starts] = n
    none = len(vocabulary.keys)
    lists: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def enter(places: np.ndarray) -> None:
        ranks = vocabulary.ranks(symbol[places], symbol[following[places]])
        known = ranks < none
        places, ranks = places[known], ranks[known]
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for part, rank in zip(np.split(places, cuts), ranks[np.append(0, cuts)].tolist() if len(ranks) else []):
            if rank in lists:
                lists[rank].append(part)
            else:
                lists[rank] = [part]
                heapq.heappush(active, rank)

    everywhere = np.arange(n, dtype=np.int32)
    enter(everywhere[following[:n] < n])
    while active:
        rank = heapq.heappop(active)
        left, right, merged = vocabulary.pairs[rank].tolist()
        parts = lists.pop(rank)
        places = parts[0] if len(parts) == 1 else np.concatenate(parts)
        places = np.unique(places[(symbol[places] == left) & (symbol[following[places]] == right)])
        if left == right and len(places) > 1:  # in a run of equal symbols every second place begins a pair
            joined = np.append(False, following[places[:-1]] == places[1:])
            index = np.arange(len(places))
            head = np.maximum.accumulate(np.where(joined, 0, index))
            places = places[(index - head) % 2 == 0]
        gone = following[places]
        after = following[gone]
        symbol[places] = merged
        symbol[gone] = -1
        following[places] = after
        before[after] = places
        previous = before[places]
        enter(np.concatenate((places[after < n], previous[previous < n])))
    return symbol[:n]


def encode_texts(texts: list[str], vocabulary: Vocabulary) -> list[bytes]:
    """Ids of every text as little-endian unsigned 32-bit integers."""
    owners: list[int] = []
    segments: list[str] = []
    out: list[list[bytes]] = [[] for _ in texts]
    slots: list[tuple[int, int]] = []
    for i, text in enumerate(texts):
        cut = vocabulary.special_pattern.split(text) if vocabulary.special_pattern else [text]
        for k, part in enumerate(cut):
            if k % 2:
                out[i].append(np.uint32(vocabulary.special[part]).astype("<u4").tobytes())
            elif part:
                slots.append((i, len(out[i])))
                out[i].append(b"")
                owners.append(i)
                segments.append(part)
    if not segments:
        return [b"".join(x) for x in out]

    keys, lengths, tokens_in = [], [], []
    at = 0
    while at < len(segments):
        upto, size = at, 0
        while upto < len(segments) and (upto == at or size + len(segments[upto]) <= HASH_CHARS):
            size += len(segments[upto])
            upto += 1
        points = np.frombuffer("".join(segments[at:upto]).encode("utf-32-le"), np.uint32)
        starts = np.cumsum([0, *map(len, segments[at : upto - 1])])
        marks = pre_token_starts(points, starts)
        tokens_in.append(np.add.reduceat(marks.astype(np.int64), starts))
        for store, part in zip((keys, lengths), token_keys(points.astype(np.uint64), marks)):
            store.append(part)
        at = upto
    key, length = np.concatenate(keys), np.concatenate(lengths)
    offset = np.cumsum(length) - length
    _, sample, which = np.unique(key, return_index=True, return_inverse=True)
    buffer = np.frombuffer("".join(segments).encode(), np.uint8)
    word_lengths = length[sample]
    word_starts = np.cumsum(word_lengths) - word_lengths
    symbols = vocabulary.byte_ids[buffer[spread(offset[sample], word_lengths)]]
    merged = apply_ranks(symbols, word_starts, vocabulary)
    kept = merged >= 0
    word_ids = merged[kept].astype("<u4")
    counts = np.add.reduceat(kept.astype(np.int64), word_starts)
    word_at = np.cumsum(counts) - counts

    edges = np.concatenate(([0], np.cumsum(np.concatenate(tokens_in))))
    for s, (i, slot) in enumerate(slots):
        words = which[edges[s] : edges[s + 1]]
        out[i][slot] = word_ids[spread(word_at[words], counts[words])].tobytes()
    encoded = [b"".join(x) for x in out]
    for i, text in enumerate(texts):  # two pre-tokens with one key would show here
        if decode_ids(encoded[i], vocabulary) != text.encode():
            if len(texts) == 1:
                encoded[i] = one_by_one(text, vocabulary)
            else:
                encoded[i] = encode_texts([text], vocabulary)[0]
    return encoded


def one_by_one(text: str, vocabulary: Vocabulary) -> bytes:
    """The same, with no keys: each pre-token on its own."""
    out = []
    for k, part in enumerate(vocabulary.special_pattern.split(text) if vocabulary.special_pattern else [text]):
        if k % 2:
            out.append(np.array([vocabulary.special[part]], "<u4"))
            continue
        points = np.frombuffer(part.encode("utf-32-le"), np.uint32)
        starts = np.flatnonzero(pre_token_starts(points, np.zeros(1, int))) if part else []
        for a, b in zip(starts, [*starts[1:], len(part)]):
            raw = np.frombuffer(part[a:b].encode(), np.uint8)
            merged = apply_ranks(vocabulary.byte_ids[raw], np.zeros(1, int), vocabulary)
            out.append(merged[merged >= 0].astype("<u4"))
    return b"".join(x.tobytes() for x in out)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all given spans, one after the other."""
    total = np.cumsum(lengths)
    return np.repeat(starts - (total - lengths), lengths) + np.arange(total[-1] if len(total) else 0)


def decode_ids(ids: bytes, vocabulary: Vocabulary) -> bytes:
    return b"".join(map(vocabulary.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def loaded(source: str) -> Vocabulary:
    return per_worker(("vocabulary", source), lambda: Vocabulary(source))


def encode(docs: DataFrame, vocabulary_path: str, into: str = "ids", text: str = "text") -> DataFrame:
    """Rows of ``docs`` plus ``into``: the text's ids, binary, little-endian unsigned 32-bit integers.

    Strings of special tokens become their ids. Null and empty texts have no ids (empty binary).
    Repeated rows are encoded alike; an empty table gives an empty result. A column already named
    ``into`` is replaced, others are carried along. ``vocabulary_path`` is read by the driver; a
    vocabulary file, whose size is fixed, is all that is broadcast.
    """
    source = docs.sparkSession.sparkContext.broadcast(open(vocabulary_path, encoding="utf-8").read())

    def compute():
        vocabulary = loaded(source.value)
        return lambda texts: encode_texts([t or "" for t in texts], vocabulary)

    return with_computed(docs, into, T.BinaryType(), text, compute, CHUNK_BYTES)


def decode(encoded: DataFrame, vocabulary_path: str, into: str = "decoded", ids: str = "ids") -> DataFrame:
    """Rows of ``encoded`` plus ``into``: the text of ``ids``; broken UTF-8 becomes replacement signs.

    Null ids give an empty text. Other columns are carried along; one already named ``into`` is replaced.
    """
    source = encoded.sparkSession.sparkContext.broadcast(open(vocabulary_path, encoding="utf-8").read())

    def compute():
        vocabulary = loaded(source.value)
        return lambda rows: [decode_ids(x or b"", vocabulary).decode("utf-8", "replace") for x in rows]

    return with_computed(encoded, into, T.StringType(), ids, compute)


def digests(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Per document: doc_id, number of ids, and digests of the ids and of the text decoded from them."""
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    round_trip = decode(encode(texts, vocabulary_path).drop("text"), vocabulary_path)
    return round_trip.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
