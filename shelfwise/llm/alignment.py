"""Alignment of two tokenizers over the same texts, by an associative monoid of fragments.

A text is a string of bytes that both tokenizers cover with tokens. Where tokens of both end at the same
byte, a group closes; the pair of tokens that end there is a link. A byte range of a text, cut anywhere,
yields a fragment: tokens before its first shared end (open prefix), closed groups, tokens behind its last
shared end (open suffix). Two neighbouring fragments compose by joining suffix and prefix to one group; that is
associative, so fragments of a long document are made by different tasks and composed in a tree. Closed
groups never move: only the open ends go up the tree, and a document's groups are read in order at the end.

Both tokenizers cut texts where one blank stands between other characters: no entry of either spans such a
place. So a range is encoded with the words that overlap it, and each distinct word of a slice once.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.bpe import byte_characters, spread
from shelfwise.llm.common import per_worker
from shelfwise.session import stored

CHUNK_BYTES = 16_384
BLOCK_BYTES = 32_000_000
SLICE_BYTES = 1_000_000
FAN = 8
TOGETHER = 64  # distinct words that are encoded as one text
KNOWN_WORDS = 500_000  # words whose groups a worker keeps; it starts anew beyond

BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>$")

FRAGMENT = "part long, cut boolean, first_cut long, head_a string, head_b string, tail_a string, tail_b string"
PARTS = "row long, doc_id {kind}, part long, low long, high long, base long, text string"
UNIT = (
    "row long, doc_id {kind}, valid boolean, n_a long, n_b long, n_groups long, groups string, block long, links binary, "
    + FRAGMENT
)


class Tokenizers:
    """Both tokenizers, their entries' byte lengths, and the groups of the words met so far."""

    def __init__(self, vocabulary: str, model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(vocabulary)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        characters, data = byte_characters(), json.loads(vocabulary)
        self.bytes_a = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, i in data["model"]["vocab"].items():
            self.bytes_a[i] = bytes(characters[c] for c in token) if all(c in characters for c in token) else token.encode()
        self.bytes_b = [piece_bytes(self.b.id_to_piece(i)) for i in range(len(self.b))]
        self.size_a, self.size_b = (np.array([len(x) for x in table]) for table in (self.bytes_a, self.bytes_b))
        self.forget()

    def forget(self) -> None:
        """Start with no known words."""
        self.place: dict[str, int] = {}
        self.groups: list[str] = []
        self.keys = np.zeros(0, np.uint32)
        self.links, self.n_a, self.n_b, self.valid = (np.zeros(0, int) for _ in range(4))

    def encode(self, words: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = [e.ids for e in self.a.encode_batch_fast([" " + w for w in words], add_special_tokens=False)]
        return a, self.b.encode(words, num_threads=1)

    def tokens(self, words: list[str], raw: list[bytes], sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]] | None:
        """Per tokenizer: ids, their byte ends, and how many each word has, from words encoded many to a text.

        None if some word is not given back: then words are looked at one by one.
        """
        lists = self.encode([" ".join(words[k : k + TOGETHER]) for k in range(0, len(words), TOGETHER)])
        word_ends, everything, out = np.cumsum(sizes), b"".join(raw), []
        for ids, table, lengths in zip(lists, (self.bytes_a, self.bytes_b), (self.size_a, self.size_b)):
            flat = np.fromiter(chain.from_iterable(ids), int)
            ends = np.cumsum(lengths[flat])
            last = np.searchsorted(ends, word_ends)
            if b"".join(map(table.__getitem__, flat.tolist())) != everything or (ends[last] != word_ends).any():
                return None
            out.append((flat, ends, np.diff(last, prepend=-1)))
        return out

    def learn(self, words: list[str]) -> None:
        """Groups of new words. A word is valid if both tokenizers give back a blank and its bytes."""
        plain = [w for w in words if not (w[0].isspace() or w[-1].isspace() or "▁" in w)]
        if len(plain) < len(words):
            self.learn_apart(sorted(set(words) - set(plain)))
        raw = [b" " + w.encode("utf-8", "surrogatepass") for w in plain]
        sizes = np.array(list(map(len, raw)), int)
        found = self.tokens(plain, raw, sizes) if plain else []
        if found is None:
            self.learn_apart(plain)
        elif plain:
            self.enter(plain, np.ones(len(plain), bool), sizes, *zip(*found))

    def learn_apart(self, words: list[str]) -> None:
        """Groups of words that are encoded one by one."""
        lists = self.encode(words)
        raw = [b" " + w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.array(list(map(len, raw)), int)
        same = np.ones(len(words), bool)
        for ids, table in zip(lists, (self.bytes_a, self.bytes_b)):
            same &= np.array([b"".join(map(table.__getitem__, x)) == r for x, r in zip(ids, raw)], bool)
        flat, ends, counts = [], [], []
        for ids, lengths in zip(lists, (self.size_a, self.size_b)):
            kept = [x if ok else () for x, ok in zip(ids, same.tolist())]
            counts.append(np.array(list(map(len, kept)), int))
            flat.append(np.fromiter(chain.from_iterable(kept), int, int(counts[-1].sum())))
            ends.append(np.cumsum(lengths[flat[-1]]))
        self.enter(words, same, sizes, flat, ends, counts)

    def enter(self, words: list[str], same: np.ndarray, sizes: np.ndarray, flat, ends, counts) -> None:
        """Keep the groups of words whose tokens are given: ids, byte ends and numbers per word, of both tokenizers."""
        shared = np.intersect1d(*ends, assume_unique=True)
        last = [np.searchsorted(e, shared) for e in ends]
        texts = group_texts(*(list(map(str, ids.tolist())) for ids in flat), *((x + 1).tolist() for x in last))
        upto = np.searchsorted(shared, np.cumsum(np.where(same, sizes, 0)), "right")
        first = 0
        known = len(self.groups)
        for w, end in zip(words, upto.tolist()):
            self.groups.append(";".join(texts[first:end]) if end - first != 1 else texts[first])
            first = end
        self.place.update(zip(words, range(known, len(self.groups))))
        keys = flat[0][last[0]] * len(self.bytes_b) + flat[1][last[1]]
        self.keys = np.concatenate((self.keys, keys.astype(np.uint32)))
        self.links = np.concatenate((self.links, np.diff(upto, prepend=0)))
        self.n_a, self.n_b = np.concatenate((self.n_a, counts[0])), np.concatenate((self.n_b, counts[1]))
        self.valid = np.concatenate((self.valid, same.astype(int)))
        self.starts = np.cumsum(self.links) - self.links

    def places(self, lists: list[list[str]]) -> list[np.ndarray]:
        """Numbers of the words of each list; new ones are learned together."""
        if len(self.place) > KNOWN_WORDS:
            self.forget()
        new = list(set(chain.from_iterable(lists)).difference(self.place))
        if new:
            self.learn(new)
        return [np.array(list(map(self.place.__getitem__, words)), int) for words in lists]


def group_texts(a: list[str], b: list[str], upto_a: list[int], upto_b: list[int]) -> list[str]:
    """Texts of groups that end before the given places of both lists of ids."""
    texts, i, j = [], 0, 0
    for p, q in zip(upto_a, upto_b):
        if p - i == 1 == q - j:
            texts.append(f"{a[i]}|{b[j]}")
        else:
            texts.append(f"{','.join(a[i:p])}|{','.join(b[j:q])}")
        i, j = p, q
    return texts


def piece_bytes(piece: str) -> bytes:
    byte = BYTE_PIECE.match(piece)
    return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()


@dataclass
class Fragment:
    """Open ends of a byte range: ids as comma-joined text. Without a shared end all ids are in the head."""

    cut: bool
    first_cut: int
    head_a: str = ""
    head_b: str = ""
    tail_a: str = ""
    tail_b: str = ""


def joined(x: str, y: str) -> str:
    return f"{x},{y}" if x and y else x or y


def compose(x: Fragment, y: Fragment) -> tuple[Fragment, tuple[int, str] | None]:
    """Two neighbouring fragments as one, and the group that closes between them: (part that closes it, text)."""
    if not x.cut:
        return Fragment(y.cut, y.first_cut, joined(x.head_a, y.head_a), joined(x.head_b, y.head_b), y.tail_a, y.tail_b), None
    if not y.cut:
        return Fragment(True, x.first_cut, x.head_a, x.head_b, joined(x.tail_a, y.head_a), joined(x.tail_b, y.head_b)), None
    seam = f"{joined(x.tail_a, y.head_a)}|{joined(x.tail_b, y.head_b)}"
    return Fragment(True, x.first_cut, x.head_a, x.head_b, y.tail_a, y.tail_b), (y.first_cut, seam)


def edge_tokens(ids: list[int], sizes: np.ndarray, start: int, low: int, high: int) -> list[tuple[int, int]]:
    """(end, id) of a word's tokens that end in (low, high]."""
    ends = start + np.cumsum(sizes[ids]) if ids else []
    return [(int(e), i) for e, i in zip(ends, ids) if low < e <= high]


def closed(tokens_a: list[tuple[int, int]], tokens_b: list[tuple[int, int]]) -> tuple[list[tuple[list[int], list[int]]], list[int], list[int]]:
    """Groups of two lists of (end, id), and the ids behind the last shared end."""
    shared = sorted({e for e, _ in tokens_a} & {e for e, _ in tokens_b})
    groups, i, j = [], 0, 0
    for end in shared:
        p = next(k for k in range(i, len(tokens_a)) if tokens_a[k][0] == end) + 1
        q = next(k for k in range(j, len(tokens_b)) if tokens_b[k][0] == end) + 1
        groups.append(([x for _, x in tokens_a[i:p]], [x for _, x in tokens_b[j:q]]))
        i, j = p, q
    return groups, [x for _, x in tokens_a[i:]], [x for _, x in tokens_b[j:]]


def ids_text(ids: list[int]) -> str:
    return ",".join(map(str, ids))


def part_fragment(known: Tokenizers, words: list[str], places: np.ndarray, sizes: np.ndarray, part: int, base: int, low: int, high: int):
    """The fragment of bytes low to high of a document, from the words that overlap them.

    Returns it with its closed groups' text, numbers of tokens, and link keys.
    """
    ends = base + np.cumsum(sizes)
    starts = ends - sizes
    whole = np.flatnonzero((starts >= low) & (ends <= high))
    edges = [k for k in range(len(places)) if starts[k] < low or ends[k] > high]
    before, after = [k for k in edges if starts[k] < low], [k for k in edges if starts[k] >= low]
    n_a, n_b = int(known.n_a[places[whole]].sum()), int(known.n_b[places[whole]].sum())
    n_links = known.links[places[whole]]
    keys = [known.keys[spread(known.starts[places[whole]], n_links)]]
    runs, tails = [], []
    for chosen in (before, after):
        lists = known.encode([words[k] for k in chosen]) if chosen else ([], [])
        a, b = (
            [t for k, x in zip(chosen, ids) for t in edge_tokens(x, table, int(starts[k]), low, high)]
            for ids, table in zip(lists, (known.size_a, known.size_b))
        )
        groups, rest_a, rest_b = closed(a, b)
        n_a, n_b = n_a + len(a), n_b + len(b)
        keys.append(np.array([x[-1] * len(known.bytes_b) + y[-1] for x, y in groups], np.uint32))
        runs.append([f"{ids_text(x)}|{ids_text(y)}" for x, y in groups])
        tails.append((ids_text(rest_a), ids_text(rest_b)))
    inside = ";".join(known.groups[p] for p in places[whole].tolist())
    text = ";".join(x for x in (*runs[0], inside, *runs[1]) if x)
    head, _, text = text.partition(";")
    # A word that overlaps the start ends in the range or covers all of it, so open ids never stand before whole words.
    tail = joined(tails[0][0], tails[1][0]), joined(tails[0][1], tails[1][1])
    if not head:
        return Fragment(False, part, *tail), "", n_a, n_b, np.concatenate(keys)
    return Fragment(True, part, *head.split("|"), *tail), text, n_a, n_b, np.concatenate(keys)


def word_sizes(words: list[str]) -> np.ndarray:
    """Sizes of words in bytes, the blank before each included."""
    return np.array([len(w.encode("utf-8", "surrogatepass")) + 1 for w in words], int)


def byte_ranges(ends: np.ndarray, chunk_bytes: int) -> np.ndarray:
    """Where the ranges of a document end: every ``chunk_bytes``; words larger than that stay in one range."""
    marks = np.arange(chunk_bytes, ends[-1], chunk_bytes)
    at = np.searchsorted(ends, marks)
    sizes = np.diff(ends, prepend=0)
    return np.unique(np.append(np.where(sizes[at] > chunk_bytes, ends[at], marks), ends[-1]))


def packed(keys: np.ndarray) -> bytes:
    return pa.compress(np.sort(keys).astype("<u4").tobytes(), codec="zstd", asbytes=True)


def unpacked(links: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(links, decompressed_size=4 * n, codec="zstd", asbytes=True) if n else b"", "<u4")


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = max(1, SLICE_BYTES * batch.num_rows // max(1, batch.column(column).nbytes))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(ddl))


def rows_batch(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def cut_documents(chunk_bytes: int, schema: pa.Schema):
    """Rows (row, doc_id, text) of long texts -> one row per byte range with the words that overlap it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = {f.name: [] for f in schema}
            for row, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
                words = BETWEEN_WORDS.split(text)
                sizes = word_sizes(words)
                ends = np.cumsum(sizes)
                highs = byte_ranges(ends, chunk_bytes)
                for part, (low, high) in enumerate(zip([0, *highs.tolist()], highs.tolist())):
                    first, last = int(np.searchsorted(ends, low, "right")), int(np.searchsorted(ends, high))
                    values = (row, doc_id, part, low, high, int(ends[first] - sizes[first]), " ".join(words[first : last + 1]))
                    for name, value in zip(out, values):
                        out[name].append(value)
            yield rows_batch(out, schema)

    return run


def encode_units(vocabulary, model, keep_groups: bool, schema: pa.Schema):
    """Whole texts (no part number) and byte ranges -> token counts, links, and groups or a fragment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = per_worker(("alignment", vocabulary.value, model.value), lambda: Tokenizers(vocabulary.value, model.value))
        task, block, filled = TaskContext.get().partitionId() << 24, 0, 0
        for batch in slices(batches, "text"):
            rows = batch.to_pylist()
            cut = [BETWEEN_WORDS.split(r["text"]) if r["text"] else [] for r in rows]
            places = known.places(cut)
            out = {f.name: [] for f in schema}
            for r, words, at in zip(rows, cut, places):
                valid = bool(known.valid[at].all())
                unit = dict(row=r["row"], doc_id=r["doc_id"], valid=valid, n_a=0, n_b=0, n_groups=0, groups="", links=b"", part=r["part"])
                if valid and r["part"] is not None:
                    found = part_fragment(known, words, at, word_sizes(words), r["part"], r["base"], r["low"], r["high"])
                    unit |= vars(found[0]) | dict(groups=found[1], n_a=found[2], n_b=found[3], n_groups=len(found[4]), links=packed(found[4]))
                elif valid and len(at):
                    text = ";".join(map(known.groups.__getitem__, at.tolist()))
                    keys = known.keys[spread(known.starts[at], known.links[at])]
                    unit |= dict(n_a=int(known.n_a[at].sum()), n_b=int(known.n_b[at].sum()), n_groups=len(keys), links=packed(keys))
                    unit["groups"] = text if keep_groups else hashlib.sha256(text.encode()).hexdigest()
                filled += len(r["text"])
                for name, values in out.items():
                    values.append(unit.get(name) if name != "block" else task | block)
            yield rows_batch(out, schema)
            if filled > BLOCK_BYTES:
                block, filled = block + 1, 0

    return run


def block_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct links of each run of rows of one block, with their counts."""
    held: list[np.ndarray] = []
    current = None

    def out():
        keys, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_pydict(
            {"block": np.full(len(keys), current, np.int64), "pair": keys.astype(np.int64), "n": n.astype(np.int64)}
        )

    for batch in batches:
        for block, n, links in zip(*(batch.column(c).to_pylist() for c in ("block", "n_groups", "links"))):
            if block != current and held:
                yield out()
                held = []
            current = block
            held.append(unpacked(links, n))
    if held:
        yield out()


def score_block(units: pa.Table, pairs: pa.Table) -> pa.Table:
    """Sums over the links of each text or range of a block, from the corpus counts of its pairs."""
    keys, first = np.unique(pairs.column("pair").to_numpy(), return_index=True)
    count = pairs.column("count").to_numpy()[first]
    best = pairs.column("best").to_numpy(zero_copy_only=False)[first].astype(np.int64)
    sums: dict[str, list[int]] = {"n_best": [], "count_sum": []}
    for n, links in zip(units.column("n_groups").to_pylist(), units.column("links").to_pylist()):
        at = np.searchsorted(keys, unpacked(links, n))
        sums["n_best"].append(int(best[at].sum()))
        sums["count_sum"].append(int(count[at].sum()))
    kept = units.drop_columns(["block", "links"])
    for name, values in sums.items():
        kept = kept.append_column(name, pa.array(values, pa.int64()))
    return kept


TREE = "row long, kind int, part long, groups string, cut boolean, first_cut long, head_a string, head_b string, tail_a string, tail_b string"
OPEN, SEAM = 0, 1


def compose_rows(schema: pa.Schema):
    """Fragments in order of row and part -> one for each node of the next level, and the groups that close at seams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, total = None, None

        def finished(out: dict[str, list]) -> None:
            for name, value in {"row": node[0], "kind": OPEN, "part": node[1], "groups": "", **vars(total)}.items():
                out[name].append(value)

        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in schema}
            for r in batch.to_pylist():
                here = (r["row"], r["part"] // FAN)
                fragment = Fragment(r["cut"], r["first_cut"], r["head_a"], r["head_b"], r["tail_a"], r["tail_b"])
                if here != node:
                    if node:
                        finished(out)
                    node, total = here, fragment
                    continue
                total, seam = compose(total, fragment)
                if seam:
                    for name, value in {"row": node[0], "kind": SEAM, "part": seam[0], "groups": seam[1], **vars(Fragment(True, 0))}.items():
                        out[name].append(value)
            yield rows_batch(out, schema)
        if node:
            out = {f.name: [] for f in schema}
            finished(out)
            yield rows_batch(out, schema)

    return run


def composed_groups(parts: DataFrame) -> DataFrame:
    """Fragments of long documents -> (row, part, place, groups): texts of closed groups in document order.

    The open ends are composed level by level, ``FAN`` neighbours at a time, nodes dealt over the tasks; groups that
    close at a seam come before those inside the range that closes them.
    """
    columns = ["row", *(name.split()[0] for name in FRAGMENT.split(", "))]
    nodes = parts.select(*columns)
    seams = []
    most = nodes.agg(F.max("part")).first()[0] or 0
    while True:
        dealt = nodes.repartition("row", F.floor(F.col("part") / FAN)).sortWithinPartitions("row", "part")
        level = stored(dealt.mapInArrow(compose_rows(arrow_schema(TREE)), TREE))
        seams.append(level.filter(f"kind = {SEAM}").select("row", "part", F.lit(0).alias("place"), "groups"))
        nodes = level.filter(f"kind = {OPEN}").select(*columns)
        if most < FAN:
            break
        most //= FAN
    heads = nodes.filter("cut").select("row", F.col("first_cut").alias("part"), F.lit(0).alias("place"), F.concat_ws("|", "head_a", "head_b").alias("groups"))
    inside = parts.filter("groups <> ''").select("row", "part", F.lit(1).alias("place"), "groups")
    for seam in seams:
        inside = inside.unionByName(seam)
    return inside.unionByName(heads)


def digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in document order -> the digest of each document's joined groups; nothing but the hash's state is held."""
    current, state = None, None
    for batch in batches:
        done = []
        for row, text in zip(batch.column("row").to_pylist(), batch.column("groups").to_pylist()):
            if row != current:
                if state:
                    done.append((current, state.hexdigest()))
                current, state = row, hashlib.sha256(text.encode())
            else:
                state.update(b";" + text.encode())
        yield pa.RecordBatch.from_pydict({"row": pa.array([r for r, _ in done], pa.int64()), "groups": pa.array([g for _, g in done], pa.string())})
    if state:
        yield pa.RecordBatch.from_pydict({"row": pa.array([current], pa.int64()), "groups": [state.hexdigest()]})


@dataclass(frozen=True)
class Alignment:
    """Texts and byte ranges with their groups; corpus counts of linked pairs; sums over each document."""

    units: DataFrame
    pairs: DataFrame
    documents: DataFrame


def align(
    docs: DataFrame, vocabulary_path: str, model_path: str, chunk_bytes: int = CHUNK_BYTES, keep_groups: bool = False
) -> Alignment:
    """Align the tokens of every text of ``docs`` (``doc_id``, ``text``; other columns are left out).

    ``documents`` has one row per row of ``docs``, with the counts and digest; null and empty texts, and those
    that a tokenizer does not give back byte by byte, have zeros and an empty digest. Repeated rows and ids are
    rows of their own; an empty table gives empty tables. Texts of more than ``chunk_bytes`` are cut into byte ranges
    that are dealt over the tasks. ``units`` has a row per text or range: closed groups of ranges are texts, those of
    whole texts too with ``keep_groups``, else digests. ``pairs`` has (a, b, count, best): how many links of the corpus
    hold the pair, and whether it is the most frequent of its b.

    Links are counted per block of about 32 MB of text first. A pair's corpus count goes back to the blocks that
    have it, not to its links. Only the two tokenizer files, of fixed size, are broadcast.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    source = spark.sparkContext.broadcast(open(vocabulary_path, encoding="utf-8").read())
    model = spark.sparkContext.broadcast(open(model_path, "rb").read())
    parts, unit = PARTS.format(kind=kind), UNIT.format(kind=kind)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    long = F.octet_length("text") > chunk_bytes
    whole = texts.filter(~long).select(
        F.lit(None).cast("long").alias("row"), "doc_id", *(F.lit(None).cast("long").alias(c) for c in ("part", "low", "high", "base")), "text"
    )
    ranges = (
        texts.filter(long).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
        .mapInArrow(cut_documents(chunk_bytes, arrow_schema(parts)), parts).repartition("row", "part")
    )
    encode = encode_units(source, model, keep_groups, arrow_schema(unit))
    units = stored(whole.unionByName(ranges).mapInArrow(encode, unit))
    cut, uncut = units.filter("part is not null"), units.filter("part is null")
    broken = cut.filter("not valid").select("row").distinct()
    good_parts = stored(cut.join(broken, "row", "left_anti"))
    columns = ["row", "doc_id", "n_a", "n_b", "n_groups", "block", "links"]
    good = uncut.filter("n_groups > 0").select(*columns, "groups").unionByName(good_parts.select(*columns, F.lit("").alias("groups")))
    counted = stored(good.select("block", "n_groups", "links").mapInArrow(block_counts, "block long, pair long, n long"))
    size_b = sentencepiece_size(model.value)
    totals = counted.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair") % size_b)
    totals = stored(totals)
    highest = totals.groupBy("b").agg(F.max("count").alias("highest"))
    pairs = totals.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    scored = counted.select("block", "pair").distinct().join(pairs, "pair")
    sums = (
        good.groupBy("block").cogroup(scored.groupBy("block"))
        .applyInArrow(score_block, f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, groups string, n_best long, count_sum long")
    )
    sums = stored(sums)
    totals_of = [F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_best", "count_sum")]
    texts_in_order = composed_groups(good_parts).repartition("row").sortWithinPartitions("row", "part", "place")
    digests = texts_in_order.select("row", "groups").mapInArrow(digest_rows, "row long, groups string")
    long_docs = sums.filter("row is not null").groupBy("row").agg(F.min("doc_id").alias("doc_id"), *totals_of).join(digests, "row", "left")
    zero = [F.lit(0).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_best", "count_sum")]
    without = uncut.filter("n_groups = 0").select("doc_id").unionAll(
        cut.filter("part = 0").join(broken, "row", "left_semi").select("doc_id")
    ).select("doc_id", *zero, F.lit("").alias("groups_sha256"))
    whole_digest = F.sha2(F.encode("groups", "utf-8"), 256) if keep_groups else F.col("groups")
    result = ["doc_id", "n_a", "n_b", "n_groups", "n_best", "count_sum"]
    documents = (
        sums.filter("row is null").select(*result, whole_digest.alias("groups_sha256"))
        .unionByName(long_docs.select(*result, F.col("groups").alias("groups_sha256"))).unionByName(without)
        .withColumn("n_links", F.col("n_groups"))
    )
    ids = F.floor(F.col("pair") / size_b).alias("a"), (F.col("pair") % size_b).alias("b")
    return Alignment(units, pairs.select(*ids, "count", "best"), documents)


def sentencepiece_size(model: bytes) -> int:
    import sentencepiece

    return len(sentencepiece.SentencePieceProcessor(model_proto=model))


def report(docs: DataFrame, vocabulary_path: str, model_path: str) -> DataFrame:
    """Per document: numbers of tokens, groups and links, sums of the links' corpus counts, and the groups' digest."""
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return align(docs, vocabulary_path, model_path).documents.select(*columns)
