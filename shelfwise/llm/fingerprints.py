"""Document fingerprints: invertible Bloom lookup sketches of digests of text pieces, in Spark expressions.

A text is cut where the hash of a word and the one before says so, after one word in six, so that a change costs the pieces it touches and no
others, wherever it stands; a piece's digest holds 48 hash bits and 16 check bits. A sketch has three rows of cells; each digest enters one cell of each row, which
keeps a count and the exclusive or of its digests. Two sketches subtract cell by cell; peeling
single-digest cells then recovers the digests that only one text has. If cells remain, wider sketches are tried,
and after the widest the digests are compared as they are. Long texts are dealt into parts first, by
hash, so that the work grows in proportion.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import text_or_empty
from shelfwise.llm.pii import let

# Scripts written without blanks, whose signs count as words: Thai to Lao, Burmese, Khmer, Japanese, Chinese.
UNSPACED = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\x{20000}-\x{323AF}"
PIECE_WORD = rf"[{UNSPACED}]|[^\s{UNSPACED}]++"
CUT_ONE_IN = 6
MOST_WORDS = 48  # of a piece, counted from the last cut: only where words repeat is it reached
WIDTH = 32  # cells in a row of the sketch that is the fingerprint
WIDTHS = (32, 128, 512)  # tried in this order
PART_DIGESTS = 128  # of both texts: if a third of them differ, as after an edit, a part fits the first width
CLEAR_CELLS = 4  # a difference that leaves fewer cells clear, for every WIDTH cells in a row, is more than they hold
PEEL_ROUNDS = 24
CHECK_BITS = 16
BUCKET_BYTES = 2_000_000  # of text whose sketches are made one after the other: they take far longer than their bytes do
MOST_BUCKETS = 20_000


def words_of(text: Column) -> Column:
    """A text's words as ``PIECE_WORD`` finds them; without unspaced signs they are what stands between blanks."""
    spaced = F.array_remove(F.split(text, r"\s+"), "")
    return F.when(text.rlike(f"[{UNSPACED}]"), F.regexp_extract_all(text, F.lit(PIECE_WORD), F.lit(0))).otherwise(spaced)


def digests(text: Column) -> Column:
    """The distinct digests of a text's pieces: hash bits above, check bits below. White space is not counted."""
    words = F.transform(words_of(text), lambda w: F.xxhash64(w))
    pair = lambda hashes, h, i: h.bitwiseXOR(F.shiftright(F.coalesce(F.get(hashes, i - 1), F.lit(0)), 3))
    last = lambda hashes, h, i: (
        (F.pmod(pair(hashes, h, i), F.lit(CUT_ONE_IN)) == 0) | (i == F.size(hashes) - 1)
    )
    ends = lambda hashes: F.filter(
        F.transform(hashes, lambda h, i: F.when(last(hashes, h, i), i + 1)), lambda end: end.isNotNull()
    )
    piece = lambda hashes, start, end: F.shiftleft(
        F.xxhash64(F.slice(hashes, start + 1, F.least(F.lit(MOST_WORDS), end - start))), CHECK_BITS
    )
    between = lambda hashes, start, end: F.transform(
        F.sequence(start, end - 1, F.lit(MOST_WORDS)), lambda at: let(piece(hashes, at, end), marked)
    )
    cut = lambda hashes, ends: F.flatten(
        F.transform(ends, lambda end, k: let(F.coalesce(F.get(ends, k - 1), F.lit(0)), lambda start: between(hashes, start, end)))
    )
    return F.array_distinct(let(words, lambda hashes: let(ends(hashes), lambda found: cut(hashes, found))))


def check(bits: Column) -> Column:
    return F.xxhash64(bits).bitwiseAND(F.lit((1 << CHECK_BITS) - 1))


def marked(bits: Column) -> Column:
    """Hash bits (low bits zero) with their check bits."""
    return bits.bitwiseOR(check(bits))


def genuine(value: Column) -> Column:
    low = (1 << CHECK_BITS) - 1
    return value.bitwiseAND(F.lit(low)) == check(value.bitwiseAND(F.lit(~low)))


def cell_of(value: Column, row: int, width: int | Column) -> Column:
    return F.shiftright(value, CHECK_BITS + 16 * row).bitwiseAND(F.lit(width) - 1)


def together(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, d: a.bitwiseXOR(d))


def dealt(values: Column, key: Callable[[Column], Column], low: int, bits: Column) -> Column:
    """``values`` in 2^bits groups by the bits of their key from ``low`` on, halved once for each bit."""
    none = F.lit(0).cast("long")
    zeros = lambda group, bit: F.filter(group, lambda v: key(v).bitwiseAND(bit) == none)
    ones = lambda group, bit: F.filter(group, lambda v: key(v).bitwiseAND(bit) != none)
    halves = lambda group, bit: F.when(F.size(group) == 0, F.array(group, group)).otherwise(
        F.array(zeros(group, bit), ones(group, bit))
    )
    places = F.when(bits > 0, F.sequence(bits + (low - 1), F.lit(low))).otherwise(F.array().cast("array<int>"))
    masks = F.transform(places, lambda place: F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return F.aggregate(
        masks, F.array(values), lambda groups, bit: F.flatten(F.transform(groups, lambda group: halves(group, bit)))
    )


def in_cells(values: Column, key: Callable[[Column], Column], row: int, width: int | Column) -> Column:
    """``values`` in groups by their cell."""
    bits = F.lit(width.bit_length() - 1) if isinstance(width, int) else F.log2(width).cast("int")
    return dealt(values, key, CHECK_BITS + 16 * row, bits)


def sketch(values: Column, width: int | Column) -> Column:
    """Three rows of cells: count and exclusive or of the digests in each."""
    cell = lambda own: F.struct(F.size(own).alias("n"), together(own).alias("x"))
    return let(values, lambda own: F.array(*[F.transform(in_cells(own, lambda d: d, row, width), cell) for row in range(3)]))


def subtracted(a: Column, b: Column) -> Column:
    cell = lambda p, q: F.struct((p["n"] - q["n"]).alias("n"), p["x"].bitwiseXOR(q["x"]).alias("x"))
    return F.zip_with(a, b, lambda row, other: F.zip_with(row, other, cell))


def clear(cells: Column) -> Column:
    return F.forall(cells, lambda row: F.forall(row, lambda c: (c["n"] == 0) & (c["x"] == 0)))


def clear_cells(cells: Column) -> Column:
    """How many cells a difference leaves clear: the fewer, the more it holds."""
    return F.aggregate(cells, F.lit(0), lambda n, row: n + F.size(F.filter(row, lambda c: (c["n"] == 0) & (c["x"] == 0))))


def peeled(cells: Column, width: int | Column) -> Column:
    """Numbers of digests that only the first and only the second text has; null if cells remain."""

    def singles(state: Column) -> Column:
        """Digests that are alone in a cell of theirs, with the sign of their text; each from the first row where it is."""
        lone = lambda c: F.abs(c["n"]) == 1

        def before(c: Column, row: int) -> Column:
            """Whether an earlier row has the digest alone in its cell there."""
            there = [F.get(state["cells"][k], cell_of(c["x"], k, width).cast("int")) for k in range(row)]
            return F.coalesce(*[F.when(lone(o) & (o["x"] == c["x"]), F.lit(True)) for o in there], F.lit(False))

        alone = lambda row: F.filter(
            state["cells"][row],
            lambda c, i: lone(c) & (cell_of(c["x"], row, width) == i) & genuine(c["x"]) & (~before(c, row) if row else F.lit(True)),
        )
        return F.concat(*[alone(row) for row in range(3)])

    def without(state: Column, pure: Column) -> Column:
        left = lambda c, own: F.struct(
            (c["n"] - F.aggregate(own, F.lit(0), lambda a, p: a + p["n"])).alias("n"),
            F.aggregate(own, c["x"], lambda a, p: a.bitwiseXOR(p["x"])).alias("x"),
        )

        def row_without(row: int) -> Column:
            touched = lambda c, own: F.when(F.size(own) == 0, c).otherwise(left(c, own))
            return F.zip_with(state["cells"][row], in_cells(pure, lambda p: p["x"], row, width), touched)

        return F.array(*[row_without(row) for row in range(3)])

    moved = lambda state: let(
        singles(state),
        lambda pure: F.when(F.size(pure) == 0, stopped(state)).otherwise(
            F.struct(
                without(state, pure).alias("cells"),
                (state["plus"] + F.size(F.filter(pure, lambda p: p["n"] == 1))).alias("plus"),
                (state["minus"] + F.size(F.filter(pure, lambda p: p["n"] == -1))).alias("minus"),
                F.lit(True).alias("going"),
            )
        ),
    )
    start = F.struct(cells.alias("cells"), F.lit(0).alias("plus"), F.lit(0).alias("minus"), F.lit(True).alias("going"))
    return F.aggregate(
        F.array(*[F.lit(k) for k in range(PEEL_ROUNDS)]),
        start,
        lambda state, _: F.when(state["going"], moved(state)).otherwise(state),
        lambda state: F.when(clear(state["cells"]), F.struct(state["plus"].alias("plus"), state["minus"].alias("minus"))),
    )


def stopped(state: Column) -> Column:
    return F.struct(
        state["cells"].alias("cells"), state["plus"].alias("plus"), state["minus"].alias("minus"), F.lit(False).alias("going")
    )


def compared(a: Column, b: Column) -> Column:
    """The last resort: the digests of both texts side by side."""
    return F.struct(F.size(F.array_except(a, b)).alias("plus"), F.size(F.array_except(b, a)).alias("minus"))


def difference(a: Column, b: Column, sketch_a: Column, sketch_b: Column) -> Column:
    """(plus, minus): how many digests only the first and only the second text has.

    The given fingerprints are subtracted first; wider sketches follow on failure, in parts for long texts.
    """
    fits = lambda cells, w: clear_cells(cells) * WIDTH >= w * CLEAR_CELLS
    attempt = lambda x, y, w: let(
        subtracted(sketch(x, w), sketch(y, w)), lambda cells: F.when(fits(cells, w), peeled(cells, w))
    )
    failed = F.lit(None).cast("struct<plus:int,minus:int>")
    widths = F.array(*[F.lit(w) for w in WIDTHS])
    tried = lambda x, y: F.coalesce(
        F.aggregate(widths, failed, lambda found, w: F.when(found.isNotNull(), found).otherwise(attempt(x, y, w))), compared(x, y)
    )
    parts = F.greatest(F.size(a) + F.size(b), F.lit(1)) / PART_DIGESTS
    halvings = F.greatest(F.ceil(F.log2(parts)), F.lit(0)).cast("int")
    own = lambda values: dealt(values, lambda d: F.xxhash64(d, F.lit(7)), 0, halvings)
    add = lambda s, both: let(
        tried(both["a"], both["b"]),
        lambda d: F.struct((s["plus"] + d["plus"]).alias("plus"), (s["minus"] + d["minus"]).alias("minus")),
    )
    nothing = F.struct(F.lit(0).alias("plus"), F.lit(0).alias("minus"))
    in_parts = F.aggregate(F.zip_with(own(a), own(b), lambda x, y: F.struct(x.alias("a"), y.alias("b"))), nothing, add)
    left = subtracted(sketch_a, sketch_b)
    whole = let(left, lambda cells: F.when(fits(cells, WIDTH), peeled(cells, WIDTH)))
    # texts without a common digest differ in all of them
    apart = F.struct(F.size(a).alias("plus"), F.size(b).alias("minus"))
    return F.when(~F.arrays_overlap(a, b), apart).otherwise(F.coalesce(whole, in_parts))


def likeness(a: Column, b: Column, sketch_a: Column, sketch_b: Column) -> Column:
    """Common digests as a share of all digests of both texts; 1 for two texts without any."""
    union = lambda d: F.size(a) + d["minus"]
    return let(
        difference(a, b, sketch_a, sketch_b),
        lambda d: F.when(union(d) == 0, 1.0).otherwise((F.size(a) - d["plus"]) / union(d)),
    )


def written(values: Column, cells: Column) -> Column:
    """A fingerprint as text: the number of digests, then the cells."""
    cell = lambda c: F.concat(c["n"].cast("string"), F.lit("."), F.lower(F.hex(c["x"])))
    return F.concat(F.size(values).cast("string"), F.lit(":"), F.array_join(F.transform(F.flatten(cells), cell), ","))


def bucket_number(value: Column, bounds: list) -> Column:
    """How many of the ascending bounds are at most ``value``, by halving steps; -1 for null."""
    if not bounds:
        return F.when(value.isNull(), -1).otherwise(0)
    array = F.array(*[F.lit(int(b)) for b in bounds])
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    fits = lambda at: (at <= len(bounds)) & (F.element_at(array, F.least(at, F.lit(len(bounds)))) <= value)
    search = F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda low, s: F.when(fits(low + s), low + s).otherwise(low)
    )
    return F.when(value.isNull(), -1).otherwise(search)


def with_next(docs: DataFrame, total: int) -> DataFrame:
    """doc_id, text, its digests ``a``, and ``next`` with digests ``c``: the text that follows in descending doc_id (null ids last); after the last, the first.

    Rows with one id follow each other by descending digest of their text. Buckets of ids are ordered each on its
    own; their first rows, one for each bucket, close the gaps between them. ``total`` is the size of all texts in bytes.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn(
        "digest", F.xxhash64("text")
    )
    buckets = min(MOST_BUCKETS, math.ceil(total / BUCKET_BYTES))
    bounds: list = []
    if buckets > 1:
        shares = [k / buckets for k in range(1, buckets)]
        bounds = sorted(set(rows.agg(F.percentile_approx("doc_id", shares, 10 * buckets)).first()[0] or []))
    rows = rows.withColumn("bucket", bucket_number(F.col("doc_id"), bounds))
    # Texts are shuffled alone; digests are made where their bucket lies.
    dealt_rows = rows.repartition(max(1, buckets), "bucket").withColumn("a", digests(F.col("text")))
    order = [F.col("doc_id").desc_nulls_last(), F.desc("digest"), F.desc("text")]
    heads = rows.groupBy("bucket").agg(F.max(F.struct("doc_id", "digest", "text")).alias("head"))
    buckets_down = Window.orderBy(F.desc("bucket"))
    following = heads.select("bucket").withColumn(
        "from", F.coalesce(F.lead("bucket").over(buckets_down), F.first("bucket").over(buckets_down))
    )
    gaps = following.join(
        heads.select(F.col("bucket").alias("from"), F.col("head.text").alias("beyond"), digests(F.col("head.text")).alias("beyond_a")),
        "from",
    )
    within = Window.partitionBy("bucket").orderBy(*order)
    linked = dealt_rows.withColumn("after", F.lead("text").over(within)).withColumn("after_a", F.lead("a").over(within))
    return linked.join(gaps.select("bucket", "beyond", "beyond_a"), "bucket").select(
        "doc_id", "text", "a", F.coalesce("after", "beyond").alias("next"), F.coalesce("after_a", "beyond_a").alias("c")
    )


def report(docs: DataFrame, measure: Callable[..., Column] = likeness) -> DataFrame:
    """Fingerprints of every text and its edited form, and how alike they are.

    The edited text's last floor(n_chars / 3) code points are the first as many (or all) of the next document.
    Null texts count as empty; an empty text has no digests, and is like another empty one (1.0). A single document is its own next.
    Repeated rows follow each other. An empty table gives an empty result. Other columns are ignored.
    """
    n = F.length("text")
    edited = F.concat(F.expr("left(text, length(text) - length(text) div 3)"), F.expr("left(next, cast(length(text) div 3 as int))"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    frame = with_next(docs, total).select("doc_id", "a", "c", n.cast("long").alias("n_chars"), edited.alias("edited"))
    frame = frame.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "a",
        digests(F.col("edited")).alias("b"),
        F.when(F.arrays_overlap("a", "c"), F.col("c")).alias("c"),
        F.size("c").alias("size_c"),
    )
    frame = frame.select("*", *[sketch(F.col(name), WIDTH).alias(f"sketch_{name}") for name in "ab"])
    # One expression for both comparisons: it is large, and evaluated for an array of two. A next text that shares no
    # digest has no sketch made: its likeness follows from the sizes.
    of_next = F.when(F.col("c").isNotNull(), sketch(F.col("c"), WIDTH))
    others = F.array(F.struct(F.col("b").alias("d"), F.col("sketch_b").alias("s")), F.struct(F.col("c").alias("d"), of_next.alias("s")))
    near = F.transform(others, lambda o: F.when(o["d"].isNotNull(), measure(F.col("a"), o["d"], F.col("sketch_a"), o["s"])))
    apart = F.when((F.size("a") == 0) & (F.col("size_c") == 0), 1.0).otherwise(0.0)
    return frame.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        written(F.col("a"), F.col("sketch_a")).alias("fingerprint"),
        written(F.col("b"), F.col("sketch_b")).alias("edited_fingerprint"),
        near.alias("near"),
        apart.alias("apart"),
    ).select("*", F.col("near")[0].alias("near_edited"), F.coalesce(F.col("near")[1], "apart").alias("near_next")).drop("near", "apart")
