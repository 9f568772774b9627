"""Mixing sources to target weights by weighted sampling without replacement.

Each document draws an exponential key whose rate is its quality weight (Efraimidis and
Spirakis); sorted by key, a source's documents form a weighted random order. A source whose
target holds several times its words is taken whole that many times first (complete epochs);
the rest of the target is filled in key order. Only the document on the budget's edge is taken
in part.

Nothing is sorted per source as a whole: keys fall into ordered buckets, bucket sizes are
pre-aggregated in the map tasks, and only the one bucket that holds the edge is ordered row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import WORD, checkpointed, small_side, text_or_empty
from shelfwise.session import stored

MIN_WEIGHT = 0.05
ORDINARY_LENGTH = 6.0  # characters a word, its space included


def size_of(text: str = "text") -> Column:
    """Words of a text; 0 for null and empty."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def quality_weight(size: Column, text: str = "text") -> Column:
    """1 for texts of ordinary mean word length, falling to ``MIN_WEIGHT`` for odd ones (lists of signs, runs of letters)."""
    mean = F.length(text_or_empty(text)) / F.greatest(size, F.lit(1))
    return F.greatest(F.lit(MIN_WEIGHT), 1 - F.abs(mean - ORDINARY_LENGTH) / (2 * ORDINARY_LENGTH))


def sampling_key(doc_id: str, weight: Column, seed: str) -> Column:
    """-ln(u) / weight, with u in (0, 1) drawn from the id: the same on every run."""
    digest = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(seed)))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / weight


def source_targets(sizes: DataFrame, weights: Sequence[float], most: int) -> DataFrame:
    """(source, source_size) -> plus target: shares by weight, capped, the excess reshared.

    Sources by code point with null last take the weights in turn. The excess of capped sources
    is shared by weight until none is above its cap: with sources sorted by cap / weight, the
    common level is the largest of (total - caps before) / (weights not before).
    """
    everything, by_name = Window.partitionBy(), Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    turn = ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")
    ranked = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn)).withColumn(
        "cap", F.col("source_size") * most
    )
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = F.max("step").over(everything)
    return ranked.withColumn("step", left / rest).select(
        "source", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * level).alias("target")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    most: int = 3,
    into: str = "mix",
    seed: str = ":mix-1",
    buckets: int = 4096,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``docs`` (columns ``keep``; all by default) plus a struct ``into`` (size, source_size, target, taken).

    ``taken`` counts the words the mix takes of a document, repeats included; per source they
    add up to the target rounded to a whole number. No document is taken more than ``most`` times.

    Null and empty texts have size 0 and are taken 0 times. Null sources form one source, ordered last.
    Rows with equal ids share a key and are ordered by a digest of their text; equal rows are
    interchangeable. An empty table gives an empty result. A column already named ``into`` is
    replaced; other columns, whatever their names, are carried along unchanged.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() != into.lower()]
    measured = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        F.col(source).alias("source"),
        size_of(text).alias("size"),
        F.col(doc_id).alias("id"),
        text_or_empty(text).alias("text"),
    )
    # Words are counted once: the draws are stored, and every later step reads them.
    rows = stored(
        measured.withColumn("key", sampling_key("id", quality_weight(F.col("size")), seed))
        .withColumn("digest", F.xxhash64("text"))
        .withColumn("bucket", F.floor((1 - F.exp(-F.col("key"))) * buckets))
        .drop("text")
    )

    filled = checkpointed(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")))
    targets = source_targets(filled.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    whole = F.floor(F.col("budget") / F.greatest(F.col("source_size"), F.lit(1)))
    targets = (
        targets.withColumn("budget", F.round("target").cast("long"))
        .withColumn("epochs", whole)
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    )
    running = Window.partitionBy("source").orderBy("bucket")
    edge = (
        filled.join(targets.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
        .withColumn("end", F.sum("words").over(running))
        .filter(F.col("end") > F.col("rest"))
        .groupBy(F.col("name").alias("of"))
        .agg(F.min(F.struct("bucket", (F.col("end") - F.col("words")).alias("start"))).alias("edge"))
    )
    plan = small_side(
        checkpointed(
            targets.join(edge, F.col("source").eqNullSafe(F.col("of")), "left").select(
                F.col("source").alias("name"), "source_size", "target", "epochs", "rest", "edge"
            )
        )
    )

    planned = rows.join(plan, F.col("source").eqNullSafe(F.col("name")))
    at_edge = F.col("bucket").eqNullSafe(F.col("edge.bucket"))
    in_order = Window.partitionBy("source").orderBy("key", "id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    used = F.col("edge.start") + F.coalesce(F.sum("size").over(in_order), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - used))
    clear = planned.filter(~at_edge).withColumn(
        "part", F.when(F.col("bucket") < F.col("edge.bucket"), F.col("size")).otherwise(F.lit(0))
    )
    taken = (F.col("epochs") * F.col("size") + F.col("part")).cast("long")
    mixed = clear.unionByName(planned.filter(at_edge).withColumn("part", part))
    return mixed.select(
        "row.*", F.struct("size", "source_size", "target", taken.alias("taken")).alias(into)
    )


def repeated(mixed: DataFrame, into: str = "mix") -> DataFrame:
    """The mix as rows: each document as often as its taken words come to, to the nearest whole."""
    times = F.round(F.col(f"{into}.taken") / F.col(f"{into}.size")).cast("int")
    return (
        mixed.filter(F.col(f"{into}.size") > 0)
        .withColumn(into, F.explode(F.array_repeat(F.lit(0), times)))
        .drop(into)
    )
