"""Links seen over several runs, in a store: a run joins only the parts of the stored links that can hold a hit.

Stored links are dealt into buckets by hash, and files hold ranges of buckets. Beside them a table of bits, one
bit for each hash, tells which links cannot have been seen. A link whose bit is clear is new without a look at the
links; for the others only their buckets are read, which Parquet's footers find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.dedup import first_seen
from shelfwise.operators.store import Change, Store
from shelfwise.session import stored

BUCKETS = 1024
WORDS = 1 << 16  # of 64 bits for each bucket: the bit table stops growing there
TABLES = {
    "seen_links": {"bucket": "int", "url": "string"},
    "seen_bits": {"bucket": "int", "word": "int", "bits": "bigint"},
    "sightings": {"url": "string", "page_id": "bigint", "position": "int"},
}


def _hashed(links: DataFrame, column: str) -> DataFrame:
    """``links`` plus bucket, word and bit of their hash."""
    h = F.xxhash64(column)
    bit: Column = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 58).cast("int"))
    return links.withColumns(
        {
            "bucket": F.pmod(h, F.lit(BUCKETS)).cast("int"),
            "word": F.shiftrightunsigned(h, 10).bitwiseAND(F.lit(WORDS - 1)).cast("int"),
            "bit": bit,
        }
    )


def unseen(store: Store, links: DataFrame, column: str = "url", entries: list[dict] | None = None) -> DataFrame:
    """Rows of ``links`` whose link no committed run has stored. Null links were never seen."""
    entries = store.entries() if entries is None else entries
    hashed = _hashed(links, column)
    bits = store.table("seen_bits", entries).groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
    asked = hashed.join(bits, ["bucket", "word"], "left")
    maybe = F.coalesce(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.lit(False)) & F.col(column).isNotNull()
    asked = asked.withColumn("maybe", maybe)
    # At most as many numbers as there are buckets.
    held = sorted(r["bucket"] for r in asked.filter("maybe").select("bucket").distinct().collect())
    new = asked.filter("not maybe")
    if held:
        known = store.table("seen_links", entries).filter(F.col("bucket").isin(held)).select(F.col("url").alias(column))
        new = new.unionByName(asked.filter("maybe").join(known, column, "left_anti").select(*asked.columns))
    return new.select(*links.columns)


def record_run(store: Store, batch: str, sightings: DataFrame) -> bool:
    """Store the first sighting (``url``, ``page_id``, ``position``) of every link that no run before has seen.

    A run given again stores nothing (False). Runs in order of their pages give the rows that one run would.
    """

    def build(entries: list[dict]) -> Change:
        new = stored(unseen(store, first_seen(sightings, "url"), "url", entries))
        hashed = _hashed(new.filter("url is not null"), "url")
        links = hashed.select("bucket", "url").repartitionByRange("bucket").sortWithinPartitions("bucket", "url")
        bits = hashed.groupBy("bucket", "word").agg(F.bit_or("bit").alias("bits"))
        return Change(add={"seen_links": links, "seen_bits": bits.sortWithinPartitions("bucket"), "sightings": new})

    return store.commit(batch, build)
