"""Connected components of a table of links, without collecting them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import checkpointed

LINK = "u long, v long"


def components(links: DataFrame) -> DataFrame:
    """(u, v) links -> (id, component): each linked id with the smallest id it reaches.

    Alternating large-star and small-star steps: each joins every link with the smallest neighbour
    of its end, which is aggregated in the map tasks first; hubs are left to skew-join splitting.
    Every round is checkpointed. Links with nulls or of an id with itself say nothing and are left out.
    """
    links = checkpointed(
        links.filter("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    state = fingerprint(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(lowest, "u")
            .select("u", "v", F.least("u", "m").alias("m"))
            .filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u")
        links = checkpointed(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(lowest.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .distinct()
        )
        before, state = state, fingerprint(links)
        if state == before:
            break
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )


def fingerprint(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))
        ).first()
    )
