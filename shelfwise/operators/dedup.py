"""Keep-first and best-record deduplication.

``row_number() = 1`` lets Spark prune each map task to one row per key before the shuffle
(window group limit), so a key that holds a third of all rows reaches its reducer as one
row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.text import title_key
from shelfwise.schemas import SOURCES

# Fields that count towards completeness, and the extra weight of a rating.
SCORED_FIELDS = ("rating", "release_date", "developer", "publisher", "genres", "description")
RATING_BONUS = 2


def keep_first(df: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; null keys form one group."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def unique_urls(
    df: DataFrame,
    order: list[Column],
    column: str = "game_url",
    source: str | None = "data_source",
    keep_null: bool = False,
) -> DataFrame:
    """First record per URL of a source (``source=None``: per URL).

    Null URLs count as equal; ``keep_null`` keeps them all.
    """
    keys = [column] if source is None else [source, column]
    if not keep_null:
        return keep_first(df, keys, order)
    known = keep_first(df.filter(F.col(column).isNotNull()), keys, order)
    return known.unionByName(df.filter(F.col(column).isNull()))


def first_seen(df: DataFrame, column: str = "url") -> DataFrame:
    """First sighting of each link across listing pages, by page and position."""
    return keep_first(df, [column], [F.col("page_id"), F.col("position")])


def completeness(columns=SCORED_FIELDS) -> Column:
    """One point per filled field, two more for a rating."""
    points = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    return points + F.col("rating").isNotNull().cast("int") * RATING_BONUS


def source_priority(column: str = "data_source") -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SOURCES]), F.col(column))


def best_per_title(df: DataFrame, tie_break: list[Column] | None = None) -> DataFrame:
    """The most complete record per normalised title.

    Ties go to the earlier source, then by URL and by any further ``tie_break`` columns, so
    the result does not depend on partitioning.
    """
    keyed = df.withColumn("_key", title_key(F.col("game_title"))).withColumn("_score", completeness())
    order = [F.col("_score").desc(), source_priority(), F.col("game_url").asc_nulls_last(), *(tie_break or [])]
    return keep_first(keyed, ["_key"], order).drop("_key", "_score")
