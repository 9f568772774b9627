"""The ten business questions, with their thresholds as arguments.

Ties at a limit are broken by an id or name, so results do not depend on partitioning.
Averages are rounded from exact integer sums. Groups are pre-aggregated map-side, and a
genre's name is joined to its one aggregated row, never to the bridge.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.numbers import cents, rounded_mean, rounded_mean_price, rounded_ratio, savings
from shelfwise.operators.clean import UNKNOWN


def named(column: str, exclude_unknown: bool = False) -> Column:
    """Predicate: the text is filled (and, on request, not the imputed placeholder)."""
    filled = F.col(column).isNotNull() & (F.col(column) != "")
    return filled & (F.col(column) != UNKNOWN) if exclude_unknown else filled


def ranked(top: DataFrame, *order: Column) -> DataFrame:
    """Number the rows of a result that a limit has already made small."""
    return top.withColumn("position", F.row_number().over(Window.orderBy(*order)).cast("int"))


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_rated(games: DataFrame, min_reviews: int = 1000, n: int = 5) -> DataFrame:
    """Games that share the highest rating among those with more than ``min_reviews`` reviews.

    The best ratings sort first, so the maximum is read off the top ``n`` rows and one
    top-n scan replaces a scan for the maximum and a second one for the rows.
    """
    order = [F.col("rating").desc(), F.col("review_count").desc(), F.col("id")]
    rated = games.filter((F.col("review_count") > min_reviews) & F.col("rating").isNotNull())
    best = ranked(top(rated.select("id", "game_title", "rating", "review_count"), n, *order), *order)
    maximum = F.max("rating").over(Window.partitionBy())
    return best.withColumn("_max", maximum).filter("rating = _max").select("position", "game_title", "rating", "review_count")


def top_performers(games: DataFrame, min_rating: int = 85, min_reviews: int = 50, n: int = 10) -> DataFrame:
    """Well-rated games with a following."""
    order = [F.col("rating").desc(), F.col("review_count").desc(), F.col("id")]
    kept = games.filter((F.col("rating") >= min_rating) & (F.col("review_count") >= min_reviews))
    columns = ["id", "game_title", "rating", "review_count", "data_source", "platform"]
    return ranked(top(kept.select(*columns), n, *order), *order).drop("id")


def hidden_gems(games: DataFrame, min_rating: int = 85, max_reviews: int = 20, n: int = 10) -> DataFrame:
    """Well-rated games with few reviews; a missing count does not qualify."""
    order = [F.col("rating").desc(), F.col("id")]
    kept = games.filter((F.col("rating") >= min_rating) & (F.col("review_count") < max_reviews))
    columns = ["id", "game_title", "rating", "review_count", "data_source", "developer"]
    return ranked(top(kept.select(*columns), n, *order), *order).drop("id")


def consistent_publishers(
    games: DataFrame, min_games: int = 5, n: int = 10, exclude_unknown: bool = False
) -> DataFrame:
    """Publishers with enough rated games, by average rating."""
    rated = games.filter(named("publisher", exclude_unknown) & F.col("rating").isNotNull())
    stats = rated.groupBy("publisher").agg(
        rounded_mean(F.col("rating"), 2).alias("avg_rating"),
        F.count("*").alias("total_games"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
    )
    order = [F.col("avg_rating").desc(), F.col("publisher")]
    return ranked(top(stats.filter(F.col("total_games") >= min_games), n, *order), *order)


def platform_pricing(games: DataFrame, exclude_unknown: bool = False) -> DataFrame:
    """The platform (or tied platforms) with the highest average discounted price.

    Averages are compared as quotients of exact integers. ``rank = 1`` keeps the best rows
    of each task before they meet, and the groups are aggregated only once.
    """
    priced = games.filter(F.col("discounted_price") > 0)
    if exclude_unknown:
        priced = priced.filter(named("platform", True))
    in_cents = cents(F.col("discounted_price"))
    stats = priced.groupBy("platform").agg(F.sum(in_cents).alias("_sum"), F.count("*").alias("game_count"))
    average = F.col("_sum") / F.col("game_count")
    best = stats.withColumn("_rank", F.rank().over(Window.orderBy(average.desc()))).filter("_rank = 1")
    rounded = rounded_ratio(F.col("_sum"), F.col("game_count"), 0) / 100
    return best.select("platform", rounded.alias("avg_discounted_price"), "game_count")


def discount_deals(games: DataFrame, min_rating: int = 80, min_discount: int = 50, n: int = 10) -> DataFrame:
    """Deepest discounts among good games, with the amount saved."""
    order = [F.col("discount_percentage").desc(), F.col("rating").desc(), F.col("id")]
    kept = games.filter(
        (F.col("rating") >= min_rating)
        & (F.col("discount_percentage") >= min_discount)
        & F.col("discounted_price").isNotNull()
    )
    columns = [
        "id", "game_title", "rating", "original_price", "discounted_price", "discount_percentage", "platform",
        savings(F.col("original_price"), F.col("discounted_price")).cast("double").alias("savings"),
    ]
    shown = ranked(top(kept.select(*columns), n, *order), *order).drop("id")
    return shown.withColumns({c: F.col(c).cast("double") for c in ("original_price", "discounted_price")})


def genre_facts(games: DataFrame, game_genres: DataFrame, *columns: str) -> DataFrame:
    """Bridge rows with the named game columns."""
    facts = games.select(F.col("id").alias("game_id"), *columns)
    return game_genres.select("game_id", "genre_id").join(facts, "game_id")


def with_genre_name(stats: DataFrame, genres: DataFrame, exclude_unknown: bool = False) -> DataFrame:
    """Names for genre ids; on request without the imputed placeholder."""
    names = genres.select(F.col("id").alias("genre_id"), "genre_name")
    if exclude_unknown:
        names = names.filter(F.col("genre_name") != UNKNOWN)
    return stats.join(names, "genre_id").drop("genre_id")


def genre_price_stats(
    games: DataFrame, game_genres: DataFrame, genres: DataFrame, exclude_unknown: bool = False
) -> DataFrame:
    """Average original price and rating per genre over priced games.

    The bridge holds a (game, genre) pair once, so counting rows counts distinct games.
    """
    facts = genre_facts(games, game_genres, "original_price", "rating").filter(F.col("original_price") > 0)
    stats = facts.groupBy("genre_id").agg(
        rounded_mean_price(F.col("original_price")).alias("avg_price"),
        F.count("*").alias("game_count"),
        rounded_mean(F.col("rating"), 2).alias("avg_rating"),
    )
    return with_genre_name(stats, genres, exclude_unknown)


def genre_price(
    games: DataFrame, game_genres: DataFrame, genres: DataFrame, min_games: int = 10, n: int = 10,
    exclude_unknown: bool = False,
) -> DataFrame:
    """Genres by average price."""
    order = [F.col("avg_price").desc(), F.col("genre_name")]
    stats = genre_price_stats(games, game_genres, genres, exclude_unknown).filter(F.col("game_count") >= min_games)
    return ranked(top(stats, n, *order), *order)


def developer_efficiency(
    games: DataFrame, min_games: int = 3, n: int = 10, exclude_unknown: bool = False
) -> DataFrame:
    """Developers by average rating, fewer games first among equals."""
    rated = games.filter(named("developer", exclude_unknown) & F.col("rating").isNotNull())
    stats = rated.groupBy("developer").agg(
        F.count("*").alias("total_games"),
        rounded_mean(F.col("rating"), 2).alias("avg_rating"),
        F.sum("review_count").alias("total_reviews"),
        rounded_mean_price(F.col("original_price")).alias("avg_price"),
    )
    order = [F.col("avg_rating").desc(), F.col("total_games"), F.col("developer")]
    return ranked(top(stats.filter(F.col("total_games") >= min_games), n, *order), *order)


def cross_platform(
    games: DataFrame, min_platforms: int = 1, n: int = 10, split_lists: bool = False, exclude_unknown: bool = False
) -> DataFrame:
    """Titles on more than ``min_platforms`` distinct platforms, with the platform list.

    Rows are first combined per (title, platform), which bounds what a hot title sends to
    its reducer by its number of platforms. ``split_lists`` counts the single platforms of
    comma lists; a game's rating still counts once per listed platform.
    """
    kept = games.filter(named("platform", exclude_unknown))
    platform = F.explode(F.split("platform", r",\s*")) if split_lists else F.col("platform")
    pairs = (
        kept.select("game_title", platform.alias("platform"), "rating", "review_count")
        .groupBy("game_title", "platform")
        .agg(
            F.sum("rating").alias("_rating"),
            F.count("rating").alias("_rated"),
            F.sum("review_count").alias("_reviews"),
            F.count("review_count").alias("_counted"),
        )
    )
    titles = pairs.groupBy("game_title").agg(
        F.count("*").alias("platform_count"),
        F.array_join(F.array_sort(F.collect_list("platform")), ",").alias("platforms"),
        (F.sum("_rating") / F.nullif(F.sum("_rated"), F.lit(0))).alias("avg_rating"),
        (F.sum("_reviews") / F.nullif(F.sum("_counted"), F.lit(0))).alias("avg_reviews"),
    )
    order = [F.col("platform_count").desc(), F.col("avg_rating").desc_nulls_last(), F.col("game_title")]
    return ranked(top(titles.filter(F.col("platform_count") > min_platforms), n, *order), *order)


def genre_reviews(
    games: DataFrame, game_genres: DataFrame, genres: DataFrame, min_games: int = 5, n: int = 10,
    exclude_unknown: bool = False,
) -> DataFrame:
    """Genres by total review volume."""
    facts = genre_facts(games, game_genres, "review_count", "rating").filter(F.col("review_count").isNotNull())
    stats = facts.groupBy("genre_id").agg(
        F.count("*").alias("game_count"),
        F.sum("review_count").alias("total_reviews"),
        rounded_mean(F.col("rating"), 2).alias("avg_rating"),
        rounded_mean(F.col("review_count"), 0).alias("avg_reviews_per_game"),
    )
    order = [F.col("total_reviews").desc(), F.col("genre_name")]
    enough = with_genre_name(stats.filter(F.col("game_count") >= min_games), genres, exclude_unknown)
    return ranked(top(enough, n, *order), *order)


GAME_QUESTIONS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "bq1_top_rated": top_rated,
    "bq2_top_performers": top_performers,
    "bq3_hidden_gems": hidden_gems,
    "bq4_consistent_publishers": consistent_publishers,
    "bq5_platform_pricing": platform_pricing,
    "bq6_discount_deals": discount_deals,
    "bq8_developer_efficiency": developer_efficiency,
    "bq9_cross_platform": cross_platform,
}
GENRE_QUESTIONS: dict[str, Callable[[DataFrame, DataFrame, DataFrame], DataFrame]] = {
    "bq7_genre_price": genre_price,
    "bq10_genre_reviews": genre_reviews,
}


def all_questions(games: DataFrame, game_genres: DataFrame, genres: DataFrame) -> dict[str, DataFrame]:
    """Every business question as a lazy result."""
    answers = {name: build(games) for name, build in GAME_QUESTIONS.items()}
    return answers | {name: build(games, game_genres, genres) for name, build in GENRE_QUESTIONS.items()}


def long_form(answers: dict[str, DataFrame]) -> DataFrame:
    """All results in one: a row per question, position and field, with its text or its number."""
    frames = []
    for name, answer in answers.items():
        cells = [
            F.struct(
                F.lit(c).alias("field"),
                (F.col(c) if kind == "string" else F.lit(None).cast("string")).alias("text"),
                (F.lit(None).cast("double") if kind == "string" else F.col(c).cast("double")).alias("number"),
            )
            for c, kind in answer.dtypes
            if c != "position"
        ]
        place = F.col("position") if "position" in answer.columns else F.lit(1)
        frames.append(answer.select(F.lit(name).alias("question"), place.alias("position"), F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, frames)
