"""The seven market questions: prices, ratings, discounts and release age."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.numbers import cents, rounded_mean, rounded_mean_price, rounded_ratio
from shelfwise.functions.text import title_key
from shelfwise.operators.clean import UNKNOWN
from shelfwise.plans.business import genre_facts, genre_price_stats, named, ranked, top, with_genre_name
from shelfwise.session import ensure_checkpoint_dir

# Release-age classes in days; the last one is open.
AGE_CLASSES = ((365, "0-1 years"), (1095, "1-3 years"), (1825, "3-5 years"))
OLDEST_CLASS = "5+ years"


def price_by_genre(
    games: DataFrame, game_genres: DataFrame, genres: DataFrame, n: int = 10, exclude_unknown: bool = False
) -> DataFrame:
    """The ``n`` dearest and the ``n`` cheapest genres; both ends read one aggregate, which is checkpointed."""
    ensure_checkpoint_dir(games.sparkSession)
    stats = genre_price_stats(games, game_genres, genres, exclude_unknown).select("genre_name", "avg_price", "game_count").checkpoint()
    ends = []
    for side, price in (("highest", F.col("avg_price").desc()), ("lowest", F.col("avg_price").asc())):
        order = [price, F.col("genre_name")]
        ends.append(ranked(top(stats, n, *order), *order).withColumn("side", F.lit(side)))
    return ends[0].unionByName(ends[1])


def price_rating_correlation(games: DataFrame) -> DataFrame:
    """Correlation of price and rating over the games that have both, rounded to six decimals."""
    both = games.filter(F.col("discounted_price").isNotNull() & F.col("rating").isNotNull())
    correlation = F.corr(F.col("discounted_price").cast("double"), F.col("rating").cast("double"))
    return both.agg(F.count("*").alias("n"), F.round(correlation, 6).alias("price_rating_corr"))


def value_by_price_bucket(games: DataFrame, low: float, high: float, buckets: int) -> DataFrame:
    """Average rating per price bucket of equal width, best first by ``value_rank``."""
    width = (high - low) / buckets
    price = F.col("discounted_price").cast("double")
    bucket = F.least(F.greatest(F.floor((price - low) / width) + 1, F.lit(0)), F.lit(buckets + 1)).cast("int")
    stats = (
        games.filter(price.isNotNull() & F.col("rating").isNotNull())
        .groupBy(bucket.alias("price_bucket"))
        .agg(F.count("*").alias("games"), rounded_mean(F.col("rating"), 2).alias("avg_rating"))
    )
    best = Window.orderBy(F.col("avg_rating").desc(), F.col("price_bucket"))
    return stats.withColumn("value_rank", F.row_number().over(best).cast("int"))


def discount_by_genre_and_source(
    games: DataFrame, game_genres: DataFrame, genres: DataFrame, exclude_unknown: bool = False
) -> DataFrame:
    """Depth and number of discounts per genre and source."""
    facts = genre_facts(games, game_genres, "data_source", "discount_percentage")
    hundredths = cents(F.col("discount_percentage"))
    stats = (
        facts.filter(F.col("discount_percentage") > 0)
        .groupBy("genre_id", "data_source")
        .agg(
            F.count("*").alias("games_on_sale"),
            (rounded_ratio(F.sum(hundredths), F.count(hundredths), 0) / 100).alias("avg_discount"),
            F.max("discount_percentage").cast("double").alias("max_discount"),
        )
    )
    return with_genre_name(stats, genres, exclude_unknown)


def rating_gap(records: DataFrame, n: int = 10) -> DataFrame:
    """Titles whose sources disagree most: gap between the highest and lowest source average.

    Records are averaged per (title, source) first, so a title brings one row per source
    and no pairs of records are formed.
    """
    rated = records.filter(F.col("rating").isNotNull())
    tenths = F.round(F.col("rating") * 10).cast("bigint")
    per_source = (
        rated.groupBy(title_key(F.col("game_title")).alias("title_key"), "data_source")
        .agg(rounded_ratio(F.sum(tenths), F.count(tenths) * 10, 2).alias("r"))
        .select("title_key", "data_source", cents(F.col("r")).alias("h"))
    )
    gaps = per_source.groupBy("title_key").agg(
        F.count("*").alias("sources"),
        F.max(F.struct("h", "data_source")).alias("top"),
        F.min(F.struct("h", "data_source")).alias("bottom"),
    )
    shown = gaps.filter(F.col("sources") > 1).select(
        "title_key",
        F.col("top.data_source").alias("high_source"),
        F.col("bottom.data_source").alias("low_source"),
        (F.col("top.h") / 100).alias("high_rating"),
        (F.col("bottom.h") / 100).alias("low_rating"),
        ((F.col("top.h") - F.col("bottom.h")) / 100).alias("gap"),
    )
    return shown.orderBy(F.col("gap").desc(), "title_key").limit(n)


def publisher_stability(games: DataFrame, min_games: int = 5, exclude_unknown: bool = False) -> DataFrame:
    """Publishers with average and population deviation of the rating, from exact sums."""
    rated = games.filter(named("publisher", exclude_unknown) & F.col("rating").isNotNull())
    r = F.col("rating").cast("bigint")
    stats = rated.groupBy("publisher").agg(
        F.count("*").alias("total_games"),
        rounded_mean(r, 2).alias("avg_rating"),
        F.sum(r).alias("_s"),
        F.sum(r * r).alias("_q"),
    )
    n = F.col("total_games")
    wide = [c.cast("decimal(19,0)") for c in (n, F.col("_q"), F.col("_s"))]
    spread = (wide[0] * wide[1] - wide[2] * wide[2]).cast("double")
    deviation = F.round(F.sqrt(spread) / n, 4)
    return stats.filter(n >= min_games).select("publisher", "total_games", "avg_rating", deviation.alias("rating_stddev"))


def feature_lift(games: DataFrame, features: Column, min_games: int = 1) -> DataFrame:
    """Average rating of games with a feature against the average of all rated games.

    ``features`` is an array column. The overall average is a scalar subquery over the
    rating column alone, so the rows per feature stay distributed.
    """
    rated = games.filter(F.col("rating").isNotNull())
    stats = (
        rated.select("rating", F.explode(F.array_distinct(features)).alias("feature"))
        .groupBy("feature")
        .agg(F.count("*").alias("games"), rounded_mean(F.col("rating") * 100, 0).alias("_own"))
    )
    overall = rated.agg(rounded_mean(F.col("rating") * 100, 0).alias("_all")).scalar()
    return stats.filter(F.col("games") >= min_games).select(
        "feature",
        "games",
        (F.col("_own") / 100).alias("avg_rating"),
        (overall / 100).alias("overall_rating"),
        ((F.col("_own") - overall) / 100).alias("lift"),
    )


def release_age_class(date: Column, as_of: Column) -> Column:
    age = F.date_diff(as_of, date)
    label = F.when(age < 0, F.lit("unreleased"))
    for days, name in AGE_CLASSES:
        label = label.when(age < days, F.lit(name))
    return F.when(date.isNull(), F.lit(UNKNOWN)).otherwise(label.otherwise(F.lit(OLDEST_CLASS)))


def new_against_catalogue(games: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Prices and ratings per release-age class."""
    day = F.current_date() if as_of is None else as_of
    return _release_stats(games, release_age_class(F.col("release_date"), day).alias("age_class"))


def release_years(games: DataFrame) -> DataFrame:
    """Prices and ratings per release year."""
    return _release_stats(games.filter(F.col("release_date").isNotNull()), F.year("release_date").alias("release_year"))


def _release_stats(games: DataFrame, key: Column) -> DataFrame:
    return games.groupBy(key).agg(
        F.count("*").alias("games"),
        rounded_mean_price(F.col("original_price")).alias("avg_original_price"),
        rounded_mean_price(F.col("discounted_price")).alias("avg_discounted_price"),
        rounded_mean(F.col("rating"), 2).alias("avg_rating"),
    )
