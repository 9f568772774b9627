"""Lookups and statistics on the relational model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.numbers import mean


def record_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def media_stats(media_files: DataFrame) -> DataFrame:
    """Files and bytes per media type."""
    return media_files.groupBy("media_type").agg(
        F.count("*").alias("files"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes")
    )


def developer_stats(games: DataFrame, developer: str | None = None) -> DataFrame:
    """Games, average rating, reviews, first and latest release per developer (or of one)."""
    rows = games.filter(F.col("developer") == developer) if developer is not None else games
    return rows.groupBy("developer").agg(
        F.count("*").alias("game_count"),
        mean(F.col("rating")).alias("avg_rating"),
        F.sum("review_count").alias("total_reviews"),
        F.min("release_date").alias("first_release"),
        F.max("release_date").alias("latest_release"),
    )


def top_rated_games(games: DataFrame, n: int = 10, min_reviews: int = 100) -> DataFrame:
    rated = games.filter(F.col("rating").isNotNull() & (F.col("review_count") > min_reviews))
    columns = ["id", "game_title", "rating", "review_count", "developer", "platform"]
    return rated.select(*columns).orderBy(F.col("rating").desc(), F.col("review_count").desc(), "id").limit(n)


def game_reviews(user_reviews: DataFrame, game_id: int | None = None) -> DataFrame:
    """Reviews of one game, or of every game in turn, most helpful and newest first.

    The sort is range-partitioned over all its keys, so the reviews of one popular game are
    spread over several tasks.
    """
    order = [F.col("helpful_count").desc(), F.col("review_date").desc(), F.col("user_name"), F.col("id")]
    columns = ["game_id", "user_name", "rating", "review_text", "helpful_count", "review_date"]
    if game_id is not None:
        return user_reviews.filter(F.col("game_id") == game_id).orderBy(*order).select(*columns)
    return user_reviews.orderBy("game_id", *order).select(*columns)


def game_with_genres(
    games: DataFrame, game_genres: DataFrame, genres: DataFrame, game_id: int | None = None
) -> DataFrame:
    """Each game with the sorted array of its genre names; a game has few genres."""
    if game_id is not None:
        games = games.filter(F.col("id") == game_id)
        game_genres = game_genres.filter(F.col("game_id") == game_id)
    named = game_genres.join(genres.select(F.col("id").alias("genre_id"), "genre_name"), "genre_id")
    lists = named.groupBy("game_id").agg(F.array_sort(F.collect_set("genre_name")).alias("genre_names"))
    joined = games.join(lists, games["id"] == lists["game_id"], "left").drop("game_id")
    return joined.withColumn("genre_names", F.coalesce("genre_names", F.array().cast("array<string>")))


def games_by_genre(
    games: DataFrame, game_genres: DataFrame, genres: DataFrame, genre_name: str, n: int = 10
) -> DataFrame:
    """The first ``n`` games of a genre by id.

    The name is resolved to its id by a scalar subquery, so the links are filtered in their
    scan and a hot genre is never gathered in one join task. The ``n`` smallest ids that
    exist, which is what bounds the broadcast, then pick the games.
    """
    genre_id = genres.filter(F.col("genre_name") == genre_name).agg(F.max("id")).scalar()
    links = game_genres.filter(F.col("genre_id") == genre_id).select(F.col("game_id").alias("id"))
    first = links.join(games.select("id"), "id", "left_semi").orderBy("id").limit(n)
    return games.join(F.broadcast(first), "id", "left_semi").orderBy("id")


def genre_distribution(genres: DataFrame, game_genres: DataFrame) -> DataFrame:
    """Games per genre, genres without games included; links are counted before the join."""
    counts = game_genres.groupBy(F.col("genre_id").alias("id")).agg(F.count("game_id").alias("n"))
    joined = genres.select("id", "genre_name").join(counts, "id", "left")
    return joined.select("genre_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("game_count"))


def find_by_title(games: DataFrame, title: str) -> DataFrame:
    """The game with exactly this title, else the first whose title contains it, ignoring case.

    One scan: exact hits sort first and one row is kept. The text is matched as it stands,
    not as a pattern.
    """
    exact = F.col("game_title") == title
    partial = F.lower("game_title").contains(title.lower())
    hits = games.filter(exact | partial).select("id", "game_title", F.when(exact, 0).otherwise(1).alias("_rank"))
    return hits.orderBy("_rank", "id").limit(1).drop("_rank")


def find_by_titles(games: DataFrame, wanted: DataFrame) -> DataFrame:
    """Exact title matches for a table of titles (column ``wanted``), lowest id per title.

    Games are reduced to one row per title map-side before the join.
    """
    lowest = games.groupBy("game_title").agg(F.min("id").alias("id"))
    return lowest.join(wanted.select(F.col("wanted").alias("game_title")), "game_title", "left_semi").select("id", "game_title")


GRAM = 3


def _grams(text: Column, n: int) -> Column:
    """All runs of ``n`` signs of a text, without repeats."""
    places = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1)))
    return F.array_distinct(F.transform(F.coalesce(places, F.array().cast("array<int>")), lambda i: F.substring(text, i, F.lit(n))))


def find_by_title_parts(games: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each text of ``wanted``: the game with exactly this title, else the first whose title contains it, ignoring case.

    Titles are listed under the runs of three signs in them. A text meets only the titles listed under its rarest
    run, which are then checked; a text of fewer signs is listed itself. Texts without a game give no row, null ones neither.
    """
    texts = wanted.select("wanted").filter("wanted is not null").distinct().withColumn("low", F.lower("wanted"))
    own = F.when(F.length("low") >= GRAM, _grams(F.col("low"), GRAM)).otherwise(F.array("low"))
    keys = texts.select("wanted", "low", F.explode(own).alias("gram"))
    titles = games.groupBy("game_title").agg(F.min("id").alias("id")).withColumn("low_title", F.lower("game_title"))
    runs = F.concat(F.array(F.lit("")), *[_grams(F.col("low_title"), n) for n in range(1, GRAM + 1)])
    listed = titles.select("id", "game_title", "low_title", F.explode(runs).alias("gram"))
    lists = listed.join(keys.select("gram").distinct(), "gram", "left_semi")
    sizes = lists.groupBy("gram").agg(F.count("*").alias("n"))
    rank = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")
    rarest = keys.join(sizes, "gram", "left").groupBy("wanted", "low").agg(F.min(rank)["gram"].alias("gram"))
    hits = rarest.join(lists, "gram").filter(F.contains("low_title", "low"))
    first = F.struct((F.col("game_title") != F.col("wanted")).alias("part"), "id", "game_title")
    return hits.groupBy("wanted").agg(F.min(first).alias("first")).select("wanted", "first.id", "first.game_title")


def database_stats(tables: dict[str, DataFrame], media_files: DataFrame) -> DataFrame:
    """Row counts and, per media type, files and bytes, in long form."""
    counts = record_counts(tables).select(
        F.col("table_name").alias("item"), F.col("n"), F.lit(None).cast("bigint").alias("bytes")
    )
    media = media_stats(media_files).select(F.col("media_type").alias("item"), F.col("files").alias("n"), "bytes")
    return counts.unionByName(media)
