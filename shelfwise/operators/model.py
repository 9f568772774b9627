"""Final records -> relational model, constraint audits, review intake."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.numbers import zero_to_null
from shelfwise.functions.text import genre_names
from shelfwise.operators import rules
from shelfwise.operators.numbering import numbered
from shelfwise.operators.store import Change, Store, next_start
from shelfwise.schemas import MODEL, ddl
from shelfwise.session import exists, staging, stored
from shelfwise.sources.csv import save_table
from shelfwise.sources.media import register_media

RATING_RANGE = (0, 100)

# Without the rules on ids that numbering keeps by itself.
CATALOGUE_RULES = {
    "games": rules.Rules(("game_title",), (("id",),)),
    "genres": rules.Rules(("genre_name",), (("genre_name",),)),
    "game_genres": rules.Rules((), (("game_id", "genre_id"),), (("game_id", "games", "id"), ("genre_id", "genres", "id"))),
}


@dataclass(frozen=True)
class Catalogue:
    """The tables of the model."""

    games: DataFrame
    genres: DataFrame
    game_genres: DataFrame

    def save(self, folder: str, mode: str = "errorifexists") -> None:
        """Write each table once; with ``mode="ignore"`` tables that exist are left as they are."""
        for name in ("games", "genres", "game_genres"):
            save_table(getattr(self, name), f"{folder}/{name}", mode)

    @classmethod
    def load(cls, spark, folder: str) -> Catalogue:
        """The stored tables, with the declared schemas."""
        tables = {
            name: spark.read.schema(ddl(MODEL[name])).parquet(f"{folder}/{name}")
            for name in ("games", "genres", "game_genres")
        }
        return cls(**tables)


    def save_bucketed(self, folder: str, prefix: str, buckets: int) -> None:
        """Write tables named ``prefix`` + name, games and links in buckets of the game's id, one file each.

        Joins of games and links then need no shuffle. ``buckets`` should leave a bucket of links that fits a task.
        """
        for name, key in (("games", "id"), ("game_genres", "game_id")):
            rows = getattr(self, name).repartition(buckets, key)
            rows.write.bucketBy(buckets, key).sortBy(key).option("path", f"{folder}/{name}").saveAsTable(f"{prefix}{name}")
        self.genres.write.option("path", f"{folder}/genres").saveAsTable(f"{prefix}genres")

    @classmethod
    def load_bucketed(cls, spark, prefix: str) -> Catalogue:
        """The tables written by ``save_bucketed``."""
        return cls(*(spark.table(f"{prefix}{name}") for name in ("games", "genres", "game_genres")))


def game_rows(final: DataFrame, zero_is_null: bool = True) -> DataFrame:
    """Typed game columns; a zero rating, count, price or discount reads as missing."""
    numeric = ("rating", "review_count", "discounted_price", "original_price", "discount_percentage")
    columns = []
    for name, kind in MODEL["games"].items():
        if name in ("id", "created_at"):
            continue
        value = F.col(name)
        if name in numeric:
            value = zero_to_null(value, kind) if zero_is_null else value.try_cast("decimal(30,6)").try_cast(kind)
        columns.append(value.cast(kind).alias(name))
    return final.select(*columns, genre_names(F.col("genres")).alias("genre_list"))


def game_table(final: DataFrame, zero_is_null: bool = True) -> DataFrame:
    """Numbered games with their genre list. Ids follow the stored order of the rows; storing
    them for the numbering is also the one evaluation of the cleaning."""
    return numbered(game_rows(final, zero_is_null))


def genre_pairs(games: DataFrame, key: str = "id", names: str = "genre_list") -> DataFrame:
    """Distinct (game, genre name) pairs.

    Games have unique ids, so repeats can only occur inside one list: ``array_distinct``
    removes them without a shuffle.
    """
    return games.select(F.col(key).alias("game_id"), F.explode(F.array_distinct(names)).alias("genre_name"))


def genre_table(pairs: DataFrame) -> DataFrame:
    """Numbered distinct genre names; the distinct is combined map-side."""
    named = numbered(pairs.select("genre_name").distinct(), "genre_name")
    return named.withColumn("description", F.lit(None).cast("string"))


def bridge_table(pairs: DataFrame, genres: DataFrame) -> DataFrame:
    """(game_id, genre_id) by name; adaptive execution broadcasts the genres or splits hot ones."""
    named = genres.select("genre_name", F.col("id").alias("genre_id"))
    return pairs.join(named, "genre_name").select("game_id", "genre_id")


def highest_id(spark, name: str, path: str) -> int:
    """The highest id of a stored table, after which new ones continue; 0 for an empty or missing one."""
    if not exists(spark, path):
        return 0
    return spark.read.schema(ddl(MODEL[name])).parquet(path).agg(F.max("id")).first()[0] or 0


def build_catalogue(final: DataFrame, zero_is_null: bool = True) -> Catalogue:
    """Games, genres and the bridge. Numbering stores its input, so the games' ids are fixed
    before the bridge refers to them."""
    games = game_table(final, zero_is_null)
    pairs = genre_pairs(games)
    genres = genre_table(pairs)
    links = numbered(bridge_table(pairs, genres))
    stamped = games.drop("genre_list").withColumn("created_at", F.current_timestamp())
    return Catalogue(stamped, genres, links)


def empty_table(spark, name: str) -> DataFrame:
    return spark.createDataFrame([], ddl(MODEL[name]))


def create_tables(spark, folder: str) -> None:
    """Every table of the model as an empty stored table, unless it exists."""
    for name in MODEL:
        empty_table(spark, name).write.mode("ignore").parquet(f"{folder}/{name}")


def load_if_empty(final: DataFrame, folder: str, zero_is_null: bool = True) -> bool:
    """Fill created tables from the final records; False, and nothing written, if games exist."""
    stored_games = Catalogue.load(final.sparkSession, folder).games
    if not stored_games.isEmpty():
        return False
    with staging(final.sparkSession):
        build_catalogue(final, zero_is_null).save(folder, mode="append")
    return True


# --------------------------------------------------------------------------
# Constraint audits: rows that break a declared rule.
# --------------------------------------------------------------------------

def audit_not_null(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """One row per missing value of a required column."""
    broken = F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]), lambda c: c.isNotNull()
    )
    return df.select(F.col(key), F.explode(broken).alias("column_name"))


def audit_unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def audit_check(df: DataFrame, condition: Column) -> DataFrame:
    """Rows whose check is false; like SQL, an unknown result passes."""
    return df.filter(~condition)


def audit_foreign_key(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose reference has no parent; null references are allowed."""
    parents = parent.select(F.col(key).alias(column))
    return child.filter(F.col(column).isNotNull()).join(parents, column, "left_anti")


def cascade_delete(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows that still have a parent."""
    return child.join(parent.select(F.col(key).alias(column)), column, "left_semi")


def audit_catalogue(games: DataFrame, genres: DataFrame, game_genres: DataFrame) -> DataFrame:
    """Violations per rule of the model's keys, names and links, one row per rule."""
    return rules.audit({"games": games, "genres": genres, "game_genres": game_genres}, CATALOGUE_RULES)


# --------------------------------------------------------------------------
# Review and media intake.
# --------------------------------------------------------------------------

def _rating_ok() -> Column:
    return F.coalesce(F.col("rating").between(*RATING_RANGE), F.lit(True))


def accepted_reviews(batch: DataFrame, games: DataFrame) -> DataFrame:
    """Reviews with a rating in range for a known game, with defaults filled in."""
    valid = batch.filter(_rating_ok() & F.col("user_name").isNotNull())
    known = valid.join(games.select(F.col("id").alias("game_id")), "game_id", "left_semi")
    return known.withColumn("helpful_count", F.coalesce("helpful_count", F.lit(0).cast("bigint")))


def rejected_reviews(batch: DataFrame, games: DataFrame) -> DataFrame:
    """The other reviews with the first reason, for quarantine; one pass and one join."""
    parents = games.select(F.col("id").alias("game_id"), F.lit(True).alias("_known"))
    checked = batch.join(parents, "game_id", "left")
    reason = (
        F.when(~_rating_ok(), F.lit("rating out of range"))
        .when(F.col("user_name").isNull(), F.lit("user name missing"))
        .when(F.col("_known").isNull(), F.lit("unknown game"))
    )
    return checked.withColumn("reason", reason).filter(F.col("reason").isNotNull()).drop("_known")


def append_reviews(batch: DataFrame, games: DataFrame, path: str, quarantine: str) -> None:
    """Append accepted reviews to the review table and the rest to the quarantine table.

    Ids continue after the highest stored one; a missing review date is the time of the append.
    """
    accepted = accepted_reviews(batch.drop("id"), games)
    if "review_date" not in accepted.columns:
        accepted = accepted.withColumn("review_date", F.lit(None).cast("timestamp"))
    dated = accepted.withColumn("review_date", F.coalesce("review_date", F.current_timestamp()))
    named = [F.col(c).cast(kind).alias(c) for c, kind in MODEL["user_reviews"].items() if c in dated.columns]
    with staging(batch.sparkSession):
        save_table(numbered(dated.select(*named), start=highest_id(batch.sparkSession, "user_reviews", path)), path, "append")
    rejected_reviews(batch, games).write.mode("append").parquet(quarantine)


def append_media(files: DataFrame, games: DataFrame, path: str) -> None:
    """Append the media rows of a ``(path, length)`` listing, stamped; ids continue after the highest stored one."""
    rows = register_media(files, games).withColumn("uploaded_at", F.current_timestamp())
    with staging(files.sparkSession):
        save_table(numbered(rows, start=highest_id(files.sparkSession, "media_files", path)), path, "append")


# --------------------------------------------------------------------------
# A model in a store: batches that may be repeated, and deletions.
# --------------------------------------------------------------------------

# The model's tables and the reviews that were not accepted.
STORE_TABLES = MODEL | {"rejected_reviews": MODEL["user_reviews"] | {"reason": "string"}}
LINK = ("data_source", "game_url")


def open_store(spark, root: str) -> Store:
    return Store(spark, root, STORE_TABLES)


def stored_catalogue(store: Store) -> Catalogue:
    entries = store.entries()
    return Catalogue(*(store.table(name, entries) for name in ("games", "genres", "game_genres")))


def _same(left: DataFrame, right: DataFrame, columns: tuple[str, ...]) -> Column:
    """Equal in all columns; nulls are equal to each other."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & left[c].eqNullSafe(right[c])
    return condition


def store_records(store: Store, batch: str, final: DataFrame, zero_is_null: bool = True) -> bool:
    """Load final records into a store that may be filled: games by source and link, genres by name, links by pair.

    What is stored keeps its id, what is not gets the next ones: a game whose source and link are known adds no row
    (a null link is one link of its source), only links to genres it lacked. All three tables change together, and a batch
    that was loaded before changes nothing (False).
    """

    def build(entries: list[dict]) -> Change:
        games, genres, links = (store.table(name, entries) for name in ("games", "genres", "game_genres"))
        known = games.groupBy(*LINK).agg(F.min("id").alias("id"))
        rows = stored(game_rows(final, zero_is_null))
        fresh = rows.join(known, _same(rows, known, LINK), "left_anti")
        added = numbered(fresh.drop("genre_list"), start=next_start(games))
        every = known.unionByName(added.groupBy(*LINK).agg(F.min("id").alias("id")))
        linked = rows.join(every, _same(rows, every, LINK)).select(every["id"], rows["genre_list"])
        pairs = stored(genre_pairs(linked).distinct())
        names = pairs.select("genre_name").distinct().join(genres, "genre_name", "left_anti")
        new_genres = numbered(names, "genre_name", start=next_start(genres)).withColumn("description", F.lit(None).cast("string"))
        named = genres.select("id", "genre_name").unionByName(new_genres.select("id", "genre_name"))
        bridge = bridge_table(pairs, named).join(links.select("game_id", "genre_id"), ["game_id", "genre_id"], "left_anti")
        return Change(
            add={
                "games": added.withColumn("created_at", F.current_timestamp()),
                "genres": new_genres,
                "game_genres": numbered(bridge, start=next_start(links)),
            }
        )

    return store.commit(batch, build)


def store_reviews(store: Store, batch: str, reviews: DataFrame) -> bool:
    """Store a batch of reviews, accepted and rejected ones together, once however often it is given (False after that)."""

    def build(entries: list[dict]) -> Change:
        games = store.table("games", entries)
        accepted = accepted_reviews(reviews.drop("id"), games)
        dates = F.col("review_date") if "review_date" in accepted.columns else F.lit(None).cast("timestamp")
        dated = accepted.withColumn("review_date", F.coalesce(dates.cast("timestamp"), F.current_timestamp()))
        start = next_start(store.table("user_reviews", entries))
        return Change(add={"user_reviews": numbered(dated, start=start), "rejected_reviews": rejected_reviews(reviews, games)})

    return store.commit(batch, build)


def store_media(store: Store, batch: str, files: DataFrame) -> bool:
    """Register the files of a ``(path, length)`` listing, once however often the batch is given (False after that)."""

    def build(entries: list[dict]) -> Change:
        rows = register_media(files, store.table("games", entries)).withColumn("uploaded_at", F.current_timestamp())
        return Change(add={"media_files": numbered(rows, start=next_start(store.table("media_files", entries)))})

    return store.commit(batch, build)


def delete_games(store: Store, batch: str, ids: DataFrame) -> bool:
    """Delete games (``ids``: one column) and all rows that refer to them; files without such rows stay as they are."""
    columns = {"games": "id", "game_genres": "game_id", "media_files": "game_id", "user_reviews": "game_id"}
    return store.delete_keys(batch, ids, columns)
