"""Named queries over the test tables, each a call of one operator on an adapter's input.

Every query reads whole tables; its checking SQL is in ``shelfwise.plans.oracles`` under the
same name.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import arrays, dates, numbers, text, urls
from shelfwise.operators import clean, conform, dedup, model, quality, rules, seen
from shelfwise.operators.store import Change, Store
from shelfwise.plans import business, lookups, research
from shelfwise.schemas import MODEL, SOURCE_A, SOURCE_B, SOURCE_C, ddl
from shelfwise.session import shared_folder
from shelfwise.sources import adapters, media, pages
from shelfwise.sources.csv import ARRIVAL, export_csv, read_csv, read_csv_replacing
from shelfwise.sources.profiles import PUBLISHED_CUTS
from shelfwise.sources.tables import run_sql, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The day on which release states and ages are judged, so that results do not age.
AS_OF = datetime.date(1998, 6, 30)


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def as_of() -> Column:
    return F.lit(AS_OF)


# --------------------------------------------------------------------------
# Business and market questions.
# --------------------------------------------------------------------------

def _game_question(question) -> Query:
    return lambda spark, folder: question(adapters.games(spark, folder))


def _genre_question(question) -> Query:
    return lambda spark, folder: question(*adapters.genre_model(spark, folder))


def _with_unknown(question) -> Query:
    """A genre question that leaves out the placeholder, here in place of one of the genres."""

    def build(spark, folder):
        games, links, genres = adapters.genre_model(spark, folder)
        hidden = F.when(F.col("genre_name") == "ring", clean.UNKNOWN).otherwise(F.col("genre_name"))
        return question(games, links, genres.withColumn("genre_name", hidden), exclude_unknown=True)

    return build


QUERIES["bq7_known"] = _with_unknown(business.genre_price)
QUERIES["bq10_known"] = _with_unknown(business.genre_reviews)
QUERIES["price_by_genre_known"] = _with_unknown(research.price_by_genre)
QUERIES["discount_by_genre_source_known"] = _with_unknown(research.discount_by_genre_and_source)


@query
def bq9_known(spark, folder):
    games = adapters.games(spark, folder)
    hidden = F.when(F.col("id") % 3 == 0, clean.UNKNOWN).otherwise(F.col("platform"))
    return business.cross_platform(games.withColumn("platform", hidden), exclude_unknown=True)


@query
def all_questions(spark, folder):
    return business.long_form(business.all_questions(*adapters.genre_model(spark, folder)))


for _name, _question in business.GAME_QUESTIONS.items():
    QUERIES[_name] = _game_question(_question)
for _name, _question in business.GENRE_QUESTIONS.items():
    QUERIES[_name] = _genre_question(_question)
QUERIES["price_by_genre"] = _genre_question(research.price_by_genre)
QUERIES["discount_by_genre_source"] = _genre_question(research.discount_by_genre_and_source)
QUERIES["price_rating_corr"] = _game_question(research.price_rating_correlation)
QUERIES["publisher_stability"] = _game_question(research.publisher_stability)


@query
def bq9_cross_platform_lists(spark, folder):
    listed = adapters.games(spark, folder).withColumn("platform", F.concat("platform", F.lit(", "), "publisher"))
    return business.cross_platform(listed, min_platforms=6, split_lists=True)


@query
def value_by_price_bucket(spark, folder):
    return research.value_by_price_bucket(adapters.games(spark, folder), 0, 1000, 10)


@query
def rating_gap(spark, folder):
    return research.rating_gap(conform.conform_renamed(adapters.landing_records(spark, folder), "ingest_ord"))


@query
def feature_lift(spark, folder):
    games = adapters.games(spark, folder)
    features = F.concat(F.split("game_title", " "), F.array("platform"))
    return research.feature_lift(games, features, 3)


def _spread_releases(spark, folder) -> DataFrame:
    """Games with release dates spread over seven years, some of them missing."""
    later = F.date_add("release_date", (F.col("id") * 13 % 2500).cast("int"))
    return adapters.games(spark, folder).withColumn("release_date", F.when(F.col("rating").isNotNull(), later))


@query
def new_vs_catalog(spark, folder):
    return research.new_against_catalogue(_spread_releases(spark, folder), as_of())


@query
def release_years(spark, folder):
    return research.release_years(_spread_releases(spark, folder))


@query
def top_rated_games(spark, folder):
    return lookups.top_rated_games(adapters.games(spark, folder))


@query
def adhoc_sql(spark, folder):
    statement = """
        SELECT data_source, COUNT(*) AS n, MAX(rating) AS best
        FROM {games} WHERE rating >= :low AND platform <> :skipped GROUP BY data_source
    """
    return run_sql(spark, statement, {"low": 50, "skipped": "PROMO"}, games=adapters.games(spark, folder))


# --------------------------------------------------------------------------
# Relational model, lookups, reviews.
# --------------------------------------------------------------------------

@query
def genre_dim(spark, folder):
    return model.genre_table(adapters.game_genre_pairs(spark, folder)).select("id", "genre_name")


@query
def genre_bridge(spark, folder):
    pairs = adapters.game_genre_pairs(spark, folder)
    return model.bridge_table(pairs, model.genre_table(pairs))


@query
def games_by_genre(spark, folder):
    games, links, genres = adapters.genre_model(spark, folder)
    found = lookups.games_by_genre(games, links, genres, "ring", 10)
    return found.select("id", "game_title", "rating", "platform")


@query
def games_with_genres(spark, folder):
    found = lookups.game_with_genres(*adapters.genre_model(spark, folder))
    return found.select("id", "game_title", F.array_join("genre_names", "|").alias("genre_names"))


@query
def genre_distribution(spark, folder):
    _, links, genres = adapters.genre_model(spark, folder)
    return lookups.genre_distribution(genres, links)


def _database(spark, folder) -> tuple[dict[str, DataFrame], DataFrame]:
    games, links, genres = adapters.genre_model(spark, folder)
    reviews = adapters.user_reviews(spark, folder)
    tables = {"games": games, "genres": genres, "game_genres": links, "user_reviews": reviews}
    return tables, media.register_media(adapters.media_listing(spark, folder), games)


@query
def table_counts(spark, folder):
    return lookups.record_counts(_database(spark, folder)[0])


@query
def database_stats(spark, folder):
    return lookups.database_stats(*_database(spark, folder))


@query
def media_stats(spark, folder):
    return lookups.media_stats(_database(spark, folder)[1])


@query
def media_files(spark, folder):
    return media.register_media(adapters.media_listing(spark, folder), adapters.games(spark, folder))


@query
def developer_stats(spark, folder):
    return lookups.developer_stats(adapters.games(spark, folder))


@query
def entity_reviews(spark, folder):
    return lookups.game_reviews(adapters.user_reviews(spark, folder))


@query
def find_by_title(spark, folder):
    games = adapters.games(spark, folder)
    wanted = [("exact", "cold ring"), ("partial", "D RIN"), ("literal", "%ring")]
    found = [lookups.find_by_title(games, t).select(F.lit(k).alias("kind"), "id", "game_title") for k, t in wanted]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def find_by_titles(spark, folder):
    wanted = table(spark, folder, "part").select(F.col("p_name").alias("wanted"))
    return lookups.find_by_titles(adapters.games(spark, folder), wanted)


@query
def find_by_title_parts(spark, folder):
    """Parts of titles in any case, whole titles, and texts of one or two signs, all looked up at once."""
    names = table(spark, folder, "part").select("p_partkey", "p_name")
    texts = F.array(F.upper(F.substring("p_name", 3, 6)), F.col("p_name"), F.substring("p_name", 1, 2), F.concat(F.lit("no "), "p_name"))
    wanted = names.select(F.explode(texts).alias("wanted")).distinct()
    return lookups.find_by_title_parts(adapters.games(spark, folder), wanted)


@query
def append_reviews_valid(spark, folder):
    return model.accepted_reviews(adapters.user_reviews(spark, folder), adapters.games(spark, folder))


@query
def append_reviews_rejected(spark, folder):
    rejected = model.rejected_reviews(adapters.user_reviews(spark, folder), adapters.games(spark, folder))
    return rejected.select("id", "game_id", "rating", "reason")


@query
def model_games(spark, folder):
    """Typed load of the final records, numbered; zeros read as missing."""
    final = clean.final_records(_master(spark, folder), as_of())
    return model.game_table(final).select(
        "data_source", "game_title", "release_date", "rating", "review_count",
        F.col("discounted_price").cast("double"), F.col("original_price").cast("double"),
        "discount_percentage", "platform", "developer", "publisher", "release_status", "game_url",
    )


@query
def audit_stored_model(spark, folder):
    """A stored load, with media and reviews appended in two batches: violations per rule of all five tables."""
    path = shared_folder(spark)
    model.create_tables(spark, path)
    model.load_if_empty(clean.final_records(_master(spark, folder), as_of()), path)
    stored = model.Catalogue.load(spark, path)
    files, reviews = adapters.media_listing(spark, folder), adapters.user_reviews(spark, folder)
    for batch in (0, 1):
        own = F.pmod(F.xxhash64("path"), F.lit(2)) == batch
        model.append_media(files.filter(own), stored.games, f"{path}/media_files")
        model.append_reviews(reviews.filter(F.col("id") % 2 == batch), stored.games, f"{path}/user_reviews", f"{path}/rejected")
    return rules.audit({name: spark.read.schema(ddl(MODEL[name])).parquet(f"{path}/{name}") for name in MODEL}, STAMPED_RULES)


# All rules of the model, and times of load, upload and review filled in.
STAMPED_RULES = {
    name: rules.Rules(own.required + rules.STAMPED.get(name, ()), own.unique, own.references, own.checks)
    for name, own in rules.MODEL_RULES.items()
}


def _filled_store(spark, folder):
    """A store with the genre model, its media, and reviews in two batches."""
    store = model.open_store(spark, shared_folder(spark))
    games, links, genres = adapters.genre_model(spark, folder)
    pairs = links.select("game_id", "genre_id").withColumn("id", F.xxhash64("game_id", "genre_id"))
    store.commit("load", lambda entries: Change(add={"games": games, "genres": genres, "game_genres": pairs}))
    model.store_media(store, "media", adapters.media_listing(spark, folder))
    reviews = adapters.user_reviews(spark, folder)
    for batch in (0, 1):
        model.store_reviews(store, f"reviews {batch}", reviews.filter(F.col("id") % 2 == batch))
    return store


@query
def append_twice(spark, folder):
    """Reviews in two batches, one of them stored three times: the table holds one copy of each."""
    store = model.open_store(spark, shared_folder(spark))
    games = adapters.games(spark, folder)
    store.commit("games", lambda entries: Change(add={"games": games}))
    reviews = adapters.user_reviews(spark, folder)
    for batch in (0, 1, 0, 0):
        model.store_reviews(store, f"reviews {batch}", reviews.filter(F.col("id") % 2 == batch))
    return store.table("user_reviews").drop("id")


@query
def model_second_load(spark, folder):
    """Half of the records loaded, then all of them, then the half again: genres and games as after one load."""
    store = model.open_store(spark, shared_folder(spark))
    final = clean.final_records(_master(spark, folder), as_of())
    half = F.pmod(F.xxhash64("game_url"), F.lit(2)) == 0
    for batch, rows in (("half", final.filter(half)), ("all", final), ("half again", final.filter(half))):
        model.store_records(store, batch, rows)
    built = model.stored_catalogue(store)
    games = built.games.agg(F.count("*").alias("game_count")).select(F.lit("all games").alias("genre_name"), "game_count")
    broken = rules.audit({"games": built.games, "genres": built.genres, "game_genres": built.game_genres})
    violations = broken.agg(F.sum("violations").alias("game_count")).select(F.lit("violations").alias("genre_name"), "game_count")
    return lookups.genre_distribution(built.genres, built.game_genres).unionByName(games).unionByName(violations)


@query
def cascade_rewrite(spark, folder):
    """Highly rated games deleted from a store: rows left per table, and broken rules."""
    store = _filled_store(spark, folder)
    model.delete_games(store, "delete", store.table("games").filter("rating >= 80").select("id"))
    entries = store.entries()
    tables = {name: store.table(name, entries) for name in MODEL}
    counts = lookups.record_counts(tables).select(F.col("table_name").alias("item"), "n")
    broken = rules.audit(tables).agg(F.sum("violations").alias("n")).select(F.lit("violations").alias("item"), "n")
    return counts.unionByName(broken)


@query
def model_genres(spark, folder):
    """Genre names and links of the loaded model."""
    built = model.build_catalogue(clean.final_records(_master(spark, folder), as_of()))
    return lookups.genre_distribution(built.genres, built.game_genres)


def _broken_games(spark, folder) -> DataFrame:
    """The games plus damaged copies: ids repeated, titles missing, ratings out of range."""
    games = adapters.games(spark, folder).select("id", "game_title", "rating")
    damaged = games.filter(F.col("rating") > 95).select(
        "id", F.lit(None).cast("string").alias("game_title"), (F.col("rating") + 3).alias("rating")
    )
    return games.unionByName(damaged)


@query
def audit_not_null(spark, folder):
    return model.audit_not_null(_broken_games(spark, folder), ["game_title", "rating"], "id")


@query
def audit_unique(spark, folder):
    return model.audit_unique(_broken_games(spark, folder), ["id"])


@query
def audit_check(spark, folder):
    return model.audit_check(_broken_games(spark, folder), F.col("rating").between(0, 100))


@query
def audit_fk(spark, folder):
    reviews = adapters.user_reviews(spark, folder).select("id", "game_id")
    return model.audit_foreign_key(reviews, "game_id", adapters.games(spark, folder), "id")


@query
def cascade_delete(spark, folder):
    reviews = adapters.user_reviews(spark, folder).select("id", "game_id")
    return model.cascade_delete(reviews, "game_id", adapters.games(spark, folder), "id")


@query
def audit_catalogue(spark, folder):
    games, links, genres = adapters.genre_model(spark, folder)
    dangling = adapters.user_reviews(spark, folder).select("game_id", (-1 - F.col("game_id")).alias("genre_id"))
    return model.audit_catalogue(games, genres, links.unionByName(dangling))


# --------------------------------------------------------------------------
# Scalar functions over raw listings, dates, documents and pages.
# --------------------------------------------------------------------------

def _listing_function(**columns: Callable[[], Column]) -> Query:
    def build(spark, folder):
        rows = adapters.listings(spark, folder)
        return rows.select("id", *[make().alias(name) for name, make in columns.items()])

    return build


QUERIES |= {
    "norm_rating": _listing_function(rating=lambda: numbers.rating(F.col("rating_raw"), F.col("data_source"))),
    "norm_price": _listing_function(
        price=lambda: numbers.price(F.col("price_raw")), price_us=lambda: numbers.price(F.col("price_raw"), "us")
    ),
    "clean_platform": _listing_function(platform=lambda: text.clean_platform(F.col("platforms_raw"))),
    "discount_number": _listing_function(discount=lambda: numbers.discount(F.col("discount_raw"))),
    "final_price": _listing_function(
        final_price=lambda: numbers.final_price(
            numbers.price(F.col("original_raw")),
            numbers.discount(F.col("discount_raw")),
            F.when(F.col("id") % 3 == 0, numbers.price(F.col("price_raw"))),
        )
    ),
    "review_count": _listing_function(review_count=lambda: numbers.review_count(F.col("review_count_raw"))),
    "text_rating_score": _listing_function(
        score=lambda: numbers.text_score(F.col("review_text")),
        strict_score=lambda: numbers.text_score(F.col("review_text"), strict=True),
    ),
    "review_pct": _listing_function(pct=lambda: numbers.review_percentage(F.col("review_text"))),
    "id_from_url": _listing_function(product_id=lambda: urls.product_id(F.col("url_raw"))),
    "currency_sign": _listing_function(currency=lambda: numbers.currency(F.col("price_raw"))),
    "price_display": _listing_function(
        shown=lambda: numbers.price_display(F.when(F.col("id") % 2 == 0, F.col("original_raw")), F.col("price_raw"))
    ),
    "genres_list": _listing_function(genres=lambda: text.genre_list(text.clean_text(F.col("genres_raw")))),
    "player_flags": _listing_function(
        multiplayer=lambda: arrays.yes_no(F.split("title_raw", " "), "ring"),
        singleplayer=lambda: arrays.yes_no(F.split("title_raw", " "), "cold"),
    ),
    "platform_flags": _listing_function(
        platforms=lambda: arrays.platforms_in(F.col("platforms_raw")),
        icon_platforms=lambda: arrays.platforms_of_classes(
            F.transform(F.split("platforms_raw", ", "), lambda p: F.concat(F.lit("os-icon--"), p))
        ),
    ),
    "list_text": _listing_function(
        pipe=lambda: arrays.delimited(F.filter(F.split("genres_raw", r"[,;|] ?"), lambda g: g != "x")),
        comma=lambda: arrays.delimited(F.filter(F.split("genres_raw", r"[,;|] ?"), lambda g: g == "x"), ", "),
    ),
    "edition_text": _listing_function(
        editions=lambda: arrays.delimited(
            arrays.editions(F.split("genres_raw", r"[,;|] ?"), F.array("price_raw", F.lit(None).cast("string"), "original_raw"))
        ),
    ),
    "user_tags": _listing_function(
        tags=lambda: arrays.delimited(arrays.user_tags(F.split(F.concat("title_raw", F.lit(" ... x")), " "), 3))
    ),
}


@query
def savings(spark, folder):
    games = adapters.games(spark, folder)
    return games.select("id", numbers.savings(F.col("original_price"), F.col("discounted_price")).cast("double").alias("savings"))


@query
def parse_price_text(spark, folder):
    rows = adapters.listings(spark, folder)
    label = F.concat(
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("-"), (F.col("id") % 90).cast("string"), F.lit("% "))).otherwise(F.lit(" ")),
        "price_raw", F.lit(" "), "original_raw",
    )
    parsed = rows.select("id", numbers.price_text(label).alias("a"), numbers.price_text(label, by_size=True).alias("b"))
    return parsed.select("id", "a.*", F.col("b.price").alias("low_price"), F.col("b.original_price").alias("high_price"))


@query
def norm_date(spark, folder):
    rows = adapters.raw_dates(spark, folder)
    spaced = F.concat(F.lit("  "), F.replace("date_raw", F.lit(" "), F.lit("   ")))
    return rows.select("id", dates.release_date(F.col("date_raw")).alias("release_date"),
                       dates.release_date(spaced).alias("spaced_date"))


@query
def release_status(spark, folder):
    rows = adapters.raw_dates(spark, folder)
    return rows.select("id", dates.release_status(dates.release_date(F.col("date_raw")), as_of()).alias("release_status"))


@query
def counts_in_text(spark, folder):
    """Bracketed counts, ratings with a scale and "n Reviews" built from the listings."""
    rows = adapters.listings(spark, folder)
    number = F.col("id").cast("string")
    return rows.select(
        "id",
        urls.count_in_brackets(F.concat("title_raw", F.lit(" ("), number, F.lit(")"))).alias("bracketed"),
        urls.first_decimal(F.concat("title_raw", F.lit(": "), F.col("rating_raw"), F.lit("/5"))).alias("score"),
        urls.review_number(F.concat(F.lit("("), number, F.lit("  Reviews)"))).alias("reviews"),
        urls.app_id(F.concat(F.lit("https://host/app/"), number, F.lit("/name/"))).alias("app"),
    )


def _noisy_documents(spark, folder) -> DataFrame:
    """Documents with entities, special blanks and escaped breaks around and inside the text."""
    noisy = F.concat(F.lit(" &nbsp;"), F.replace("text", F.lit(". "), F.lit(". ​&amp;\\n")), F.lit("\\r &quot;"))
    return table(spark, folder, "documents").select("doc_id", "text", noisy.alias("noisy"))


@query
def clean_text(spark, folder):
    return _noisy_documents(spark, folder).select("doc_id", text.clean_text(F.col("noisy")).alias("clean"))


@query
def flat_text(spark, folder):
    return _noisy_documents(spark, folder).select("doc_id", text.flat_text(F.concat(F.lit("\r\n"), "text")).alias("flat"))


@query
def title_norm(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", text.title_key(F.col("text")).alias("title_key"))


@query
def fix_encoding(spark, folder):
    damage = "â€œ q â€\x9d â„¢ Â® Â© Â  x Â â€˜ â€™ ﬁ \x07\t ½"
    docs = table(spark, folder, "documents").withColumn("damaged", F.concat(F.lit(damage), "text", F.lit(damage)))
    return docs.select(
        "doc_id",
        text.fix_encoding(F.col("damaged")).alias("fixed"),
        text.fix_encoding(F.col("damaged"), repair_first=True).alias("repaired_first"),
    )


@query
def safe_name(spark, folder):
    docs = table(spark, folder, "documents")
    risky = F.concat(F.lit(' <a>:"b/\\|?*\x07 '), "text")
    return docs.select(
        "doc_id", text.safe_name(risky, 50).alias("short_name"),
        text.safe_name(risky, 80, control=True, strip_first=True).alias("long_name"),
    )


@query
def description_clean(spark, folder):
    docs = table(spark, folder, "documents")
    summary = (
        F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit("  Originally released in 1999")))
        .when(F.col("doc_id") % 3 == 1, F.concat("text", F.lit("....  ")))
        .otherwise(F.concat(F.lit("Short note from "), F.col("source")))
    )
    return docs.select("doc_id", text.description(summary, F.concat("lang", F.lit(" "), "source", F.lit(": "), "text"), 1000).alias("description"))


@query
def requirements_text(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select(
        "doc_id", text.requirements_text(F.col("text"), 300).alias("short"),
        text.requirements_list(F.split("text", "\n")).alias("listed"),
    )


@query
def absolute_url(spark, folder):
    links = pages.page_links(table(spark, folder, "pages"))
    forms = F.when(F.col("position") % 3 == 0, F.concat(F.lit("//cdn.example.com"), "href")).otherwise(F.col("href"))
    return links.select("page_id", "position", urls.absolute_url(forms, "https://host.example").alias("link"))


@query
def image_sizes(spark, folder):
    links = pages.page_links(table(spark, folder, "pages"))
    return links.select(
        "page_id", "position",
        urls.full_size_screenshot(F.concat("href", F.lit(".116x65.jpg"))).alias("full_size"),
        urls.large_image(F.concat("href", F.lit("_256.jpg?x=-thumb.png"))).alias("large"),
        urls.image_extension(F.concat("href", F.lit(".PNG"))).alias("image_ext"),
        urls.video_extension(F.concat("href", F.lit(".mp4"))).alias("video_ext"),
    )


@query
def slug_title(spark, folder):
    links = pages.page_links(table(spark, folder, "pages"))
    slug = F.concat(F.lit("https://host/en/game/"), F.regexp_replace("href", r"[^A-Za-z0-9]", "_"), F.lit("-two_parts/"))
    return links.select("page_id", "position", text.slug_title(slug).alias("title"))


@query
def status_prefix(spark, folder):
    rows = adapters.listings(spark, folder)
    badge = F.when(F.col("id") % 4 == 0, F.lit(" soon ")).when(F.col("id") % 4 == 1, F.lit("Pre-order")).otherwise(F.col("status_raw"))
    tagged = rows.select("id", F.coalesce(text.status_tag(F.coalesce(badge, F.lit("new"))), F.lit("")).alias("tag"),
                         F.when(F.col("id") % 8 == 0, F.concat(F.lit("SOON "), "title_raw")).otherwise(F.col("title_raw")).alias("title"))
    return tagged.select("id", "tag", text.with_status_prefix(F.col("title"), F.col("tag")).alias("title"))


# --------------------------------------------------------------------------
# Conforming, filters, deduplication.
# --------------------------------------------------------------------------

def _conformed(spark, folder) -> DataFrame:
    return conform.conform_renamed(adapters.landing_records(spark, folder), "ingest_ord")


def _master(spark, folder) -> DataFrame:
    return conform.master_of(_conformed(spark, folder), "ingest_ord")


@query
def conform_union(spark, folder):
    return _conformed(spark, folder)


@query
def column_mapping(spark, folder):
    source = adapters.landing_sources(spark, folder)[SOURCE_B]
    mapped = conform.unified(conform.to_standard_names(source, SOURCE_B), "rating_raw", "current_price_raw")
    return conform.column_subset(mapped, ["game_url", "rating_raw", "current_price_raw", "not_there", "genres", "data_source"])


@query
def csv_round_trip(spark, folder):
    """The listings written as one UTF-8 and one Latin-1 file set and read back as text."""
    rows = adapters.listings(spark, folder).select(
        F.concat("title_raw", F.lit(" é, \"ü\"\nß")).alias("title"), F.col("id").cast("string").alias("id"),
        "genres_raw", F.coalesce("url_raw", F.lit("N/A")).alias("url"),
    )
    path = shared_folder(spark)
    for remainder, charset in ((0, "UTF-8"), (1, "ISO-8859-1")):
        part = rows.filter(F.col("id").cast("bigint") % 2 == remainder)
        export_csv(part, path, "append", charset)
    return read_csv(spark, path, multi_line=True).drop(ARRIVAL)


@query
def csv_line_breaks(spark, folder):
    """Documents of several lines, with quotes and commas, in two charsets, read in splits by default."""
    rows = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.replace("text", F.lit("\r"), F.lit(" ")).alias("text"),
        F.concat(F.lit('5" \n, "'), "source", F.lit('",\n\n')).alias("note"),
    )
    path = shared_folder(spark)
    latin = F.coalesce((F.col("id").cast("bigint") % 2 == 1) & ~F.col("text").rlike(r"[^\x00-\xFF]"), F.lit(False))
    export_csv(rows.filter(~latin), path, "append", "UTF-8")
    export_csv(rows.filter(latin).select("note", "text", "id"), path, "append", "ISO-8859-1")
    return read_csv(spark, path).drop(ARRIVAL)


@query
def csv_mixed_headers(spark, folder):
    """The listings written in two file sets with their columns in opposite orders."""
    rows = adapters.listings(spark, folder).select(F.col("id").cast("string").alias("id"), "title_raw", "genres_raw")
    path = shared_folder(spark)
    for remainder, columns in ((0, rows.columns), (1, rows.columns[::-1])):
        export_csv(rows.filter(F.col("id").cast("bigint") % 2 == remainder).select(*columns), path, "append")
    return read_csv(spark, path).drop(ARRIVAL)


@query
def csv_replacing(spark, folder):
    """The listings written in Latin-1 and read as UTF-8."""
    rows = adapters.listings(spark, folder).select(
        F.concat("title_raw", F.lit(" é, \"ü\"\nß")).alias("title"), F.col("id").cast("string").alias("id")
    )
    path = shared_folder(spark)
    export_csv(rows, path, "append", "ISO-8859-1")
    return read_csv_replacing(spark, path, multi_line=True).drop(ARRIVAL)


@query
def stored_model(spark, folder):
    """A business question on the stored tables, which prune columns and filter in the scan."""
    games, links, genres = adapters.genre_model(spark, folder)
    path = shared_folder(spark)
    model.Catalogue(games, genres, links).save(path)
    stored = model.Catalogue.load(spark, path)
    return business.genre_price(stored.games, stored.game_genres, stored.genres)


@query
def url_dedup(spark, folder):
    rows = adapters.listings(spark, folder).select("id", "data_source", F.col("url_raw").alias("game_url"))
    return dedup.unique_urls(rows, [F.col("id")])


@query
def url_dedup_keep_null(spark, folder):
    rows = adapters.listings(spark, folder).select("id", F.col("url_raw").alias("game_url"))
    return dedup.unique_urls(rows, [F.col("id")], source=None, keep_null=True)


@query
def seen_over_runs(spark, folder):
    """The pages' links in two runs, the first of them stored twice: as one run sees them."""
    pages_ = table(spark, folder, "pages")
    links = pages.page_links(pages_).select(F.col("href").alias("url"), "page_id", "position")
    store = Store(spark, shared_folder(spark), seen.TABLES)
    middle = (pages_.agg(F.max("page_id")).first()[0] or 0) // 2
    for batch, rows in (("first", F.col("page_id") <= middle), ("first", F.col("page_id") <= middle), ("second", F.col("page_id") > middle)):
        seen.record_run(store, batch, links.filter(rows))
    return store.table("sightings").withColumnRenamed("url", "href")


@query
def seen_dedup(spark, folder):
    """First sighting of each link path over all pages, in page and position order."""
    return dedup.first_seen(pages.page_links(table(spark, folder, "pages")), "href").select("href", "page_id", "position")


@query
def capped_records(spark, folder):
    links = dedup.first_seen(pages.page_links(table(spark, folder, "pages")), "href")
    return conform.capped(links.select("page_id", "position", "href"), 700)


@query
def preview(spark, folder):
    return conform.preview(adapters.games(spark, folder), ["id", "game_title", "missing", "rating"], 5, [F.col("id")])


@query
def smart_dedup(spark, folder):
    return _master(spark, folder)


def _entries(spark, folder) -> DataFrame:
    """Listing entries with links, badges and media counts made from the listings."""
    rows = adapters.listings(spark, folder)
    words = ["Gift Card", "V-Points", "expansion pack", "Deluxe Upgrade", "Season Pass", "dlc"]
    extra = F.element_at(F.array(*[F.lit(w) for w in words]), (F.col("id") % 6 + 1).cast("int"))
    return rows.select(
        "id",
        F.coalesce("url_raw", F.lit("N/A")).alias("url"),
        F.when(F.col("id") % 4 == 0, F.concat("title_raw", F.lit(" "), extra)).otherwise(F.col("title_raw")).alias("title"),
        F.when(F.col("id") % 5 == 0, extra).alias("badge"),
        F.split(F.when(F.col("id") % 3 == 0, F.col("genres_raw")), r"[,;|] ?").alias("screenshots"),
        F.split(F.when(F.col("id") % 4 == 0, F.col("genres_raw")), r"[,;|] ?").alias("videos"),
    )


@query
def keyword_filter(spark, folder):
    return pages.game_titles(_entries(spark, folder)).select("id", "title")


@query
def add_on_filter(spark, folder):
    return pages.without_add_on_titles(pages.without_add_on_badges(_entries(spark, folder))).select("id", "title")


@query
def link_filter(spark, folder):
    return pages.product_links(pages.has_url(_entries(spark, folder))).select("id", "url")


@query
def media_file_scan(spark, folder):
    """Files stored per supplier nation, found again by path and length and registered for the games with its number."""
    path = shared_folder(spark)
    listed = table(spark, folder, "supplier").join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    kind = F.when(F.col("n_nationkey") % 3 == 0, "videos").otherwise("images")
    name = F.concat(F.lit("game_"), F.col("n_nationkey") * 7, F.lit("_list.txt"))
    adapters.store_named_files(listed.select(F.concat_ws("/", kind, name).alias("file"), F.col("s_name").alias("value")), path)
    return media.media_files(spark, path, adapters.games(spark, folder)).drop("file_path")


@query
def bucketed_genre_price(spark, folder):
    """A genre question on tables that are stored by game id, so that games and links meet without a shuffle."""
    games, links, genres = adapters.genre_model(spark, folder)
    path = shared_folder(spark)
    prefix = f"model_{path.rsplit('/', 1)[-1]}_"
    model.Catalogue(games, genres, links).save_bucketed(path, prefix, 8)
    stored = model.Catalogue.load_bucketed(spark, prefix)
    return business.genre_price(stored.games, stored.game_genres, stored.genres)


@query
def media_filter(spark, folder):
    return pages.with_media(_entries(spark, folder)).select("id")


@query
def array_distinct_top(spark, folder):
    """Distinct words of each whole document in order of appearance, first ten."""
    docs = table(spark, folder, "documents")
    words = F.split(F.lower("text"), r"[ \n]+")
    return docs.select("doc_id", F.array_join(arrays.distinct_items(words, 10), " ").alias("words"),
                       F.size(arrays.distinct_items(words)).alias("n"))


# --------------------------------------------------------------------------
# Cleaning.
# --------------------------------------------------------------------------

@query
def impute(spark, folder):
    rows = conform.unified(_conformed(spark, folder))
    return clean.imputed(clean.with_critical_fields(rows).drop("review_count"))


@query
def unknown_filter(spark, folder):
    kept = clean.with_known_maker(clean.mostly_known(clean.imputed(_conformed(spark, folder)), 2))
    return kept.select("ingest_ord", "game_title", "developer", "publisher")


@query
def discount_recompute(spark, folder):
    rows = adapters.listings(spark, folder)
    original, now = numbers.price(F.col("original_raw")), numbers.price(F.col("price_raw"))
    return rows.select("id", numbers.recomputed_discount(original, now, numbers.discount(F.col("discount_raw"))).alias("discount"))


@query
def clean_catalog(spark, folder):
    return clean.final_records(_master(spark, folder), as_of())


# --------------------------------------------------------------------------
# Quality reports.
# --------------------------------------------------------------------------

@query
def quality_sources(spark, folder):
    return quality.source_counts(_master(spark, folder))


@query
def quality_ratings(spark, folder):
    return quality.rating_report(_master(spark, folder))


@query
def quality_prices(spark, folder):
    return quality.price_report(_master(spark, folder))


@query
def quality_dates(spark, folder):
    return quality.date_report(_master(spark, folder))


@query
def field_completeness(spark, folder):
    return quality.field_completeness(_master(spark, folder))


@query
def missing_by_column(spark, folder):
    return quality.missing_by_column(clean.repaired(_master(spark, folder)))


@query
def unknown_by_column(spark, folder):
    return quality.placeholders_by_column(clean.final_records(_master(spark, folder), as_of()))


@query
def step_retention(spark, folder):
    flagged = clean.flagged_steps(conform.unified(_conformed(spark, folder)))
    return quality.step_retention(flagged, ["has_critical", "mostly_known", "known_maker"])


# --------------------------------------------------------------------------
# Pages and media.
# --------------------------------------------------------------------------

@query
def page_fields(spark, folder):
    return pages.page_fields(table(spark, folder, "pages"))


@query
def page_links(spark, folder):
    return pages.page_links(table(spark, folder, "pages"))


def _manifest(source: str) -> Query:
    return lambda spark, folder: media.media_manifest(
        adapters.media_records(spark, folder), source, "id", **media.PUBLISHED_COUNTS[source]
    )


QUERIES["media_manifest"] = _manifest(SOURCE_A)
QUERIES["media_manifest_b"] = _manifest(SOURCE_B)
QUERIES["media_manifest_c"] = _manifest(SOURCE_C)


@query
def video_candidates(spark, folder):
    rows = adapters.trailer_attributes(spark, folder)
    none = F.array().cast("array<string>")
    found = urls.video_urls(none, F.col("attribute"), urls.page_video_urls(F.col("html"), 3), F.col("url"), 3)
    direct = urls.direct_video_urls(F.concat(F.lit("https://v/"), F.col("page_id"), F.lit("/hls_264.m3u8")))
    return rows.select("page_id", F.array_join(found, " ").alias("videos"), F.array_join(direct, " ").alias("direct"))


def _records(source: str, *drop: str) -> Query:
    def build(spark, folder):
        found = pages.store_records(
            adapters.listing_pages(spark, folder, source), adapters.detail_pages(spark, folder, source), source,
            PUBLISHED_CUTS[source],
        )
        lists = [n for n, t in found.dtypes if t.startswith("array")]
        return found.withColumns({n: F.array_join(n, " ; ") for n in lists}).drop(*drop)

    return build


QUERIES["store_page_records_a"] = _records(SOURCE_A)
QUERIES["store_page_records_b"] = _records(SOURCE_B, "scrape_timestamp")
QUERIES["store_page_records_c"] = _records(SOURCE_C)


@query
def crawl_statistics(spark, folder):
    found = pages.store_records(
        adapters.listing_pages(spark, folder, SOURCE_A), adapters.detail_pages(spark, folder, SOURCE_A), SOURCE_A
    )
    return quality.crawl_statistics(found)


@query
def crawl_completeness(spark, folder):
    found = pages.store_records(
        adapters.listing_pages(spark, folder, SOURCE_C), adapters.detail_pages(spark, folder, SOURCE_C), SOURCE_C
    )
    landed = pages.as_text_columns(found, SOURCE_C)
    return quality.crawl_completeness(
        landed, ["rating", "rating_count", "genres", "platforms", "developer", "publisher"],
        {"description": 100, "screenshots": 10, "videos": 10},
    )


def queries() -> dict[str, Query]:
    return dict(QUERIES)
