"""From landing files to stored tables, and groups that hold a third of all rows."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import clean, conform, dedup, model
from shelfwise.plans import business, lookups, research
from shelfwise.sources import adapters
from shelfwise.sources.csv import ARRIVAL, export_csv, read_csv

DAY = datetime.date(1998, 6, 30)


@pytest.fixture(scope="module")
def landing(spark, small, tmp_path_factory):
    """The three landing tables as CSV files in arrival order, the second one in Latin-1."""
    folder = tmp_path_factory.mktemp("landing")
    paths = {}
    for (source, frame), charset in zip(adapters.landing_sources(spark, small).items(), ("UTF-8", "ISO-8859-1", "UTF-8")):
        paths[source] = str(folder / source)
        prices = [c for c in frame.columns if "price" in c]
        ascii_prices = frame.withColumns({c: F.replace(c, F.lit("€"), F.lit("$")) for c in prices})
        export_csv(ascii_prices.orderBy("ingest_ord").drop("ingest_ord").coalesce(1), paths[source], encoding=charset)
    return paths


def test_csv_to_stored_model(spark, small, landing, tmp_path):
    sources = {source: read_csv(spark, path) for source, path in landing.items()}
    master = conform.master_records(sources, ARRIVAL)
    direct = conform.master_records(adapters.landing_sources(spark, small), "ingest_ord")
    assert master.exceptAll(direct).count() == 0 and direct.exceptAll(master).count() == 0

    folder = str(tmp_path / "model")
    model.create_tables(spark, folder)
    model.create_tables(spark, folder)
    final = clean.final_records(master, F.lit(DAY))
    assert model.load_if_empty(final, folder) is True
    assert model.load_if_empty(final, folder) is False
    stored = model.Catalogue.load(spark, folder)
    assert stored.games.count() == final.count()
    assert {r["violations"] for r in model.audit_catalogue(stored.games, stored.genres, stored.game_genres).collect()} == {0}
    assert business.genre_reviews(stored.games, stored.game_genres, stored.genres, min_games=1).count() > 0


HOT = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    """9000 records: a third share a title and a link, the rest are pairs of equal titles."""
    n = F.col("id")
    hot = n < HOT
    rows = spark.range(0, 3 * HOT, 1, 12).select(
        n.alias("ord"),
        F.lit("Steam").alias("data_source"),
        F.when(hot, F.lit("Hot Title!")).otherwise(F.concat(F.lit("t "), (n / 2).cast("bigint"))).alias("game_title"),
        F.when(hot, F.lit("/hot")).otherwise(F.concat(F.lit("/u"), n)).alias("game_url"),
        F.when(n % 7 != 0, (n % 100).cast("double")).alias("rating"),
        F.when(n % 5 != 0, F.lit("d")).alias("developer"),
    )
    return conform.unified(rows, "ord")


def test_hot_title_and_link(spark, skewed):
    records = [r.asDict() for r in skewed.collect()]

    def score(r):
        filled = sum(r[c] is not None for c in ("rating", "release_date", "developer", "publisher", "genres", "description"))
        return filled + 2 * (r["rating"] is not None)

    best, first = {}, {}
    for r in sorted(records, key=lambda r: (-score(r), r["game_url"], r["ord"])):
        best.setdefault(r["game_title"].lower().replace("!", ""), r["ord"])
    for r in sorted(records, key=lambda r: r["ord"]):
        first.setdefault(r["game_url"], r["ord"])
    kept = dedup.best_per_title(skewed, [F.col("ord")])
    assert sorted(r["ord"] for r in kept.collect()) == sorted(best.values())
    assert sorted(r["ord"] for r in dedup.unique_urls(skewed, [F.col("ord")]).collect()) == sorted(first.values())


def test_hot_genre_and_developer(spark):
    n = F.col("id")
    games = spark.range(0, 6000, 1, 12).select(
        n.alias("id"),
        (n % 101).cast("int").alias("rating"),
        n.alias("review_count"),
        (n % 50 + 1).cast("decimal(12,2)").alias("original_price"),
        F.when(n % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("d"), n % 40)).alias("developer"),
    )
    pairs = games.select(F.col("id").alias("game_id"), F.explode(F.array(F.lit("hot"), F.concat(F.lit("g"), n % 30))).alias("genre_name"))
    genres = model.genre_table(pairs)
    stats = {r["genre_name"]: r for r in business.genre_reviews(games, model.bridge_table(pairs, genres), genres, n=40).collect()}
    assert stats["hot"]["total_reviews"] == sum(range(6000)) and stats["hot"]["game_count"] == 6000
    assert stats["hot"]["position"] == 1 and len(stats) == 31
    found = {r["developer"]: r for r in business.developer_efficiency(games, n=50).collect()}
    hot = [i for i in range(0, 6000, 3)]
    assert found["hot"]["total_games"] == len(hot) and found["hot"]["total_reviews"] == sum(hot)


def test_hot_review_target(spark):
    n = F.col("id")
    reviews = spark.range(0, 6000, 1, 12).select(
        n.alias("id"), F.when(n % 3 == 0, F.lit(7)).otherwise(n).cast("bigint").alias("game_id"), F.lit("u").alias("user_name"),
        (n % 110).cast("int").alias("rating"), F.lit("").alias("review_text"), (n % 9).alias("helpful_count"),
        F.lit(DAY).alias("review_date"),
    )
    games = spark.range(3000).select("id")
    accepted, rejected = model.accepted_reviews(reviews, games), model.rejected_reviews(reviews, games)
    expected = [i for i in range(6000) if i % 110 <= 100 and (i % 3 == 0 or i < 3000)]
    assert sorted(r["id"] for r in accepted.select("id").collect()) == expected
    assert rejected.count() == 6000 - len(expected)
    ranked = [(r["game_id"], -r["helpful_count"]) for r in lookups.game_reviews(reviews).collect()]
    assert ranked == sorted(ranked) and len(ranked) == 6000


def test_rating_gap_by_brute_force(spark, medium):
    records = conform.conform_all(adapters.landing_sources(spark, medium), "ingest_ord")
    titles: dict[str, dict[str, list[float]]] = {}
    for r in records.filter("rating is not null").collect():
        key = "".join(ch for ch in r["game_title"].lower() if ch.isalnum() or ch in "_ ")
        titles.setdefault(key, {}).setdefault(r["data_source"], []).append(r["rating"])
    gaps = {}
    for key, sources in titles.items():
        means = [sum(v) / len(v) for v in sources.values()]
        if len(means) > 1:
            gaps[key] = max(means) - min(means)
    best = sorted(gaps.values(), reverse=True)[:10]
    found = [r["gap"] for r in research.rating_gap(records).collect()]
    assert found == pytest.approx(best, abs=0.011)
