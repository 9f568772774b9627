"""Numbering, the relational model, audits and review intake."""

from __future__ import annotations

import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from shelfwise.operators import clean, conform, model
from shelfwise.operators.numbering import numbered
from shelfwise.plans import business, lookups
from shelfwise.sources import adapters

DAY = datetime.date(1998, 6, 30)


@pytest.fixture(scope="module")
def final(spark, small):
    return clean.final_records(conform.master_records(adapters.landing_sources(spark, small), "ingest_ord"), DAY)


@pytest.fixture(scope="module")
def catalogue(final):
    return model.build_catalogue(final)


@pytest.mark.parametrize("partitions", ["1", "5", "16"])
def test_numbers_are_dense_and_ordered(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        frame = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
        found = [(r["id"], r["k"]) for r in numbered(frame, "k").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(found) == [(i + 1, i) for i in range(1000)]


def test_numbers_with_one_hot_value(spark):
    frame = spark.range(900).select(F.when(F.col("id") < 600, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    found = sorted((r["id"], r["k"]) for r in numbered(frame, "k").collect())
    assert [i for i, _ in found] == list(range(1, 901))
    assert [k for _, k in found] == sorted(k for _, k in found)


def test_numbering_an_empty_table(spark):
    assert numbered(spark.range(0), "id", name="n").count() == 0


def test_unordered_numbers_are_dense(spark):
    frame = spark.range(0, 1000, 1, 7).filter("id < 100 OR id >= 900").withColumn("k", F.col("id") % 3)
    found = numbered(frame.drop("id"), name="n")
    assert sorted(r["n"] for r in found.collect()) == list(range(1, 201))
    assert "Exchange hashpartitioning(k" not in found._jdf.queryExecution().executedPlan().toString()


def test_model_passes_its_audits(catalogue):
    report = model.audit_catalogue(catalogue.games, catalogue.genres, catalogue.game_genres)
    assert {r["violations"] for r in report.collect()} == {0}
    reviews = catalogue.games.select(F.col("id").alias("game_id"))
    assert model.audit_foreign_key(reviews, "game_id", catalogue.games, "id").count() == 0


def test_bridge_links_by_name(spark):
    pairs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "game_id bigint, genre_name string")
    links = model.bridge_table(pairs, model.genre_table(pairs))
    assert sorted(tuple(r) for r in links.collect()) == [(1, 1), (1, 2), (2, 1)]


def test_links_have_keys(catalogue):
    ids = [r["id"] for r in catalogue.game_genres.select("id").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_media_ids_continue_and_are_stamped(spark, tmp_path):
    games = spark.createDataFrame([(1,)], "id bigint")
    files = spark.createDataFrame([("/m/images/game_1_a.jpg", 5), ("/m/videos/game_1_b.mp4", 6), ("/m/images/game_9_c.jpg", 7)], "path string, length bigint")
    for _ in range(2):
        model.append_media(files, games, str(tmp_path / "media"))
    rows = spark.read.parquet(str(tmp_path / "media")).collect()
    assert sorted(r["id"] for r in rows) == [1, 2, 3, 4] and all(r["uploaded_at"] for r in rows)


def test_staging_leaves_nothing(spark, final, tmp_path):
    from pathlib import Path

    from shelfwise.session import shared_folder

    folder = str(tmp_path / "model")
    model.create_tables(spark, folder)
    scratch = Path(shared_folder(spark).removeprefix("file:")).parent
    before = set(scratch.iterdir()) if scratch.exists() else set()
    model.load_if_empty(final, folder)
    assert set(scratch.iterdir()) == before


def test_tables_are_written_once(spark, catalogue, tmp_path):
    folder = str(tmp_path / "model")
    catalogue.save(folder)
    with pytest.raises(AnalysisException):
        catalogue.save(folder)
    catalogue.save(folder, mode="ignore")
    stored = model.Catalogue.load(spark, folder)
    assert stored.games.count() == catalogue.games.count()
    plan = business.top_performers(stored.games)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(rating,85)" in plan and "description" not in plan


def test_zero_reads_as_missing_unless_switched_off(spark, final):
    free = final.withColumns({"discounted_price": F.lit(0.0), "review_count": F.lit(0.0)}).limit(1)
    assert model.game_rows(free).first()["discounted_price"] is None
    kept = model.game_rows(free, zero_is_null=False).first()
    assert kept["discounted_price"] == 0 and kept["review_count"] == 0


def test_unknown_publishers_can_be_left_out(spark):
    rows = [(i, "Unknown", "P", 90 + i % 3) for i in range(6)] + [(10 + i, "Acme", "P", 80) for i in range(6)]
    games = spark.createDataFrame(rows, "id bigint, publisher string, platform string, rating int")
    assert [r["publisher"] for r in business.consistent_publishers(games).collect()] == ["Unknown", "Acme"]
    assert [r["publisher"] for r in business.consistent_publishers(games, exclude_unknown=True).collect()] == ["Acme"]


def test_reviews_are_split_without_loss(spark, small):
    batch, games = adapters.user_reviews(spark, small), adapters.games(spark, small)
    accepted, rejected = model.accepted_reviews(batch, games), model.rejected_reviews(batch, games)
    assert accepted.count() + rejected.count() == batch.count()
    assert accepted.select("id").intersect(rejected.select("id")).count() == 0


def test_review_append(spark, tmp_path):
    games = spark.createDataFrame([(1,)], "id bigint")
    schema = "id bigint, game_id bigint, user_name string, rating int, review_text string, helpful_count bigint, review_date date"
    batch = spark.createDataFrame([(1, 1, "a", 50, "", None, None), (2, 1, "b", 101, "", 1, None), (3, 2, "c", None, "", 1, None)], schema)
    paths = str(tmp_path / "reviews"), str(tmp_path / "quarantine")
    model.append_reviews(batch, games, *paths)
    model.append_reviews(batch, games, *paths)
    assert spark.read.parquet(paths[0]).select("helpful_count").collect() == [(0,), (0,)]
    assert spark.read.parquet(paths[1]).count() == 4
    stored = spark.read.parquet(paths[0])
    assert sorted(r["id"] for r in stored.collect()) == [1, 2] and stored.filter("review_date is null").count() == 0


def test_all_questions_build(spark, small):
    games, links, genres = adapters.genre_model(spark, small)
    assert len(business.all_questions(games, links, genres)) == 10


def test_exact_title_wins_over_lower_id(spark):
    games = spark.createDataFrame([(1, "Big Ring"), (2, "ring"), (3, "50% off")], "id bigint, game_title string")
    assert lookups.find_by_title(games, "ring").first()["id"] == 2
    assert lookups.find_by_title(games, "RING").first()["id"] == 1
    assert lookups.find_by_title(games, "0%").first()["id"] == 3
    assert lookups.find_by_title(games, "_ing").count() == 0


def test_empty_tables_have_declared_columns(spark):
    assert model.empty_table(spark, "user_reviews").columns[:3] == ["id", "game_id", "user_name"]


def test_title_parts_for_a_table_of_titles(spark):
    games = spark.createDataFrame([(4, "Big Ring"), (2, "ring"), (3, "50% off"), (5, "big ring"), (6, "Ünder"), (7, "x"), (8, None)], "id bigint, game_title string")
    texts = ["ring", "RING", "0%", "_ing", "g r", "i", "ün", "", "big RING", None, "nowhere", "50% off more"]
    wanted = spark.createDataFrame([(t,) for t in texts], "wanted string")
    found = {r["wanted"]: (r["id"], r["game_title"]) for r in lookups.find_by_title_parts(games, wanted).collect()}
    for text in texts:
        first = lookups.find_by_title(games, text).first() if text is not None else None
        assert found.get(text) == (tuple(first) if first else None), text
