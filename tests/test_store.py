"""Stored tables that change by batches, and audits in one shuffle."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import model, rules
from shelfwise.operators.store import Change

GAMES = "id bigint, data_source string, game_title string, game_url string, rating int"
REVIEWS = "id bigint, game_id bigint, user_name string, rating int, review_text string, helpful_count bigint, review_date date"


def games(spark, *ids):
    return spark.createDataFrame([(i, "A", f"Game {i}", f"u{i}", 50) for i in ids], GAMES)


def reviews(spark, *rows):
    return spark.createDataFrame([(0, g, u, r, "", None, None) for g, u, r in rows], REVIEWS)


@pytest.fixture
def store(spark, tmp_path):
    store = model.open_store(spark, f"file://{tmp_path}/store")
    store.commit("games", lambda entries: Change(add={"games": games(spark, 1, 2, 3)}))
    return store


def test_a_batch_is_stored_once(spark, store):
    batch = reviews(spark, (1, "a", 50), (2, "b", 101), (9, "c", 1), (2, None, 5), (2, "d", None))
    assert model.store_reviews(store, "one", batch) and not model.store_reviews(store, "one", batch)
    assert model.store_reviews(store, "two", reviews(spark, (3, "e", 7)))
    assert not model.store_reviews(store, "one", batch)
    rows = sorted(tuple(r) for r in store.table("user_reviews").select("id", "user_name", "helpful_count").collect())
    assert sorted(r[0] for r in rows) == [1, 2, 3] and sorted(r[1] for r in rows) == ["a", "d", "e"] and {r[2] for r in rows} == {0}
    assert store.table("user_reviews").filter("review_date is null").count() == 0
    assert sorted(r["reason"] for r in store.table("rejected_reviews").collect()) == ["rating out of range", "unknown game", "user name missing"]


def test_a_run_that_breaks_leaves_nothing_to_readers(spark, store):
    def broken(entries):
        bad = reviews(spark, (1, "a", 1)).withColumn("review_text", F.raise_error(F.lit("lost")).cast("string"))
        return Change(add={"user_reviews": reviews(spark, (1, "a", 1)), "rejected_reviews": bad})

    with pytest.raises(Exception, match="lost"):
        store.commit("one", broken)
    assert store.table("user_reviews").count() == 0
    assert model.store_reviews(store, "one", reviews(spark, (1, "a", 1)))
    assert store.table("user_reviews").count() == 1
    assert store.vacuum() >= 1 and store.table("user_reviews").count() == 1 and store.table("games").count() == 3


def test_a_slower_writer_goes_on_behind_the_faster_one(spark, store):
    calls = []

    def build(entries):
        if not calls:
            calls.append(1)
            model.store_reviews(model.open_store(spark, store.root), "faster", reviews(spark, (1, "a", 1), (1, "b", 2)))
        start = store.table("user_reviews", entries).agg(F.max("id")).first()[0] or 0
        return Change(add={"user_reviews": model.numbered(reviews(spark, (2, "c", 3)).drop("id"), start=start)})

    assert store.commit("slower", build)
    assert sorted((r["id"], r["user_name"]) for r in store.table("user_reviews").collect())[-1] == (3, "c")
    assert [e["batch"] for e in store.entries()] == ["games", "faster", "slower"]
    calls.clear()
    assert len(list(Path(store.root.removeprefix("file://"), "user_reviews").iterdir())) == 2


def test_second_load_keeps_ids(spark, tmp_path):
    names = "data_source string, game_title string, game_url string, genres string, rating double"
    first = spark.createDataFrame([("A", "One", "u1", "x, y", 5.0), ("A", "Two", None, "y", 6.0)], names)
    second = spark.createDataFrame(
        [("A", "One", "u1", "x, z", 5.0), ("B", "One", "u1", "z", 5.0), ("A", "Other", None, "w", 1.0), ("B", "New", None, "x", 1.0)], names
    )
    fill = {c: F.lit(None).cast("string") for c in model.MODEL["games"] if c not in ("id", "created_at", *first.columns)}
    store = model.open_store(spark, f"file://{tmp_path}/store")
    assert model.store_records(store, "1", first.withColumns(fill))
    before = {r["id"]: r["game_title"] for r in store.table("games").collect()}
    assert model.store_records(store, "2", second.withColumns(fill)) and not model.store_records(store, "2", second.withColumns(fill))
    built = model.stored_catalogue(store)
    after = {r["id"]: (r["data_source"], r["game_title"]) for r in built.games.collect()}
    assert set(before) == {1, 2} and set(after) == {1, 2, 3, 4} and sorted(after.values())[-2:] == [("B", "New"), ("B", "One")]
    genres = {r["id"]: r["genre_name"] for r in built.genres.collect()}
    assert sorted(genres.values()) == ["w", "x", "y", "z"] and sorted(genres) == [1, 2, 3, 4]
    links = sorted((after[r["game_id"]], genres[r["genre_id"]]) for r in built.game_genres.collect())
    assert links == [
        (("A", "One"), "x"), (("A", "One"), "y"), (("A", "One"), "z"), (("A", "Two"), "w"), (("A", "Two"), "y"), (("B", "New"), "x"), (("B", "One"), "z"),
    ]
    assert {r["violations"] for r in rules.audit({"games": built.games, "genres": built.genres, "game_genres": built.game_genres}).collect()} == {0}


def test_cascade_writes_only_files_with_affected_keys(spark, store):
    for batch in (1, 2, 3):
        model.store_reviews(store, f"r{batch}", reviews(spark, (batch, "a", 1), (batch, "b", 2), *([(3, "c", 1)] if batch == 2 else [])))
    before = set(store.files("user_reviews"))
    gone = spark.createDataFrame([(1,), (None,), (77,)], "id bigint")
    assert model.delete_games(store, "gone", gone) and not model.delete_games(store, "gone", gone)
    after = set(store.files("user_reviews"))
    untouched = {f for f in before if spark.read.parquet(f).filter("game_id = 1").count() == 0}
    assert untouched and untouched < before and untouched <= after
    assert sorted(r["game_id"] for r in store.table("user_reviews").collect()) == [2, 2, 3, 3, 3]
    assert sorted(r["id"] for r in store.table("games").collect()) == [2, 3]
    tables = {n: store.table(n) for n in ("games", "genres", "game_genres", "media_files", "user_reviews")}
    assert {r["violations"] for r in rules.audit(tables).collect()} == {0}
    assert model.delete_games(store, "none", gone.limit(0))
    store.vacuum()
    assert sorted(r["game_id"] for r in store.table("user_reviews").collect()) == [2, 2, 3, 3, 3]


def test_audit_counts_what_the_single_audits_find(spark):
    tables = {
        "games": spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "c"), (None, "d")], "id bigint, game_title string"),
        "genres": spark.createDataFrame([(1, "x"), (2, "x"), (3, None)], "id bigint, genre_name string"),
        "game_genres": spark.createDataFrame([(1, 1, 1), (2, 1, 1), (3, 9, 9), (3, None, 1), (4, 11, 1), (5, 1, 11)], "id bigint, game_id bigint, genre_id bigint"),
        "user_reviews": spark.createDataFrame([(1, 1, "u", 50), (2, 8, None, 101), (3, None, "u", None), (4, 8, "u", -1)], "id bigint, game_id bigint, user_name string, rating int"),
    }
    found = {r["rule"]: r["violations"] for r in rules.audit(tables).collect()}
    assert set(found) == set(rules.rule_names({n: rules.MODEL_RULES[n] for n in tables}))
    for name, table in tables.items():
        own = rules.MODEL_RULES[name]
        for column in own.required:
            assert found[f"{name}.{column} not null"] == model.audit_not_null(table, [column], "id").count()
        for columns in own.unique:
            known = table.dropna(subset=list(columns))
            assert found[rules.unique_name(name, columns)] == model.audit_unique(known, list(columns)).count()
        for column, parent, key in own.references:
            assert found[f"{name}.{column} references {parent}"] == model.audit_foreign_key(table, column, tables[parent], key).count()
    assert found["user_reviews.rating in range"] == 2 and found["game_genres pair unique"] == 1


def test_audit_scans_each_table_once(spark, store):
    model.store_reviews(store, "r", reviews(spark, (1, "a", 1)))
    tables = {n: store.table(n) for n in ("games", "user_reviews")}
    plan = rules.audit(tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") <= 2 + plan.count("ReusedExchange") and plan.count("FileScan parquet") == 2


def test_runs_see_links_as_one_run_does(spark, tmp_path):
    from shelfwise.operators import dedup, seen
    from shelfwise.operators.store import Store

    rows = [(f"u{(i * i) % 37}" if i % 11 else None, i // 4, i % 4) for i in range(120)]
    sightings = spark.createDataFrame(rows, "url string, page_id bigint, position int")
    store = Store(spark, f"file://{tmp_path}/seen", seen.TABLES)
    for run in range(3):
        assert seen.record_run(store, str(run), sightings.filter(F.col("page_id").between(run * 10, run * 10 + 9)))
        assert not seen.record_run(store, str(run), sightings)
    found = sorted(tuple(r) for r in store.table("sightings").filter("url is not null").collect())
    assert found == sorted(tuple(r) for r in dedup.first_seen(sightings).filter("url is not null").collect())
    assert seen.unseen(store, sightings).filter("url is not null").count() == 0
    assert seen.unseen(store, spark.createDataFrame([("new",)], "url string")).count() == 1


def test_a_driver_folder_is_refused_on_a_cluster():
    from types import SimpleNamespace

    from shelfwise.session import ensure_checkpoint_dir

    def session(master, warehouse, folder=None):
        used = []
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=used.append)
        settings = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": warehouse}
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: settings.get(k) or d)), used

    with pytest.raises(ValueError, match="shared folder"):
        ensure_checkpoint_dir(session("yarn", "file:/home/driver/warehouse")[0])
    for master, warehouse, folder, expected in (
        ("local[4]", "file:/w", None, "file:/w/_shelfwise"), ("yarn", "hdfs://n/w", None, "hdfs://n/w/_shelfwise"), ("yarn", "file:/w", "file:/mnt/shared", "file:/mnt/shared"),
    ):
        spark, used = session(master, warehouse, folder)
        ensure_checkpoint_dir(spark)
        assert used == [expected]
