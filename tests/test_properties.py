"""Invariants: idempotence, best record per title, retention sums, partition independence."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from shelfwise.functions import text
from shelfwise.operators import clean, conform, dedup, quality
from shelfwise.sources import adapters


@pytest.mark.parametrize("function", [text.clean_text, text.fix_encoding, text.title_key, text.squeeze])
def test_text_functions_are_idempotent(spark, function):
    pick = random.Random(7)
    alphabet = ["a", "B", " ", "\n", "\t", "&amp;", "&nbsp;", "Â", "é", "ﬁ", "!", "_", "​", " ", "®", "9"]
    samples = ["".join(pick.choices(alphabet, k=pick.randint(0, 12))) for _ in range(400)]
    frame = spark.createDataFrame([(s,) for s in samples], "s string")
    once = frame.select(F.col("s"), function(F.col("s")).alias("a"))
    twice = once.select("s", "a", function(F.col("a")).alias("b"))
    # A title key keeps inner blanks that trimming would remove the second time.
    expected = F.col("a") if function is not text.title_key else text.strip(F.col("a"))
    assert twice.filter(~F.col("b").eqNullSafe(expected)).count() == 0


def test_best_record_has_the_highest_score_of_its_title(spark, medium):
    records = conform.conform_all(adapters.landing_sources(spark, medium), "ingest_ord")
    scored = records.select(text.title_key(F.col("game_title")).alias("k"), dedup.completeness().alias("s"))
    best = dedup.best_per_title(records, [F.col("ingest_ord")])
    kept = best.select(text.title_key(F.col("game_title")).alias("k"), dedup.completeness().alias("s"))
    assert kept.count() == kept.select("k").distinct().count() == scored.select("k").distinct().count()
    highest = scored.groupBy("k").agg(F.max("s").alias("s"))
    assert kept.exceptAll(highest).count() == 0


def test_retention_adds_up(spark, medium):
    records = conform.unified(conform.conform_all(adapters.landing_sources(spark, medium), "ingest_ord"))
    steps = quality.step_retention(clean.flagged_steps(records), ["has_critical", "mostly_known", "known_maker"]).collect()
    assert all(r["rows_before"] == r["rows_after"] + r["dropped"] for r in steps)
    assert steps[0]["rows_before"] == records.count()
    assert steps[-1]["rows_after"] == clean.final_records(records, F.current_date()).count()


def test_steps_in_order(spark):
    rows = [
        ("a", 50.0, None, "d", None),
        ("b", None, None, "d", None),
        ("c", 50.0, "g", None, None),
        ("d", 50.0, None, None, "x"),
    ]
    frame = spark.createDataFrame(rows, "game_title string, rating double, genres string, developer string, publisher string")
    kept = clean.with_known_maker(clean.mostly_known(clean.imputed(clean.with_critical_fields(frame))))
    found = {r["game_title"]: (r["genres"], r["developer"]) for r in kept.collect()}
    assert found == {"a": ("Unknown", "d"), "d": ("Unknown", "Unknown")}


def test_null_links(spark):
    frame = spark.createDataFrame([(1, None), (2, None), (3, "u"), (4, "u")], "id int, game_url string").withColumn("data_source", F.lit("s"))
    assert sorted(r["id"] for r in dedup.unique_urls(frame, [F.col("id")]).collect()) == [1, 3]
    assert sorted(r["id"] for r in dedup.unique_urls(frame, [F.col("id")], keep_null=True).collect()) == [1, 2, 3]


def test_united_sources_equal_separate_ones(spark, small):
    sources = adapters.landing_sources(spark, small)
    together = conform.conform_all(sources, "ingest_ord")
    apart = conform.union_sources([conform.conform_source(df, s, "ingest_ord") for s, df in sources.items()])
    assert together.exceptAll(apart).count() == 0 and apart.exceptAll(together).count() == 0


@pytest.mark.parametrize("name", ["smart_dedup", "url_dedup", "seen_dedup", "bq4_consistent_publishers", "bq9_cross_platform", "bq2_top_performers"])
def test_results_do_not_depend_on_partitions(spark, small, name):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    found = []
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for partitions in ("1", "4", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            found.append(sorted(str(r) for r in entry_point.queries()[name](spark, small).collect()))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert found[0] == found[1] == found[2]
