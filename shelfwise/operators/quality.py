"""Quality reports, one pass over the data each, in long format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.numbers import cents, rounded_ratio, share
from shelfwise.operators.clean import UNKNOWN, numeric_columns, text_columns

REPORT_FIELDS = (
    "game_title", "rating", "release_date", "genres", "platform", "developer", "publisher", "description", "game_url",
)
# Completeness from which a field counts as good or fair, and the marks.
GOOD, FAIR = 80, 50
MARKS = ("✓", "⚠", "✗")


def _tall(counted: DataFrame, labels: dict[str, str], value: str, *keep: str) -> DataFrame:
    """Columns of a one-row result as (field, value) rows."""
    pairs = F.array(
        *[F.struct(F.lit(label).alias("field"), F.col(c).alias(value)) for c, label in labels.items()]
    )
    return counted.select(*keep, F.inline(pairs))


def _counts(df: DataFrame, conditions: dict[str, Column], value: str, *totals: Column) -> DataFrame:
    """All conditions counted in one scan, one row per condition."""
    columns = {f"c{i}": field for i, field in enumerate(conditions)}
    aggregates = [F.count_if(conditions[field]).alias(c) for c, field in columns.items()]
    totals = (F.count("*").alias("total"), *totals)
    return _tall(df.agg(*aggregates, *totals), columns, value, "total")


def source_counts(df: DataFrame) -> DataFrame:
    """Rows and percentage per source. The window runs over the few aggregated rows."""
    counted = df.groupBy("data_source").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counted.select("data_source", "n", share(F.col("n"), total).alias("pct"))


def rating_report(df: DataFrame) -> DataFrame:
    """Coverage, mean, minimum and maximum of the rating (one decimal)."""
    tenths = F.round(F.col("rating") * 10).cast("bigint")
    rated = F.count("rating")
    return df.agg(
        F.count("*").alias("total"),
        rated.alias("rated"),
        (F.count("*") - rated).alias("unrated"),
        share(rated, F.count("*")).alias("rated_pct"),
        share(F.count("*") - rated, F.count("*")).alias("unrated_pct"),
        rounded_ratio(F.sum(tenths), rated * 10, 1).alias("avg_rating"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
    )


def price_report(df: DataFrame) -> DataFrame:
    """Priced, free and paid records and the mean paid price."""
    price = F.col("discounted_price")
    paid_cents = F.when(price > 0, cents(price))
    return df.agg(
        F.count("*").alias("total"),
        F.count(price).alias("priced"),
        share(F.count(price), F.count("*")).alias("priced_pct"),
        F.count_if(price == 0).alias("free"),
        F.count_if(price > 0).alias("paid"),
        (rounded_ratio(F.sum(paid_cents), F.count(paid_cents), 0) / 100).alias("avg_paid_price"),
    )


def date_report(df: DataFrame) -> DataFrame:
    dated = F.count("release_date")
    return df.agg(
        F.count("*").alias("total"),
        dated.alias("dated"),
        (F.count("*") - dated).alias("undated"),
        share(dated, F.count("*")).alias("dated_pct"),
        share(F.count("*") - dated, F.count("*")).alias("undated_pct"),
    )


def field_completeness(df: DataFrame, fields=REPORT_FIELDS) -> DataFrame:
    """Filled count, percentage and mark per field."""
    counted = _counts(df, {f: F.col(f).isNotNull() for f in fields if f in df.columns}, "filled")
    exact = F.col("filled") * 100
    mark = (
        F.when(exact >= GOOD * F.col("total"), F.lit(MARKS[0]))
        .when(exact >= FAIR * F.col("total"), F.lit(MARKS[1]))
        .otherwise(F.lit(MARKS[2]))
    )
    return counted.select(
        "field", "filled", "total", share(F.col("filled"), F.col("total")).alias("pct"), mark.alias("status")
    )


def missing_by_column(df: DataFrame) -> DataFrame:
    """Columns with missing values and how many."""
    counted = _counts(df, {c: F.col(c).isNull() for c in df.columns}, "missing")
    return counted.select("field", "missing").filter("missing > 0")


def placeholders_by_column(df: DataFrame) -> DataFrame:
    """Remaining ``Unknown`` texts and zero numbers per column."""
    conditions = {f"{c}": F.col(c) == UNKNOWN for c in text_columns(df)}
    conditions |= {f"{c}": F.col(c) == 0 for c in numeric_columns(df)}
    counted = _counts(df, conditions, "n")
    kind = F.when(F.col("field").isin(*text_columns(df)), F.lit("unknown")).otherwise(F.lit("zero"))
    return counted.select("field", kind.alias("kind"), "n").filter("n > 0")


def step_retention(flagged: DataFrame, steps: list[str]) -> DataFrame:
    """Before, after, dropped and retained percentage per filter step, from flag columns.

    The flags are counted cumulatively in one aggregate, so no step is run on its own.
    """
    passed = [F.lit(True)]
    for step in steps:
        passed.append(passed[-1] & F.col(step))
    counted = flagged.agg(*[F.count_if(condition).alias(f"n{i}") for i, condition in enumerate(passed)])
    rows = [
        F.struct(
            F.lit(i + 1).alias("step_no"),
            F.lit(step).alias("step"),
            F.col(f"n{i}").alias("rows_before"),
            F.col(f"n{i + 1}").alias("rows_after"),
            (F.col(f"n{i}") - F.col(f"n{i + 1}")).alias("dropped"),
            share(F.col(f"n{i + 1}"), F.col("n0")).alias("retained_pct"),
        )
        for i, step in enumerate(steps)
    ]
    return counted.select(F.inline(F.array(*rows)))


def crawl_statistics(df: DataFrame) -> DataFrame:
    """Counts of player modes, free and reduced entries, media, and rating figures (source A)."""
    score = F.col("rating_score")
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("singleplayer") == "Yes").alias("single_player"),
        F.count_if(F.col("multiplayer") == "Yes").alias("multi_player"),
        F.count_if(F.col("price") == "Free").alias("free"),
        F.count_if(F.col("discount_percentage") != "N/A").alias("on_sale"),
        F.count_if(F.size("screenshots") > 0).alias("with_screenshots"),
        F.count_if(F.size("videos") > 0).alias("with_videos"),
        F.count(score).alias("rated"),
        rounded_ratio(F.sum(score), F.count(score), 1).alias("avg_score"),
        F.max(score).alias("max_score"),
        F.min(score).alias("min_score"),
    )


def crawl_completeness(df: DataFrame, fields: list[str], long_fields: dict[str, int] | None = None) -> DataFrame:
    """Entries per field that are not ``N/A``, or longer than a given length, with percentage."""
    conditions = {f: F.col(f) != "N/A" for f in fields}
    for field, minimum in (long_fields or {}).items():
        conditions[field] = (F.col(field) != "N/A") & (F.length(field) > minimum)
    counted = _counts(df, conditions, "filled")
    return counted.select("field", "filled", "total", share(F.col("filled"), F.col("total")).alias("pct"))
