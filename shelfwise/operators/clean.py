"""Master records -> final records: repair, impute, filter, derive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import dates, numbers, text

UNKNOWN = "Unknown"
# Fields a record must have, and how many unknown texts it may have.
CRITICAL_FIELDS = ("developers", "publishers", "rating", "release_date")
MAX_UNKNOWN = 3
NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def text_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


def numeric_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind in NUMERIC_TYPES or kind.startswith("decimal")]


def repaired(df: DataFrame, repair_first: bool = False) -> DataFrame:
    """Encoding repair on every text column, and the review count as a number."""
    values = {c: text.fix_encoding(F.col(c), repair_first) for c in text_columns(df) if c != "review_count"}
    if "review_count" in df.columns:
        values["review_count"] = numbers.review_count(F.col("review_count"))
    return df.withColumns(values)


def with_critical_fields(df: DataFrame) -> DataFrame:
    """Records that have every critical field the table has (rating and release date)."""
    return df.na.drop(subset=[c for c in CRITICAL_FIELDS if c in df.columns])


def imputed(df: DataFrame) -> DataFrame:
    """Missing numbers become 0 and missing texts ``Unknown``."""
    return df.na.fill(0, numeric_columns(df)).na.fill(UNKNOWN, text_columns(df))


def unknown_count(columns: list[str]) -> Column:
    """Number of ``Unknown`` texts in a row."""
    return sum(((F.col(c) == UNKNOWN).cast("int") for c in columns), F.lit(0))


def mostly_known(df: DataFrame, limit: int = MAX_UNKNOWN) -> DataFrame:
    return df.filter(unknown_count(text_columns(df)) <= limit)


def both_unknown() -> Column:
    return (F.col("developer") == UNKNOWN) & (F.col("publisher") == UNKNOWN)


def with_known_maker(df: DataFrame) -> DataFrame:
    """Records whose developer or publisher is known."""
    return df.filter(~both_unknown())


def derived(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Discount recomputed from the prices, release status from the date."""
    return df.withColumns(
        {
            "discount_percentage": numbers.recomputed_discount(
                F.col("original_price"), F.col("discounted_price"), F.col("discount_percentage")
            ),
            "release_status": dates.release_status(F.col("release_date"), as_of),
        }
    )


def final_records(master: DataFrame, as_of: Column | None = None) -> DataFrame:
    """All steps in order: the unknown count looks at the status before it is derived."""
    kept = with_known_maker(mostly_known(imputed(with_critical_fields(repaired(master)))))
    return derived(kept, as_of)


def flagged_steps(master: DataFrame) -> DataFrame:
    """The repaired input with one flag per filter step, for retention reports."""
    ready = repaired(master)
    critical = [c for c in CRITICAL_FIELDS if c in ready.columns]
    has_critical = F.lit(True)
    for c in critical:
        has_critical = has_critical & F.col(c).isNotNull()
    filled = imputed(ready.withColumn("_critical", has_critical))
    few = unknown_count([c for c in text_columns(filled)]) <= MAX_UNKNOWN
    return filled.select(
        F.col("_critical").alias("has_critical"),
        few.alias("mostly_known"),
        (~both_unknown()).alias("known_maker"),
    )
