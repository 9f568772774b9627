"""Source records -> unified records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import dates, numbers, text
from shelfwise.operators.dedup import best_per_title, unique_urls
from shelfwise.schemas import COLUMN_MAPPINGS, UNIFIED

TEXT_FIELDS = ("description", "developer", "publisher")


def to_standard_names(df: DataFrame, source: str) -> DataFrame:
    """Rename the source's columns, keep unknown ones, tag the source."""
    return df.withColumnsRenamed(COLUMN_MAPPINGS[source]).withColumn("data_source", F.lit(source))


def standardised(df: DataFrame, price_locale: str = "eu") -> DataFrame:
    """Typed and cleaned values of renamed records; columns that are absent stay absent.

    Two projections: values that later ones read more than once come first, so each raw
    text is parsed once per row.
    """
    present = set(df.columns)
    first: dict[str, Column] = {c: text.clean_text(F.col(c)) for c in (*TEXT_FIELDS, "genres") if c in present}
    for raw, name in (("original_price_raw", "original_price"), ("current_price_raw", "_current_price")):
        if raw in present:
            first[name] = numbers.price(F.col(raw), price_locale)
    if "discount_percentage" in present:
        first["discount_percentage"] = numbers.discount(F.col("discount_percentage"))
    if "release_date" in present:
        first["release_date"] = text.squeeze(F.col("release_date"))

    second: dict[str, Column] = {}
    if "genres" in present:
        second["genres"] = text.genre_list(F.col("genres"))
    if "rating_raw" in present:
        second["rating"] = numbers.rating(F.col("rating_raw"), F.col("data_source"))
    if "release_date" in present:
        second["release_date"] = dates.release_date(F.col("release_date"), squeezed=True)
    for column in ("platforms", "platform"):
        if column in present:
            second["platform"] = text.clean_platform(F.col(column))
            break
    available = present | set(first)
    absent = F.lit(None).cast("double")
    original = F.col("original_price") if "original_price" in available else absent
    percent = F.col("discount_percentage") if "discount_percentage" in available else absent
    known = [F.col(c).try_cast("double") for c in ("discounted_price", "_current_price", "price") if c in available]
    second["discounted_price"] = numbers.final_price(original, percent, *known)
    temporary = ("rating_raw", "original_price_raw", "current_price_raw", "platforms", "_current_price")
    return df.withColumns(first).withColumns(second).drop(*temporary)


def titled(df: DataFrame) -> DataFrame:
    """Records whose cleaned title is not empty, with that title."""
    cleaned = df.withColumn("game_title", text.clean_text(F.col("game_title")))
    return cleaned.filter(F.col("game_title").isNotNull() & (F.length("game_title") > 0))


def unified(df: DataFrame, *extra: str) -> DataFrame:
    """The unified columns in order, absent ones as typed nulls; ``extra`` columns follow."""
    present = set(df.columns)
    columns = [
        (F.col(name) if name in present else F.lit(None)).cast(kind).alias(name) for name, kind in UNIFIED.items()
    ]
    return df.select(*columns, *extra)


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name; missing columns become null."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def conform_all(
    sources: dict[str, DataFrame], order: str, keep_null_urls: bool = False, price_locale: str = "eu"
) -> DataFrame:
    """Unified records of all sources; untitled ones, and repeated links of a source, removed.

    Sources are renamed and united first, which needs one shuffle and one set of expressions
    instead of one per source. Only the title, which decides what is dropped, is cleaned
    before the repeated links go; the rest is cleaned once per remaining record. ``order``
    names the arrival column of every source; it stays in the result for later tie-breaks.
    """
    renamed = union_sources([to_standard_names(df, source) for source, df in sources.items()])
    return conform_renamed(renamed, order, keep_null_urls, price_locale)


def conform_renamed(
    renamed: DataFrame, order: str, keep_null_urls: bool = False, price_locale: str = "eu"
) -> DataFrame:
    """The same for records of all sources in one frame, in standard names with their ``data_source``."""
    kept = unique_urls(titled(renamed), [F.col(order)], keep_null=keep_null_urls)
    return unified(standardised(kept, price_locale), order)


def conform_source(df: DataFrame, source: str, order: str, **options) -> DataFrame:
    """One source's records in unified form."""
    return conform_all({source: df}, order, **options)


def master_records(sources: dict[str, DataFrame], order: str) -> DataFrame:
    """The deduplicated master table over all sources."""
    return master_of(conform_all(sources, order), order)


def master_of(conformed: DataFrame, order: str) -> DataFrame:
    """The best record of each title among conformed ones."""
    return best_per_title(conformed, [F.col(order)]).drop(order)


def column_subset(df: DataFrame, names) -> DataFrame:
    """The named columns that exist, in the named order."""
    return df.select(*[c for c in names if c in df.columns])


def capped(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` records by listing page and position."""
    return df.orderBy("page_id", "position").limit(n)


def preview(df: DataFrame, names, n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows of some columns."""
    return column_subset(df.orderBy(*order), names).limit(n)
