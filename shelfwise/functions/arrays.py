"""Lists: delimited text, truncation, order-preserving distinct, flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.text import flat_text, strip

# Display names of the platforms and the words that reveal them.
PLATFORM_WORDS = (("Windows", ("windows",)), ("Mac", ("mac", "os x")), ("Linux", ("linux",)))


def delimited(items: Column, separator: str = "|") -> Column:
    """Joined list, ``N/A`` when empty or missing."""
    return F.when(F.size(items) > 0, F.array_join(items, separator)).otherwise(F.lit("N/A"))


def first_items(items: Column, n: int | None = None) -> Column:
    """The first ``n`` items; all by default."""
    return items if n is None else F.slice(items, 1, n)


def distinct_items(items: Column, n: int | None = None) -> Column:
    """Distinct in order of first occurrence, optionally the first ``n``."""
    return first_items(F.array_distinct(items), n)


def platforms_in(text: Column) -> Column:
    """Comma list of platforms mentioned in a text, ``N/A`` if none."""
    lowered = F.lower(text)
    found = []
    for name, words in PLATFORM_WORDS:
        found.append(F.when(lowered.rlike("|".join(words)), F.lit(name)))
    return delimited(F.array_compact(F.array(*found)), ", ")


def platforms_of_classes(classes: Column) -> Column:
    """Comma list of platforms from icon class names, in icon order, without repeats."""
    lowered = F.transform(classes, F.lower)
    names = F.flatten(
        F.transform(
            lowered,
            lambda c: F.array_compact(
                F.array(*[F.when(c.contains(name.lower()), F.lit(name)) for name, _ in PLATFORM_WORDS])
            ),
        )
    )
    return delimited(F.array_distinct(names), ", ")


def yes_no(items: Column, word: str) -> Column:
    """``Yes`` when any item contains the word, ignoring case."""
    hit = F.exists(items, lambda x: F.lower(x).contains(word))
    return F.when(F.coalesce(hit, F.lit(False)), F.lit("Yes")).otherwise(F.lit("No"))


def editions(names: Column, prices: Column, n: int | None = None) -> Column:
    """``name: price`` of the items (the first ``n``) that have both."""
    pairs = first_items(F.arrays_zip(names.alias("name"), prices.alias("price")), n)
    both = F.filter(pairs, lambda p: (p["name"] != "") & (p["price"] != ""))
    return F.transform(both, lambda p: F.concat(flat_text(p["name"]), F.lit(": "), flat_text(p["price"])))


def user_tags(items: Column, n: int | None = None) -> Column:
    """Non-empty tags (among the first ``n``), without the "more" marker."""
    trimmed = F.transform(first_items(items, n), strip)
    return F.filter(trimmed, lambda t: (t != "") & (t != "..."))


def short_genres(items: Column, n: int | None = None, limit: int = 40) -> Column:
    """Genre labels (the first ``n``) shorter than ``limit`` that are not separators."""
    trimmed = F.transform(items, strip)
    kept = F.filter(trimmed, lambda g: (g != "") & (F.length(g) < limit) & ~g.isin("-", ",", "&"))
    return first_items(kept, n)
