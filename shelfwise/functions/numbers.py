"""Ratings, prices, discounts, counts and exact averages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.text import strip
from shelfwise.schemas import RATING_NA_TOKENS, RATING_SCALE

NUMERIC = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# --------------------------------------------------------------------------
# Text rating scores in matching order, and currency signs.
# --------------------------------------------------------------------------
TEXT_SCORES = (
    ("overwhelmingly positive", 95),
    ("very positive", 85),
    ("positive", 75),
    ("mostly positive", 70),
    ("mixed", 50),
    ("mostly negative", 30),
    ("negative", 25),
    ("very negative", 15),
    ("overwhelmingly negative", 5),
)
PRICE_SIGNS = "€$£¥"
CURRENCY_SIGNS = "€$£¥₹₽"


def decimal_of(c: Column) -> Column:
    """Plain numeric text as an exact decimal; anything else is null."""
    text = strip(c.cast("string"))
    return F.when(text.rlike(NUMERIC), text.try_cast("decimal(30,12)"))


def rating(c: Column, source: Column) -> Column:
    """Rating on a 0..100 scale with one decimal; values outside the source's scale are null."""
    value = F.when(~c.cast("string").isin(*RATING_NA_TOKENS), decimal_of(c))
    factor = F.lit(None).cast("int")
    for name, top in RATING_SCALE.items():
        factor = F.when(source == name, F.lit(100 // top)).otherwise(factor)
    scaled = value * factor
    return F.when(scaled.between(0, 100), F.round(scaled, 1).cast("double"))


def price(c: Column, locale: str = "eu") -> Column:
    """First number of a price text; "free" is 0.

    With ``locale="eu"`` a comma is a decimal point and, where both signs occur, the point
    groups thousands (so ``1,234.56`` reads as 1.23456). ``locale="us"`` drops commas.
    """
    text = F.lower(c.cast("string"))
    bare = F.translate(text, PRICE_SIGNS, "")
    if locale == "us":
        plain = F.translate(bare, ",", "")
    else:
        both = bare.rlike(r"(?s),.*\.|\..*,")
        plain = F.when(both, F.translate(bare, ",.", ".")).otherwise(F.translate(bare, ",", "."))
    number = F.regexp_extract(plain, r"\d+\.?\d*", 0)
    return (
        F.when(text == "n/a", F.lit(None))
        .when(text.contains("free"), F.lit(0.0))
        .otherwise(number.try_cast("double"))
    )


def discount(c: Column) -> Column:
    """``-50%`` -> 50.0; text that is not a number is null."""
    return decimal_of(F.translate(c, "%-", "")).cast("double")


def final_price(original: Column, discount_pct: Column, *known: Column) -> Column:
    """First known price, else the original reduced by the discount, else the original."""
    exact = original.try_cast("decimal(18,6)")
    share = 1 - discount_pct.try_cast("decimal(18,6)") / 100
    reduced = F.when(discount_pct > 0, F.round(exact * share, 2).cast("double"))
    return F.coalesce(*known, reduced, original)


def recomputed_discount(original: Column, discounted: Column, current: Column) -> Column:
    """Discount from two positive prices with two decimals; negative results are 0."""
    whole, part = original.try_cast("decimal(18,6)"), discounted.try_cast("decimal(18,6)")
    derived = F.round((whole - part) * 100 / F.nullif(whole, F.lit(0)), 2).cast("double")
    value = F.when((original > 0) & (discounted > 0), derived).otherwise(current)
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def review_count(c: Column) -> Column:
    """``1,234 reviews`` -> 1234.0; text without digits is null."""
    digits = F.regexp_extract(F.translate(c.cast("string"), ",", ""), r"(\d+)", 1)
    return digits.try_cast("double")


def text_score(c: Column, strict: bool = False) -> Column:
    """Score of a review summary by the first matching phrase.

    In the default order "positive" and "negative" come before some longer phrases that
    contain them. ``strict`` tries longer phrases first.
    """
    phrases = sorted(TEXT_SCORES, key=lambda pair: -len(pair[0])) if strict else TEXT_SCORES
    lowered = F.lower(c)
    score = F.lit(None).cast("int")
    for phrase, value in reversed(phrases):
        score = F.when(lowered.contains(phrase), F.lit(value)).otherwise(score)
    return score


def review_percentage(c: Column) -> Column:
    return F.regexp_extract(c, r"(\d+)%", 1).try_cast("int")


def price_text(c: Column, by_size: bool = False) -> Column:
    """Struct (price, original_price, discount_percentage) of a price label, ``N/A`` if absent.

    The first amount is the price and the second the original; ``by_size`` makes the lower
    one the price, for labels that show the original first.
    """
    text = strip(c)
    free = F.lower(text).contains("free")
    percent = F.concat(F.nullif(F.regexp_extract(text, r"-(\d+)%", 1), F.lit("")), F.lit("%"))
    amounts = F.regexp_extract_all(text, F.lit(rf"([{PRICE_SIGNS}][\s\xa0]*[\d,]+\.?\d*)"), 1)

    def pair(found: Column) -> Column:
        first, second = strip(F.get(found, 0)), strip(F.get(found, 1))
        if not by_size:
            return F.struct(first.alias("now"), second.alias("before"))
        swap = F.coalesce(price(second, "us") < price(first, "us"), F.lit(False))
        return F.struct(
            F.when(swap, second).otherwise(first).alias("now"), F.when(swap, first).otherwise(second).alias("before")
        )

    # The one-element array binds the amounts to a variable, so the label is searched once.
    parsed = F.get(F.transform(F.array(amounts), pair), 0)
    return F.struct(
        F.when(free, F.lit("Free")).otherwise(F.coalesce(parsed["now"], F.lit("N/A"))).alias("price"),
        F.coalesce(F.when(~free, parsed["before"]), F.lit("N/A")).alias("original_price"),
        F.coalesce(F.when(~free, percent), F.lit("N/A")).alias("discount_percentage"),
    )


def price_display(block: Column, label: Column) -> Column:
    """Final price of the discount block, else the plain label ("Free" wins), else ``N/A``."""
    plain = F.when(label.contains("Free"), F.lit("Free")).otherwise(F.nullif(label, F.lit("")))
    return F.coalesce(F.nullif(block, F.lit("N/A")), plain, F.lit("N/A"))


def currency(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, f"[{CURRENCY_SIGNS}]", 0), F.lit(""))


def savings(original: Column, discounted: Column) -> Column:
    """Original minus discounted, 0 when either is missing or zero."""
    return F.when((original != 0) & (discounted != 0), original - discounted).otherwise(F.lit(0))


def zero_to_null(c: Column, kind: str) -> Column:
    """Typed value of a text or number with 0 read as missing; integers are cut, not rounded."""
    exact = c.try_cast("decimal(30,6)")
    return F.nullif(exact.try_cast(kind), F.lit(0).cast(kind))


def cents(c: Column) -> Column:
    """Two-decimal amount as whole cents: sums over integers do not depend on row order.

    An amount too large for an integer number of cents is null, it does not fail the job.
    """
    return F.round(c * 100).try_cast("bigint")


def rounded_ratio(total: Column, n: Column, digits: int) -> Column:
    """``total / n`` rounded half up from exact decimals; null when ``n`` is 0."""
    quotient = total.cast("decimal(20,0)") / F.nullif(n, F.lit(0)).cast("decimal(20,0)")
    return F.round(quotient, digits).cast("double")


def mean(c: Column) -> Column:
    """Aggregate: mean of an integer column as one division of exact sums."""
    return F.sum(c) / F.nullif(F.count(c), F.lit(0))


def rounded_mean(c: Column, digits: int) -> Column:
    """Aggregate: mean of an integer column, rounded from exact sums."""
    return rounded_ratio(F.sum(c), F.count(c), digits)


def rounded_mean_price(c: Column) -> Column:
    """Aggregate: mean of a two-decimal price, rounded to cents from exact sums."""
    in_cents = cents(c)
    return (rounded_ratio(F.sum(in_cents), F.count(in_cents), 0) / 100).cast("double")


def share(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percentage of a total, rounded from exact integers."""
    return rounded_ratio(part * 100, whole, digits)
