"""Dates and release status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.text import squeeze

# --------------------------------------------------------------------------
# Accepted shapes and their formats, in the order they are tried.
# --------------------------------------------------------------------------
DATE_FORMATS = (
    (r"^\d{1,2}-[A-Za-z]{3}-\d{2}$", "d-MMM-yy"),
    (r"^[A-Za-z]+ \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    (r"^\d{1,2} [A-Za-z]{3}, \d{4}$", "d MMM, yyyy"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^\d{1,2}-\d{2}-\d{4}$", "d-MM-yyyy"),
)
# Two-digit years from this one on belong to the previous century.
CENTURY_PIVOT = 69


def release_date(c: Column, squeezed: bool = False) -> Column:
    """Date of a text in one of seven shapes, or 1 January of a bare year; else null.

    White space is collapsed first because the formatter, unlike the accepted shapes,
    allows exactly one blank; ``squeezed`` says the caller has done that in a column of its own,
    so that it is not repeated per shape.
    """
    text = c if squeezed else squeeze(c)
    candidates = []
    for shape, fmt in DATE_FORMATS:
        parsed = F.try_to_date(text, fmt)
        if fmt.endswith("-yy"):
            late = F.year(parsed) % 100 >= CENTURY_PIVOT
            parsed = F.when(late, F.add_months(parsed, -1200)).otherwise(parsed)
        candidates.append(F.when(text.rlike(shape), parsed))
    year_only = F.when(text.rlike(r"^\d{4}$"), F.try_to_date(F.concat(text, F.lit("-01-01")), "yyyy-MM-dd"))
    found = F.coalesce(*candidates, year_only)
    return F.when(F.year(found) >= 1, found)


def release_status(date: Column, as_of: Column | None = None) -> Column:
    """Released up to and including ``as_of`` (today by default), Upcoming after, Unknown if missing."""
    day = F.current_date() if as_of is None else as_of
    return F.when(date <= day, F.lit("Released")).when(date > day, F.lit("Upcoming")).otherwise(F.lit("Unknown"))
