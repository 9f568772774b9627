"""Dense surrogate keys without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import stored


def numbered(df: DataFrame, *order: Column | str, name: str = "id", start: int = 0) -> DataFrame:
    """1, 2, 3, ... as a new first column.

    Without an order, rows are numbered where they are: nothing is shuffled. With an order,
    which is meant for small tables, they are range-partitioned and sorted in parallel first.
    The rows are stored once; a row's number is its place in its file plus the rows of the
    files before. Files do not change, so later readers and retries see the same numbers.
    Numbers begin after ``start``.
    """
    arranged = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    placed = stored(arranged).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    part = F.regexp_extract("_file", r"^part-(\d+)", 1).cast("int")
    before = Window.orderBy(part, "_file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_file").agg(F.count("*").alias("_size"))
    offsets = sizes.select("_file", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return placed.join(offsets, "_file").select(
        (F.col("_offset") + F.col("_row") + 1 + start).cast("bigint").alias(name), *df.columns
    )
