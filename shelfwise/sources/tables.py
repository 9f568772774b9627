"""Parquet tables with declared schemas, and ad-hoc SQL over named DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.schemas import TABLES


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def run_sql(spark: SparkSession, sql: str, args: dict | list | None = None, **frames: DataFrame) -> DataFrame:
    """Parameterised SQL; ``{name}`` in the text stands for the DataFrame passed as ``name``."""
    return spark.sql(sql, args=args, **frames)
