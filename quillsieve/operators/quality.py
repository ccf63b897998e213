"""Generic data checks, each of all its columns in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _long(counts: DataFrame, names: list[str]) -> DataFrame:
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return counts.selectExpr(f"stack({len(names)}, {pairs}) AS (column_name, violations)")


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, violations: the NULLs of each column."""
    return _long(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]), columns)


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the accepted ones, with their number; NULL passes."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(values)).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Combinations that occur more than once, with their number; NULLs are equal here."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
