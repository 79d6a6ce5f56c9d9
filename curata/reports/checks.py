"""Checks on a finished table, as frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def key_check(df: DataFrame, keys: Sequence[str], source: str) -> DataFrame:
    """Whether each key has one row, and how many rows lack the first key column."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        (F.coalesce(F.max("n"), F.lit(1)) == 1).alias("one_row_per_key"),
        F.coalesce(F.sum(F.when(F.col(keys[0]).isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
    ).select(F.lit(source).alias("source"), "one_row_per_key", "null_keys")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of nulls per column."""
    return df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])


def distinct_counts(df: DataFrame, columns: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Rows and distinct values per column, per group."""
    return df.groupBy(*within).agg(
        F.count(F.lit(1)).alias("rows"), *[F.countDistinct(c).alias(f"n_{c}") for c in columns]
    )
