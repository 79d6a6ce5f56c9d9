"""One value or row per group, as aggregates that combine before their shuffle."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def first_nonnull(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key and column the first non-null value; values may come from different rows."""
    place = F.struct(*order)
    return df.groupBy(*keys).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in columns]
    )


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Per key the first whole row."""
    return _one_row(df, keys, lambda row: F.min_by(row, F.struct(*order)))


def last_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Per key the last whole row (the latest revision, the closest earlier value)."""
    return _one_row(df, keys, lambda row: F.max_by(row, F.struct(*order)))


def _one_row(df: DataFrame, keys: Sequence[str], pick: Callable[[Column], Column]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(pick(F.struct(*rest)).alias("__row"))
    return picked.select(*keys, "__row.*").select(*df.columns)


def consistent_values(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per key, for keys whose rows do not contradict each other.

    Keys with more than one distinct value are dropped; equal copies collapse.
    """
    return (
        df.groupBy(*keys)
        .agg(F.min(value).alias(value), F.max(value).alias("__hi"))
        .filter(F.col(value).eqNullSafe(F.col("__hi")))
        .drop("__hi")
    )


def by_priority(df: DataFrame, keys: Sequence[str], rank: str, valid: Mapping[str, Column]) -> DataFrame:
    """Per key and measure the value of the best-ranked source with a valid value.

    Every key survives, with nulls where nothing is valid. Ranks are distinct per source; several
    rows of one source at one key give the smallest value.
    """
    return df.groupBy(*keys).agg(
        *[F.min(F.when(ok, F.struct(F.col(rank), F.col(c)))).getField(c).alias(c) for c, ok in valid.items()]
    )


def with_group_size(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """The number of rows of the group on every row, by a counted join instead of a window."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return df.join(sizes, list(keys), "left")
