"""Carry-forward and carry-back fills."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from curata.operators.scan import ordered_scan


def carry_fill(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    columns: Mapping[str, str],
) -> DataFrame:
    """``{source: filled}``: the last observation carried forward, else the next one carried back."""
    scan = ordered_scan(
        df,
        keys,
        order,
        chunk,
        upto={f"__f_{c}": F.col(c) for c in columns},
        after={f"__b_{c}": F.col(c) for c in columns},
    )
    return scan.select(
        *df.columns, *[F.coalesce(f"__f_{c}", f"__b_{c}").alias(name) for c, name in columns.items()]
    )
