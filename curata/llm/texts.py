"""What several operators of this package share: words, null-safe texts, column checks."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def whole_text(column: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(column: str) -> Column:
    """Number of words of the text as a long; 0 where it is null."""
    return F.regexp_count(whole_text(column), F.lit(WORD)).cast("long")


def bound_once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row.

    A column that occurs inside a lambda may be put there as an expression and so be computed for every element.
    A lambda's own variable is not, hence the detour over an array of one.
    """
    return F.transform(F.array(value), use)[0]


def need(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}; there are {df.columns}")


def free_name(wanted: str, *frames: DataFrame) -> str:
    """``wanted``, lengthened until no frame has a column of that name (names compare without case)."""
    taken = {c.lower() for df in frames for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def hex_sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
