"""Rule tables: weighted flags, unit factors, bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def bands(value: Column, steps: Sequence[tuple[str, float, int]], otherwise: int = 0) -> Column:
    """First matching step wins: ``(comparison, bound, points)``; null stays null, the rest is 0."""
    tests = {"<": value.__lt__, "<=": value.__le__, ">": value.__gt__, ">=": value.__ge__}
    out = None
    for sign, bound, points in steps:
        hit = tests[sign](F.lit(bound))
        out = F.when(hit, F.lit(points)) if out is None else out.when(hit, F.lit(points))
    return out.when(value.isNull(), F.lit(None).cast("int")).otherwise(F.lit(otherwise))


def first_match(text: Column, patterns: Sequence[tuple[str, str]]) -> Column:
    """The tag of the first LIKE pattern of ``(pattern, tag)`` that the text matches, null if there is none."""
    return F.coalesce(*[F.when(text.like(p), F.lit(tag)) for p, tag in patterns]) if patterns else F.lit(None).cast("string")


def every_match(text: Column, patterns: Sequence[tuple[str, str]]) -> Column:
    """The tags of all patterns that the text matches, each once, in the order of the table: one reading for all of them."""
    by_tag: dict[str, Column] = {}
    for p, tag in patterns:
        by_tag[tag] = by_tag[tag] | text.like(p) if tag in by_tag else text.like(p)
    return F.filter(F.array(*[F.when(hit, F.lit(tag)) for tag, hit in by_tag.items()]), lambda x: x.isNotNull())


def weighted_flags(
    people: DataFrame,
    facts: DataFrame,
    key: str,
    fact: str,
    categories: Mapping[str, tuple[int, Sequence[str]]],
) -> DataFrame:
    """People plus one column per category: its weight if any fact of the person is listed, else 0.

    ``categories`` is ``{column: (weight, texts)}``. Facts shrink to one row per person before
    the join, and people without facts keep zeros.
    """
    flags = facts.filter(F.col(fact).isin(*[t for _, texts in categories.values() for t in texts])).groupBy(key).agg(
        *[
            F.max(F.when(F.col(fact).isin(*texts), F.lit(weight)).otherwise(F.lit(0))).alias(name)
            for name, (weight, texts) in categories.items()
        ]
    )
    joined = people.join(flags, [key], "left")
    return joined.select(*people.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in categories])


def total(columns: Sequence[str]) -> Column:
    out = F.col(columns[0])
    for c in columns[1:]:
        out = out + F.col(c)
    return out
