"""Event logs (subject, time, item, value) to wide tables, and the validity rules on the way."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


BOUNDS = {"above": "__gt__", "at_least": "__ge__", "below": "__lt__", "at_most": "__le__"}


@dataclass(frozen=True)
class Range:
    """A validity range; a bound of None is open-ended. ``above``/``below`` exclude the bound."""

    above: float | None = None
    at_least: float | None = None
    below: float | None = None
    at_most: float | None = None


    def holds(self, value: Column) -> Column:
        bounds = {b: getattr(self, b) for b in BOUNDS}
        tests = [getattr(value, BOUNDS[b])(F.lit(float(x))) for b, x in bounds.items() if x is not None]
        return reduce(lambda a, b: a & b, tests, value.isNotNull())


@dataclass(frozen=True)
class Measure:
    """One wide column: the items that feed it, their validity and an optional conversion."""

    name: str
    items: tuple
    valid: Range = Range()
    scale: float = 1.0
    shift: float = 0.0

    @property
    def converts(self) -> bool:
        return bool(self.shift) or self.scale != 1.0


AGGREGATES = {"avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum, "any": F.min}


def rule_table(spark: SparkSession, measures: Sequence[Measure]) -> DataFrame:
    """The measures as rows, one per (item, column), of which the first given counts: as small as the rules in the code."""
    kind = "string" if any(isinstance(i, str) for m in measures for i in m.items) else "long"
    first: dict[tuple, Measure] = {}
    for m in measures:
        for item in m.items:
            first.setdefault((item, m.name), m)
    data = [
        (item, name, *[None if getattr(m.valid, b) is None else float(getattr(m.valid, b)) for b in BOUNDS], float(m.shift), float(m.scale))
        for (item, name), m in first.items()
    ]
    bounds = ", ".join(f"__{b} double" for b in BOUNDS)
    return spark.createDataFrame(data, f"__item {kind}, __measure string, {bounds}, __shift double, __scale double")


def keeps(value: Column, measures: Sequence[Measure]) -> Column:
    """Whether a value keeps the rule beside it; bounds that no rule has are not asked, so text can go without."""
    tests = [value.isNotNull()]
    for bound, test in BOUNDS.items():
        if any(getattr(m.valid, bound) is not None for m in measures):
            tests.append(F.coalesce(getattr(value, test)(F.col(f"__{bound}")), F.lit(True)))
    return reduce(lambda a, b: a & b, tests)


def pivot_measures(
    df: DataFrame,
    keys: Sequence[str],
    item: str,
    value: str,
    measures: Sequence[Measure],
    how: str = "avg",
    digits: int | None = None,
    largest: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per key with one column per measure; every key of an input row survives.

    A row counts once in every column that has a rule for its item. Measures of the same name feed one column; if they share an item,
    the first rule counts. A column keeps the value's type unless one of its measures has a scale or shift. Rows combine per
    (key, column) before columns are spread, so that the shuffle carries the few values a key has and not a
    buffer for every column. ``largest`` adds, per key, the largest value of other expressions.
    """
    largest = dict(largest or {})
    names = list(dict.fromkeys(m.name for m in measures))
    converted = {m.name for m in measures if m.converts}
    pick, v = AGGREGATES[how], F.col(value)
    rules = F.broadcast(rule_table(df.sparkSession, measures))  # one row per rule in the code
    slim = df.select(*keys, item, value, *[c.alias(f"__l_{n}") for n, c in largest.items()])
    ruled = slim.join(rules, F.col(item) == F.col("__item"), "left").withColumn("__valid", keeps(v, measures))
    parts = [pick(F.when(F.col("__valid"), v)).alias("__plain")] if len(converted) < len(names) else []
    if converted:
        parts.append(pick(F.when(F.col("__valid"), (v - F.col("__shift")) / F.col("__scale"))).alias("__converted"))
    parts += [F.max(f"__l_{n}").alias(f"__l_{n}") for n in largest]
    combined = ruled.groupBy(*keys, "__measure").agg(*parts).repartition(*keys)
    out = {n: F.max(F.when(F.col("__measure") == n, F.col("__converted" if n in converted else "__plain"))) for n in names}
    rounded = [(c if digits is None else F.round(c, digits)).alias(n) for n, c in out.items()]
    return combined.groupBy(*keys).agg(*rounded, *[F.max(f"__l_{n}").alias(n) for n in largest])


def pivot_labels(
    df: DataFrame, keys: Sequence[str], label: str, value: str, columns: dict[str, str], how: str = "any"
) -> DataFrame:
    """``{label: column}``: a pivot of text or numbers without validity rules.

    "any" is the smallest value, so that a pick among several is repeatable.
    """
    pick = AGGREGATES[how]
    return df.groupBy(*keys).agg(
        *[pick(F.when(F.col(label) == text, F.col(value))).alias(name) for text, name in columns.items()]
    )


def known_items(measures: Sequence[Measure]) -> list:
    return list(dict.fromkeys(i for m in measures for i in m.items))


def valid_rows(df: DataFrame, item: str, value: str, measures: Sequence[Measure]) -> DataFrame:
    """Rows that satisfy a rule of their item, each once; items without a rule are dropped."""
    rules = F.broadcast(rule_table(df.sparkSession, measures))
    return df.join(rules, (F.col(item) == F.col("__item")) & keeps(F.col(value), measures), "left_semi")
