"""Two-way shares, attrition funnels and their totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from curata.operators.scan import numbered


def crosstab_percent(df: DataFrame, rows: str, columns: str, within: Sequence[str] = (), digits: int = 2) -> DataFrame:
    """Share of each cell in the total of its ``within`` group, in percent.

    Rows with a null category count neither as cells nor in the total. Totals are aggregates of the counted cells.
    """
    cells = df.dropna(subset=[rows, columns]).groupBy(*within, rows, columns).agg(F.count(F.lit(1)).alias("n"))
    share = lambda total: F.bround(F.col("n") * 100.0 / total, digits).alias("pct")
    if not within:
        return cells.select(*cells.columns, share(cells.agg(F.sum("n")).scalar()))
    totals = cells.groupBy(*[F.col(w).alias(f"__w_{w}") for w in within]).agg(F.sum("n").alias("__total"))
    same = reduce(lambda a, b: a & b, [F.col(w).eqNullSafe(F.col(f"__w_{w}")) for w in within])
    return cells.join(totals, same).select(*cells.columns, share(F.col("__total")))


def crosstab_wide(df: DataFrame, rows: str, columns: str, values: Sequence, digits: int = 2) -> DataFrame:
    """The same as a table with one column per value and 0 in empty cells, largest row first and
    "Unknown" last (``place`` is the row's position).

    Categories that are not among ``values`` share the column ``pct_other`` and count in the total.
    """
    named = F.col(columns).isin(*values)
    counts = df.dropna(subset=[rows, columns]).groupBy(rows).agg(
        *[F.count_if(F.col(columns) == v).alias(f"__{v}") for v in values],
        F.count_if(~named).alias("__other"),
        F.count(F.lit(1)).alias("n"),
    )
    grand = counts.agg(F.sum("n")).scalar()
    by_size = [F.when(F.col(rows) == "Unknown", 1).otherwise(0), F.desc("n"), F.asc(rows)]
    return numbered(counts, by_size, "place").select(
        rows,
        *[F.bround(F.col(f"__{v}") * 100.0 / grand, digits).alias(f"pct_{v}") for v in [*values, "other"]],
        (F.col("place") + 1).cast("int").alias("place"),
    )


def cell_totals(cells: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Row or column totals of tidy cells."""
    return cells.groupBy(*by).agg(F.sum(value).alias(f"total_{value}"))


def align_on_label(tables: Mapping[str, DataFrame], label: str, values: Sequence[str]) -> DataFrame:
    """Tables side by side on their row label; absent cells are 0.

    A stacked pivot, so the label set is the union over all tables without chained outer joins.
    """
    stacked = None
    for name, table in tables.items():
        tagged = table.select(F.lit(name).alias("__table"), label, *values)
        stacked = tagged if stacked is None else stacked.unionByName(tagged)
    return stacked.groupBy(label).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("__table") == name, F.col(v))), F.lit(0)).alias(f"{name}_{v}")
            for name in tables
            for v in values
        ]
    )


def funnel_counts(df: DataFrame, subject: str, stages: Mapping[str, Column], within: Sequence[str] = ()) -> DataFrame:
    """Rows and subjects left at every stage, from one pass over the first stage's rows.

    Rows shrink to one per subject before the totals, so no distinct count is needed.
    """
    per_subject = df.groupBy(*within, subject).agg(
        *[F.count(F.when(test, 1)).alias(f"__{s}") for s, test in stages.items()]
    )
    totals = per_subject.groupBy(*within).agg(
        *[F.sum(f"__{s}").alias(f"__p_{s}") for s in stages],
        *[F.count(F.when(F.col(f"__{s}") > 0, 1)).alias(f"__n_{s}") for s in stages],
    )
    entries = [
        F.struct(
            F.lit(i).alias("step"),
            F.lit(s).alias("stage"),
            F.coalesce(f"__p_{s}", F.lit(0)).alias("p_rows"),
            F.col(f"__n_{s}").alias("n_subjects"),
        )
        for i, s in enumerate(stages)
    ]
    return totals.select(*within, F.explode(F.array(*entries)).alias("e")).select(*within, "e.*")


def funnel_shares(
    df: DataFrame,
    subject: str,
    stages: Mapping[str, Column],
    order: Sequence[str],
    rows: str,
    columns: str,
    within: Sequence[str] = (),
) -> DataFrame:
    """Per stage the two-way shares over subjects, each with its first non-null categories."""
    place = F.struct(*order)
    picks = []
    for s, test in stages.items():
        for c in (rows, columns):
            picks.append(F.min_by(c, F.when(test & F.col(c).isNotNull(), place)).alias(f"__{s}_{c}"))
    per_subject = df.groupBy(*within, subject).agg(*picks)
    entries = [
        F.struct(F.lit(s).alias("stage"), F.col(f"__{s}_{rows}").alias(rows), F.col(f"__{s}_{columns}").alias(columns))
        for s in stages
    ]
    tidy = per_subject.select(*within, F.explode(F.array(*entries)).alias("e")).select(*within, "e.*")
    return crosstab_percent(tidy, rows, columns, [*within, "stage"])
