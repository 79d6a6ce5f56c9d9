"""Stratified descriptive tables and the tests beside them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from curata.reports.quantiles import exact_quantiles, value_counts_in_order

#: Expected rows in a cell of a two by two table below which it gets the exact test.
SMALL = 5
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def unpivot(df: DataFrame, keys: Sequence[str], columns: Sequence[str], kind: str) -> DataFrame:
    """``variable`` and ``value`` rows of the named columns; a number that is NaN is missing."""
    values = {c: F.col(c).cast(kind) for c in columns}
    if kind == "double":
        values = {c: F.when(~F.isnan(v), v) for c, v in values.items()}
    entries = F.array(*[F.struct(F.lit(c).alias("variable"), v.alias("value")) for c, v in values.items()])
    return df.select(*keys, F.explode(entries).alias("e")).select(*keys, "e.variable", "e.value")


def describe_continuous(df: DataFrame, stratum: str, columns: Sequence[str]) -> DataFrame:
    """Per variable and stratum: rows, missing, median and quartiles."""
    long = unpivot(df, [stratum], columns, "double")
    keys = ["variable", stratum]
    counts = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("value").isNull(), 1)).alias("missing")
    )
    quartiles = exact_quantiles(long, keys, "value", QUARTILES).drop("n")
    return counts.join(quartiles, keys, "left")


def describe_categorical(df: DataFrame, stratum: str, columns: Sequence[str]) -> DataFrame:
    """Per variable, level and stratum: count and percent of the stratum's known values."""
    long = unpivot(df, [stratum], columns, "string").filter(F.col("value").isNotNull())
    cells = long.groupBy("variable", stratum, F.col("value").alias("level")).agg(F.count(F.lit(1)).alias("n"))
    known = Window.partitionBy("variable", stratum)
    return cells.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(known))


def table_one(
    df: DataFrame, stratum: str, categorical: Sequence[str], numbers: Sequence[str], tests: bool = False, exact: bool = False
) -> DataFrame:
    """The whole descriptive table as tidy rows.

    One row per variable, level (null for numbers) and stratum with ``n`` known values (numbers) or rows of
    the level, ``missing`` values, ``pct`` or ``median`` [``q1``, ``q3``]; with ``tests`` also the p-value
    of the variable and the test's name; with ``exact`` the counts choose between chi-square and the exact test. Rows without a stratum are in none.
    """
    df = df.dropna(subset=[stratum])
    parts = []
    if numbers:
        described = describe_continuous(df, stratum, numbers).withColumn("n", F.col("rows") - F.col("missing")).drop("rows")
        parts.append(described.withColumns({"level": F.lit(None).cast("string"), "pct": F.lit(None).cast("double")}))
    if categorical:
        missing = unpivot(df, [stratum], categorical, "string").groupBy("variable", stratum).agg(
            F.count(F.when(F.col("value").isNull(), 1)).alias("missing")
        )
        parts.append(describe_categorical(df, stratum, categorical).join(missing, ["variable", stratum], "left"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    if not tests:
        return out
    tested = []
    if categorical:
        tested.append(association(df, stratum, categorical, SMALL if exact else 0))
    if numbers:
        tested.append(kruskal_wallis(df, stratum, numbers).withColumn("test", F.lit("Kruskal-Wallis")))
    values = [t.select("variable", "p_value", "test") for t in tested]
    both = values[0] if len(values) == 1 else values[0].unionByName(values[1])
    return out.join(both, "variable", "left")


def describe_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum per column."""
    long = unpivot(df, [], columns, "double")
    moments = long.groupBy("variable").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return moments.join(exact_quantiles(long, ["variable"], "value", QUARTILES).drop("n"), "variable", "left")


def _cells(df: DataFrame, stratum: str, columns: Sequence[str]) -> DataFrame:
    """Counted cells with the totals of their row and column; the windows run over as many rows as there are levels and strata."""
    long = unpivot(df.dropna(subset=[stratum]), [stratum], columns, "string").filter(F.col("value").isNotNull())
    cells = long.groupBy("variable", stratum, "value").agg(F.count(F.lit(1)).alias("n"))
    by_row, by_column = Window.partitionBy("variable", "value"), Window.partitionBy("variable", stratum)
    n = F.col("n").cast("double")
    return cells.select(
        "variable", stratum, "value", n.alias("n"), F.sum(n).over(by_row).alias("__row"), F.sum(n).over(by_column).alias("__column")
    )


def _chi_square_of(cells: DataFrame, stratum: str, *more: Column) -> DataFrame:
    return cells.groupBy("variable").agg(
        (F.sum("n") * (F.sum(F.col("n") * F.col("n") / (F.col("__row") * F.col("__column"))) - F.lit(1.0))).alias("chi2"),
        ((F.countDistinct("value") - 1) * (F.countDistinct(stratum) - 1)).alias("dof"),
        *more,
    )


def chi_square(df: DataFrame, stratum: str, columns: Sequence[str]) -> DataFrame:
    """Pearson's chi-square of each categorical variable against the strata.

    Empty cells count with their expectation: the statistic is N (sum of n^2 / (row * column) - 1),
    which needs only the cells that occur.
    """
    return _chi_square_of(_cells(df, stratum, columns), stratum).withColumn("p_value", chi2_tail("chi2", "dof"))


def association(df: DataFrame, stratum: str, columns: Sequence[str], small: float = SMALL) -> DataFrame:
    """``variable, p_value, test`` of each categorical variable against the strata, the test chosen by the counts.

    Two levels in two strata with fewer than ``small`` rows expected in a cell get the exact test, all others chi-square.
    """
    cells = _cells(df, stratum, columns)
    variable = Window.partitionBy("variable")
    first = (F.col("value") == F.min("value").over(variable)) & (F.col(stratum) == F.min(stratum).over(variable))
    marked = cells.withColumns(
        {
            "__a": F.when(first, F.col("n")).otherwise(0.0),
            "__r": F.when(F.col("value") == F.min("value").over(variable), F.col("n")).otherwise(0.0),
            "__c": F.when(F.col(stratum) == F.min(stratum).over(variable), F.col("n")).otherwise(0.0),
        }
    )
    sums = [F.sum(f"__{x}").alias(x) for x in "arc"] + [F.sum("n").alias("all")]
    least = (F.min("__row") * F.min("__column") / F.sum("n")).alias("least")
    found = _chi_square_of(marked, stratum, *sums, least)
    exact = (F.col("dof") == 1) & (F.col("least") < F.lit(small))
    return found.select(
        "variable",
        F.when(exact, fisher_exact(*[F.col(x) for x in ("a", "r", "c", "all")])).otherwise(chi2_tail("chi2", "dof")).alias("p_value"),
        F.when(exact, "Fisher's exact").otherwise("Chi-squared").alias("test"),
    )


def fisher_exact(a: Column, row: Column, column: Column, everything: Column) -> Column:
    """Two-sided exact probability of a two by two table with ``a`` in a cell of these totals: of all tables with the totals those
    that are no likelier. Hypergeometric terms in logarithms, as many as the smaller total allows."""
    rest = everything - row - column
    fixed = sum((log_factorial(x) for x in (row, everything - row, column, everything - column)), -log_factorial(everything))

    def of(k: Column, totals: Column) -> Column:
        parts = (log_factorial(x) for x in (k, totals["row"] - k, totals["column"] - k, totals["rest"] + k))
        return sum((-x for x in parts), totals["fixed"])

    totals = F.struct(a.alias("a"), row.alias("row"), column.alias("column"), rest.alias("rest"), fixed.alias("fixed"))
    tables = F.sequence(F.greatest(F.lit(0.0), -rest).cast("long"), F.least(row, column).cast("long"))

    def summed(t: Column) -> Column:
        limit = of(t["a"], t) + 1e-7
        add = lambda total, k: total + F.when(of(k.cast("double"), t) <= limit, F.exp(of(k.cast("double"), t))).otherwise(0.0)
        return F.least(F.aggregate(tables, F.lit(0.0), add), F.lit(1.0))

    return F.transform(F.array(totals), summed)[0]  # the detour computes the totals once


def log_factorial(n: Column) -> Column:
    """Of whole numbers: exact up to 20, Stirling's series beyond."""
    series = n * F.log(n) - n + 0.5 * F.log(2 * math.pi * n)
    for power, factor in ((1, 1 / 12), (3, -1 / 360), (5, 1 / 1260), (7, -1 / 1680)):
        series = series + factor / F.pow(n, F.lit(power))
    return F.when(n <= 20, F.log(F.factorial(n.cast("int")))).otherwise(series)


def kruskal_wallis(df: DataFrame, stratum: str, columns: Sequence[str]) -> DataFrame:
    """Kruskal-Wallis H with tie correction for each variable across the strata.

    Distinct values carry one count per stratum; their mean rank follows from the running count,
    which is taken in range partitions, never over a whole variable in one task. Ranks are
    centred before they are squared.
    """
    long = unpivot(df.dropna(subset=[stratum]), [stratum], columns, "double").filter(F.col("value").isNotNull())
    ranked = value_counts_in_order(long, ["variable"], "value").select(
        "variable", "value", F.col("n").cast("double").alias("t"), (F.col("upto") - (F.col("n") - 1) / 2.0).alias("rank")
    )
    ties = ranked.groupBy("variable").agg(
        F.sum("t").alias("everything"), F.sum(F.col("t") * F.col("t") * F.col("t") - F.col("t")).alias("ties")
    )
    per_value = long.groupBy("variable", "value", stratum).agg(F.count(F.lit(1)).cast("double").alias("c"))
    strata = (
        per_value.join(ranked, ["variable", "value"])
        .groupBy("variable", stratum)
        .agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("rank")).alias("r"))
    )
    total = F.col("everything")
    apart = F.col("r") / F.col("n") - (total + 1) / 2.0  # mean rank against the mean of all ranks
    sums = strata.join(ties, "variable").groupBy("variable", "everything", "ties").agg(
        F.sum(F.col("n") * apart * apart).alias("s"), (F.count(F.lit(1)) - 1).alias("dof")
    )
    raw = F.lit(12.0) / (total * (total + 1)) * F.col("s")
    correction = F.lit(1.0) - F.col("ties") / (total * total * total - total)
    tested = sums.select("variable", F.try_divide(raw, correction).alias("h"), "dof")
    return tested.withColumn("p_value", chi2_tail("h", "dof"))


def chi2_tail(statistic: Column | str, dof: Column | str) -> Column:
    """Upper tail of the chi-square distribution for whole degrees of freedom; null below one.

    A finite sum of positive terms, each got from the one before, in logarithms, so that neither large statistics nor many degrees
    leave the range of a double.
    """
    x = F.col(statistic) if isinstance(statistic, str) else statistic
    k = (F.col(dof) if isinstance(dof, str) else dof).cast("long")
    half = F.greatest(x.cast("double"), F.lit(0.0)) / 2.0
    odd = k % 2
    steps = F.floor(k / 2).cast("int")

    def summed(h: Column) -> Column:
        shift = odd / 2.0
        # half a step on, the first term is divided by gamma(3/2) = sqrt(pi) / 2
        first = -h + shift * F.log(h) - odd * math.log(math.sqrt(math.pi) / 2)
        start = F.struct(first.alias("term"), F.lit(None).cast("double").alias("total"))

        def add(seen: Column, i: Column) -> Column:
            term, total = seen["term"], seen["total"]
            high, low = F.greatest(total, term), F.least(total, term)
            both = F.when(total.isNull(), term).otherwise(high + F.log1p(F.exp(low - high)))
            return F.struct((term + F.log(h) - F.log(i + shift)).alias("term"), both.alias("total"))

        terms = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
        logs = F.aggregate(terms, start, add, lambda seen: seen["total"])
        return F.when(odd == 1, _erfc(F.sqrt(h))).otherwise(0.0) + F.coalesce(F.exp(logs), F.lit(0.0))

    tail = F.when(half == 0, 1.0).otherwise(F.least(F.transform(F.array(half), summed)[0], F.lit(1.0)))
    return F.when((k >= 1) & x.isNotNull() & ~F.isnan(x.cast("double")), tail)


def _erfc(x: Column) -> Column:
    """Complementary error function of positive numbers: a series below 2, a continued fraction above."""
    scale = F.exp(-x * x) / math.sqrt(math.pi)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(60)),
        F.struct(x.alias("term"), x.alias("total")),
        lambda seen, i: F.struct(
            (seen["term"] * x * x * 2.0 / (i * 2 + 1)).alias("term"),
            (seen["total"] + seen["term"] * x * x * 2.0 / (i * 2 + 1)).alias("total"),
        ),
        lambda seen: seen["total"],
    )
    fraction = F.aggregate(F.sequence(F.lit(120), F.lit(1)), x, lambda below, i: x + i / 2.0 / below)
    return F.when(x < 2, 1.0 - 2.0 * scale * series).otherwise(scale / fraction)
