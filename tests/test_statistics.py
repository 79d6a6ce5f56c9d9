"""Tails, quantiles, scans over nulls and settled stages, each against a direct version."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from curata.operators.scan import numbered, ordered_scan
from curata.reports import quantiles, tableone
from curata.reports.quantiles import exact_quantiles
from curata.session import ensure_checkpoint_dir, settle, stages


def tail_by_logs(x, k):
    """Q(k/2, x/2) by summing its terms in logarithms."""
    h, odd = x / 2, k % 2
    logs = [-h + (i + odd / 2) * math.log(h) - math.lgamma(i + 1 + odd / 2) for i in range(k // 2)] if h else []
    high = max(logs, default=0)
    total = math.exp(high) * math.fsum(math.exp(t - high) for t in logs) if logs else 0
    return 1.0 if not h else min(1.0, total + (math.erfc(math.sqrt(h)) if odd else 0))


def test_chi_square_tail(spark):
    cases = [(x, k) for x in (0.0, 1e-6, 0.3, 1.0, 4.2, 9.0, 40.0, 300.0) for k in (1, 2, 3, 8, 9, 101)]
    cases += [(1900.0, 2000), (1500.0, 1600), (1900.0, 2001), (2500.0, 2000), (1e5, 100_001)]
    got = spark.createDataFrame(cases, "x double, k long").select("x", "k", tableone.chi2_tail("x", "k").alias("p")).collect()
    for r in got:
        assert r.p == pytest.approx(tail_by_logs(r.x, r.k), rel=1e-6, abs=1e-14), r
    none = spark.createDataFrame([(1.0, 0), (None, 3), (float("nan"), 2)], "x double, k long")
    assert {r.p for r in none.select(tableone.chi2_tail("x", "k").alias("p")).collect()} == {None}


def test_no_difference_is_not_reported_as_certain(spark):
    rows = spark.range(20_000).select((F.xxhash64("id", F.lit(1)) % 2).alias("g"), (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(2_000))).alias("v"))
    p = tableone.chi_square(rows, "g", ["v"]).first().p_value
    assert 0.001 < p < 0.999


def test_quantiles_leave_nan_out(spark):
    rows = [(x,) for x in (1.0, 2.0, 3.0, 1000.0, 2000.0, float("nan"), None)]
    df = spark.createDataFrame(rows, "v double")
    got = exact_quantiles(df, [], "v", {"median": 0.5, "high": 0.8}).first()
    assert (got.n, got.median, got.high) == (5, 3.0, pytest.approx(1200.0))
    assert tableone.describe_numbers(df, ["v"]).first().median == 3.0


@pytest.mark.parametrize("cells,few", [(1 << 10, 10_000), (16, 10_000), (64, 0)])
def test_selection_by_narrowing(spark, monkeypatch, cells, few):
    monkeypatch.setattr(quantiles, "CELLS", cells)
    monkeypatch.setattr(quantiles, "FEW", few)
    monkeypatch.setattr(quantiles, "PLAIN", 40 if cells == 16 else 0)
    rng = random.Random(cells)
    columns = {
        "even": [float(i) for i in range(200)], "ties": [float(rng.randrange(4)) for _ in range(99)], "one": [7.5], "same": [1.0] * 30,
        "wide": [1e308, -1e308, 5e-324, 0.0, -0.0, 1e-300, 3.0, 3.0], "skewed": [2.0**-i for i in range(20)], None: [rng.gauss(0, 1) for _ in range(150)],
    }
    rows = [(k, x) for k, values in columns.items() for x in [*values, None, float("nan")]] + [("none", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", {"low": 0.1, "median": 0.5, "top": 1.0}).collect()}
    assert got.keys() == columns.keys()
    for k, values in columns.items():
        values = sorted(values)
        for name, p in (("low", 0.1), ("median", 0.5), ("top", 1.0)):
            at = p * (len(values) - 1)
            a, b = values[math.floor(at)], values[math.ceil(at)]
            assert got[k][name] == pytest.approx(a + (b - a) * (at - math.floor(at))), (k, name)
        assert got[k].n == len(values)


def test_order_statistics_keep_their_type(spark):
    df = spark.createDataFrame([(2**53 + i,) for i in range(9)], "v long")
    rows = quantiles.order_statistics(df, [], "v", lambda n: [F.lit(0), n - 1, F.lit(4)]).collect()
    assert {(r["rank"], r["value"]) for r in rows} == {(0, 2**53), (4, 2**53 + 4), (8, 2**53 + 8)}


@pytest.mark.parametrize("width", [1, 1440, 100_000])
def test_nulls_do_not_depend_on_the_chunk(spark, width):
    rows = [(None, 5, 3.0, 1), (None, 2000, None, 2), (1, None, 7.0, 3), (1, 10, None, 4), (1, 5000, None, 5), (2, 3, None, 6)]
    df = spark.createDataFrame(rows, "k long, t long, v double, id long")
    out = ordered_scan(df, ["k"], ["t", "id"], F.floor(F.col("t") / width), upto={"seen": F.col("v")}, running={"n": F.lit(1)}, total={"all": F.lit(1)})
    assert sorted((r.id, r.seen, r.n, r["all"]) for r in out.collect()) == [
        (1, 3.0, 1, 2), (2, 3.0, 2, 2), (3, 7.0, 1, 3), (4, 7.0, 2, 3), (5, 7.0, 3, 3), (6, None, 1, 1),
    ]


def test_numbered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(7)
    assert all(r.x == r.place for r in numbered(df, ["x"], "place").collect())


def test_stages_leave_nothing_behind(spark):
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with stages():
        assert settle(spark.range(5)).count() == 5
        assert set(os.listdir(folder)) - before
    assert set(os.listdir(folder)) == before


def exact_by_fractions(a, row, column, everything):
    """Two-sided, with whole numbers."""
    ways = {k: math.comb(column, k) * math.comb(everything - column, row - k) for k in range(max(0, row + column - everything), min(row, column) + 1)}
    return sum(w for w in ways.values() if w <= ways[a]) / sum(ways.values())


def test_exact_test(spark):
    cases = [(3, 5, 4, 20), (0, 1, 3, 9), (1, 9, 11, 24), (0, 0, 3, 9), (2, 2, 2, 2), (0, 40, 30, 900), (30, 60, 31, 3000), (5, 10, 10, 20), (1, 3, 50_000, 100_000)]
    df = spark.createDataFrame([tuple(map(float, c)) for c in cases], "a double, r double, c double, n double")
    got = df.select("*", tableone.fisher_exact(*[F.col(x) for x in "arcn"]).alias("p")).collect()
    for r in got:
        assert r.p == pytest.approx(exact_by_fractions(int(r.a), int(r.r), int(r.c), int(r.n)), rel=1e-7), r


def test_log_factorials(spark):
    ns = [0, 1, 2, 20, 21, 50, 171, 10**4, 10**9]
    got = spark.createDataFrame([(float(n),) for n in ns], "n double").select("n", tableone.log_factorial(F.col("n")).alias("f")).collect()
    for r in got:
        assert r.f == pytest.approx(math.lgamma(r.n + 1), rel=1e-13, abs=1e-12)


def test_the_counts_choose_the_test(spark):
    rows = [("x", i % 10 == 0, i % 2) for i in range(20)] + [("y", None, 1)] + [("y", i % 7 == 0, i % 2) for i in range(18)]
    rows += [(None, True, 0)]
    df = spark.createDataFrame(rows, "g string, rare boolean, half int").withColumn("same", F.lit("all"))
    got = {r.variable: r for r in tableone.association(df, "g", ["rare", "half", "same"]).collect()}
    assert got["rare"].test == "Fisher's exact" and got["half"].test == got["same"].test == "Chi-squared"
    assert got["rare"].p_value == pytest.approx(exact_by_fractions(15, 33, 18, 38)) and got["same"].p_value is None
