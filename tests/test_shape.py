"""Picks, pivots, rules, harmonising and reports on hand-made frames."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from curata.operators import harmonise, pick, pivot, rules
from curata.operators.pivot import Measure, Range
from curata.reports import checks, completeness, crosstab, quantiles, tableone
from curata.sources import tables


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_first_nonnull_mixes_rows_and_first_row_does_not(spark):
    df = spark.createDataFrame([(1, 1, None, "x"), (1, 2, 5, None), (2, 1, None, None)], "k long, t long, a long, b string")
    assert rows(pick.first_nonnull(df, ["k"], ["t"], ["a", "b"])) == [(1, 5, "x"), (2, None, None)]
    assert rows(pick.first_row(df, ["k"], ["t"]))[0] == (1, 1, None, "x")
    assert rows(pick.last_row(df, ["k"], ["t"]))[0] == (1, 2, 5, None)


def test_consistent_values(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (2, 5.0), (2, 6.0), (3, None), (4, None), (4, 2.0)], "k long, v double")
    assert rows(pick.consistent_values(df, ["k"], "v")) == [(1, 5.0), (3, None), (4, 2.0)]


def test_priority(spark):
    df = spark.createDataFrame([(1, 2, 10.0, None), (1, 1, -1.0, 3.0), (1, 3, 20.0, 4.0), (2, 1, -5.0, None)], "k long, r int, a double, b double")
    got = pick.by_priority(df, ["k"], "r", {"a": F.col("a") > 0, "b": F.col("b") > 0})
    assert rows(got) == [(1, 10.0, 3.0), (2, None, None)]


def test_pivot_ranges_and_alternatives(spark):
    df = spark.createDataFrame([(1, 7, 0.0), (1, 7, 10.0), (1, 8, 98.6), (1, 9, 37.0), (2, 7, 300.0)], "k long, i int, v double")
    measures = [
        Measure("rate", (7,), Range(above=0, below=300)),
        Measure("temp", (8,), Range(above=70, below=120), scale=1.8, shift=32),
        Measure("temp", (9,), Range(above=10, below=50)),
    ]
    got = rows(pivot.pivot_measures(df, ["k"], "i", "v", measures, digits=3))
    assert got == [(1, 10.0, 37.0), (2, None, None)]
    assert pivot.valid_rows(df, "i", "v", measures).count() == 3


def test_bands(spark):
    df = spark.createDataFrame([(5.0,), (4.9,), (1.2,), (0.1,), (None,)], "v double")
    got = [r[0] for r in df.select(rules.bands(F.col("v"), [(">=", 5, 4), (">=", 3.5, 3), (">=", 1.2, 1)])).collect()]
    assert got == [4, 3, 1, 0, None]


def test_patterns_tag_a_row_in_one_reading(spark):
    table = [("%epi%", "e"), ("Nor%", "n"), ("dopa_", "d"), ("%rine", "e")]
    df = spark.createDataFrame([("Norepinephrine",), ("dopax",), ("Dopa",), ("epi",), ("",), (None,)], "t string")
    got = {r.t: (r.one, r.all) for r in df.select("t", rules.first_match(F.col("t"), table).alias("one"), rules.every_match(F.col("t"), table).alias("all")).collect()}
    assert got == {"Norepinephrine": ("e", ["e", "n"]), "dopax": ("d", ["d"]), "Dopa": (None, []), "epi": ("e", ["e"]), "": (None, []), None: (None, [])}
    assert df.select(rules.first_match(F.col("t"), []).alias("x")).where("x is not null").count() == 0


def test_weighted_flags_keep_people_without_facts(spark):
    people = spark.createDataFrame([(1,), (2,), (3,)], "p long")
    facts = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "z")], "p long, f string")
    got = rules.weighted_flags(people, facts, "p", "f", {"x": (6, ["a"]), "y": (2, ["b", "c"])})
    assert rows(got) == [(1, 6, 2), (2, 0, 0), (3, 0, 0)]


def test_map_category(spark):
    df = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "i long, c string")
    mapping = spark.createDataFrame([("a", "A"), ("b", "B")], "o string, m string")
    assert rows(harmonise.map_category(df, "c", mapping, "o", "m", "Unknown")) == [(1, "A"), (2, "Unknown"), (3, "Unknown")]
    assert rows(harmonise.map_category(df, "c", mapping, "o", "m")) == [(1, "A"), (2, None), (3, None)]


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, "___", "x")], "a long, delta_b long, c string, d_todrop string")
    assert harmonise.move_columns(df, {"c": 0}).columns == ["c", "a", "delta_b", "d_todrop"]
    assert harmonise.drop_suffixed(df).columns == ["a", "delta_b", "c"]
    assert harmonise.columns_with_prefix(df, "delta_") == ["delta_b"]
    assert harmonise.columns_containing(df, "_b") == ["delta_b"]
    assert harmonise.rename_by_lists(df, ["a", "zz"], ["A", "ZZ"]).columns[0] == "A"
    assert harmonise.blank_to_null(df).first().c is None
    assert harmonise.cast_columns(df, {"d_todrop": "bigint"}).first().d_todrop is None


def test_union(spark):
    a = spark.createDataFrame([(1, "x")], "id long, s string")
    b = spark.createDataFrame([("u-2", 5.0)], "id string, v double")
    out = harmonise.harmonised_union([a, b])
    assert rows(out) == [("1", "x", None), ("u-2", None, 5.0)]
    assert not harmonise.same_schema([a, b])
    with pytest.raises(ValueError):
        harmonise.harmonised_union([a, b], strict=True)


def test_members(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "a long")
    other = spark.createDataFrame([(1,), (1,), (None,)], "b long")
    assert rows(harmonise.members_of(df, other, {"a": "b"})) == [(1,)]
    # A null among the others must not empty the result.
    assert harmonise.not_members_of(df, other, {"a": "b"}).filter("a = 2").count() == 1


def test_dense_ids(spark):
    rng = random.Random(1)
    data = [(rng.choice("ab"), rng.randint(0, 300), i) for i in range(2000)]
    df = spark.createDataFrame(data, "db string, s long, i long")
    got = {(r.db, r.s): r.code for r in harmonise.dense_ids(df, ["db", "s"], ["db", "s", "i"], "code").collect()}
    assert got == {k: n for n, k in enumerate(sorted({(d, s) for d, s, _ in data}))}
    wrapped = harmonise.dense_ids(df, ["db", "s"], ["db", "s", "i"], "code", modulo=10)
    assert wrapped.agg(F.max("code")).first()[0] == 9


def test_quantiles_and_ranks(spark):
    rng = random.Random(5)
    data = [(g, rng.choice([0.0, -3.5, 1e-9, rng.uniform(-50, 1e6), float(rng.randint(0, 5))])) for g in "xyz" for _ in range(301)]
    data += [("one", 4.0), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r.g: r for r in quantiles.exact_quantiles(df, ["g"], "v", tableone.QUARTILES).collect()}
    assert set(got) == {"x", "y", "z", "one"}
    for g in "xyz":
        q = statistics.quantiles([v for k, v in data if k == g], n=4, method="inclusive")
        assert [got[g].q1, got[g].median, got[g].q3] == pytest.approx(q)
    assert got["one"].median == 4.0


def test_kruskal_and_chi(spark):
    # Worked by hand: three groups of three without ties give ranks 1-3, 4-6, 7-9 and H = 7.2.
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 4.0), ("b", 5.0), ("b", 6.0), ("c", 7.0), ("c", 8.0), ("c", 9.0)], "g string, v double")
    k = tableone.kruskal_wallis(df, "g", ["v"]).first()
    assert (round(k.h, 9), k.dof) == (7.2, 2)
    assert k.p_value == pytest.approx(math.exp(-3.6))
    cells = [("a", "u")] * 10 + [("a", "w")] * 20 + [("b", "u")] * 30 + [("b", "w")] * 5
    c = tableone.chi_square(spark.createDataFrame(cells, "g string, v string"), "g", ["v"]).first()
    n, expected = 65, {("a", "u"): 30 * 40 / 65, ("a", "w"): 30 * 25 / 65, ("b", "u"): 35 * 40 / 65, ("b", "w"): 35 * 25 / 65}
    want = sum((cells.count(k) - e) ** 2 / e for k, e in expected.items())
    assert c.chi2 == pytest.approx(want) and c.dof == 1 and n == len(cells)
    assert c.p_value == pytest.approx(math.erfc(math.sqrt(want / 2)))


def test_tables_of_strata(spark):
    df = spark.createDataFrame([("g", 1.0, "x"), ("g", None, "x"), ("g", 3.0, None), ("h", None, "y")], "s string, n double, c string")
    cont = {r.s: r for r in tableone.describe_continuous(df, "s", ["n"]).collect()}
    assert (cont["g"].rows, cont["g"].missing, cont["g"].median) == (3, 1, 2.0)
    assert (cont["h"].missing, cont["h"].median) == (1, None)
    assert rows(tableone.describe_categorical(df, "s", ["c"])) == [("c", "g", "x", 2, 100.0), ("c", "h", "y", 1, 100.0)]


def test_completeness(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 3.0, "a"), (None, None, "b")], "x long, y double, g string")
    got = {r.column: (r.present, r.missing) for r in completeness.completeness(df, ["x", "y"]).collect()}
    assert got == {"x": (2, 1), "y": (1, 2)}
    grouped = completeness.completeness(df, ["x"], ["g"])
    assert {r.g: r.share for r in grouped.collect()} == {"a": 1.0, "b": 0.0}
    assert [r.present for r in completeness.with_present_count(df, ["x", "y"]).collect()] == [1, 2, 0]
    assert tuple(checks.null_counts(df, ["x", "y"]).first()) == (1, 2)
    assert not checks.key_check(df, ["g"], "t").first().one_row_per_key


def test_crosstab(spark):
    df = spark.createDataFrame([("A", 0), ("A", 1), ("B", 1), ("Unknown", 1), ("Unknown", 1), ("Unknown", 1), (None, 1), ("A", None)], "r string, s int")
    got = {(r.r, r.s): r.pct for r in crosstab.crosstab_percent(df, "r", "s").collect()}
    assert got == {("A", 0): 16.67, ("A", 1): 16.67, ("B", 1): 16.67, ("Unknown", 1): 50.0}
    wide = crosstab.crosstab_wide(df, "r", "s", [0, 1]).orderBy("place").collect()
    assert [(r.r, r.pct_0, r.pct_1) for r in wide] == [("A", 16.67, 16.67), ("B", 0.0, 16.67), ("Unknown", 0.0, 50.0)]


def test_funnel(spark):
    df = spark.createDataFrame([(1, -10), (1, -3), (2, -80), (3, -1)], "p long, d int")
    got = crosstab.funnel_counts(df, "p", {"all": F.lit(True), "strict": F.col("d") >= -5, "none": F.lit(False)})
    assert rows(got) == [(0, "all", 4, 3), (1, "strict", 2, 2), (2, "none", 0, 0)]


def test_sources_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i long, s string")
    path = tables.table_path(str(tmp_path), "pairs", "one")
    assert rows(tables.write_table(df, path)) == rows(df)
    written = tables.write_tables({"t1": df, "t2": df.limit(1)}, str(tmp_path), "set")
    assert spark.read.parquet(written["t1"]).count() == 2
    tables.write_table(df.limit(1), path)  # a second write replaces the first
    assert spark.read.parquet(path).count() == 1
    tables.write_csv(df, f"{tmp_path}/out")
    assert rows(tables.read_csv(spark, f"{tmp_path}/out", "i long, s string")) == rows(df)
    assert tables.query(spark, "select count(*) as n from {d}", d=df).first().n == 2


def test_variable_config_from_csv(spark, tmp_path):
    from curata.operators.nearest import CONFIG_SCHEMA, Covariate

    text = "var_type,var_name,var_new_name,var_window_low_hr,var_window_upper_hr,var_source_table,var_foreign_key,var_timestamp\n"
    (tmp_path / "v.csv").write_text(text + "vitals,hr,heart_rate,-24,0,db.vitals,stay_id,charttime\n")
    config = [Covariate.from_config(r) for r in tables.read_csv(spark, str(tmp_path / "v.csv"), CONFIG_SCHEMA).collect()]
    assert config == [Covariate("vitals_heart_rate", "hr", "db.vitals", "stay_id", "charttime", -24.0, 0.0)]


def test_table_one_with_tests(spark):
    df = spark.createDataFrame([("g", 1.0, "x"), ("g", 2.0, None), ("h", 3.0, "y"), ("h", None, "x")], "s string, n double, c string")
    got = {(r.variable, r.level, r.s): r for r in tableone.table_one(df, "s", ["c"], ["n"], tests=True).collect()}
    assert set(got) == {("n", None, "g"), ("n", None, "h"), ("c", "x", "g"), ("c", "x", "h"), ("c", "y", "h")}
    n = got["n", None, "h"]
    assert (n.n, n.missing, n.median, n.test) == (1, 1, 3.0, "Kruskal-Wallis") and 0 < n.p_value < 1
    c = got["c", "x", "g"]
    assert (c.n, c.missing, c.pct, c.test) == (1, 1, 100.0, "Chi-squared")


def test_config_is_checked_as_data(spark):
    from curata.operators import config, nearest

    a = spark.createDataFrame([], "k long, t timestamp_ntz, m int, v double")
    lines = [
        ("x", "v", "good", -1.0, 1.0, "a", "k", "t"), ("x", "v", "point", 0.0, 0.0, "a", "k", "t"), ("x", "w", "a", -1.0, 1.0, "a", "k", "t"),
        ("x", "v", "b", 2.0, 1.0, "a", "kk", "m"), (None, "v", None, None, None, None, None, None), ("y", "v", "c", 0.0, 1.0, "a", "k", "tt"),
    ]
    df = spark.createDataFrame(lines, nearest.CONFIG_SCHEMA)
    found = config.checked(df, {"a": a}, a.schema["t"].dataType)
    assert [c.name for c in config.covariates(found)] == ["x_good", "x_point"]
    got = {(r.name, r.reason) for r in config.findings(found).collect()}
    assert got == {
        ("x_a", "unknown column"), ("x_b", "reversed window"), ("x_b", "unknown key"), ("x_b", "time on another clock"),
        ("", "unknown source"), ("", "no window"), ("", "no name"), ("y_c", "unknown time"),
    }
    assert config.covariates(config.checked(df.limit(0), {"a": a}, a.schema["t"].dataType)) == []
