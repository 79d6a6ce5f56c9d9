"""What the physical plans must and must not contain."""

import re

import pytest

from curata.queries import registry
import __spark_entry__  # noqa: F401
from curata.session import stages

FOLDER = "/root/testdata/sf0.001"

NAMES = sorted(registry.QUERIES)
PLANS = {}


def plan(spark, name):
    if name not in PLANS:
        with stages():
            df = registry.QUERIES[name](spark, FOLDER)
            PLANS[name] = df._jdf.queryExecution().executedPlan().toString()
    return PLANS[name]


def below(lines, i):
    """The first operator under line ``i`` that is not a mere projection or sort."""
    for line in lines[i + 1 :]:
        operator = line.lstrip(" :+-*()0123456789")
        if not operator.startswith(("Project", "Sort", "Filter")):
            return line
    return ""


@pytest.mark.parametrize("name", NAMES)
def test_no_all_pairs_and_no_single_task(spark, name):
    """One task may only get what is combined to a row per task or per sort partition."""
    text = plan(spark, name)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            source = below(lines, i)
            assert "partial_" in source or "__part" in source or "functions=[]" in source, (line, source)


@pytest.mark.parametrize("name", ["asof_backward_pairs", "locf_nocb_fill", "state_change_detection", "covariate_attach"])
def test_windows_over_rows_are_cut_by_chunk(spark, name):
    """A window on a key alone may only run over the one-row-per-chunk summaries."""
    windows = [line for line in plan(spark, name).splitlines() if "windowspecdefinition" in line]
    over_rows = [line for line in windows if "__c_" not in line]
    assert over_rows
    for line in over_rows:
        assert "__chunk" in line.split("windowspecdefinition")[1]


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "asof_backward_pairs")
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    assert scans
    for line in scans:
        assert "EqualTo(event_type," in line
        read = re.search(r"ReadSchema: struct<([^>]*)>", line).group(1)
        assert "props" not in read


def test_aggregates_combine_before_their_shuffle(spark):
    text = plan(spark, "lab_last_revision")
    assert text.count("partial_") >= 3


def test_anti_join_is_not_null_aware(spark):
    assert "isNullAwareAntiJoin=true" not in plan(spark, "anti_filter")


def test_the_rates_of_all_drugs_come_from_one_scan(spark):
    from curata.plans import infusions
    from curata.queries.derived import derived
    from curata.queries.registry import Tables

    log = derived(Tables(spark, FOLDER), "infusion_log")
    rates = infusions.numeric_rates(log, infusions.VASOACTIVE)
    assert rates._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1


def test_covariate_values_move_once_per_key(spark):
    """Of the exchanges of a wide attach, the one by key and chunk alone carries values."""
    from curata.operators.nearest import attach_covariates
    from curata.queries import final
    from curata.queries.derived import derived
    from curata.queries.registry import Tables

    t = Tables(spark, FOLDER)
    pairs = spark.createDataFrame([(1, 10, None)], "subject_id long, stay_id long, at timestamp_ntz")
    members = [c for c in final.covariates("timed_a") if c.source != "severity"]
    tables = {"vitals": derived(t, "cov_vitals"), "labs": derived(t, "cov_labs")}
    wide = attach_covariates(pairs, "at", members, tables)
    text = wide._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "__chunk" in line]
    assert len(members) == 41 and len(moved) == len({c.key for c in members}) == 2
    assert text.count("FileScan parquet") == 2
