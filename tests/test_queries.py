"""Every query of the reports and series against its SQL, on the smallest tables; the others have tests of their own."""

import os

import pytest
from harness import duck, duck_result, spark_result

import __spark_entry__ as entry
from curata.queries import registry
from curata.session import ensure_checkpoint_dir, stages

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def left_over(spark) -> set[str]:
    """What lies in the shared folder besides the report store, which outlives its queries."""
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {n for n in os.listdir(folder) if n != "store"}


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, con, name):
    before = left_over(spark)
    with stages():
        names, rows = spark_result(entry.queries()[name](spark, FOLDER))
    assert left_over(spark) == before
    if name not in SQL:
        assert rows
        return
    want_names, want = duck_result(con, SQL[name])
    assert names == want_names
    assert rows == want


def test_every_sql_has_its_query():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
