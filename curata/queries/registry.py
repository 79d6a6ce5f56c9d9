"""Named queries over the test tables, each with the SQL that states its expected result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from curata.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of one folder; the files of a table are asked for its schema once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.schemas: dict[str, StructType] = {}

    def __getattr__(self, name: str) -> DataFrame:
        rows = read_table(self.spark, self.folder, name, self.schemas.get(name))
        self.schemas.setdefault(name, rows.schema)
        return rows


def query(sql: str | None = None):
    """Register a function of ``Tables`` under its name, with its SQL where there is one."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
        if sql:
            SQL[build.__name__] = sql
        return build

    return register


def rounded(column: Column | str, digits: int = 6) -> Column:
    return F.round(column, digits)
