"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, folder: str, name: str, schema: StructType | None = None) -> DataFrame:
    """A table of a folder; with its schema known, its files are not asked for it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV file with a header and a declared schema (variable config, category mapping)."""
    return spark.read.csv(path, header=True, schema=schema)


def query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """SQL text over named frames, as a lazy frame."""
    return spark.sql(sql, **frames)


def table_path(root: str, dataset: str, table: str) -> str:
    return f"{root.rstrip('/')}/{dataset}/{table}"


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path`` and return it as read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_tables(frames: Mapping[str, DataFrame], root: str, dataset: str) -> dict[str, str]:
    """Replace one table per entry; returns the paths."""
    paths = {name: table_path(root, dataset, name) for name in frames}
    for name, frame in frames.items():
        frame.write.mode("overwrite").parquet(paths[name])
    return paths


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, one file per partition; also the sink for report tables."""
    df.write.mode("overwrite").option("header", True).csv(path)
