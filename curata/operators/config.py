"""The variable config checked as data: good lines become covariates, the others come out with their reasons."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from curata.operators.nearest import Covariate

CLOCKS = ("timestamp", "timestamp_ntz", "int", "bigint", "smallint")


def schema_rows(spark: SparkSession, sources: Mapping[str, DataFrame]) -> DataFrame:
    """``source, column, kind`` of every column of every source."""
    rows = [(name, f.name, f.dataType.simpleString()) for name, df in sources.items() for f in df.schema.fields]
    return spark.createDataFrame(rows, "source string, column string, kind string")


def checked(config: DataFrame, sources: Mapping[str, DataFrame], anchor: T.DataType) -> DataFrame:
    """``config`` with ``name`` and ``reasons``, the array of what is wrong with a line (empty if nothing is).

    A line must name a source and columns that it has, a time on the anchor's clock, a window that does not end before it begins, and no name that another
    line has too. Lines meet the schemas in joins, so a config of any length is checked at once.
    """
    name = F.concat_ws("_", "var_type", "var_new_name")
    lines = config.withColumn("name", name)
    schemas = schema_rows(config.sparkSession, sources)
    named = schemas.groupBy(F.col("source").alias("__s")).agg(F.map_from_entries(F.collect_list(F.struct("column", "kind"))).alias("__has"))
    uses = lines.groupBy(F.col("name").alias("__n")).agg(F.count(F.lit(1)).alias("__uses"))
    met = lines.join(named, F.col("var_source_table") == F.col("__s"), "left").join(uses, F.col("name") == F.col("__n"), "left")
    has = F.col("__has")
    wall = anchor.simpleString().startswith("timestamp")
    clock = F.try_element_at(has, F.col("var_timestamp"))
    fits = clock.isin(*[k for k in CLOCKS if k.startswith("timestamp") == wall])

    def without(column: str) -> Column:
        return has.isNotNull() & F.try_element_at(has, F.col(column)).isNull()

    reasons = {
        "unknown source": has.isNull(),
        "unknown column": without("var_name"),
        "unknown key": without("var_foreign_key"),
        "unknown time": without("var_timestamp"),
        "time on another clock": clock.isNotNull() & ~fits,
        "no window": F.col("var_window_low_hr").isNull() | F.col("var_window_upper_hr").isNull(),
        "reversed window": F.col("var_window_low_hr") > F.col("var_window_upper_hr"),
        "repeated name": F.col("__uses") > 1,
        "no name": (F.col("var_type").isNull()) | (F.col("var_new_name").isNull()),
    }
    found = F.array(*[F.when(F.coalesce(wrong, F.lit(False)), F.lit(text)) for text, wrong in reasons.items()])
    return met.select(*lines.columns, F.filter(found, lambda x: x.isNotNull()).alias("reasons"))


def findings(lines: DataFrame) -> DataFrame:
    """A row for each reason of each line that has any."""
    return lines.select("name", "var_source_table", "var_name", F.explode("reasons").alias("reason"))


def covariates(lines: DataFrame) -> list[Covariate]:
    """The good lines, by name; as many as the config has."""
    return [Covariate.from_config(r) for r in lines.where(F.size("reasons") == 0).orderBy("name").collect()]
