"""On/off state events to episodes with a start and an end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from curata.operators.scan import ordered_scan


def state_changes(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, flag: str, name: str = "change"
) -> DataFrame:
    """``name``: flag minus the previous flag (-1, 0, 1), null on a key's first row."""
    scan = ordered_scan(df, keys, order, chunk, before={"__was": F.struct(F.col(flag).alias("flag"))})
    return scan.select(*df.columns, (F.col(flag) - F.col("__was.flag")).alias(name))


def from_first_on(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, flag: str) -> DataFrame:
    """Rows from the first on-row of their key; keys never on disappear."""
    scan = ordered_scan(df, keys, order, chunk, upto={"__on": F.when(F.col(flag) == 1, F.lit(1))})
    return scan.filter(F.col("__on").isNotNull()).select(*df.columns)


def run_episodes(
    df: DataFrame, keys: Sequence[str], time: str, order: Sequence[str], chunk: Column, flag: str
) -> DataFrame:
    """Each run of consecutive on-rows as one row.

    ``start`` is the run's first time, ``last_on`` its last, ``end`` the time of the off-row that
    closes it (null when nothing follows), ``n`` the number of on-rows. A run is named by the place of
    the off-row before it, so one scan in both directions is enough and the runs combine before
    their shuffle.
    """
    off = F.when(F.col(flag) == 0, F.struct(*order))
    scan = ordered_scan(
        df,
        keys,
        order,
        chunk,
        before={"__run": off},
        after={"__closed": F.when(F.col(flag) == 0, F.col(time))},
    )
    return (
        scan.filter(F.col(flag) == 1)
        .groupBy(*keys, "__run")
        .agg(
            F.min(time).alias("start"),
            F.max(time).alias("last_on"),
            F.min("__closed").alias("end"),
            F.count(F.lit(1)).alias("n"),
        )
        .drop("__run")
    )


def paired_endpoints(
    df: DataFrame, keys: Sequence[str], time: str, order: Sequence[str], chunk: Column, flag: str
) -> DataFrame:
    """Episodes by pairing ordered endpoints: the odd one opens, the next one closes.

    Endpoints are the times of on-rows that have a successor and the times of those successors. A run
    of several on-rows yields interior endpoints, so it splits: on, on, off at 10, 20, 30 gives
    (10, 20) and drops the rest, where ``run_episodes`` gives (10, 30).
    """
    scan = ordered_scan(df, keys, order, chunk, after={"__next": F.col(time)})
    ends = (
        scan.filter((F.col(flag) == 1) & F.col("__next").isNotNull())
        .select(*keys, F.explode(F.array(F.col(time), F.col("__next"))).alias(time))
        .distinct()
    )
    numbered = ordered_scan(
        ends, keys, [time], chunk, running={"__nr": F.lit(1)}, after={"end": F.col(time)}
    )
    return numbered.filter((F.col("__nr") % 2 == 1) & F.col("end").isNotNull()).select(
        *keys, F.col(time).alias("start"), "end"
    )


def ranked_endpoints(
    df: DataFrame, keys: Sequence[str], time: str, order: Sequence[str], chunk: Column, flag: str
) -> DataFrame:
    """Episodes by pairing two streams from their ends: the last start with the last end, the one before with the one before.

    Starts are the first times of the runs of on-rows, ends the last times of the runs of off-rows. Both are numbered from the end of the
    key, as the total less what runs up to a row, in one scan; a number without a partner in the other stream is left out. A key that ends on
    pairs its open start with an earlier end: the literal form, which ``run_episodes`` replaces.
    """
    row = F.struct(F.col(flag).alias("flag"))
    edges = ordered_scan(df, keys, order, chunk, before={"__was": row}, after={"__then": row})
    first_on = (F.col(flag) == 1) & (F.col("__was").isNull() | (F.col("__was.flag") == 0))
    last_off = (F.col(flag) == 0) & (F.col("__then").isNull() | (F.col("__then.flag") == 1))
    edges = edges.filter(first_on | last_off).select(*df.columns)
    streams = {f"__{flag_}": F.when(F.col(flag) == flag_, F.lit(1)).otherwise(0) for flag_ in (0, 1)}
    numbered = ordered_scan(edges, keys, order, chunk, running=streams, total={f"{n}_of": e for n, e in streams.items()})
    rank = F.when(F.col(flag) == 1, F.col("__1_of") - F.col("__1")).otherwise(F.col("__0_of") - F.col("__0"))
    pairs = numbered.withColumn("__rank", rank).groupBy(*keys, "__rank").agg(
        F.max(F.when(F.col(flag) == 1, F.col(time))).alias("start"), F.max(F.when(F.col(flag) == 0, F.col(time))).alias("end")
    )
    return pairs.filter(F.col("start").isNotNull() & F.col("end").isNotNull()).drop("__rank")


def with_end_markers(
    df: DataFrame, keys: Sequence[str], time: str, order: Sequence[str], flag: str, minutes: int
) -> DataFrame:
    """Append an off-row ``minutes`` after the last row of each key that ends on.

    Appended rows carry ``synthetic`` = 1. The last rows come from an aggregate.
    """
    ends = (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("__row"))
        .select("__row.*")
        .filter(F.col(flag) == 1)
    )
    numeric = dict(df.dtypes)[time] in ("int", "bigint")
    later = F.col(time) + F.lit(minutes) if numeric else F.timestamp_add("MINUTE", F.lit(minutes), F.col(time))
    added = ends.withColumns({time: later, flag: F.lit(0).cast(dict(df.dtypes)[flag])})
    return df.withColumn("synthetic", F.lit(0)).unionByName(added.withColumn("synthetic", F.lit(1)))


def rows_before_event(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, rows: Column, event: Column
) -> DataFrame:
    """Rows that satisfy ``rows`` and are followed, anywhere later in their key, by an ``event`` row."""
    scan = ordered_scan(df, keys, order, chunk, after={"__event": F.when(event, F.lit(1))})
    return scan.filter(rows & F.col("__event").isNotNull()).select(*df.columns)
