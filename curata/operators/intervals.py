"""Stays and other intervals: fuzzy boundaries and interval joins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from curata.functions.clock import Clock, shift_seconds
from curata.operators.scan import ordered_scan
from curata.session import FILE_ROWS, once, settle

#: Intervals of 2 ** 36 minutes or more share a level, where they may touch more cells than two.
MOST_LEVEL = 36
#: Neighbouring levels that share the highest of them: a row looks once for all, in cells up to 2 ** SHARED times as long as an interval.
SHARED = 4


def fuzzy_bounds(
    stays: DataFrame,
    *,
    subject: str,
    stay: str,
    start: str,
    end: str,
    near_hours: float = 24,
    pad_hours: float = 12,
    chunk_minutes: float = 30 * 1440,
) -> DataFrame:
    """Widen each stay to catch measurements taken shortly outside it.

    Toward a neighbouring stay closer than ``near_hours`` the boundary is halfway between the two
    (overlapping stays give a negative gap and are cut at the middle of the overlap); otherwise it
    is ``pad_hours`` away. Adds ``data_start`` and ``data_end``.
    """
    clock = Clock.of(stays, start)
    near = round(near_hours * 3600)
    pad = round(pad_hours * 3600)
    scan = ordered_scan(
        stays,
        [subject],
        [start, stay],
        clock.bucket(clock.axis(start), chunk_minutes),
        before={"__prev_end": F.struct(F.col(end).alias("at"))},
        after={"__next_start": F.struct(F.col(start).alias("at"))},
    )
    previous, following = F.col("__prev_end.at"), F.col("__next_start.at")
    gap_before = F.timestamp_diff("SECOND", previous, F.col(start))
    gap_after = F.timestamp_diff("SECOND", F.col(end), following)
    half_before = F.round(gap_before / F.lit(2.0)).cast("long")
    half_after = F.round(gap_after / F.lit(2.0)).cast("long")
    back = F.when(previous > shift_seconds(F.col(start), F.lit(-near)), half_before).otherwise(F.lit(pad))
    forth = F.when(following < shift_seconds(F.col(end), F.lit(near)), half_after).otherwise(F.lit(pad))
    return scan.select(
        *stays.columns,
        shift_seconds(F.col(start), -back).alias("data_start"),
        shift_seconds(F.col(end), forth).alias("data_end"),
    )


@dataclass(frozen=True)
class Spans:
    """Intervals of one kind: a frame, the columns of their bounds, and the columns a row inside takes over.

    ``closed`` is "left" for [start, end) or "both" for [start, end]. Intervals that end before they start hold nothing.
    """

    frame: DataFrame
    start: str
    end: str
    columns: Sequence[str]
    closed: str = "both"


def _levelled(kinds: Sequence[Spans], keys: Sequence[str], clock: Clock) -> DataFrame:
    """All intervals with their level, the smallest power of two of minutes above their length."""
    parts = []
    for i, kind in enumerate(kinds):
        at = Clock.of(kind.frame, kind.start)
        low, high = at.axis(kind.start), at.axis(kind.end)
        high = high - 1 if kind.closed == "left" else high
        taken = [F.struct(*k.columns).alias(f"__in{j}") for j, k in enumerate(kinds) if j == i]
        parts.append(
            kind.frame.select(*[F.col(k).alias(f"__r_{k}") for k in keys], F.lit(i).alias("__kind"), low.alias("__low"), high.alias("__high"), *taken)
            .filter(F.col("__low") <= F.col("__high"))
        )
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    minutes = F.floor((F.col("__high") - F.col("__low")) / F.lit(clock.units_per_minute)).cast("long")
    return stacked.withColumn("__r_level", F.least(F.length(F.bin(minutes)), F.lit(MOST_LEVEL)))


def _in_cells(levelled: DataFrame, clock: Clock, top: int) -> DataFrame:
    """Intervals in the cells of their level, of which ``SHARED`` share the highest, counted from the top level.

    Cells are longer than an interval, so it touches two at most, also if its end is a far date that stands for an open one.
    """
    shared = F.lit(top) - F.lit(SHARED) * F.floor((F.lit(top) - F.col("__r_level")) / F.lit(SHARED)).cast("int")
    levelled = levelled.withColumn("__r_level", shared.cast("int"))
    cells = F.sequence(_cell(clock, F.col("__low"), F.col("__r_level")), _cell(clock, F.col("__high"), F.col("__r_level")))
    return levelled.withColumn("__r_cell", F.explode(cells))


def _cell(clock: Clock, axis: Column, level: Column) -> Column:
    width = F.call_function("shiftleft", F.lit(clock.units_per_minute).cast("long"), level)
    return F.floor(axis / width).cast("long")


def _at_levels(rows: DataFrame, axis: Column, clock: Clock, levels: Sequence[int]) -> DataFrame:
    """A copy of each row for every level that occurs, with its cell there."""
    places = [F.struct(F.lit(n).alias("level"), _cell(clock, axis, F.lit(n)).alias("cell")) for n in levels]
    if len(places) == 1:
        return rows.withColumn("__p", places[0])
    return rows.withColumn("__p", F.explode(F.array(*places)))


def attach_intervals(left: DataFrame, kinds: Sequence[Spans], *, keys: Sequence[str], time: str, how: str = "left") -> DataFrame:
    """Rows of ``left`` with the intervals of every kind that contain their time.

    A row inside several intervals comes once for each, and once for each pair if they are of two kinds; with "left" a row inside none
    keeps nulls, with "inner" (one kind) it goes. All kinds share one equi-join on (key, level, cell) between the instants that
    occur and the intervals; what it finds comes back to the rows on (key, time), where ``left`` moves once for all kinds. With "inner" rows go into the
    join themselves. Runs a job for the levels that occur (64 at most).
    """
    if how == "inner" and len(kinds) != 1:
        raise ValueError("an inner join takes one kind of intervals")
    clock = Clock.of(left, time)
    spans = settle(_levelled(kinds, keys, clock), FILE_ROWS)
    occur = [r[0] for r in spans.select("__r_level").distinct().collect()] or [1]
    spans = _in_cells(spans, clock, max(occur))
    levels = sorted({max(occur) - SHARED * ((max(occur) - n) // SHARED) for n in occur})
    inside = F.col("__axis").between(F.col("__low"), F.col("__high"))
    match = inside & (F.col("__p.level") == F.col("__r_level")) & (F.col("__p.cell") == F.col("__r_cell"))
    match = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__r_{k}") for k in keys], match)
    taken = [F.col(f"__in{i}.{c}").alias(c) for i, kind in enumerate(kinds) for c in kind.columns]
    if how == "inner" or (len(kinds) == 1 and len(levels) == 1):
        placed = _at_levels(left.withColumn("__axis", clock.axis(time)), F.col("__axis"), clock, levels)
        return placed.join(spans, match, how).select(*left.columns, *taken)

    left = once(left)  # read for its rows and for its instants
    instants = left.select(*keys, clock.axis(time).alias("__axis")).dropna().distinct()
    found = _at_levels(instants, F.col("__axis"), clock, levels).join(spans, match)
    hits = [F.col(f"__in{i}") for i in range(len(kinds))]
    found = found.select(*[F.col(k).alias(f"__r_{k}") for k in keys], F.col("__axis").alias("__r_axis"), "__kind", *hits)
    found = settle(found, FILE_ROWS) if len(kinds) > 1 else found
    out = left.withColumn("__axis", clock.axis(time))
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__r_{k}") for k in keys], F.col("__axis") == F.col("__r_axis"))
    for i in range(len(kinds)):
        mine = found.filter(F.col("__kind") == i).select(*[f"__r_{k}" for k in keys], "__r_axis", f"__in{i}")
        out = out.join(mine, same, "left").drop(*[f"__r_{k}" for k in keys], "__r_axis")
    return out.select(*left.columns, *taken)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    *,
    keys: Sequence[str],
    time: str,
    start: str,
    end: str,
    right_columns: Sequence[str],
    closed: str = "both",
    how: str = "left",
) -> DataFrame:
    """Rows of ``left`` with the intervals of ``right`` that contain their time; see ``attach_intervals``."""
    return attach_intervals(left, [Spans(right, start, end, right_columns, closed)], keys=keys, time=time, how=how)


def split_by_interval(
    left: DataFrame, right: DataFrame, value: str, inside: str, outside: str, **options
) -> DataFrame:
    """``value`` in one of two columns, by whether the row's time lies in an interval."""
    joined = interval_join(left, right.withColumn("__hit", F.lit(1)), right_columns=["__hit"], **options)
    hit = F.col("__hit").isNotNull()
    return joined.select(
        *left.columns,
        F.when(~hit, F.col(value)).alias(outside),
        F.when(hit, F.col(value)).alias(inside),
    )
