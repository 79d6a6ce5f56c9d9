"""As-of joins: the latest row of one series at or before each row of another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from curata.functions.clock import Clock
from curata.operators.pick import last_row
from curata.operators.scan import ordered_scan

_LEFT, _AXIS, _SIDE, _TIE, _ROW, _MATCH = "__is_left", "__axis", "__side", "__tie", "__row", "__match"


def stack_series(
    left: DataFrame,
    right: DataFrame,
    *,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    left_axis: Column,
    right_axis: Column,
    tie: Column,
    right_first: bool,
) -> tuple[DataFrame, list[str]]:
    """Both series on one axis, ready for an ordered scan; right rows keep their columns."""
    keys = [f"__k{i}" for i in range(len(left_keys))]
    lefts = left.select(
        *[F.col(c).alias(k) for c, k in zip(left_keys, keys)],
        left_axis.alias(_AXIS),
        F.lit(1 if right_first else 0).alias(_SIDE),
        F.lit(True).alias(_LEFT),
        F.struct(*left.columns).alias(_ROW),
    )
    rights = right.select(
        *[F.col(c).alias(k) for c, k in zip(right_keys, keys)],
        right_axis.alias(_AXIS),
        F.lit(0 if right_first else 1).alias(_SIDE),
        F.lit(False).alias(_LEFT),
        tie.alias(_TIE),
        F.struct(*right.columns).alias(_MATCH),
    )
    usable = F.lit(True)
    for k in [*keys, _AXIS]:
        usable = usable & F.col(k).isNotNull()
    return lefts.filter(usable).unionByName(rights.filter(usable), allowMissingColumns=True), keys


def asof_join(
    left: DataFrame,
    right: DataFrame,
    *,
    left_keys: Sequence[str],
    right_keys: Sequence[str] | None = None,
    left_time: str,
    right_time: str,
    tolerance: float | None = None,
    direction: str = "backward",
    exact: bool = True,
    tie: str | None = None,
    right_columns: Sequence[str] | None = None,
    delta: str | None = None,
    chunk_minutes: float = 1440,
) -> DataFrame:
    """Inner as-of join: each left row with the nearest right row on one side in time.

    ``tolerance`` and ``delta`` are minutes; delta is right time minus left time. Among right rows
    at the same instant the highest ``tie`` wins (forward: the lowest). ``chunk_minutes`` bounds what one
    task sees of one key. All columns of ``left`` travel with their row: select the needed ones first.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(direction)
    right_keys = list(right_keys or left_keys)
    clock = Clock.of(left, left_time)
    backward = direction == "backward"
    payload = list(right_columns or [c for c in right.columns if c not in right_keys])
    needed = dict.fromkeys([*right_keys, right_time, *payload, *([tie] if tie else [])])
    right = right.select(*needed)
    stacked, keys = stack_series(
        left,
        right,
        left_keys=left_keys,
        right_keys=right_keys,
        left_axis=clock.axis(left_time),
        right_axis=Clock.of(right, right_time).axis(right_time),
        tie=F.col(tie) if tie else F.lit(None).cast("long"),
        right_first=backward == exact,
    )
    candidate = F.when(~F.col(_LEFT), F.struct(F.col(_AXIS).alias("axis"), F.col(_MATCH).alias("row")))
    scan = ordered_scan(
        stacked.withColumn("__found", candidate).drop(_MATCH),
        keys,
        [_AXIS, _SIDE, _TIE],
        clock.bucket(F.col(_AXIS), chunk_minutes),
        **{"before" if backward else "after": {_MATCH: F.col("__found")}},
    )
    gap = F.col(f"{_MATCH}.axis") - F.col(_AXIS)
    matched = scan.filter(F.col(_LEFT) & F.col(_MATCH).isNotNull())
    if tolerance is not None:
        matched = matched.filter(F.abs(gap) <= F.lit(clock.units(tolerance)))
    out = [F.col(f"{_ROW}.{c}").alias(c) for c in left.columns]
    out += [F.col(f"{_MATCH}.row.{c}").alias(c) for c in payload]
    if delta:
        out.append(clock.exact_minutes(gap).alias(delta))
    return matched.select(*out)


def closest_prior(
    left: DataFrame,
    right: DataFrame,
    *,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    left_pick: str,
    tie: str | None = None,
    **options,
) -> DataFrame:
    """One pair per (key, left instant): the latest right row at or before it.

    What an inequality join ranked by right time keeps, without building its pairs. Of several
    left rows at one instant the one with the highest ``left_pick`` stands for the instant.
    """
    return asof_join(
        last_row(left, [*keys, left_time], [left_pick]),
        right,
        left_keys=keys,
        left_time=left_time,
        right_time=right_time,
        tie=tie,
        **options,
    )
