"""One integer time axis for both clocks.

A time column is either a timestamp (wall clock) or a whole number of minutes since unit
admission (offset clock). Operators compute on an integer axis: microseconds for the first,
minutes for the second.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

_NTZ_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# Fixed value: the day that offset zero stands for when offsets become timestamps.
OFFSET_EPOCH = "TIMESTAMP_NTZ'2014-01-01 00:00:00'"


@dataclass(frozen=True)
class Clock:
    """How a time column maps to the integer axis."""

    units_per_minute: int
    wall: bool
    zoned: bool = False

    @staticmethod
    def of(df: DataFrame, name: str) -> "Clock":
        kind = df.schema[name].dataType
        if isinstance(kind, T.TimestampNTZType):
            return Clock(60_000_000, True)
        if isinstance(kind, T.TimestampType):
            return Clock(60_000_000, True, zoned=True)
        if isinstance(kind, (T.IntegerType, T.LongType, T.ShortType)):
            return Clock(1, False)
        raise TypeError(f"{name}: {kind.simpleString()} is neither a timestamp nor minutes")

    def axis(self, column: Column | str) -> Column:
        column = F.col(column) if isinstance(column, str) else column
        if not self.wall:
            return column.cast("long")
        if self.zoned:
            return F.unix_micros(column)
        return F.timestamp_diff("MICROSECOND", F.expr(_NTZ_EPOCH), column)

    def units(self, minutes: float) -> int:
        return round(minutes * self.units_per_minute)

    def exact_minutes(self, units: Column) -> Column:
        """Fractional minutes on the wall clock, whole minutes on the offset clock."""
        if not self.wall:
            return units
        return units / F.lit(float(self.units_per_minute))

    def whole_minutes(self, units: Column) -> Column:
        """Whole minutes, cut toward zero."""
        if not self.wall:
            return units
        quotient = F.floor(F.abs(units) / F.lit(self.units_per_minute)).cast("long")
        return F.when(units < 0, -quotient).otherwise(quotient)

    def bucket(self, axis: Column, minutes: float) -> Column:
        width = self.units(minutes)
        return F.floor(axis / F.lit(width)).cast("long")


def minutes_to_timestamp(offset: Column | str) -> Column:
    """Offset minutes to a timestamp on the fixed epoch."""
    offset = F.col(offset) if isinstance(offset, str) else offset
    return F.timestamp_add("MINUTE", offset, F.expr(OFFSET_EPOCH))


def shift_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


def hour_bucket(offset: Column | str) -> Column:
    """The hour h with 60(h-1) < offset <= 60h."""
    offset = F.col(offset) if isinstance(offset, str) else offset
    return F.ceil(offset / F.lit(60)).cast("int")
