"""Bucket arithmetic on zone-less timestamps.

All functions stay on ``timestamp_ntz``: no cast to a zoned timestamp, so the
session time zone never moves a bucket edge.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, functions as F

MICROS = 1_000_000
MINUTE_US = 60 * MICROS
DAY_US = 86_400 * MICROS

# --- Fixed values: duration units --------------------------------------------
_FIXED_US = {
    "us": 1,
    "ms": 1_000,
    "s": MICROS,
    "m": MINUTE_US,
    "h": 3_600 * MICROS,
    "d": DAY_US,
    "w": 7 * DAY_US,
}
_MONTHS = {"mo": 1, "q": 3, "y": 12}


def ts(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def micros(t: Column) -> Column:
    """Microseconds since 1970-01-01 of a zone-less timestamp."""
    days = F.unix_date(t.cast("date")).cast("long")
    seconds = F.date_part(F.lit("SECOND"), t)
    return (
        days * F.lit(DAY_US)
        + (F.hour(t) * 60 + F.minute(t)).cast("long") * F.lit(MINUTE_US)
        + (seconds * MICROS).cast("long")
    )


def py_micros(value: datetime) -> int:
    delta = value - datetime(1970, 1, 1)
    return delta.days * DAY_US + delta.seconds * MICROS + delta.microseconds


def floor_div(x: Column, width: int) -> Column:
    """Exact integer division rounding down."""
    return ((x - F.pmod(x, F.lit(width))) / F.lit(width)).cast("long")


def _add_months(value: datetime, months: int) -> datetime:
    index = value.year * 12 + value.month - 1 + months
    year, month = divmod(index, 12)
    first = datetime(year, month + 1, 1)
    following = datetime(year + (month == 11), (month + 1) % 12 + 1, 1)
    return value.replace(year=year, month=month + 1, day=min(value.day, (following - first).days))


@dataclass(frozen=True)
class Buckets:
    """Edges ``start, start + step, ...`` below ``end``; step is fixed or in months."""

    start: datetime
    end: datetime
    width_us: int
    months: int

    @staticmethod
    def parse(interval: str, time_range: tuple[datetime, datetime]) -> "Buckets":
        pieces = re.findall(r"(\d+)(us|ms|mo|s|m|h|d|w|q|y)", interval)
        if not pieces or "".join(n + u for n, u in pieces) != interval:
            raise ValueError(f"not an interval: {interval!r}")
        width = sum(int(n) * _FIXED_US.get(u, 0) for n, u in pieces)
        months = sum(int(n) * _MONTHS.get(u, 0) for n, u in pieces)
        if bool(width) == bool(months):
            raise ValueError(f"use either fixed or calendar units: {interval!r}")
        return Buckets(*time_range, width, months)

    @property
    def count(self) -> int:
        span = py_micros(self.end) - py_micros(self.start)
        if span <= 0:
            return 0
        if self.width_us:
            return -(-span // self.width_us)
        n = 0
        while _add_months(self.start, n * self.months) < self.end:
            n += 1
        return n

    def edge(self, k: Column) -> Column:
        """Timestamp of edge ``k``."""
        if self.width_us:
            days, rest = divmod(self.width_us, DAY_US)
            step = F.make_dt_interval(
                days=(k * days).cast("int"),
                hours=F.lit(0),
                mins=F.lit(0),
                secs=(k * rest / MICROS).cast("decimal(18,6)"),
            )
            return ts(self.start) + step
        return ts(self.start) + F.make_ym_interval(F.lit(0), (k * self.months).cast("int"))

    def _month_floor(self, t: Column) -> Column:
        """Largest k with edge(k) <= t, for calendar steps."""
        apart = (F.year(t) - self.start.year) * 12 + F.month(t) - self.start.month
        k = floor_div(apart.cast("long"), self.months)
        return F.when(self.edge(k) > t, k - 1).otherwise(k)

    def floor_index(self, t: Column) -> Column:
        """Bucket that holds ``t`` (may be negative or >= count)."""
        if self.width_us:
            return floor_div(micros(t) - F.lit(py_micros(self.start)), self.width_us)
        return self._month_floor(t)

    def ceil_index(self, t: Column) -> Column:
        """First edge at or after ``t``, i.e. the first sample that sees it."""
        if self.width_us:
            return -floor_div(F.lit(py_micros(self.start)) - micros(t), self.width_us)
        k = self._month_floor(t)
        return F.when(self.edge(k) < t, k + 1).otherwise(k)

    def edges(self, spark):
        """The regular timestamps as a one-column frame."""
        n = self.count
        return spark.range(n).select(self.edge(F.col("id")).alias("timestamp"))
