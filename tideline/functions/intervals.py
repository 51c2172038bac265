"""Predicates and bounds of half-open intervals ``[start, end)``; NULL end = open."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """True when both intervals share an instant; touching ends do not count."""
    return (b_end.isNull() | (a_start < b_end)) & (a_end.isNull() | (a_end > b_start))


def enclosed(
    inner_start: Column, inner_end: Column, outer_start: Column, outer_end: Column
) -> Column:
    """True when the inner interval lies wholly in the outer one."""
    ends_inside = inner_end.isNotNull() & (inner_end <= outer_end)
    return (inner_start >= outer_start) & (outer_end.isNull() | ends_inside)


def later(*bounds: Column) -> Column:
    """Latest non-NULL bound."""
    return F.greatest(*bounds)


def earlier(*bounds: Column) -> Column:
    """Earliest non-NULL bound."""
    return F.least(*bounds)


def touches_window(start: Column, end: Column, lo: datetime, hi: datetime) -> Column:
    """Overlap with a window, inclusive at both ends."""
    return (start <= F.lit(hi).cast("timestamp_ntz")) & (
        end.isNull() | (end >= F.lit(lo).cast("timestamp_ntz"))
    )
