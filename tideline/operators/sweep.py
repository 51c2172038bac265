"""Intervals to step functions."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tideline.operators.scan import SESSION, Measure, running


def intervals_to_deltas(
    df: DataFrame,
    start: str,
    end: str,
    groups: Sequence[str],
    value: str | None = None,
) -> DataFrame:
    """``+v`` at start and ``-v`` at end, one pass over the input; NULL end never closes."""
    size: Column = F.col(value) if value else F.lit(1).cast("long")
    opening = F.struct(F.col(start).alias("timestamp"), size.alias("change"))
    closing = F.struct(F.col(end).alias("timestamp"), (-size).alias("change"))
    edges = F.when(F.col(end).isNull(), F.array(opening)).otherwise(
        F.array(opening, closing)
    )
    return df.select(*groups, F.inline(edges)).select("timestamp", *groups, "change")


def deltas_to_counts(
    df: DataFrame,
    groups: Sequence[str],
    slice_us: int | None = SESSION,
    slice_rows: int | None = SESSION,
) -> DataFrame:
    """Sum changes per instant, then accumulate them per group."""
    per_instant = df.groupBy("timestamp", *groups).agg(
        F.coalesce(F.sum("change"), F.lit(0)).alias("change")
    )
    return running(
        per_instant,
        groups,
        "timestamp",
        [Measure("value", "sum", "change")],
        slice_us=slice_us,
        slice_rows=slice_rows,
    ).select("timestamp", *groups, "value")


def intervals_to_counts(
    df: DataFrame,
    start: str,
    end: str,
    groups: Sequence[str],
    value: str | None = None,
    slice_us: int | None = SESSION,
    slice_rows: int | None = SESSION,
) -> DataFrame:
    """Step function of the intervals open at each instant, one row per change."""
    return deltas_to_counts(
        intervals_to_deltas(df, start, end, groups, value), groups, slice_us, slice_rows
    )
