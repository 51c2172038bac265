"""Intervals to usage: sweep, clip, align, derive, sample."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from tideline import vocab
from tideline.contracts import UsageSpec, as_interval, as_timeline
from tideline.functions.buckets import Buckets, ts
from tideline.operators import runs, steps, sweep
from tideline.operators.derive import (
    compute_derived_metrics,
    distinct_values,
    wide_to_long,
    with_derivations,
)
from tideline.operators.scan import SESSION, Measure, running


# --- single stages -------------------------------------------------------------


def interval_counts(intervals: DataFrame, spec: UsageSpec) -> DataFrame:
    counts = sweep.intervals_to_counts(
        as_interval(intervals), "start", "end", spec.group_cols, "value"
    )
    return as_timeline(counts)


def clip_to_window(df: DataFrame, spec: UsageSpec) -> DataFrame:
    """Drop what happens after the window; earlier events still set its first level."""
    return as_timeline(df).where(F.col("timestamp") <= ts(spec.time_range[1]))


def align_timestamps(df: DataFrame, spec: UsageSpec) -> DataFrame:
    aligned = steps.align_step_functions(
        as_timeline(df), "timestamp", "value", spec.group_cols
    )
    return as_timeline(aligned.fillna(0, subset=["value"]))


def resample(df: DataFrame, interval: str, spec: UsageSpec) -> DataFrame:
    """Sample at the bucket edges of the spec's window."""
    spec.validate_against(df)
    sampled = steps.resample_step_function(
        as_timeline(df), "timestamp", "value", interval, spec.group_cols, spec.time_range
    )
    return as_timeline(sampled)


def resample_weighted(df: DataFrame, interval: str, spec: UsageSpec) -> DataFrame:
    """Duration-weighted mean per bucket; NULL before a group's first event."""
    spec.validate_against(df)
    weighted = steps.resample_time_weighted(
        as_timeline(df), "timestamp", "value", interval, spec.group_cols, spec.time_range
    )
    return as_timeline(weighted)


def weighted_usage(intervals: DataFrame, interval: str, spec: UsageSpec) -> DataFrame:
    """Duration-weighted mean per bucket straight from intervals.

    Equals ``resample_weighted`` of their counts, but only sums per bucket are
    shuffled: no instant is ordered.
    """
    spec.validate_against(intervals)
    deltas = sweep.intervals_to_deltas(
        as_interval(intervals), "start", "end", spec.group_cols, "value"
    )
    weighted = steps.weighted_from_deltas(
        deltas.withColumn("change", F.coalesce("change", F.lit(0.0))),
        "timestamp",
        "change",
        interval,
        spec.group_cols,
        spec.time_range,
    )
    return as_timeline(weighted)


def add_site_context(df: DataFrame, site: str, collector_type: str = "current") -> DataFrame:
    return as_timeline(df).withColumns(
        {"site": F.lit(site), "collector_type": F.lit(collector_type)}
    )


# --- the whole run ---------------------------------------------------------------


def metrics_in_window(intervals: DataFrame, spec: UsageSpec) -> list[str]:
    """Metrics with at least one event up to the window's end."""
    first = F.least(F.col("start"), F.col("end"))
    return distinct_values(intervals.where(first <= ts(spec.time_range[1])), "metric")


def metric_bits(
    intervals: DataFrame, spec: UsageSpec, scope: Sequence[str], metrics: Sequence[str]
) -> DataFrame:
    """Per scope value, a bit for each metric with an event up to the window's end."""
    first = F.least(F.col("start"), F.col("end"))
    other = F.raise_error(F.concat(F.lit("a metric that was not planned for: "), F.col("metric")))
    bit = F.when(F.col("metric").isNull(), F.lit(0)).otherwise(other.cast("int"))
    for i, metric in enumerate(metrics):
        bit = F.when(F.col("metric") == metric, F.lit(1 << i)).otherwise(bit)
    held = intervals.where(first <= ts(spec.time_range[1])).groupBy(*scope)
    return held.agg(F.bit_or(bit).alias("_bits"))


def _of_scope(
    wide: DataFrame,
    bits: DataFrame,
    index: Sequence[str],
    scope: Sequence[str],
    metrics: Sequence[str],
) -> DataFrame:
    """Long rows of the metrics that a scope has, and of what derives from them."""
    needed = {m: 1 << i for i, m in enumerate(metrics)}
    for result, parent, child in vocab.DERIVATIONS:
        if parent in needed and child in needed:
            needed[result] = needed[parent] | needed[child]
    renamed = {c: f"_of_{c}" for c in scope}
    on = F.lit(True)
    for c in scope:
        on = on & F.col(c).eqNullSafe(F.col(renamed[c]))
    known = wide.join(bits.withColumnsRenamed(renamed), on).drop(*renamed.values())
    kept = {
        m: F.when(F.col("_bits").bitwiseAND(n) == n, F.coalesce(F.col(m), F.lit(0.0)))
        for m, n in needed.items()
    }
    return wide_to_long(known.withColumns(kept), index, list(needed))


def run_usage(
    intervals: DataFrame,
    spec: UsageSpec,
    resample_interval: str | None = None,
    metrics: Sequence[str] | None = None,
    scope: Sequence[str] = (),
    slice_rows: int | None = SESSION,
) -> DataFrame:
    """Aligned counts with derived metrics, sampled when an interval is given.

    Same result as the single stages in order, planned differently: changes are
    pivoted by metric before anything is ordered, so one row carries all metrics
    of an instant and derived metrics are column subtractions. With an interval,
    changes are first summed per bucket, so the shuffle carries one row per task,
    group and bucket, whatever the number of intervals; sampling commutes with
    the subtractions, which is why it may come first. Without one, groups are runs
    between their own changes, and the rows at all instants are written out last.

    ``scope`` names group columns (a site) whose values do not share metrics or
    instants: each gets the rows that a run over it alone would give. All base
    metrics (or ``metrics``) are then planned for, so no job has to ask which ones
    there are; a row with another metric fails.
    """
    spec.validate_against(intervals)
    intervals = as_interval(intervals)
    if scope:
        metrics = metrics or vocab.BASE_METRICS
    elif metrics is None:
        metrics = metrics_in_window(intervals, spec)
    metrics = list(metrics)
    others = spec.other_groups
    deltas = sweep.intervals_to_deltas(
        intervals, "start", "end", spec.group_cols, "value"
    ).where(F.col("timestamp") <= ts(spec.time_range[1]))
    per_metric = [
        F.coalesce(
            F.sum(F.when(F.col("metric") == m, F.col("change"))), F.lit(0.0)
        ).alias(m)
        for m in metrics
    ]

    if resample_interval:
        buckets = Buckets.parse(resample_interval, spec.time_range)
        reduced = (
            deltas.withColumn("_k", steps.sample_index(buckets, F.col("timestamp")))
            .groupBy(*others, "_k")
            .agg(*per_metric)
        )
        levels = running(
            reduced, others, "_k", [Measure(m, "sum", m) for m in metrics], slice_us=None
        )
        held = steps.hold(levels, others, buckets.count)
        wide = held.select(
            buckets.edge(F.col("_bucket")).alias("timestamp"),
            *others,
            *[F.when(F.col("_before"), 0.0).otherwise(F.col(m)).alias(m) for m in metrics],
        )
    else:
        changes = deltas.groupBy("timestamp", *others).agg(*per_metric)
        numbered = runs.number_instants(changes, "timestamp", scope, slice_rows)
        levels = runs.to_runs(changes, numbered, "timestamp", others, metrics, scope, slice_rows)
        wide = runs.expand(levels, numbered, "timestamp", scope)

    wide, present = with_derivations(wide, metrics)
    index = ["timestamp", *others]
    if scope:
        bits = metric_bits(intervals, spec, scope, metrics)
        return as_timeline(_of_scope(wide, bits, index, scope, metrics))
    return as_timeline(wide_to_long(wide, index, present))
