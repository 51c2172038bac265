"""Step functions: align, sample and average them.

Sampling never joins events to buckets. Each event is mapped to the one bucket
that first sees it, events are reduced per (group, bucket) before the shuffle,
and only those reduced rows (at most one per bucket and group) are ordered.
"""

from __future__ import annotations

from datetime import datetime
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tideline.functions.buckets import MICROS, Buckets, micros, ts
from tideline.operators.scan import SESSION, Measure, running

_K = "_k"


def dense_grid(df: DataFrame, time: str, groups: Sequence[str]) -> DataFrame:
    """Every distinct group at every distinct instant.

    Instants are spread over salts and each group is repeated once per salt, so
    the grid is an equi-join: the instants stay where they are if the groups turn
    out small enough to broadcast at run time, and spread over all tasks if not.
    """
    instants = df.select(time).distinct()
    if not groups:
        return instants
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = (
        df.select(*groups)
        .distinct()
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    spread = instants.withColumn("_salt", F.pmod(F.hash(time), F.lit(salts)))
    return spread.join(copies, "_salt").drop("_salt")


def align_step_functions(
    df: DataFrame,
    time: str,
    value: str,
    groups: Sequence[str],
    slice_us: int | None = SESSION,
    slice_rows: int | None = SESSION,
) -> DataFrame:
    """Forward-fill every group to the union of instants; NULL before a group's first."""
    grid = dense_grid(df, time, groups).withColumn("_side", F.lit(1))
    events = df.select(time, *groups, value).withColumn("_side", F.lit(0))
    both = events.unionByName(grid, allowMissingColumns=True)
    filled = running(
        both,
        groups,
        time,
        [Measure("_filled", "last", value)],
        ties=["_side"],
        slice_us=slice_us,
        unique_times=True,
        slice_rows=slice_rows,
    )
    return filled.where(F.col("_side") == 1).select(
        time, *groups, F.col("_filled").alias(value)
    )


def hold(df: DataFrame, groups: Sequence[str], count: int) -> DataFrame:
    """Repeat each (group, ``_k``) row up to the next one, over buckets ``0..count-1``.

    Adds ``_bucket`` and ``_before``: the buckets ahead of a group's first row are
    emitted from that row with ``_before`` true. A row with ``_k = count`` only
    proves that its group exists. Each group has at most ``count + 1`` rows here.
    """
    ordered = Window.partitionBy(*groups).orderBy(_K)
    upto = F.coalesce(F.lead(_K).over(ordered), F.lit(count)) - 1
    first = F.row_number().over(ordered) == 1
    since = F.when(first, F.lit(0).cast("long")).otherwise(F.col(_K))
    return (
        df.withColumns({"_since": since, "_upto": upto})
        .where(F.col("_since") <= F.col("_upto"))
        .withColumn("_bucket", F.explode(F.sequence("_since", "_upto")))
        .withColumn("_before", F.col("_bucket") < F.col(_K))
        .drop("_since", "_upto")
    )


def sample_index(buckets: Buckets, time: Column) -> Column:
    """First bucket edge that sees an event, from 0 to ``count``."""
    k = F.greatest(buckets.ceil_index(time), F.lit(0).cast("long"))
    return F.least(k, F.lit(buckets.count).cast("long"))


def resample_step_function(
    df: DataFrame,
    time: str,
    value: str,
    interval: str,
    groups: Sequence[str],
    time_range: tuple[datetime, datetime],
) -> DataFrame:
    """Value at each bucket edge (latest event at or before it), 0 before the first."""
    buckets = Buckets.parse(interval, time_range)
    latest = (
        df.where(F.col(time).isNotNull())
        .withColumn(_K, sample_index(buckets, F.col(time)))
        .groupBy(*groups, _K)
        .agg(F.max_by(value, time).alias(value))
    )
    seen = F.when(~F.col("_before"), F.col(value))
    return hold(latest, groups, buckets.count).select(
        buckets.edge(F.col("_bucket")).alias(time),
        *groups,
        F.coalesce(seen, F.lit(0)).alias(value),
    )


def weighted_from_deltas(
    deltas: DataFrame,
    time: str,
    change: str,
    interval: str,
    groups: Sequence[str],
    time_range: tuple[datetime, datetime],
) -> DataFrame:
    """Duration-weighted mean per bucket of the step function with these changes.

    The area of a bucket is its entry level times its width plus, for each change
    inside it, change times the time left in the bucket. Both parts are sums, so
    changes are combined before the shuffle. NULL before a group's first event;
    the first bucket averages over its covered part only.
    """
    buckets = Buckets.parse(interval, time_range)
    n = buckets.count
    lo, hi = (ts(t) for t in time_range)

    def width_end(k: Column) -> Column:
        return F.least(buckets.edge(k + 1), hi)

    def seconds(a: Column, b: Column) -> Column:
        return (micros(b) - micros(a)) / F.lit(float(MICROS))

    inside = (
        deltas.where(F.col(time).isNotNull())
        .withColumn("_at", F.greatest(F.col(time), lo))
        .withColumn(
            _K,
            F.when(F.col("_at") >= hi, F.lit(n).cast("long")).otherwise(
                buckets.floor_index(F.col("_at"))
            ),
        )
    )
    left = seconds(F.col("_at"), width_end(F.col(_K)))
    reduced = inside.groupBy(*groups, _K).agg(
        F.sum(change).cast("double").alias("_step"),
        F.sum(F.col(change) * left).alias("_part"),
        F.min("_at").alias("_first"),
    )
    ordered = Window.partitionBy(*groups).orderBy(_K)
    entry = F.sum("_step").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    levels = reduced.withColumns(
        {
            "_entry": F.coalesce(entry, F.lit(0.0)),
            "_level": F.sum("_step").over(
                ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
            "_opening": F.row_number().over(ordered) == 1,
        }
    )
    held = hold(levels, groups, n)
    k = F.col("_bucket")
    full = seconds(buckets.edge(k), width_end(k))
    covered = F.when(
        F.col("_opening"), seconds(F.col("_first"), width_end(k))
    ).otherwise(full)
    own = (F.col("_entry") * full + F.col("_part")) / covered
    mean = (
        F.when(F.col("_before"), F.lit(None))
        .when(k == F.col(_K), own)
        .otherwise(F.col("_level"))
    )
    return held.select(
        buckets.edge(k).alias(time), *groups, mean.cast("double").alias("value")
    )


def resample_time_weighted(
    df: DataFrame,
    time: str,
    value: str,
    interval: str,
    groups: Sequence[str],
    time_range: tuple[datetime, datetime],
    slice_us: int | None = SESSION,
) -> DataFrame:
    """Duration-weighted mean per bucket of a step function given by its values.

    Expects one row per group and instant. NULL values continue the last one.
    """
    previous = running(
        df.where(F.col(value).isNotNull()).select(time, *groups, value),
        groups,
        time,
        [Measure("_previous", "last", value)],
        slice_us=slice_us,
        exclusive=True,
    )
    changes = previous.withColumn(
        "_change", F.col(value) - F.coalesce(F.col("_previous"), F.lit(0))
    )
    return weighted_from_deltas(
        changes, time, "_change", interval, groups, time_range
    ).withColumnRenamed("value", value)
