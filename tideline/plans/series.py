"""Series behind the charts, computed from wide usage."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tideline import vocab
from tideline.functions.buckets import micros, ts
from tideline.functions.exprs import member
from tideline.operators.rolling import trailing_mean

ALL_SITES = "*"


def _metric(wide: DataFrame, metric: str, collector: str = vocab.CURRENT) -> Column:
    """A metric's column in the wide frame, 0 where NULL or absent."""
    name = f"{metric}_{collector}"
    if name not in wide.columns:
        return F.lit(0.0)
    return F.coalesce(F.col(name), F.lit(0.0))


def stacked_usage(
    wide: DataFrame,
    include_ondemand: bool = True,
    merge_reserved: bool = False,
    denominator: str | None = None,
) -> DataFrame:
    """Stacked layers per (timestamp, site, resource): value, band and percentages.

    Bands stack ``max(0, value)``; percentages stack the value itself over the
    denominator ("total", "reservable" or "reservable_legacy"; 0 counts as 1).
    The default denominator is total with on-demand usage, else reservable.
    """
    denominators = {
        "total": _metric(wide, vocab.TOTAL),
        "reservable": _metric(wide, vocab.RESERVABLE),
        "reservable_legacy": _metric(wide, vocab.RESERVABLE, vocab.LEGACY),
    }
    chosen = denominator or ("total" if include_ondemand else "reservable")
    denom = denominators.get(chosen, denominators["reservable"])
    denom = F.when(denom != 0, denom).otherwise(F.lit(1.0))

    reserved = _metric(wide, vocab.OCCUPIED_RESERVATION)
    idle = _metric(wide, vocab.IDLE)
    available = _metric(wide, vocab.AVAILABLE_RESERVABLE)
    layers: list[tuple[str, Column]] = []
    if include_ondemand:
        layers.append((vocab.OCCUPIED_ONDEMAND, _metric(wide, vocab.OCCUPIED_ONDEMAND)))
        available = available + _metric(wide, vocab.AVAILABLE_ONDEMAND)
    layers.append((vocab.OCCUPIED_RESERVATION, reserved + idle if merge_reserved else reserved))
    if not merge_reserved:
        layers.append((vocab.IDLE, idle))
    layers.append(("available", available))

    entries = []
    band = pct = F.lit(0.0)
    for position, (name, value) in enumerate(layers):
        band_top = band + F.greatest(value, F.lit(0.0))
        pct_top = pct + value / denom * 100
        entries.append(
            F.struct(
                F.lit(name).alias("layer"),
                F.lit(position).alias("position"),
                value.alias("value"),
                band.alias("band_lower"),
                band_top.alias("band_upper"),
                pct.alias("pct_lower"),
                pct_top.alias("pct_upper"),
            )
        )
        band, pct = band_top, pct_top
    return wide.select("timestamp", "site", "resource", F.inline(F.array(*entries)))


def _utilisation(used: Column, available: Column) -> Column:
    capacity = used + available
    return F.when(capacity > 0, used / capacity * 100)


def site_comparison(
    wide: DataFrame, full_capacity_prefix: str = "kvm", smooth_days: int = 30
) -> DataFrame:
    """Used, available and capacity per site, and over all sites as site ``*``.

    Sites with the prefix sell on-demand capacity too: their capacity is the
    total and their available part includes on-demand; other sites count what is
    reservable. ``pct`` is NULL without capacity; ``pct_smooth`` is its trailing
    mean. All-site rows add sites up by timestamp.
    """
    ondemand = F.col("site").startswith(full_capacity_prefix)
    per_site = wide.select(
        "timestamp",
        "site",
        "resource",
        (
            _metric(wide, vocab.OCCUPIED_RESERVATION)
            + _metric(wide, vocab.OCCUPIED_ONDEMAND)
            + _metric(wide, vocab.IDLE)
        ).alias("used"),
        (
            _metric(wide, vocab.AVAILABLE_RESERVABLE)
            + F.when(ondemand, _metric(wide, vocab.AVAILABLE_ONDEMAND)).otherwise(0.0)
        ).alias("available"),
        F.when(ondemand, _metric(wide, vocab.TOTAL))
        .otherwise(_metric(wide, vocab.RESERVABLE))
        .alias("capacity"),
    )
    combined = per_site.groupBy("timestamp", "resource").agg(
        *[F.sum(c).alias(c) for c in ("used", "available", "capacity")]
    )
    both = per_site.unionByName(combined.withColumn("site", F.lit(ALL_SITES)))
    both = both.withColumn("pct", _utilisation(F.col("used"), F.col("available")))
    return trailing_mean(
        both, ["site", "resource"], "timestamp", "pct", smooth_days, "pct_smooth"
    )


def with_site_position(
    df: DataFrame, sites: Sequence[str], preferred: Sequence[str] = ()
) -> DataFrame:
    """Display position: preferred sites first, the others in the order given."""
    rank = {name: i for i, name in enumerate(preferred)}
    ordered = sorted(sites, key=lambda s: (rank.get(s, len(rank)), list(sites).index(s)))
    order = F.array(*[F.lit(s) for s in ordered])
    return df.withColumn(
        "position", F.nullif(F.array_position(order, F.col("site")), F.lit(0)) - 1
    )


def collector_gap(wide: DataFrame) -> DataFrame:
    """Reservable counts of both collectors and the regions where they differ."""
    needed = [
        f"{vocab.TOTAL}_{vocab.CURRENT}",
        f"{vocab.RESERVABLE}_{vocab.CURRENT}",
        f"{vocab.RESERVABLE}_{vocab.LEGACY}",
    ]
    missing = [c for c in needed if c not in wide.columns]
    if missing:
        raise ValueError(f"nothing to compare without {missing}")
    current = _metric(wide, vocab.RESERVABLE)
    legacy = _metric(wide, vocab.RESERVABLE, vocab.LEGACY)
    return wide.select(
        "timestamp",
        "site",
        "resource",
        _metric(wide, vocab.TOTAL).alias("total"),
        current.alias("reservable_current"),
        legacy.alias("reservable_legacy"),
        F.when(legacy > current, legacy - current).alias("missing_history"),
        F.when(current > legacy, current - legacy).alias("untracked_maintenance"),
    )


def nearest_samples(
    df: DataFrame,
    columns: Sequence[str],
    annotations: Sequence[tuple[str, datetime]],
    time: str = "timestamp",
    series: Sequence[str] = (),
) -> DataFrame:
    """The sample nearest to each annotation, the earlier one on a tie.

    The annotations are a short list in the caller's code; each task keeps one
    candidate per annotation and series.
    """
    marks = F.array(
        *[F.struct(F.lit(n).alias("label"), ts(t).alias("event_at")) for n, t in annotations]
    )
    apart = F.abs(micros(F.col(time)) - micros(F.col("event_at")))
    best = F.min_by(F.struct(time, *columns), F.struct(apart, F.col(time)))
    return (
        df.select(time, *series, *columns, F.inline(marks))
        .groupBy(*series, "label", "event_at")
        .agg(best.alias("_best"))
        .select(*series, "label", "event_at", "_best.*")
    )


def ops_user_split(usage: DataFrame, resource: str = vocab.DEVICES) -> DataFrame:
    """Committed by operators, by users, and what is left of the reservable count.

    Only instants that have all three series are kept.
    """
    committed = F.col("metric") == vocab.COMMITTED
    parts = {
        "ops": committed & F.col("ops"),
        "user": committed & ~F.col("ops"),
        "reservable": (F.col("metric") == vocab.RESERVABLE) & ~F.col("ops"),
    }
    sums = [
        F.coalesce(F.sum(F.when(c, F.col("value"))), F.lit(0.0)).alias(n)
        for n, c in parts.items()
    ]
    counts = [F.count(F.when(c, True)).alias(f"_n_{n}") for n, c in parts.items()]
    complete = reduce(lambda a, b: a & b, [F.col(f"_n_{n}") > 0 for n in parts])
    return (
        usage.where(F.col("resource") == resource)
        .groupBy("timestamp")
        .agg(*sums, *counts)
        .where(complete)
        .select(
            "timestamp",
            *parts,
            (F.col("reservable") - F.col("ops") - F.col("user")).alias("available"),
        )
    )


def with_ops_flag(intervals: DataFrame, ops_projects: Sequence[str]) -> DataFrame:
    return intervals.withColumn("ops", member(F.col("project_id"), ops_projects))


def project_summary(
    intervals: DataFrame, projects: DataFrame, ops_projects: Sequence[str], top: int = 20
) -> DataFrame:
    """Projects with the most committed rows, with name (NULL if unknown) and ops flag."""
    counts = (
        intervals.where(F.col("metric") == vocab.COMMITTED)
        .groupBy("project_id")
        .agg(F.count(F.lit(1)).alias("allocations"))
    )
    named = counts.join(
        projects.select(F.col("id").alias("project_id"), "name"), "project_id", "left"
    )
    return (
        named.withColumn("ops", F.col("project_id").isin(list(ops_projects)))
        .orderBy(F.col("allocations").desc(), F.col("project_id"))
        .limit(top)
    )
