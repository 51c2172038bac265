"""Clamp child intervals to their parents' windows and say what happened to each.

A child that needs no parent passes ("none"); one with a NULL key cannot match
("null_key"); one that overlaps no parent of its keys is an "orphan"; every
overlapping parent yields one row, "none" when the child lies inside it and
"clipped" when a bound moved. Invalid rows stay, with ``valid`` false.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tideline import vocab
from tideline.functions.exprs import any_null
from tideline.functions.intervals import earlier, enclosed, later, overlaps
from tideline.operators.overlap import has_overlap, overlap_pairs
from tideline.session import materialise

AUDIT = ("original_start", "original_end", "valid", "coerce_action")
ACTIONS = ("none", "clipped", "orphan", "null_key")
HOT_PARENTS = 1_000
#: Columns beyond those of an interval that the levels of ``clamp_hierarchy`` match by.
KEYS = ("hypervisor_hostname", "blazar_host_id", "reservation_type", "blazar_reservation_id")

_EXEMPT, _NULL_KEY, _MATCH = "exempt", "null_key", "match"


def hot_keys(parents: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """Keys with more than ``limit`` parents (at most ``rows / limit`` of them).

    One with a NULL matches no child, however many parents have it.
    """
    return (
        parents.where(~any_null(keys)).groupBy(*keys).count().where(F.col("count") > limit).select(*keys)
    )


def _audited(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Audit columns and clamped bounds of rows that carry ``_p_start, _p_end`` or NULLs."""
    start, end = F.col("original_start"), F.col("original_end")
    p_start, p_end = F.col("_p_start"), F.col("_p_end")
    matched = p_start.isNotNull()
    action = (
        F.when(F.col("_branch") == _EXEMPT, F.lit("none"))
        .when(F.col("_branch") == _NULL_KEY, F.lit("null_key"))
        .when(~matched, F.lit("orphan"))
        .when(enclosed(start, end, p_start, p_end), F.lit("none"))
        .otherwise(F.lit("clipped"))
    )
    bounds = {
        "start": F.when(matched, later(start, p_start)).otherwise(start),
        "end": F.when(matched, earlier(end, p_end)).otherwise(end),
    }
    return df.select(
        *[bounds[c].alias(c) if c in bounds else F.col(c) for c in columns],
        "original_start",
        "original_end",
        ((F.col("_branch") == _EXEMPT) | matched).alias("valid"),
        action.alias("coerce_action"),
        F.when(F.col("_branch") == _EXEMPT, 0)
        .when(F.col("_branch") == _NULL_KEY, 1)
        .when(~matched, 2)
        .otherwise(3)
        .alias("_rank"),
    )


def _clamp(
    children: DataFrame,
    parents: DataFrame,
    keys: Sequence[str],
    require_parent: Column | None,
    hot_limit: int | None,
) -> DataFrame:
    missing = set(keys) - set(children.columns) | set(keys) - set(parents.columns)
    if missing:
        raise ValueError(f"both sides need the key columns {sorted(missing)}")
    columns = [c for c in children.columns if c not in AUDIT]
    needs = F.lit(True) if require_parent is None else require_parent
    tagged = children.select(
        *columns,
        F.col("start").alias("original_start"),
        F.col("end").alias("original_end"),
        F.when(~needs, F.lit(_EXEMPT))
        .when(needs, F.when(any_null(keys), _NULL_KEY).otherwise(_MATCH))
        .alias("_branch"),
    ).where(F.col("_branch").isNotNull())  # an unknown need is neither exempt nor clamped
    windows = parents.select(
        *keys, F.col("start").alias("_p_start"), F.col("end").alias("_p_end")
    )

    hot = None
    if hot_limit is not None:
        hot = hot_keys(windows, keys, hot_limit)
        hot = None if hot.isEmpty() else hot.withColumn("_hot", F.lit(True))
    if hot is None and hot_limit is None:
        return _audited(_keyed_join(tagged, windows, keys), columns)
    if hot is None:
        # children that must not match are read apart, and not shuffled to a join
        matching = F.col("_branch") == _MATCH
        joined = _keyed_join(tagged.where(matching), windows, keys)
        apart = tagged.where(~matching)
        return _audited(joined.unionByName(apart, allowMissingColumns=True), columns)

    split = tagged.join(hot, list(keys), "left")
    in_hot = F.col("_hot").isNotNull() & (F.col("_branch") == _MATCH)
    cold_children = split.where(~in_hot).drop("_hot")
    hot_children = split.where(in_hot).drop("_hot")
    cold_windows = windows.join(hot, list(keys), "left_anti")
    hot_windows = windows.join(hot, list(keys), "left_semi")

    cold = _keyed_join(cold_children, cold_windows, keys)
    bounds = ("original_start", "original_end")
    flagged = has_overlap(hot_children, hot_windows, keys, *bounds)
    orphans = flagged.where(~F.col("_has_parent")).drop("_has_parent")
    pairs = overlap_pairs(hot_children, hot_windows, keys, *bounds)
    whole = cold.unionByName(pairs).unionByName(orphans, allowMissingColumns=True)
    return _audited(whole, columns)


def _keyed_join(tagged: DataFrame, windows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One left join: overlapping parents, or NULLs for rows without any.

    Rows that must not match carry a spread value in an extra key, so NULL or
    exempt keys do not meet in one task.
    """
    spread = F.when(F.col("_branch") == _MATCH, F.lit(0)).otherwise(
        F.pmod(F.xxhash64("original_start", "original_end", *keys), F.lit(4096)) + 1
    )
    left = tagged.withColumn("_spread", spread.cast("int"))
    right = windows.where(F.col("_p_start").isNotNull()).select(
        *[F.col(k).alias(f"_p_{k}") for k in keys], "_p_start", "_p_end"
    )
    on = (F.col("_spread") == F.lit(0)) & overlaps(
        F.col("original_start"), F.col("original_end"), F.col("_p_start"), F.col("_p_end")
    )
    right = right.withColumn("_p_spread", F.lit(0))
    on = on & (F.col("_spread") == F.col("_p_spread"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_p_{k}"))
    joined = left.join(right, on, "left")
    return joined.drop("_spread", "_p_spread", *[f"_p_{k}" for k in keys])


def apply_temporal_clamp(
    children: DataFrame,
    parents: DataFrame,
    keys: Sequence[str],
    require_parent: Column | None = None,
    hot_limit: int | None = None,
) -> DataFrame:
    """Children with clamped bounds and audit columns; one row per overlapping parent.

    ``require_parent`` marks the rows that need a parent (all by default); where
    it is NULL the row is dropped. With ``hot_limit``, parents are counted per key
    first, and keys above the limit are matched by time nodes instead of by key.
    """
    return _clamp(children, parents, keys, require_parent, hot_limit).drop("_rank")


def with_audit(df: DataFrame) -> DataFrame:
    """Audit columns for rows that skip clamping."""
    return df.withColumns(
        {
            "original_start": F.col("start"),
            "original_end": F.col("end"),
            "valid": F.lit(True),
            "coerce_action": F.lit("none"),
        }
    )


def first_per_key(clamped: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One parent window per key: exempt, null_key, orphan, matched; then the earliest.

    An aggregate with map-side combine, so many copies of one key cost nothing.
    """
    order = F.struct(
        "_rank",
        "start",
        "entity_id",
        F.col("end").isNull().alias("_open"),
        "end",
    )
    best = clamped.groupBy(*keys).agg(F.min(order).alias("_best"))
    return best.select(
        *keys, F.col("_best.start").alias("start"), F.col("_best.end").alias("end")
    )


def clamp_hierarchy(
    intervals: DataFrame,
    scope: Sequence[str] = (),
    hot_limit: int | None = None,
    cut: bool = False,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Total -> reservable -> committed -> occupied_reservation, each within its parent.

    Totals and on-demand occupancy pass. Parents are used whether valid or not.
    ``scope`` adds columns (a site) that parent and child must share. ``cut``
    writes the levels that feed another level to the shared folder, so no level
    is computed twice; with ``hot_limit`` their keys are checked for skew. With ``keep``
    the written levels hold those columns, what the next level needs and the outcome; others
    are NULL in the result.
    """
    scope = list(scope)

    def written(level: DataFrame, keys: Sequence[str]) -> DataFrame:
        if not cut:
            return level
        if keep is not None:
            needed = {*keep, *keys, "entity_id", "start", "end", "valid", "coerce_action", "_rank"}
            level = level.select(*[c for c in level.columns if c in needed])
        return materialise(level)

    metric = F.col("metric")
    total = intervals.where(metric == vocab.TOTAL)

    reservable = _clamp(
        intervals.where(metric == vocab.RESERVABLE),
        total,
        ["hypervisor_hostname", "resource", *scope],
        F.col("hypervisor_hostname").isNotNull(),
        hot_limit,
    )
    keys = ["blazar_host_id", "hypervisor_hostname", "resource", *scope]
    reservable = written(reservable, keys)
    committed = _clamp(
        intervals.where(metric == vocab.COMMITTED),
        reservable,
        keys,
        F.col("reservation_type").isin(*vocab.HOST_SCOPED_RESERVATIONS),
        hot_limit,
    )
    keys = ["blazar_reservation_id", "hypervisor_hostname", "resource", *scope]
    committed = written(committed, keys)
    occupied = _clamp(
        intervals.where(metric == vocab.OCCUPIED_RESERVATION),
        first_per_key(committed, keys),
        keys,
        None,
        None,  # one parent per key by construction
    )
    levels = [
        with_audit(total),
        reservable.drop("_rank"),
        committed.drop("_rank"),
        occupied.drop("_rank"),
        with_audit(intervals.where(metric == vocab.OCCUPIED_ONDEMAND)),
    ]
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level, allowMissingColumns=True)
    return out
