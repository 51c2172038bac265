"""Overlap join of intervals under keys that hold very many rows.

An equi-join on the keys with the overlap as residual compares every child with
every parent of its key. That is fine while keys have few parents, and hopeless
for one key with a large share of all rows. For such keys the overlap becomes an
equality:

* a pair overlaps in exactly one of two ways: the parent is already open when the
  child starts, or the parent starts while the child is open;
* either way one side is an instant and the other an interval that holds it;
* the interval is covered by disjoint aligned time nodes (4-adic: 1, 4, 16, ...
  ticks), the instant lists the one node of each size that holds it. They share
  exactly one node, so every pair meets once.

An interval needs a few nodes per size however long it is, and an instant one
per size, so rows are repeated by a bounded factor and compared only with rows
that share their stretch of time.
"""

from __future__ import annotations

from functools import partial
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tideline.functions.buckets import DAY_US, floor_div, micros
from tideline.functions.intervals import overlaps
from tideline.operators.scan import SESSION, Measure, running, slice_width

_SPAN_US = 800 * 365 * DAY_US  # the tree reaches at least this far past 1970
_FOREVER = "9999-12-31 00:00:00"


class _Nodes:
    """Node arrays of instants and intervals; the smallest node is one tick wide."""

    def __init__(self, tick_us: int):
        self.tick_us = tick_us
        self.top = 1
        while 4**self.top * tick_us < _SPAN_US:
            self.top += 1
        self.last = F.lit(4**self.top - 1).cast("long")  # stands for an open end

    def _tick(self, t: Column) -> Column:
        """Tick number, clipped to the tree's range."""
        tick = floor_div(micros(t), self.tick_us)
        return F.least(F.greatest(tick, F.lit(0).cast("long")), self.last)

    def with_ticks(self, df: DataFrame, start: str, end: str) -> DataFrame:
        """Add ``_lo``, the first tick, and ``_hi``, the one after the last."""
        last = F.when(F.col(end).isNull(), self.last).otherwise(self._tick(F.col(end)))
        return df.withColumns({"_lo": self._tick(F.col(start)), "_hi": last + 1})

    def _number(self, size: int, index: Column) -> Column:
        return index * (self.top + 1) + size

    def _of_instant(self) -> Column:
        sizes = range(self.top + 1)
        return F.array(*[self._number(s, F.shiftright("_lo", 2 * s)) for s in sizes])

    def _of_interval(self) -> Column:
        """Disjoint nodes that cover every tick the interval touches.

        At each size the whole nodes inside the interval form one run; the nodes
        of that run that no wider node covers are its two ends.
        """
        lo, hi = F.col("_lo"), F.col("_hi")
        empty = F.array().cast("array<bigint>")
        parts = []
        for s in range(self.top + 1):
            first, stop = F.shiftright(lo + (4**s - 1), 2 * s), F.shiftright(hi, 2 * s)
            if s == self.top:
                wide_first, wide_stop = stop, stop
            else:
                wide_first = F.shiftright(lo + (4 ** (s + 1) - 1), 2 * s + 2) * 4
                wide_stop = F.shiftright(hi, 2 * s + 2) * 4
            wider = wide_first < wide_stop
            left_stop = F.when(wider, wide_first).otherwise(stop)
            left = F.when(first < left_stop, F.sequence(first, left_stop - 1))
            right = F.when(wider & (wide_stop < stop), F.sequence(wide_stop, stop - 1))
            run = F.concat(F.coalesce(left, empty), F.coalesce(right, empty))
            parts.append(F.transform(run, partial(self._number, s)))
        return F.concat(*parts)

    def roles(self, instant_role: int) -> Column:
        """Both roles of a row with ticks as (role, node) entries, ready to inline."""
        as_instant = F.transform(
            self._of_instant(),
            lambda n: F.struct(F.lit(instant_role).alias("_role"), n.alias("_node")),
        )
        as_interval = F.transform(
            self._of_interval(),
            lambda n: F.struct(F.lit(1 - instant_role).alias("_role"), n.alias("_node")),
        )
        return F.concat(as_instant, as_interval)


def overlap_pairs(
    children: DataFrame,
    parents: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    tick_us: int | None = None,
) -> DataFrame:
    """Every (child, parent) with equal keys that overlap; parents bring ``_p_start, _p_end``.

    The smallest node is one time slice of the session unless ``tick_us`` is given.
    """
    nodes = _Nodes(tick_us or slice_width(children))
    c_start, c_end = F.col(start), F.col(end)
    p_start, p_end = F.col("_p_start"), F.col("_p_end")
    # role 0: parent open at child's start; role 1: parent starts inside the child
    left = nodes.with_ticks(children, start, end).select(
        *children.columns, F.inline(nodes.roles(0))
    )
    known = nodes.with_ticks(parents.where(p_start.isNotNull()), "_p_start", "_p_end")
    right = known.select(
        *[F.col(k).alias(f"_p_{k}") for k in keys],
        "_p_start",
        "_p_end",
        F.inline(nodes.roles(1)).alias("_p_role", "_p_node"),
    )
    same = (F.col("_role") == F.col("_p_role")) & (F.col("_node") == F.col("_p_node"))
    for k in keys:
        same = same & (F.col(k) == F.col(f"_p_{k}"))
    first = (F.col("_role") == 0) == (p_start <= c_start)
    pairs = left.join(right, same & first & overlaps(c_start, c_end, p_start, p_end))
    return pairs.select(*children.columns, "_p_start", "_p_end")


def has_overlap(
    children: DataFrame,
    parents: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    slice_us: int | None = SESSION,
) -> DataFrame:
    """Children with ``_has_parent``, decided without comparing pairs.

    Some parent overlaps a child exactly when, among the parents that start
    before the child ends, the latest end lies after the child's start.
    """
    forever = F.lit(_FOREVER).cast("timestamp_ntz")
    probes = children.withColumns(
        {"_at": F.coalesce(F.col(end), forever), "_side": F.lit(0)}
    )
    ends = parents.where(F.col("_p_start").isNotNull()).select(
        *keys,
        F.col("_p_start").alias("_at"),
        F.coalesce(F.col("_p_end"), forever).alias("_reach"),
        F.lit(1).alias("_side"),
    )
    both = probes.unionByName(ends, allowMissingColumns=True)
    scanned = running(
        both, keys, "_at", [Measure("_latest", "max", "_reach")], ["_side"], slice_us
    ).where(F.col("_side") == 0)
    return scanned.select(
        *children.columns,
        F.coalesce(F.col("_latest") > F.col(start), F.lit(False)).alias("_has_parent"),
    )
