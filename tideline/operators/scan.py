"""Running aggregates over time that do not need one task per group.

A usage timeline has few groups and very many instants, so a plain
``OVER (PARTITION BY group ORDER BY ts)`` would put a whole group into one task.
Here every group is cut into time slices:

1. each slice is reduced to one total (map-side combined, one row per slice);
2. the totals are scanned per group, which sees one row per slice;
3. the carry of each slice joins the slice's rows as its first row, and the
   window runs per (group, slice).

Slices come from the clock, so a recomputed task puts every row where the first
attempt put it. Their width is the session setting ``tideline.slice.seconds``
(900). Where the data are denser than any one width suits, ``slice_rows`` (or the
setting ``tideline.slice.rows``) bounds them as well: rows are written out, cells of
(group, slice) with more rows are found by counting, and their edges come from a
quantile sketch per cell, merged over tasks and stored, so a retry cuts alike.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tideline.functions.buckets import MICROS, floor_div, micros
from tideline.functions.exprs import any_null
from tideline.session import materialise

_SLICE = "_slice"
_PART = "_part"
_AT = "_at_us"
_ROW = "_row"

SESSION = -1  # slice width, or rows of a slice, from the session setting
MOST_PARTS, FINE = 1024, 32
_ALL = (Window.unboundedPreceding, Window.unboundedFollowing)


def slice_width(df: DataFrame) -> int:
    seconds = df.sparkSession.conf.get("tideline.slice.seconds", "900")
    return int(float(seconds) * MICROS)


def slice_limit(df: DataFrame, rows: int | None) -> int | None:
    """Rows that a slice should have at most; None where only the clock cuts."""
    if rows != SESSION:
        return rows
    held = df.sparkSession.conf.get("tideline.slice.rows", None)
    return int(held) if held else None


def _same(left: Sequence[str], prefix: str) -> Column:
    on = F.lit(True)
    for c in left:
        on = on & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return on


def dense_cuts(rows: DataFrame, cell: Sequence[str], at: str, limit: int) -> DataFrame | None:
    """Stored edges (``_edges``, every ``FINE``-th again in ``_coarse``) of cells of over ``limit`` rows.

    Reads ``rows`` twice, or once if there is no such cell. An edge is a value of ``at``, so
    rows of one instant stay together, however many they are.
    """
    counted = rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
    heavy = materialise(counted.where(F.col("_n") > limit))
    most = heavy.agg(F.max("_n")).first()[0]
    if most is None:
        return None
    parts = min(MOST_PARTS, -(-most // limit))
    shares = [i / parts for i in range(1, parts)]
    renamed = heavy.drop("_n").withColumnsRenamed({c: f"_h_{c}" for c in cell})
    dense = rows.join(renamed, _same(cell, "_h_"), "left_semi")
    sketch = F.percentile_approx(at, shares, 10 * parts).alias("_edges")
    edges = dense.groupBy(*cell).agg(sketch)
    return materialise(edges.withColumn("_coarse", F.expr(f"filter(_edges, (e, i) -> i % {FINE} = {FINE - 1})")))


def cut_rows(rows: DataFrame, cuts: DataFrame | None, cell: Sequence[str], at: str) -> DataFrame:
    """``rows`` with ``_part``, their place among the edges of their cell (0 without)."""
    if cuts is None:
        return rows.withColumn(_PART, F.lit(0))
    renamed = cuts.withColumnsRenamed({c: f"_c_{c}" for c in cell})
    joined = rows.join(renamed, _same(cell, "_c_"), "left")

    def passed(edges: Column) -> Column:
        return F.size(F.filter(edges, lambda e: e <= F.col(at)))

    first = passed(F.col("_coarse")) * FINE
    part = first + passed(F.slice("_edges", first + 1, F.lit(FINE)))
    part = F.when(F.col("_edges").isNull(), 0).otherwise(part)
    return joined.withColumn(_PART, part).drop("_edges", "_coarse", *[f"_c_{c}" for c in cell])


@dataclass(frozen=True)
class Measure:
    """``out`` = running ``kind`` ("sum", "last" non-NULL, "max") of ``column``.

    Two kinds look past the row: "next" is the value of the row after it (for rows
    without ties), "whole" the sum over the group.
    """

    out: str
    kind: str
    column: str

    def total(self, value: Column, order: Column, descending: bool = False) -> Column:
        if self.kind in ("sum", "whole"):
            return F.sum(value)
        if self.kind == "max":
            return F.max(value)
        latest = F.min_by if descending != (self.kind == "next") else F.max_by
        return latest(value, F.when(value.isNotNull(), order))

    def carried(self, value: Column, ordered) -> Column:
        """What a slice gets from the totals of the others."""
        if self.kind == "whole":
            return F.sum(value).over(ordered.rowsBetween(*_ALL))
        if self.kind == "next":
            after = ordered.rowsBetween(1, Window.unboundedFollowing)
            return F.first(value, ignorenulls=True).over(after)
        return self.over(value, ordered.rowsBetween(Window.unboundedPreceding, -1))

    def over(self, value: Column, window) -> Column:
        if self.kind == "sum":
            return F.sum(value).over(window)
        if self.kind == "max":
            return F.max(value).over(window)
        return F.last(value, ignorenulls=True).over(window)

    def within(self, value: Column, ordered, frame) -> Column:
        """In a slice whose first row, the one with ``_row`` 0, holds what was carried."""
        carried = F.first(F.when(F.col(_ROW) == 0, value), ignorenulls=True)
        if self.kind == "whole":
            return carried.over(ordered.rowsBetween(*_ALL))
        if self.kind == "next":
            return F.coalesce(F.lead(value).over(ordered), carried.over(ordered.rowsBetween(*_ALL)))
        return self.over(value, ordered.rowsBetween(*frame))


def running(
    df: DataFrame,
    groups: Sequence[str],
    time: str,
    measures: Sequence[Measure],
    ties: Sequence[str] = (),
    slice_us: int | None = SESSION,
    exclusive: bool = False,
    unique_times: bool = False,
    slice_rows: int | None = SESSION,
    descending: bool = False,
) -> DataFrame:
    """Add running measures per group in (time, ties) order.

    ``exclusive`` leaves the current row out. ``slice_us=None`` is the plain
    window, for groups whose row count is known to be small. A sliced task holds
    at most one slice of one group, the middle step one row per slice of a group.
    ``unique_times`` promises at most one non-NULL value per group and instant,
    which lets the slice totals use a hash aggregate. With ``slice_rows`` the input is
    written to the shared folder, and cells of more rows are cut at quantiles.
    ``descending`` runs from the latest instant to the earliest (sums and maxima, or
    "last" with one row per instant and no ``ties``).
    """

    def ordered(column: str) -> Column:
        return F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_first()

    order = [ordered(c) for c in (time, *ties)]
    last_row = -1 if exclusive else Window.currentRow
    frame = (Window.unboundedPreceding, last_row)

    if slice_us is None:
        plain = df.withColumn(_ROW, F.lit(1))
        window = Window.partitionBy(*groups).orderBy(*order)
        own = {m.out: m.within(F.col(m.column), window, frame) for m in measures}
        own |= {
            m.out: F.sum(F.col(m.column)).over(window.rowsBetween(*_ALL)) for m in measures if m.kind == "whole"
        }
        return plain.withColumns(own).drop(_ROW)

    width = slice_width(df) if slice_us == SESSION else slice_us
    inputs = {f"_in{i}": m for i, m in enumerate(measures)}
    rows = df.withColumns(
        {
            _SLICE: floor_div(micros(F.col(time)), width),
            **{c: F.col(m.column) for c, m in inputs.items()},
        }
    )
    slices = [_SLICE]
    limit = slice_limit(df, slice_rows)
    if limit is not None:
        cell = [*groups, _SLICE]
        rows = materialise(rows.withColumn(_AT, micros(F.col(time))))
        rows = cut_rows(rows, dense_cuts(rows, cell, _AT, limit), cell, _AT).drop(_AT)
        slices.append(_PART)
    rank = F.struct(time, *ties) if ties and not unique_times else F.col(time)
    totals = rows.groupBy(*groups, *slices).agg(
        *[m.total(F.col(c), rank, descending).alias(c) for c, m in inputs.items()]
    )
    by_slice = Window.partitionBy(*groups).orderBy(*[ordered(c) for c in slices])
    carry = totals.select(
        *groups,
        *slices,
        *[m.carried(F.col(c), by_slice).alias(c) for c, m in inputs.items()],
        F.lit(0).alias(_ROW),
    )
    both = rows.withColumn(_ROW, F.lit(1)).unionByName(carry, allowMissingColumns=True)
    window = Window.partitionBy(*groups, *slices).orderBy(_ROW, *order)
    return (
        both.withColumns({m.out: m.within(F.col(c), window, frame) for c, m in inputs.items()})
        .where(F.col(_ROW) == 1)
        .drop(_ROW, *slices, *inputs)
    )


def at_most_per_key(df: DataFrame, keys: Sequence[str], limit: int) -> bool:
    """Whether no key holds more than ``limit`` rows (one aggregation, run now)."""
    over = df.groupBy(*keys).count().where(F.col("count") > limit)
    return over.isEmpty()


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_on: str,
    right_on: str,
    payload: Sequence[str],
    ties: Sequence[str] = (),
    era_limit: int | None = None,
    slice_us: int | None = SESSION,
) -> DataFrame:
    """Backward as-of join: the latest right row with ``right_on <= left_on`` per key.

    Equal instants match; several right rows at one instant resolve to the last
    in ``ties`` order (columns of ``right``). Unmatched left rows keep NULLs, and a
    NULL key matches nothing.

    With ``era_limit``, the right side is counted per key first. While no key has
    more rows, each row becomes the era up to its successor and an equi-join finds
    the one era of a left row, reading the left side once. Without the limit, or
    beyond it, a tagged union and a sliced running "last" need no pairs at all.
    """
    known = F.col(right_on).isNotNull() & ~any_null(by)
    right = right.where(known)
    if era_limit is not None and at_most_per_key(right, by, era_limit):
        return _join_eras(left, right, by, left_on, right_on, payload, ties)
    keep = left.columns
    tie_names = [f"_tie{i}" for i in range(len(ties))]
    probe = left.withColumns({"_at": F.col(left_on), "_side": F.lit(1)})
    found = right.select(
        *by,
        F.col(right_on).alias("_at"),
        F.lit(0).alias("_side"),
        F.struct(*payload).alias("_found"),
        *[F.col(t).alias(n) for t, n in zip(ties, tie_names)],
    )
    both = probe.unionByName(found, allowMissingColumns=True)
    out = running(
        both,
        by,
        "_at",
        [Measure("_match", "last", "_found")],
        ties=["_side", *tie_names],
        slice_us=slice_us,
    ).where(F.col("_side") == 1)
    return out.select(*keep, *[F.col(f"_match.{p}").alias(p) for p in payload])


def _join_eras(left, right, by, left_on, right_on, payload, ties) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(right_on, *ties)
    eras = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in by],
        F.col(right_on).alias("_since"),
        F.lead(right_on).over(order).alias("_until"),
        F.struct(*payload).alias("_match"),
    )
    at = F.col(left_on)
    on = (at >= F.col("_since")) & (F.col("_until").isNull() | (at < F.col("_until")))
    for k in by:
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    joined = left.join(eras, on, "left")
    return joined.select(
        *left.columns, *[F.col(f"_match.{p}").alias(p) for p in payload]
    )
