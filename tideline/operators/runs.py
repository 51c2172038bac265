"""Aligned step functions as runs, written out only at the end.

A timeline aligned to all instants of its site has groups times instants rows, nearly
all of which repeat the row before. Here the instants of a scope are numbered once,
and a group has one run ``[_from, _to)`` of numbers for each of its own changes, so
whatever is joined, summed or derived has as many rows as there are changes.

``expand`` writes the rows out. Instants lie in chunks of ``CHUNK`` as arrays; a run
meets the chunks that it crosses and explodes its part of each, in the stage that
delivers the rows: the rows themselves are never shuffled.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tideline.operators.scan import SESSION, Measure, running

CHUNK = 1024


def _meet(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which equal NULLs meet; the keys come from the left."""
    renamed = {k: f"_r_{k}" for k in keys}
    on = F.lit(True)
    for k, r in renamed.items():
        on = on & F.col(k).eqNullSafe(F.col(r))
    return left.join(right.withColumnsRenamed(renamed), on).drop(*renamed.values())


def number_instants(
    changes: DataFrame, time: str, scope: Sequence[str] = (), slice_rows: int | None = SESSION
) -> DataFrame:
    """Every distinct instant of a scope with its number ``_i`` from 1, and ``_end``, the number after the last."""
    instants = changes.select(time, *scope).distinct().withColumn("_one", F.lit(1).cast("long"))
    measures = [Measure("_i", "sum", "_one"), Measure("_n", "whole", "_one")]
    counted = running(instants, scope, time, measures, slice_rows=slice_rows)
    return counted.withColumn("_end", F.col("_n") + 1).drop("_one", "_n")


def to_runs(
    changes: DataFrame,
    numbered: DataFrame,
    time: str,
    groups: Sequence[str],
    values: Sequence[str],
    scope: Sequence[str] = (),
    slice_rows: int | None = SESSION,
) -> DataFrame:
    """``groups, _from, _to`` and the running sums of ``values``; 0 ahead of a group's first change.

    ``changes`` has at most one row per group and instant, its instants are those of ``numbered``.
    """
    placed = _meet(changes, numbered, [time, *scope]).withColumn("_one", F.lit(1).cast("long"))
    measures = [Measure(f"_sum_{v}", "sum", v) for v in values]
    measures += [Measure("_n", "sum", "_one"), Measure("_next", "next", "_i")]
    levels = running(placed, groups, time, measures, unique_times=True, slice_rows=slice_rows)
    levels = levels.withColumns({v: F.coalesce(f"_sum_{v}", F.lit(0.0)) for v in values})

    def run(start: Column, end: Column, level) -> Column:
        return F.struct(start.alias("_from"), end.alias("_to"), *[level(v).alias(v) for v in values])

    own = run(F.col("_i"), F.coalesce("_next", "_end"), F.col)
    ahead_of_first = run(F.lit(1).cast("long"), F.col("_i"), lambda v: F.lit(0.0))
    first = (F.col("_n") == 1) & (F.col("_i") > 1)
    runs = F.when(first, F.array(ahead_of_first, own)).otherwise(F.array(own))
    return levels.select(*groups, F.inline(runs))


def expand(
    runs: DataFrame, numbered: DataFrame, time: str, scope: Sequence[str] = ()
) -> DataFrame:
    """A row for each instant of each run, with the instant in column ``time``."""

    def chunk(i: Column) -> Column:
        return F.floor((i - 1) / CHUNK)

    chunks = (
        numbered.groupBy(*scope, chunk(F.col("_i")).alias("_chunk"))
        .agg(F.sort_array(F.collect_list(time)).alias("_times"))
    )
    crossed = runs.withColumn(
        "_chunk", F.explode(F.sequence(chunk(F.col("_from")), chunk(F.col("_to") - 1)))
    )
    met = _meet(crossed, chunks, ["_chunk", *scope])
    base = F.col("_chunk") * CHUNK
    start = F.greatest(F.col("_from") - base, F.lit(1))
    end = F.least(F.col("_to") - base, F.lit(CHUNK + 1))
    part = F.slice("_times", start.cast("int"), (end - start).cast("int"))
    kept = [c for c in runs.columns if c not in ("_from", "_to")]
    return met.select(F.explode(part).alias(time), *kept)
