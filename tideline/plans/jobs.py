"""Whole runs over several sites, planned as one."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from functools import reduce
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tideline import vocab
from tideline.contracts import INTERVAL, UsageSpec
from tideline.operators.clamp import ACTIONS, HOT_PARENTS, KEYS, clamp_hierarchy
from tideline.operators.derive import to_wide
from tideline.operators.scan import SESSION
from tideline.plans.compat import to_compat_format
from tideline.plans.usage import resample, run_usage
from tideline.session import copies, materialise, release, scratch
from tideline.sources.adapters import REGISTRY, in_window, sites_to_intervals
from tideline.sources.builders import Tables
from tideline.sources.legacy import legacy_usage_counts, read_daily_cache
from tideline.sources.sinks import write_report, write_usage
from tideline.sources.tables import RawTableError, load_raw_tables

logger = logging.getLogger(__name__)

#: A site's raw tables: the folder they are in, or the tables themselves.
Raw = str | Tables
SITE = ("site",)
#: Rows that one task of an unsampled timeline should hold at most.
DENSE_ROWS = 2_000_000


@dataclass(frozen=True)
class Audit:
    """How many rows of a metric clamping left in each state."""

    metric: str
    action: str
    rows: int


@dataclass(frozen=True)
class Processed:
    """What a run wrote, and what clamping did on the way."""

    usage: DataFrame
    audit: list[Audit]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# --- intervals --------------------------------------------------------------------


def load_sites(spark: SparkSession, sites: Mapping[str, Raw]) -> dict[str, Tables]:
    """Raw tables of every site; one whose tables cannot be read is logged and left out."""
    loaded = {}
    for site, raw in sites.items():
        try:
            loaded[site] = load_raw_tables(spark, raw) if isinstance(raw, str) else raw
        except RawTableError as exc:
            logger.error("[%s] left out: %s", site, exc)
    if not loaded:
        raise RawTableError(f"none of {list(sites)} could be loaded")
    return loaded


_CELLS = {f"{m}/{a}": (m, a) for m in vocab.BASE_METRICS for a in ACTIONS}


def _observed(clamped: DataFrame) -> tuple[DataFrame, Observation]:
    """``clamped``, counted by metric and action while something else reads it."""
    seen = Observation("clamp_audit")
    # the texts are compared once a row, not once a row and cell
    places = {c: F.lit(None).cast("int") for c in ("metric", "coerce_action")}
    for c, names in (("metric", vocab.BASE_METRICS), ("coerce_action", ACTIONS)):
        for i, name in enumerate(names):
            places[c] = F.when(F.col(c) == name, i).otherwise(places[c])
    cell = places["metric"] * len(ACTIONS) + places["coerce_action"]
    counts = [F.count_if(F.col("_cell") == i).alias(name) for i, name in enumerate(_CELLS)]
    return clamped.withColumn("_cell", cell).observe(seen, *counts).drop("_cell"), seen


def valid_intervals(
    intervals: DataFrame,
    site: str | None = None,
    cut: bool = True,
    audit: list[Audit] | None = None,
    keep: Sequence[str] | None = None,
    spent: Sequence[DataFrame] = (),
) -> DataFrame:
    """Clamped, valid intervals; rows of one site never clamp those of another.

    Without a site column all rows are those of ``site``. With ``cut`` both the
    intervals and the result are written to the shared folder: the first is read
    once per metric and level, the second twice. ``audit`` then gets the counts of
    each metric and action, valid or not, from the pass that writes the result.
    ``keep`` names the columns wanted besides those of an interval (all by default);
    the copies then hold no others, but for the keys of the levels. Copies in ``spent``
    are those that only ``intervals`` reads; they go when it is written, and all others of
    this step when its result is.
    """
    if "site" not in intervals.columns:
        intervals = intervals.withColumn("site", F.lit(site))
    wanted = None
    if keep is not None:
        wanted = list(dict.fromkeys((*INTERVAL, *SITE, *keep)))
        intervals = intervals.select(*[c for c in intervals.columns if c in (*wanted, *KEYS)])

    def valid_of(clamped: DataFrame) -> DataFrame:
        valid = clamped.where("valid")
        return valid if wanted is None else valid.select(*wanted)

    if not cut:
        return valid_of(clamp_hierarchy(intervals, SITE))
    # not partitioned by metric, which would sort all rows: an adapter's files hold its metrics only
    with copies() as made:
        intervals = materialise(intervals)
        release(spent)
        clamped = clamp_hierarchy(intervals, SITE, hot_limit=HOT_PARENTS, cut=True, keep=wanted)
        counted, seen = (clamped, None) if audit is None else _observed(clamped)
        valid = materialise(valid_of(counted), observed=seen)
    release(made, but=valid)
    if audit is None:
        return valid
    found = valid.tideline_observed
    audit.extend(Audit(*cell, found[name]) for name, cell in _CELLS.items() if found[name])
    return valid


def sites_usage(
    sites: Mapping[str, Tables],
    spec: UsageSpec,
    resample_interval: str | None = None,
    adapters=REGISTRY,
    cut: bool = True,
    audit: list[Audit] | None = None,
    spent: Sequence[DataFrame] = (),
) -> DataFrame:
    """Usage of all sites from one plan: the number of jobs does not grow with them.

    Rows, metrics and instants of a site do not depend on the others, so each site
    gets what a run over it alone would give. Copies in ``spent`` are those that only the
    sites' tables read; with ``cut`` they go once the intervals are written.
    """
    with copies() as made:
        intervals = sites_to_intervals(
            sites, adapters, time_range=spec.time_range, keep=(*KEYS, *spec.group_cols), cut=cut
        ).withColumn("collector_type", F.lit(vocab.CURRENT))
    rows = in_window(intervals, spec.time_range)
    valid = valid_intervals(rows, cut=cut, audit=audit, keep=spec.group_cols, spent=(*spent, *made))
    rows = DENSE_ROWS if cut else SESSION
    return run_usage(valid, spec, resample_interval, scope=SITE, slice_rows=rows)


# --- jobs -------------------------------------------------------------------------


def process(
    spark: SparkSession,
    sites: Mapping[str, Raw],
    spec: UsageSpec,
    output: str,
    resample_interval: str | None = None,
    adapters=REGISTRY,
    export: Callable[[DataFrame], None] | None = None,
    cut: bool = True,
    run: str | None = None,
    spent: Sequence[DataFrame] = (),
) -> Processed:
    """Usage of every site (name -> raw tables) to one folder, partitioned by site.

    A site whose raw tables cannot be loaded is logged and left out; any other
    error stops the run. ``export`` gets the wide output of all sites. The audit is
    empty without ``cut``. Scratch tables are removed; a ``run`` that has a name and
    fails leaves them for the next one of that name. ``spent`` as for ``sites_usage``.
    """
    audit: list[Audit] = []
    loaded = load_sites(spark, sites)
    with scratch(spark, run):
        usage = sites_usage(loaded, spec, resample_interval, adapters, cut, audit, spent)
        write_usage(usage, output)
    usage = spark.read.schema(usage.schema).parquet(output)
    if export:
        export(to_compat_format(usage))
    return Processed(usage, audit)


def combine_collectors(
    current: Mapping[str, DataFrame], legacy: Mapping[str, DataFrame]
) -> DataFrame:
    """Both collectors' timelines of all sites, one below the other."""
    frames = []
    for collector, by_site in ((vocab.CURRENT, current), (vocab.LEGACY, legacy)):
        frames += [
            df.withColumns({"site": F.lit(s), "collector_type": F.lit(collector)})
            for s, df in by_site.items()
        ]
    return _union(frames)


def report(
    spark: SparkSession,
    sites: Mapping[str, Raw],
    legacy_caches: Mapping[str, str | DataFrame],
    spec: UsageSpec,
    interval: str,
    folder: str,
    cut: bool = True,
    run: str | None = None,
    spent: Sequence[DataFrame] = (),
) -> DataFrame:
    """Resampled usage of both collectors to three file formats; returns it wide.

    The caches of the earlier collector are stacked with their site, summed and
    sampled as one frame. What is returned reads the parquet files just written. ``spent``
    as for ``sites_usage``.
    """
    loaded = load_sites(spark, sites)
    with scratch(spark, run):
        usage = sites_usage(loaded, spec, interval, cut=cut, spent=spent)
        if legacy_caches:
            caches = [
                (read_daily_cache(spark, c) if isinstance(c, str) else c).withColumn("site", F.lit(s))
                for s, c in legacy_caches.items()
            ]
            context = UsageSpec(("metric", "resource", "site"), spec.time_range)
            legacy = resample(legacy_usage_counts(_union(caches), SITE), interval, context)
            usage = usage.unionByName(legacy.withColumn("collector_type", F.lit(vocab.LEGACY)))
        written = write_report(usage, folder)
    return to_wide(written, ["metric", "collector_type"])
