"""Queries behind reports: wide outputs, chart series, project summaries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline import vocab
from tideline.contracts import UsageSpec
from tideline.operators.derive import to_wide
from tideline.operators.rolling import trailing_mean
from tideline.operators.sweep import intervals_to_counts
from tideline.plans import series
from tideline.plans.compat import to_compat_format
from tideline.plans.jobs import combine_collectors
from tideline.plans.usage import resample, run_usage
from tideline.sources.adapters import DEVICE_COMMITTED
from tideline.sources.legacy import legacy_usage_counts
from workload import service, timeline
from workload.timeline import DERIVED, END, HI, METRICS, START, daily_usage, plain
from workload.views import Inputs, duck

QUERIES: dict = {}
ORACLES: dict = {}

_LEGACY = ("total", "reservable", "committed", "occupied_reservation", "available_reservable", "idle")
_KEYS = [f"{m}_current" for m in METRICS + DERIVED] + [f"{m}_legacy" for m in _LEGACY]
OPS = ["p1", "p2", "p3"]
FULL = "s1"  # the site that plays the one with on-demand capacity


def _legacy_wide() -> str:
    total, maint = "sum(total_hours)", "sum(maint_hours)"
    reserved, used = "sum(reserved_hours)", "sum(used_hours)"
    return f"""
        SELECT date AS timestamp, {total} / 24 AS total, ({total} - {maint}) / 24 AS reservable,
               ({reserved} + {used}) / 24 AS committed, {used} / 24 AS occupied_reservation,
               ({total} - {maint} - {reserved} - {used}) / 24 AS available_reservable,
               {reserved} / 24 AS idle
        FROM {{event_cache}} GROUP BY date
    """


CTES = {
    **timeline.CTES,
    "cached": _legacy_wide(),
    "cached_daily": """
        SELECT b.bucket AS timestamp, """
    + ", ".join(f"coalesce(c.{m}, 0) AS {m}" for m in _LEGACY)
    + """
        FROM {buckets} b ASOF LEFT JOIN {cached} c ON b.bucket >= c.timestamp
    """,
    "wide": "SELECT d.timestamp, d.site, d.resource, "
    + ", ".join(
        f"coalesce(max(d.value) FILTER (WHERE d.metric = '{m}'), 0) AS {m}_current"
        for m in METRICS + DERIVED
    )
    + ", "
    + ", ".join(
        f"CASE WHEN d.resource = 'nodes' AND d.site IN ('s0', 's1') THEN max(c.{m}) ELSE 0 END AS {m}_legacy"
        for m in _LEGACY
    )
    + """ FROM {daily} d LEFT JOIN {cached_daily} c ON c.timestamp = d.timestamp
        GROUP BY d.timestamp, d.site, d.resource
    """,
    "comparison": f"""
        SELECT timestamp, site, resource,
               occupied_reservation_current + occupied_ondemand_current + idle_current AS used,
               available_reservable_current + CASE WHEN site = '{FULL}'
                   THEN available_ondemand_current ELSE 0 END AS available,
               CASE WHEN site = '{FULL}' THEN total_current ELSE reservable_current END AS capacity
        FROM {{wide}}
    """,
    "compared": """
        SELECT *, CASE WHEN used + available > 0 THEN used / (used + available) * 100 END AS pct
        FROM (SELECT timestamp, site, resource, used, available, capacity FROM {comparison}
              UNION ALL
              SELECT timestamp, '*', resource, sum(used), sum(available), sum(capacity)
              FROM {comparison} GROUP BY timestamp, resource)
    """,
}


def sql(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    return duck(list(names), body, {**CTES, **(extra or {})})


def query(name: str, oracle: str | None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def report_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily usage of three sites, two of which also have the earlier collector."""
    current = daily_usage(spark, sf_dir)
    cache = legacy_usage_counts(Inputs(spark, sf_dir)["event_cache"])
    cached = resample(cache, "1d", UsageSpec(("metric", "resource"), (START, END)))
    legacy = combine_collectors({}, {"s0": cached, "s1": cached})
    return to_wide(
        current.unionByName(legacy), ["metric", "collector_type"], values=_KEYS
    )


def _rounded(names, digits: int = 4) -> str:
    return ", ".join(f"round({n}, {digits}) + 0.0 AS {n}" for n in names)


@query(
    "report_wide", sql(f"SELECT timestamp, site, resource, {_rounded(_KEYS)} FROM wide", "wide")
)
def report(spark, sf_dir):
    return plain(report_wide(spark, sf_dir))


# --- compatibility output -------------------------------------------------------------

_GAPS = (
    "NOT (site = 's1' AND metric IN ('total', 'occupied_ondemand')) "
    "AND NOT (site = 's2' AND metric = 'occupied_reservation')"
)


@query(
    "compat_wide",
    sql(
        """
        SELECT timestamp AS time, site, 'nodes' AS resource, """
        + _rounded(
            (
                "total",
                "reservable",
                "committed",
                "occupied_ondemand",
                "occupied_reserved",
            )
        )
        + """, round(occupied_ondemand, 4) + 0.0 AS active_ondemand,
               round(occupied_reserved, 4) + 0.0 AS active_reserved
        FROM (SELECT timestamp, site,
                     CASE WHEN site = 's1' THEN reservable ELSE total END AS total,
                     reservable, committed,
                     CASE WHEN site = 's1' THEN 0 ELSE occupied_ondemand END AS occupied_ondemand,
                     CASE WHEN site = 's2' THEN committed ELSE occupied_reservation END AS occupied_reserved
              FROM point_wide WHERE resource = 'nodes')
        """,
        "point_wide",
    ),
)
def compat_wide(spark, sf_dir):
    return plain(to_compat_format(daily_usage(spark, sf_dir).where(_GAPS)))


# --- chart series ---------------------------------------------------------------------


def _stack_sql(layers: list[tuple[str, str]], denominator: str) -> str:
    """One SELECT per layer with its band and percentages spelled out."""
    selects = []
    for i, (name, value) in enumerate(layers):
        below = [v for _, v in layers[:i]]
        band = " + ".join(["0.0", *[f"greatest({v}, 0)" for v in below]])
        pct = " + ".join(["0.0", *[f"({v}) / denom * 100" for v in below]])
        selects.append(
            f"SELECT timestamp, site, resource, '{name}' AS layer, {i} AS position, "
            f"round({value}, 4) + 0.0 AS value, round({band}, 4) + 0.0 AS band_lower, "
            f"round({band} + greatest({value}, 0), 4) + 0.0 AS band_upper, "
            f"round({pct}, 4) + 0.0 AS pct_lower, "
            f"round({pct} + ({value}) / denom * 100, 4) + 0.0 AS pct_upper FROM base"
        )
    base = (
        f"base AS (SELECT *, CASE WHEN {denominator} <> 0 THEN {denominator} ELSE 1 END AS denom FROM wide)"
    )
    text = sql("", "wide").rstrip()
    return f"{text},\n{base}\n" + "\nUNION ALL\n".join(selects)


@query(
    "stacked_bands",
    _stack_sql(
        [
            ("occupied_ondemand", "occupied_ondemand_current"),
            ("occupied_reservation", "occupied_reservation_current"),
            ("idle", "idle_current"),
            ("available", "available_reservable_current + available_ondemand_current"),
        ],
        "total_current",
    ),
)
def stacked_bands(spark, sf_dir):
    return plain(series.stacked_usage(report_wide(spark, sf_dir)))


@query(
    "stacked_pct",
    _stack_sql(
        [
            ("occupied_reservation", "occupied_reservation_current + idle_current"),
            ("available", "available_reservable_current"),
        ],
        "reservable_legacy",
    ),
)
def stacked_pct(spark, sf_dir):
    out = series.stacked_usage(
        report_wide(spark, sf_dir),
        include_ondemand=False,
        merge_reserved=True,
        denominator="reservable_legacy",
    )
    return plain(out)


_SMOOTH = """
    SELECT *, CASE WHEN pct IS NOT NULL THEN avg(pct) OVER (
        PARTITION BY site, resource ORDER BY timestamp
        RANGE BETWEEN INTERVAL '7' DAY PRECEDING AND CURRENT ROW) END AS pct_smooth
    FROM compared
"""


def compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.site_comparison(report_wide(spark, sf_dir), FULL, smooth_days=7)


@query(
    "site_comparison",
    sql(
        f"SELECT timestamp, site, resource, "
        f"{_rounded(('used', 'available', 'capacity', 'pct', 'pct_smooth'))} FROM ({_SMOOTH})",
        "compared",
    ),
)
def site_comparison(spark, sf_dir):
    return plain(compared(spark, sf_dir))


@query(
    "rolling_util",
    sql(
        """
        SELECT timestamp, metric, site, avg(value) OVER (
                   PARTITION BY metric, site ORDER BY timestamp
                   RANGE BETWEEN INTERVAL '3' DAY PRECEDING AND CURRENT ROW) AS mean
        FROM (SELECT timestamp, metric, site, CAST(sum(sum(change)) OVER (
                         PARTITION BY metric, site ORDER BY timestamp) AS BIGINT) AS value
              FROM (SELECT start_ts AS timestamp, metric, site, 1 AS change FROM event_wide
                    UNION ALL
                    SELECT end_ts, metric, site, -1 FROM event_wide WHERE end_ts IS NOT NULL)
              GROUP BY timestamp, metric, site)
        """,
        "event_wide",
    ),
)
def rolling_util(spark, sf_dir):
    # counts are whole numbers, so both engines reach the same double
    events = Inputs(spark, sf_dir)["event_wide"]
    rows = intervals_to_counts(events, "start_ts", "end_ts", ["metric", "site"])
    rolled = trailing_mean(rows, ["metric", "site"], "timestamp", "value", 3, "mean")
    return rolled.drop("value")


@query(
    "display_order",
    sql(
        "SELECT timestamp, site, resource, CASE site WHEN 's2' THEN 0 WHEN 's0' THEN 1 "
        "WHEN 's1' THEN 2 END AS position FROM comparison",
        "comparison",
    ),
)
def display_order(spark, sf_dir):
    wide = report_wide(spark, sf_dir)
    placed = series.with_site_position(wide, ["s0", "s1", "s2"], preferred=["s2"])
    return placed.select("timestamp", "site", "resource", F.col("position").cast("int"))


@query(
    "collector_gap",
    sql(
        """
        SELECT timestamp, site, resource, total_current AS total, reservable_current, reservable_legacy,
               CASE WHEN reservable_legacy > reservable_current
                    THEN round(reservable_legacy - reservable_current, 4) + 0.0 END AS missing_history,
               CASE WHEN reservable_current > reservable_legacy
                    THEN round(reservable_current - reservable_legacy, 4) + 0.0 END AS untracked_maintenance
        FROM (SELECT timestamp, site, resource, """
        + _rounded(("total_current", "reservable_current", "reservable_legacy"))
        + """ FROM wide)
        """,
        "wide",
    ),
)
def collector_gap(spark, sf_dir):
    # rounded before the comparison: running sums of doubles end near, not at, zero
    return plain(series.collector_gap(plain(report_wide(spark, sf_dir))))


MARKS = [
    ("opened", datetime(2024, 1, 1)),
    ("noon", datetime(2024, 1, 9, 12)),
    ("grown", datetime(2024, 1, 17, 5, 30)),
    ("closed", datetime(2024, 2, 20)),
]


@query(
    "nearest_annotation",
    sql(
        """
        SELECT site, resource, label, event_at, timestamp, round(capacity, 4) + 0.0 AS capacity
        FROM compared, (VALUES """
        + ", ".join(f"('{n}', TIMESTAMP '{t}')" for n, t in MARKS)
        + """) AS marks (label, event_at)
        QUALIFY row_number() OVER (PARTITION BY site, resource, label
            ORDER BY abs(epoch_us(timestamp) - epoch_us(event_at)), timestamp) = 1
        """,
        "compared",
    ),
)
def nearest_annotation(spark, sf_dir):
    rows = compared(spark, sf_dir).select("timestamp", "site", "resource", "capacity")
    return plain(
        series.nearest_samples(rows, ["capacity"], MARKS, series=["site", "resource"])
    )


# --- operators and users ----------------------------------------------------------------


@query(
    "ops_user_split",
    sql(
        f"""
        SELECT timestamp, round(ops, 4) + 0.0 AS ops, round("user", 4) + 0.0 AS "user",
               round(reservable, 4) + 0.0 AS reservable,
               round(reservable - ops - "user", 4) + 0.0 AS available
        FROM (SELECT b.bucket AS timestamp,
                     coalesce(sum(change) FILTER (WHERE metric = 'committed' AND is_ops), 0) AS ops,
                     coalesce(sum(change) FILTER (WHERE metric = 'committed' AND NOT is_ops), 0) AS "user",
                     coalesce(sum(change) FILTER (WHERE metric = 'reservable' AND NOT is_ops), 0) AS reservable
              FROM buckets b LEFT JOIN flagged f ON f.at_ts <= b.bucket
              GROUP BY b.bucket)
        """,
        "buckets",
        "flagged",
        extra={
            "flagged": f"""
                SELECT * FROM (
                    SELECT start_ts AS at_ts, metric, project_id IN ('p1', 'p2', 'p3') AS is_ops, 1.0::DOUBLE AS change
                    FROM {{event_wide}}
                    UNION ALL
                    SELECT end_ts, metric, project_id IN ('p1', 'p2', 'p3'), -1.0::DOUBLE
                    FROM {{event_wide}} WHERE end_ts IS NOT NULL)
                WHERE at_ts <= {HI}
            """
        },
    ),
)
def ops_user_split(spark, sf_dir):
    flagged = series.with_ops_flag(Inputs(spark, sf_dir).event_intervals(), OPS)
    spec = UsageSpec(("metric", "resource", "ops"), (START, END))
    return plain(series.ops_user_split(run_usage(flagged, spec, "1d"), vocab.NODES))


@query(
    "project_top20",
    duck(
        ["device_committed_rows", "projects"],
        """
        SELECT r.project_id, p.name, CAST(count(*) AS BIGINT) AS allocations,
               r.project_id IN ('p1', 'p2', 'p3') AS ops
        FROM device_committed_rows r LEFT JOIN projects p ON r.project_id = p.id
        GROUP BY r.project_id, p.name
        ORDER BY allocations DESC, r.project_id NULLS FIRST LIMIT 20
        """,
        service.CTES,
    ),
)
def project_top20(spark, sf_dir):
    inputs = Inputs(spark, sf_dir)
    committed = DEVICE_COMMITTED.intervals(inputs.raw())
    return series.project_summary(committed, inputs["projects"], OPS)
