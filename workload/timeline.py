"""Queries over event intervals, with their DuckDB statements."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.contracts import UsageSpec
from tideline.functions.buckets import DAY_US
from tideline.operators import clamp as clamping
from tideline.operators import overlap, steps, sweep
from tideline.operators.derive import collapse_dimension, compute_derived_metrics, to_wide
from tideline.plans import usage
from tideline.session import shared_folder
from tideline.sources.adapters import in_window
from workload.views import EVENT_INTERVALS, Inputs, duck

START, END = datetime(2024, 1, 3), datetime(2024, 1, 28)
GROUPS = ("metric", "resource", "site", "collector_type")
SPEC = UsageSpec(GROUPS, (START, END))
METRICS = ("total", "reservable", "committed", "occupied_reservation", "occupied_ondemand")
DERIVED = ("ondemand_capacity", "available_reservable", "idle", "available_ondemand")
LO, HI = f"TIMESTAMP '{START}'", f"TIMESTAMP '{END}'"


def num(column: str, digits: int = 4):
    """Rounded, and without a negative zero."""
    return (F.round(F.col(column), digits) + 0.0).alias(column)


def plain(df: DataFrame, digits: int = 4) -> DataFrame:
    """Names free of keywords and doubles rounded, as the SQL writes them."""
    out = []
    for name, kind in df.dtypes:
        column = num(name, digits) if kind == "double" else F.col(name)
        out.append(column.alias({"start": "start_ts", "end": "end_ts"}.get(name, name)))
    return df.select(*out)


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.interval_counts(Inputs(spark, sf_dir).event_intervals(), SPEC)


# --- DuckDB building blocks ---------------------------------------------------------

_G = ", ".join(GROUPS)


def _per_metric(change: str = "value") -> str:
    return ", ".join(
        f"coalesce(sum({change}) FILTER (WHERE metric = '{m}'), 0) AS {m}" for m in METRICS
    )


def derive_sql(source: str, index: str) -> str:
    """Derived columns of a wide source, back to long."""
    first = (
        f"SELECT *, total - reservable AS ondemand_capacity, "
        f"reservable - committed AS available_reservable, "
        f"committed - occupied_reservation AS idle FROM {source}"
    )
    wide = f"SELECT *, ondemand_capacity - occupied_ondemand AS available_ondemand FROM ({first})"
    return (
        f"SELECT {index}, metric, round(value, 4) + 0.0 AS value FROM ({wide}) "
        f"UNPIVOT (value FOR metric IN ({', '.join(METRICS + DERIVED)}))"
    )


CTES = {
    "event_intervals": EVENT_INTERVALS,
    "deltas": f"""
        SELECT start_ts AS timestamp, {_G}, value AS change FROM {{event_intervals}}
        UNION ALL
        SELECT end_ts, {_G}, -value FROM {{event_intervals}} WHERE end_ts IS NOT NULL
    """,
    "counts": f"""
        SELECT timestamp, {_G},
               sum(sum(change)) OVER (PARTITION BY {_G} ORDER BY timestamp) AS value
        FROM {{deltas}} GROUP BY timestamp, {_G}
    """,
    "clipped": f"SELECT * FROM {{counts}} WHERE timestamp <= {HI}",
    "buckets": f"""
        SELECT unnest(generate_series({LO}, {HI} - INTERVAL '1' SECOND, INTERVAL '1' DAY)) AS bucket
    """,
    "point": f"""
        SELECT s.bucket AS timestamp, s.metric, s.resource, s.site, s.collector_type,
               coalesce(c.value, 0) AS value
        FROM (SELECT * FROM (SELECT DISTINCT {_G} FROM {{clipped}}) CROSS JOIN {{buckets}}) s
        ASOF LEFT JOIN {{clipped}} c
          ON s.metric = c.metric AND s.resource = c.resource AND s.site = c.site
         AND s.collector_type = c.collector_type AND s.bucket >= c.timestamp
    """,
    "point_wide": f"""
        SELECT timestamp, resource, site, collector_type, {_per_metric()}
        FROM {{point}} GROUP BY timestamp, resource, site, collector_type
    """,
    "daily": derive_sql("{point_wide}", "timestamp, resource, site, collector_type"),
}


def sql(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    return duck(list(names), body, {**CTES, **(extra or {})})


# --- sweep --------------------------------------------------------------------------

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, oracle: str | None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


@query(
    "interval_deltas",
    sql(
        "SELECT timestamp, metric, resource, site, collector_type, "
        "round(change, 4) + 0.0 AS change FROM deltas",
        "deltas",
    ),
)
def interval_deltas(spark, sf_dir):
    intervals = Inputs(spark, sf_dir).event_intervals()
    return plain(sweep.intervals_to_deltas(intervals, "start", "end", GROUPS, "value"))


@query(
    "interval_counts",
    sql(
        """
        SELECT timestamp, metric, site,
               CAST(sum(sum(change)) OVER (PARTITION BY metric, site ORDER BY timestamp) AS BIGINT) AS value
        FROM (SELECT start_ts AS timestamp, metric, site, 1 AS change FROM event_intervals
              UNION ALL
              SELECT end_ts, metric, site, -1 FROM event_intervals WHERE end_ts IS NOT NULL)
        GROUP BY timestamp, metric, site
        """,
        "event_intervals",
    ),
)
def interval_counts(spark, sf_dir):
    intervals = Inputs(spark, sf_dir).event_intervals()
    return sweep.intervals_to_counts(intervals, "start", "end", ["metric", "site"])


@query(
    "interval_counts_value",
    sql(f"SELECT timestamp, {_G}, round(value, 4) + 0.0 AS value FROM counts", "counts"),
)
def interval_counts_value(spark, sf_dir):
    return plain(counts(spark, sf_dir))


@query(
    "interval_counts_dense",
    sql(f"SELECT timestamp, {_G}, round(value, 4) + 0.0 AS value FROM counts", "counts"),
)
def interval_counts_dense(spark, sf_dir):
    """As ``interval_counts_value``, in slices whose edges come from the data."""
    rows = Inputs(spark, sf_dir).event_intervals()
    out = sweep.intervals_to_counts(
        rows, "start", "end", GROUPS, "value", slice_us=30 * DAY_US, slice_rows=500
    )
    return plain(out)


@query(
    "overlap_filter",
    sql(
        f"""
        SELECT entity_id, start_ts, end_ts, metric, resource, round(value, 4) + 0.0 AS value
        FROM event_intervals
        WHERE start_ts <= {HI} AND (end_ts IS NULL OR end_ts >= {LO})
        """,
        "event_intervals",
    ),
)
def overlap_filter(spark, sf_dir):
    kept = in_window(Inputs(spark, sf_dir).event_intervals(), (START, END))
    return plain(kept.select("entity_id", "start", "end", "metric", "resource", "value"))


@query(
    "clip_window",
    sql(f"SELECT timestamp, {_G}, round(value, 4) + 0.0 AS value FROM clipped", "clipped"),
)
def clip_window(spark, sf_dir):
    return plain(usage.clip_to_window(counts(spark, sf_dir), SPEC))


# --- step functions -----------------------------------------------------------------


@query(
    "align_steps",
    sql(
        """
        SELECT g.timestamp, g.metric,
               last_value(c.value IGNORE NULLS) OVER (
                   PARTITION BY g.metric ORDER BY g.timestamp
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
        FROM (SELECT * FROM (SELECT DISTINCT metric FROM by_metric)
              CROSS JOIN (SELECT DISTINCT timestamp FROM by_metric)) g
        LEFT JOIN by_metric c ON g.metric = c.metric AND g.timestamp = c.timestamp
        """,
        "by_metric",
        extra={
            "by_metric": """
                SELECT timestamp, metric,
                       CAST(sum(sum(change)) OVER (PARTITION BY metric ORDER BY timestamp) AS BIGINT) AS value
                FROM (SELECT start_ts AS timestamp, metric, 1 AS change FROM {event_wide}
                      UNION ALL
                      SELECT end_ts, metric, -1 FROM {event_wide} WHERE end_ts IS NOT NULL)
                GROUP BY timestamp, metric
            """
        },
    ),
)
def align_steps(spark, sf_dir):
    events = Inputs(spark, sf_dir)["event_wide"]
    counted = sweep.intervals_to_counts(events, "start_ts", "end_ts", ["metric"])
    return steps.align_step_functions(counted, "timestamp", "value", ["metric"])


@query(
    "resample_point",
    sql(
        f"SELECT timestamp, {_G}, round(value, 4) + 0.0 AS value FROM point", "point"
    ),
)
def resample_point(spark, sf_dir):
    clipped = usage.clip_to_window(counts(spark, sf_dir), SPEC)
    return plain(usage.resample(clipped, "1d", SPEC))


@query(
    "resample_calendar",
    sql(
        f"""
        SELECT s.bucket AS timestamp, s.metric, s.resource,
               round(coalesce(c.value, 0), 4) + 0.0 AS value
        FROM (SELECT * FROM (SELECT DISTINCT metric, resource FROM orders_open)
              CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '1996-02-01',
                   TIMESTAMP '1998-12-31', INTERVAL '1' MONTH)) AS bucket)) s
        ASOF LEFT JOIN (SELECT timestamp, metric, resource, CAST(sum(sum(change)) OVER
                 (PARTITION BY metric, resource ORDER BY timestamp) AS DOUBLE) AS value
              FROM orders_open GROUP BY timestamp, metric, resource) c
          ON s.metric = c.metric AND s.resource = c.resource AND s.bucket >= c.timestamp
        """,
        "orders_open",
        extra={
            "orders_open": """
                SELECT start_date AS timestamp, project_id AS metric, 'leases' AS resource, 1 AS change
                FROM {leases}
                UNION ALL
                SELECT end_date, project_id, 'leases', -1 FROM {leases} WHERE end_date IS NOT NULL
            """
        },
    ),
)
def resample_calendar(spark, sf_dir):
    leases = Inputs(spark, sf_dir)["leases"].select(
        F.col("start_date").alias("start"),
        F.col("end_date").alias("end"),
        F.col("project_id").alias("metric"),
        F.lit("leases").alias("resource"),
    )
    counted = sweep.intervals_to_counts(leases, "start", "end", ["metric", "resource"])
    sampled = steps.resample_step_function(
        counted.withColumn("value", F.col("value").cast("double")),
        "timestamp",
        "value",
        "1mo",
        ["metric", "resource"],
        (datetime(1996, 2, 1), datetime(1999, 1, 1)),
    )
    return plain(sampled)


# an hour's share of cents can end in a 5 at the fifth place, hence six
_WEIGHTED = sql(
        f"""
        SELECT g.bucket AS timestamp, g.metric, g.resource, g.site, g.collector_type,
               round(sum(s.value * epoch(least(s.upto, g.bucket + INTERVAL '1' DAY)
                                         - greatest(s.timestamp, g.bucket)))
                     / sum(epoch(least(s.upto, g.bucket + INTERVAL '1' DAY)
                                 - greatest(s.timestamp, g.bucket))), 6) + 0.0 AS value
        FROM (SELECT * FROM (SELECT DISTINCT {_G} FROM counts) CROSS JOIN buckets) g
        LEFT JOIN (SELECT *, coalesce(lead(timestamp) OVER (
                       PARTITION BY {_G} ORDER BY timestamp), {HI} + INTERVAL '1' YEAR) AS upto
                   FROM counts) s
          ON s.metric = g.metric AND s.resource = g.resource AND s.site = g.site
         AND s.collector_type = g.collector_type
         AND s.timestamp < g.bucket + INTERVAL '1' DAY AND s.upto > g.bucket
        GROUP BY g.bucket, g.metric, g.resource, g.site, g.collector_type
        """,
        "counts",
        "buckets",
    )


@query("resample_weighted", _WEIGHTED)
def resample_weighted(spark, sf_dir):
    return plain(usage.resample_weighted(counts(spark, sf_dir), "1d", SPEC), 6)


@query("weighted_usage", _WEIGHTED)
def weighted_usage(spark, sf_dir):
    intervals = Inputs(spark, sf_dir).event_intervals()
    return plain(usage.weighted_usage(intervals, "1d", SPEC), 6)


# --- derive and whole runs ----------------------------------------------------------


@query("derived_metrics", sql("SELECT * FROM daily", "daily"))
def derived_metrics(spark, sf_dir):
    clipped = usage.clip_to_window(counts(spark, sf_dir), SPEC)
    return plain(compute_derived_metrics(usage.resample(clipped, "1d", SPEC), SPEC))


def daily_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.run_usage(Inputs(spark, sf_dir).event_intervals(), SPEC, "1d")


@query("usage_daily", sql("SELECT * FROM daily", "daily"))
def usage_daily(spark, sf_dir):
    return plain(daily_usage(spark, sf_dir))


@query(
    "usage_full",
    sql(
        derive_sql("levels", "timestamp, resource"),
        "levels",
        extra={
            "changes": f"""
                SELECT timestamp, resource, {_per_metric("change")}
                FROM {{deltas}} WHERE timestamp <= {HI} GROUP BY timestamp, resource
            """,
            "levels": """
                SELECT g.timestamp, g.resource, """
            + ", ".join(
                f"sum(coalesce({m}, 0)) OVER (PARTITION BY g.resource ORDER BY g.timestamp) AS {m}"
                for m in METRICS
            )
            + """
                FROM (SELECT * FROM (SELECT DISTINCT timestamp FROM {changes})
                      CROSS JOIN (SELECT DISTINCT resource FROM {changes})) g
                LEFT JOIN {changes} c ON c.timestamp = g.timestamp AND c.resource = g.resource
            """,
        },
    ),
)
def usage_full(spark, sf_dir):
    spec = UsageSpec(("metric", "resource"), (START, END))
    intervals = Inputs(spark, sf_dir).event_intervals()
    return plain(usage.run_usage(intervals, spec))


# --- clamping -----------------------------------------------------------------------

_CLAMP_COLUMNS = (
    "entity_id",
    "metric",
    "resource",
    "value",
    "site",
    "hypervisor_hostname",
    "blazar_host_id",
    "blazar_reservation_id",
    "reservation_type",
)


def clamp_sql(
    children: str, parents: str, keys: list[str], need: str, columns=_CLAMP_COLUMNS
) -> str:
    null_key = " OR ".join(f"{k} IS NULL" for k in keys)
    equal = " AND ".join(f"c.{k} = p.{k}" for k in keys)
    names = ", ".join(f"c.{c}" for c in columns)
    return f"""
        SELECT {names},
               CASE WHEN p.p_start IS NULL THEN c.start_ts
                    ELSE greatest(c.start_ts, p.p_start) END AS start_ts,
               CASE WHEN p.p_start IS NULL THEN c.end_ts
                    WHEN c.end_ts IS NULL THEN p.p_end WHEN p.p_end IS NULL THEN c.end_ts
                    ELSE least(c.end_ts, p.p_end) END AS end_ts,
               c.start_ts AS original_start, c.end_ts AS original_end,
               c.branch = 'exempt' OR p.p_start IS NOT NULL AS valid,
               CASE WHEN c.branch = 'exempt' THEN 'none' WHEN c.branch = 'null_key' THEN 'null_key'
                    WHEN p.p_start IS NULL THEN 'orphan'
                    WHEN c.start_ts >= p.p_start AND (p.p_end IS NULL OR
                         (c.end_ts IS NOT NULL AND c.end_ts <= p.p_end)) THEN 'none'
                    ELSE 'clipped' END AS coerce_action,
               CASE WHEN c.branch = 'exempt' THEN 0 WHEN c.branch = 'null_key' THEN 1
                    WHEN p.p_start IS NULL THEN 2 ELSE 3 END AS branch_rank
        FROM (SELECT *, CASE WHEN NOT ({need}) THEN 'exempt'
                             WHEN ({need}) AND ({null_key}) THEN 'null_key'
                             WHEN ({need}) THEN 'match' END AS branch
              FROM {children}) c
        LEFT JOIN (SELECT {', '.join(keys)}, start_ts AS p_start, end_ts AS p_end
                   FROM {parents}) p
          ON c.branch = 'match' AND {equal} AND p.p_start IS NOT NULL
         AND (p.p_end IS NULL OR c.start_ts < p.p_end)
         AND (c.end_ts IS NULL OR c.end_ts > p.p_start)
        WHERE c.branch IS NOT NULL
    """


_AUDIT_SQL = (
    "original_start, original_end, valid, coerce_action"
)


def hierarchy_ctes(source: str, columns=_CLAMP_COLUMNS) -> dict[str, str]:
    """The three clamp levels over ``source`` and their union ``clamped``."""
    names = ", ".join(columns)
    passing = (
        f"SELECT {names}, start_ts, end_ts, start_ts AS original_start, "
        f"end_ts AS original_end, TRUE AS valid, 'none' AS coerce_action FROM {{{source}}} "
    )
    level = f"SELECT {names}, start_ts, end_ts, {_AUDIT_SQL} FROM "
    return {
        "totals": f"SELECT * FROM {{{source}}} WHERE metric = 'total'",
        "level_one": clamp_sql(
            f"(SELECT * FROM {{{source}}} WHERE metric = 'reservable')",
            "{totals}",
            ["hypervisor_hostname", "resource"],
            "hypervisor_hostname IS NOT NULL",
            columns,
        ),
        "level_two": clamp_sql(
            f"(SELECT * FROM {{{source}}} WHERE metric = 'committed')",
            "{level_one}",
            ["blazar_host_id", "hypervisor_hostname", "resource"],
            "reservation_type IN ('physical:host', 'flavor:instance')",
            columns,
        ),
        "first_committed": """
            SELECT * FROM {level_two} QUALIFY row_number() OVER (
                PARTITION BY blazar_reservation_id, hypervisor_hostname, resource
                ORDER BY branch_rank, start_ts NULLS FIRST, entity_id, end_ts ASC NULLS LAST) = 1
        """,
        "level_three": clamp_sql(
            f"(SELECT * FROM {{{source}}} WHERE metric = 'occupied_reservation')",
            "{first_committed}",
            ["blazar_reservation_id", "hypervisor_hostname", "resource"],
            "TRUE",
            columns,
        ),
        "clamped": f"""
            {passing} WHERE metric = 'total'
            UNION ALL {level} {{level_one}} UNION ALL {level} {{level_two}}
            UNION ALL {level} {{level_three}}
            UNION ALL {passing} WHERE metric = 'occupied_ondemand'
        """,
    }


_HIERARCHY = hierarchy_ctes("event_intervals")
_CLAMP_OUT = (
    "entity_id, metric, resource, round(value, 4) + 0.0 AS value, start_ts, end_ts, "
    + _AUDIT_SQL
)


def _clamp_out(df: DataFrame) -> DataFrame:
    return plain(
        df.select("entity_id", "metric", "resource", "value", "start", "end", *clamping.AUDIT)
    )


@query(
    "clamp_one_level",
    sql(f"SELECT {_CLAMP_OUT} FROM level_one", "level_one", extra=_HIERARCHY),
)
def clamp_one_level(spark, sf_dir):
    intervals = Inputs(spark, sf_dir).event_intervals()
    out = clamping.apply_temporal_clamp(
        intervals.where("metric = 'reservable'"),
        intervals.where("metric = 'total'"),
        ["hypervisor_hostname", "resource"],
        F.col("hypervisor_hostname").isNotNull(),
        hot_limit=clamping.HOT_PARENTS,
    )
    return _clamp_out(out)


def clamped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    intervals = Inputs(spark, sf_dir).event_intervals()
    return clamping.clamp_hierarchy(intervals, hot_limit=clamping.HOT_PARENTS, cut=True)


@query(
    "clamp_hierarchy",
    sql(f"SELECT {_CLAMP_OUT} FROM clamped", "clamped", extra=_HIERARCHY),
)
def clamp_hierarchy(spark, sf_dir):
    return _clamp_out(clamped_events(spark, sf_dir))


@query(
    "clamp_audit_counts",
    sql(
        "SELECT metric, resource, coerce_action, valid, CAST(count(*) AS BIGINT) AS n "
        "FROM clamped GROUP BY metric, resource, coerce_action, valid",
        "clamped",
        extra=_HIERARCHY,
    ),
)
def clamp_audit_counts(spark, sf_dir):
    by = ("metric", "resource", "coerce_action", "valid")
    return clamped_events(spark, sf_dir).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


@query(
    "first_parent_per_key",
    sql(
        "SELECT blazar_reservation_id, hypervisor_hostname, resource, start_ts, end_ts "
        "FROM first_committed",
        "first_committed",
        extra=_HIERARCHY,
    ),
)
def first_parent_per_key(spark, sf_dir):
    intervals = Inputs(spark, sf_dir).event_intervals()
    reservable = clamping.apply_temporal_clamp(
        intervals.where("metric = 'reservable'"),
        intervals.where("metric = 'total'"),
        ["hypervisor_hostname", "resource"],
        F.col("hypervisor_hostname").isNotNull(),
    )
    committed = clamping._clamp(
        intervals.where("metric = 'committed'"),
        reservable,
        ["blazar_host_id", "hypervisor_hostname", "resource"],
        F.col("reservation_type").isin("physical:host", "flavor:instance"),
        None,
    )
    keys = ["blazar_reservation_id", "hypervisor_hostname", "resource"]
    return plain(clamping.first_per_key(committed, keys))


_PAIR_SIDES = {
    "kids": "SELECT * FROM {event_wide} WHERE metric = 'committed' AND hypervisor_hostname IS NOT NULL",
    "windows": "SELECT * FROM {event_wide} WHERE metric = 'reservable' AND hypervisor_hostname IS NOT NULL",
}


def _pair_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    known = Inputs(spark, sf_dir)["event_wide"].where("hypervisor_hostname IS NOT NULL")
    kids = known.where("metric = 'committed'")
    windows = known.where("metric = 'reservable'").select(
        "hypervisor_hostname",
        F.col("start_ts").alias("_p_start"),
        F.col("end_ts").alias("_p_end"),
    )
    return kids, windows


_OVERLAP = (
    "k.hypervisor_hostname = w.hypervisor_hostname AND (w.end_ts IS NULL OR k.start_ts < w.end_ts)"
    " AND (k.end_ts IS NULL OR k.end_ts > w.start_ts)"
)


@query(
    "overlap_pairs",
    sql(
        f"""
        SELECT k.entity_id, k.start_ts, k.end_ts, w.start_ts AS parent_start, w.end_ts AS parent_end
        FROM kids k JOIN windows w ON {_OVERLAP}
        """,
        "kids",
        "windows",
        extra=_PAIR_SIDES,
    ),
)
def overlap_pairs(spark, sf_dir):
    kids, windows = _pair_sides(spark, sf_dir)
    pairs = overlap.overlap_pairs(kids, windows, ["hypervisor_hostname"], "start_ts", "end_ts")
    return pairs.select(
        "entity_id",
        "start_ts",
        "end_ts",
        F.col("_p_start").alias("parent_start"),
        F.col("_p_end").alias("parent_end"),
    )


@query(
    "orphan_children",
    sql(
        f"""
        SELECT k.entity_id, k.start_ts, k.end_ts FROM kids k
        WHERE NOT EXISTS (SELECT 1 FROM windows w WHERE {_OVERLAP})
        """,
        "kids",
        "windows",
        extra=_PAIR_SIDES,
    ),
)
def orphan_children(spark, sf_dir):
    kids, windows = _pair_sides(spark, sf_dir)
    flagged = overlap.has_overlap(kids, windows, ["hypervisor_hostname"], "start_ts", "end_ts")
    return flagged.where(~F.col("_has_parent")).select("entity_id", "start_ts", "end_ts")


# --- output transforms --------------------------------------------------------------


@query(
    "collapse_dimension",
    sql(
        """
        SELECT timestamp, metric, resource, collector_type,
               round(coalesce(sum(value), 0), 4) + 0.0 AS value
        FROM daily WHERE site NOT IN ('s2')
        GROUP BY timestamp, metric, resource, collector_type
        """,
        "daily",
    ),
)
def collapse(spark, sf_dir):
    out, _ = collapse_dimension(daily_usage(spark, sf_dir), SPEC, "site", ["s2"])
    return plain(out)


def _pivot_sql(names: list[str], key: str) -> str:
    columns = ", ".join(
        f"coalesce(round(max(value) FILTER (WHERE {key} = '{n}'), 4), 0) + 0.0 AS {n}"
        for n in names
    )
    return f"SELECT timestamp, site, resource, {columns} FROM daily GROUP BY timestamp, site, resource"


@query("to_wide", sql(_pivot_sql(list(METRICS + DERIVED), "metric"), "daily"))
def wide(spark, sf_dir):
    return plain(to_wide(daily_usage(spark, sf_dir)))


@query(
    "combine_cols_wide",
    sql(
        _pivot_sql(
            [f"{m}_current" for m in METRICS + DERIVED], "metric || '_' || collector_type"
        ),
        "daily",
    ),
)
def combined_wide(spark, sf_dir):
    keys = [f"{m}_current" for m in METRICS + DERIVED]
    return plain(
        to_wide(daily_usage(spark, sf_dir), ["metric", "collector_type"], values=keys)
    )


# --- files --------------------------------------------------------------------------


def _scratch(spark: SparkSession, name: str) -> str:
    import uuid

    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("parquet_roundtrip", sql("SELECT * FROM daily", "daily"))
def parquet_roundtrip(spark, sf_dir):
    from tideline.sources.sinks import write_usage

    rows = daily_usage(spark, sf_dir)
    path = _scratch(spark, "usage")
    write_usage(rows, path)
    return plain(spark.read.schema(rows.schema).parquet(path))


@query(
    "json_csv_roundtrip",
    sql(
        "SELECT 'csv' AS format, d.* FROM daily d UNION ALL SELECT 'json', d.* FROM daily d",
        "daily",
    ),
)
def json_csv_roundtrip(spark, sf_dir):
    from tideline.sources.sinks import write_report

    rows = daily_usage(spark, sf_dir)
    folder = _scratch(spark, "report")
    write_report(rows, folder)
    base = f"{folder}/usage_timeline"
    csv = spark.read.schema(rows.schema).option("header", True).csv(f"{base}.csv")
    json = spark.read.schema(rows.schema).json(f"{base}.json")
    both = csv.withColumn("format", F.lit("csv")).unionByName(
        json.withColumn("format", F.lit("json"))
    )
    return plain(both)
