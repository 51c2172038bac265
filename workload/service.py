"""Queries over service-database tables: builders, adapters, whole runs."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.contracts import INTERVAL, UsageSpec
from tideline.operators.clamp import AUDIT, HOT_PARENTS, KEYS, clamp_hierarchy
from tideline.operators.scan import asof_join
from tideline.plans.jobs import process, report, valid_intervals
from tideline.plans.usage import run_usage
from tideline.session import copies, materialise, release, scratch, shared_folder
from tideline.sources import adapters, builders
from tideline.sources.legacy import legacy_usage_counts
from workload.timeline import DERIVED, METRICS, hierarchy_ctes, plain
from workload.views import RAW_TABLES, VIEWS, Inputs, duck

START, END = datetime(1996, 1, 1), datetime(1998, 1, 1)
LO, HI = f"TIMESTAMP '{START}'", f"TIMESTAMP '{END}'"
SPEC = UsageSpec(("metric", "resource", "site", "collector_type"), (START, END))

QUERIES: dict = {}
ORACLES: dict = {}

_RESOURCES = ("nodes", "vcpus_overcommit", "vcpus", "memory_mb", "disk_gb")
_CONTEXT = (
    "hypervisor_hostname",
    "blazar_host_id",
    "blazar_allocation_id",
    "blazar_lease_id",
    "blazar_reservation_id",
    "reservation_type",
    "instance_id",
    "blazar_device_id",
    "device_name",
    "project_id",
)


def _adapter_sql(
    source: str, entity: str, metric: str, start: str, end: str, context: dict, sizes: dict
) -> str:
    """One adapter's rows: a SELECT per resource, all context columns in order."""
    shared = ", ".join(f"{context.get(c, 'CAST(NULL AS STRING)')} AS {c}" for c in _CONTEXT)
    return "\nUNION ALL\n".join(
        f"SELECT {entity} AS entity_id, {start} AS start_ts, {end} AS end_ts, "
        f"{metric} AS metric, '{r}' AS resource, CAST({size} AS DOUBLE) AS value, {shared} "
        f"FROM {source}"
        for r, size in sizes.items()
    )


CTES = {
    "alloc": """
        SELECT * FROM (
            SELECT a.id, a.compute_host_id, a.reservation_id, r.lease_id,
                   r.resource_type AS reservation_type, h.hypervisor_hostname,
                   h.vcpus AS host_vcpus, l.project_id,
                   CASE WHEN l.start_date IS NULL OR l.created_at > l.start_date
                        THEN l.created_at ELSE l.start_date END AS effective_start,
                   CASE WHEN l.end_date IS NULL OR l.deleted_at < l.end_date
                        THEN l.deleted_at ELSE l.end_date END AS effective_end,
                   CASE WHEN r.resource_type = 'flavor:instance' THEN f.vcpus ELSE h.vcpus END AS effective_vcpus,
                   CASE WHEN r.resource_type = 'flavor:instance' THEN f.memory_mb ELSE h.memory_mb END AS effective_memory_mb,
                   CASE WHEN r.resource_type = 'flavor:instance' THEN f.disk_gb ELSE h.local_gb END AS effective_disk_gb
            FROM {computehost_allocations} a
            LEFT JOIN {computehosts} h ON a.compute_host_id = h.id
            LEFT JOIN {reservations} r ON a.reservation_id = r.id
            LEFT JOIN {instance_reservations} f ON a.reservation_id = f.reservation_id
            LEFT JOIN {leases} l ON r.lease_id = l.id)
        WHERE effective_start <= effective_end
    """,
    "device_alloc": """
        SELECT * FROM (
            SELECT a.id, a.device_id, d.name, d.device_type, d.device_driver, a.reservation_id,
                   r.lease_id, r.resource_type AS reservation_type, l.project_id,
                   CASE WHEN l.start_date IS NULL OR l.created_at > l.start_date
                        THEN l.created_at ELSE l.start_date END AS effective_start,
                   CASE WHEN l.end_date IS NULL OR l.deleted_at < l.end_date
                        THEN l.deleted_at ELSE l.end_date END AS effective_end
            FROM {device_allocations} a
            LEFT JOIN {devices} d ON a.device_id = d.id
            LEFT JOIN {reservations} r ON a.reservation_id = r.id
            LEFT JOIN {leases} l ON r.lease_id = l.id)
        WHERE effective_start <= effective_end
    """,
    "good_events": """
        SELECT a.instance_uuid, e.host, e.event, a.start_time, e.id AS event_id
        FROM {instance_actions} a JOIN {instance_actions_events} e ON a.id = e.action_id
        WHERE e.result = 'Success'
    """,
    "last_hosts": """
        SELECT instance_uuid, host AS last_host FROM {good_events}
        WHERE starts_with(event, 'compute_')
        QUALIFY row_number() OVER (PARTITION BY instance_uuid
            ORDER BY start_time DESC NULLS LAST, event_id DESC) = 1
    """,
    "event_ends": """
        SELECT instance_uuid, min(start_time) FILTER (WHERE event IN (
                   'compute_terminate_instance', 'compute_shelve_offload_instance',
                   'compute_shelve_instance')
                   AND (last_resume IS NULL OR start_time > last_resume)) AS event_terminated_at
        FROM (SELECT *, max(start_time) FILTER (WHERE event = 'compute_unshelve_instance')
                        OVER (PARTITION BY instance_uuid) AS last_resume
              FROM {good_events})
        GROUP BY instance_uuid
    """,
    "first_hosts": """
        SELECT * FROM {compute_nodes} QUALIFY row_number() OVER (
            PARTITION BY hypervisor_hostname ORDER BY created_at, CAST(id AS STRING)) = 1
    """,
    "hints": r"""
        SELECT instance_uuid,
               json_extract_string(spec, '$."nova_object.data".scheduler_hints.reservation[0]') AS hinted,
               nullif(regexp_extract(json_extract_string(spec,
                   '$."nova_object.data".flavor."nova_object.data".name'),
                   '^reservation:(.+)$', 1), '') AS from_flavor
        FROM {request_specs}
    """,
    "launched": """
        SELECT i.id, i.uuid, i.created_at, coalesce(i.node, h.last_host) AS node,
               least(coalesce(i.deleted_at, TIMESTAMP '9999-01-01'),
                     coalesce(i.terminated_at, TIMESTAMP '9999-01-01'),
                     coalesce(e.event_terminated_at, TIMESTAMP '9999-01-01')) AS last_seen,
               coalesce(s.hinted, s.from_flavor) AS blazar_reservation_id,
               CASE WHEN s.hinted IS NULL AND s.from_flavor IS NULL THEN 'ondemand'
                    ELSE 'reservation' END AS booking_type,
               i.vcpus, i.memory_mb, i.root_gb
        FROM {instances} i
        LEFT JOIN {hints} s ON i.uuid = s.instance_uuid
        LEFT JOIN {last_hosts} h ON i.uuid = h.instance_uuid
        LEFT JOIN {event_ends} e ON i.uuid = e.instance_uuid
        WHERE i.launched_at IS NOT NULL
    """,
    "instance_rows": """
        SELECT i.id, i.uuid, i.created_at, i.node,
               CASE WHEN i.last_seen < TIMESTAMP '9999-01-01' THEN i.last_seen END AS deleted_at,
               i.blazar_reservation_id, i.booking_type, i.vcpus, i.memory_mb, i.root_gb,
               coalesce(h.hypervisor_type, f.hypervisor_type) AS hypervisor_type,
               coalesce(h.vcpus, f.vcpus) AS host_vcpus,
               coalesce(h.memory_mb, f.memory_mb) AS host_memory_mb,
               coalesce(h.local_gb, f.local_gb) AS host_disk_gb
        FROM {launched} i
        ASOF LEFT JOIN {compute_nodes} h
          ON i.node = h.hypervisor_hostname AND i.created_at >= h.created_at
        LEFT JOIN {first_hosts} f ON i.node = f.hypervisor_hostname
    """,
    "container_rows": """
        SELECT uuid, started_at AS created_at, status,
               CASE WHEN status IN ('Deleted', 'Error', 'Stopped') THEN updated_at END AS deleted_at,
               host, cpu, memory, disk
        FROM {container} WHERE started_at IS NOT NULL
    """,
    "total_rows": _adapter_sql(
        "{compute_nodes}",
        "hypervisor_hostname",
        "'total'",
        "created_at",
        "deleted_at",
        {"hypervisor_hostname": "hypervisor_hostname"},
        dict(
            zip(
                _RESOURCES,
                ("1", "vcpus * cpu_allocation_ratio", "vcpus", "memory_mb", "local_gb"),
            )
        ),
    ),
    "reservable_rows": _adapter_sql(
        "{computehosts}",
        "hypervisor_hostname",
        "'reservable'",
        "created_at",
        "deleted_at",
        {"blazar_host_id": "id", "hypervisor_hostname": "hypervisor_hostname"},
        {"nodes": "1", "vcpus": "vcpus", "memory_mb": "memory_mb", "disk_gb": "local_gb"},
    ),
    "committed_rows": _adapter_sql(
        "{alloc}",
        "id",
        "'committed'",
        "effective_start",
        "effective_end",
        {
            "blazar_allocation_id": "id",
            "blazar_lease_id": "lease_id",
            "blazar_reservation_id": "reservation_id",
            "reservation_type": "reservation_type",
            "blazar_host_id": "compute_host_id",
            "hypervisor_hostname": "hypervisor_hostname",
        },
        {
            "nodes": "CASE WHEN reservation_type <> 'physical:host' "
            "THEN effective_vcpus / nullif(CAST(host_vcpus AS DOUBLE), 0) ELSE 1 END",
            "vcpus": "effective_vcpus",
            "memory_mb": "effective_memory_mb",
            "disk_gb": "effective_disk_gb",
        },
    ),
    "occupied_rows": _adapter_sql(
        "{instance_rows}",
        "uuid",
        "concat('occupied_', booking_type)",
        "created_at",
        "deleted_at",
        {
            "instance_id": "uuid",
            "blazar_reservation_id": "blazar_reservation_id",
            "hypervisor_hostname": "node",
        },
        {
            "nodes": "CASE WHEN hypervisor_type = 'QEMU' "
            "THEN vcpus / nullif(CAST(host_vcpus AS DOUBLE), 0) ELSE 1 END",
            "vcpus_overcommit": "vcpus",
            "vcpus": "vcpus",
            "memory_mb": "memory_mb",
            "disk_gb": "root_gb",
        },
    ),
    "device_reservable_rows": _adapter_sql(
        "{devices} WHERE reservable = 1",
        "id",
        "'reservable'",
        "created_at",
        "deleted_at",
        {"blazar_device_id": "id", "device_name": "name"},
        {"nodes": "1"},
    ),
    "device_committed_rows": _adapter_sql(
        "{device_alloc}",
        "id",
        "'committed'",
        "effective_start",
        "effective_end",
        {
            "blazar_allocation_id": "id",
            "blazar_lease_id": "lease_id",
            "blazar_reservation_id": "reservation_id",
            "reservation_type": "reservation_type",
            "blazar_device_id": "device_id",
            "device_name": "name",
            "project_id": "project_id",
        },
        {"nodes": "1"},
    ),
    "registry": """
        SELECT * FROM {total_rows} UNION ALL SELECT * FROM {reservable_rows}
        UNION ALL SELECT * FROM {committed_rows} UNION ALL SELECT * FROM {occupied_rows}
        UNION ALL SELECT * FROM {device_reservable_rows}
        UNION ALL SELECT * FROM {device_committed_rows}
    """,
    "in_range": f"""
        SELECT * FROM {{registry}}
        WHERE start_ts <= {HI} AND (end_ts IS NULL OR end_ts >= {LO})
    """,
    **hierarchy_ctes("in_range", ("entity_id", "metric", "resource", "value", *_CONTEXT)),
    "usable_deltas": f"""
        SELECT * FROM (
            SELECT start_ts AS seen_at, resource, metric, value AS change FROM {{clamped}} WHERE valid
            UNION ALL
            SELECT end_ts, resource, metric, -value FROM {{clamped}} WHERE valid AND end_ts IS NOT NULL)
        WHERE seen_at <= {HI}
    """,
    "weekly": f"""
        SELECT g.bucket AS timestamp, g.resource, """
    + ", ".join(
        f"coalesce(sum(d.change) FILTER (WHERE d.metric = '{m}'), 0) AS {m}" for m in METRICS
    )
    + f"""
        FROM (SELECT * FROM (SELECT DISTINCT resource FROM {{usable_deltas}})
              CROSS JOIN (SELECT unnest(generate_series({LO}, {HI} - INTERVAL '1' SECOND,
                                                        INTERVAL '7' DAY)) AS bucket)) g
        LEFT JOIN {{usable_deltas}} d ON d.resource = g.resource AND d.seen_at <= g.bucket
        GROUP BY g.bucket, g.resource
    """,
}


def sql(body: str, *names: str) -> str:
    return duck(list(names), body, CTES)


def query(name: str, oracle: str | None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


# --- builders -------------------------------------------------------------------------

_ALLOC = (
    "id, compute_host_id, reservation_id, lease_id, reservation_type, hypervisor_hostname, "
    "project_id, effective_start, effective_end, CAST(effective_vcpus AS BIGINT) AS effective_vcpus, "
    "CAST(effective_memory_mb AS BIGINT) AS effective_memory_mb, "
    "CAST(effective_disk_gb AS BIGINT) AS effective_disk_gb"
)


@query("alloc_source", sql(f"SELECT {_ALLOC} FROM alloc", "alloc"))
def alloc_source(spark, sf_dir):
    return builders.host_allocations(Inputs(spark, sf_dir).raw()).selectExpr(
        *[c.strip() for c in _ALLOC.split(",")]
    )


_DEVICE_ALLOC = (
    "id, device_id, name, device_type, device_driver, reservation_id, lease_id, "
    "reservation_type, project_id, effective_start, effective_end"
)


@query("device_alloc_source", sql(f"SELECT {_DEVICE_ALLOC} FROM device_alloc", "device_alloc"))
def device_alloc_source(spark, sf_dir):
    return builders.device_allocations(Inputs(spark, sf_dir).raw()).select(
        *_DEVICE_ALLOC.split(", ")
    )


@query(
    "instance_events",
    sql("SELECT instance_uuid, host, event, start_time FROM good_events", "good_events"),
)
def instance_events(spark, sf_dir):
    return builders.instance_events(Inputs(spark, sf_dir).raw()).drop("event_id")


@query("last_host", sql("SELECT * FROM last_hosts", "last_hosts"))
def last_host(spark, sf_dir):
    return builders.last_host(Inputs(spark, sf_dir).raw())


@query("terminated_at", sql("SELECT * FROM event_ends", "event_ends"))
def terminated_at(spark, sf_dir):
    return builders.event_end(Inputs(spark, sf_dir).raw())


@query(
    "reservation_hints",
    sql("SELECT instance_uuid AS uuid, hinted, from_flavor FROM hints", "hints"),
)
def reservation_hints(spark, sf_dir):
    return builders.reservation_hints(Inputs(spark, sf_dir).raw())


@query(
    "earliest_host",
    sql(
        "SELECT hypervisor_hostname AS node, hypervisor_type AS first_hypervisor_type, "
        "CAST(vcpus AS BIGINT) AS first_host_vcpus, CAST(memory_mb AS BIGINT) AS first_host_memory_mb, "
        "CAST(local_gb AS BIGINT) AS first_host_disk_gb FROM first_hosts",
        "first_hosts",
    ),
)
def earliest_host(spark, sf_dir):
    return builders.earliest_host(Inputs(spark, sf_dir).raw())


_ASOF = sql(
        """
        SELECT i.uuid, i.node, i.created_at, h.created_at AS host_created_at,
               h.hypervisor_type, CAST(h.id AS STRING) AS host_id
        FROM instances i ASOF LEFT JOIN compute_nodes h
          ON i.node = h.hypervisor_hostname AND i.created_at >= h.created_at
        """,
        "instances",
        "compute_nodes",
    )


def _asof(spark: SparkSession, sf_dir: str, era_limit: int | None) -> DataFrame:
    raw = Inputs(spark, sf_dir).raw()
    return asof_join(
        raw["nova_instances"].select("uuid", "node", "created_at"),
        builders.host_history(raw),
        ["node"],
        "created_at",
        "host_created_at",
        ["host_created_at", "hypervisor_type", "host_id"],
        ties=["host_id"],
        era_limit=era_limit,
    )


@query("asof_host", _ASOF)
def asof_host(spark, sf_dir):
    return _asof(spark, sf_dir, 1_000)


@query("asof_host_sliced", _ASOF)
def asof_host_sliced(spark, sf_dir):
    return _asof(spark, sf_dir, None)


_INSTANCE = (
    "CAST(id AS STRING) AS id, uuid, created_at, deleted_at, node, blazar_reservation_id, "
    "booking_type, hypervisor_type, CAST(host_vcpus AS BIGINT) AS host_vcpus, "
    "CAST(host_memory_mb AS BIGINT) AS host_memory_mb, CAST(host_disk_gb AS BIGINT) AS host_disk_gb"
)


@query("instance_source", sql(f"SELECT {_INSTANCE} FROM instance_rows", "instance_rows"))
def instance_source(spark, sf_dir):
    return builders.instances(Inputs(spark, sf_dir).raw()).selectExpr(
        *[c.strip() for c in _INSTANCE.split(", ")]
    )


@query(
    "container_source",
    sql("SELECT uuid, created_at, deleted_at, status FROM container_rows", "container_rows"),
)
def container_source(spark, sf_dir):
    rows = builders.containers(Inputs(spark, sf_dir).raw())
    return rows.select("uuid", "created_at", "deleted_at", "status")


# --- adapters -------------------------------------------------------------------------

_CORE = "entity_id, start_ts, end_ts, metric, resource, round(value, 6) + 0.0 AS value"


def _core(df: DataFrame) -> DataFrame:
    return plain(df.select("entity_id", "start", "end", "metric", "resource", "value"), 6)


def _adapter_query(name: str, adapter: adapters.Adapter, cte: str, where: str = "") -> None:
    @query(name, sql(f"SELECT {_CORE} FROM {cte} {where}", cte))
    def run(spark, sf_dir):
        return _core(adapter.intervals(Inputs(spark, sf_dir).raw()))


_adapter_query("unpivot_resources", adapters.HOST_TOTAL, "total_rows")
_adapter_query("host_reservable", adapters.HOST_RESERVABLE, "reservable_rows")
_adapter_query("alloc_committed", adapters.HOST_COMMITTED, "committed_rows")
_adapter_query(
    "instance_reserved",
    adapters.INSTANCE_RESERVED,
    "occupied_rows",
    "WHERE metric = 'occupied_reservation'",
)
_adapter_query(
    "instance_ondemand",
    adapters.INSTANCE_ONDEMAND,
    "occupied_rows",
    "WHERE metric = 'occupied_ondemand'",
)
_adapter_query("device_reservable", adapters.DEVICE_RESERVABLE, "device_reservable_rows")
_adapter_query("device_committed", adapters.DEVICE_COMMITTED, "device_committed_rows")


@query(
    "container_occupied",
    sql(
        "SELECT uuid AS entity_id, created_at AS start_ts, deleted_at AS end_ts, "
        "'occupied_ondemand' AS metric, resource, round(value, 6) + 0.0 AS value "
        "FROM (SELECT uuid, created_at, deleted_at, cpu AS vcpus, memory AS memory_mb, "
        "CAST(disk AS DOUBLE) AS disk_gb FROM container_rows) "
        "UNPIVOT (value FOR resource IN (vcpus, memory_mb, disk_gb))",
        "container_rows",
    ),
)
def container_occupied(spark, sf_dir):
    return _core(adapters.CONTAINER_OCCUPIED.intervals(Inputs(spark, sf_dir).raw()))


@query(
    "diagonal_union",
    sql(
        f"SELECT {_CORE}, hypervisor_hostname, blazar_device_id, device_name FROM "
        "(SELECT * FROM total_rows UNION ALL SELECT * FROM device_reservable_rows)",
        "total_rows",
        "device_reservable_rows",
    ),
)
def diagonal_union(spark, sf_dir):
    both = adapters.to_intervals(
        Inputs(spark, sf_dir).raw(), [adapters.HOST_TOTAL, adapters.DEVICE_RESERVABLE]
    )
    return plain(both, 6)


def registry(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    raw = Inputs(spark, sf_dir, kept=("li",)).raw()
    rows = adapters.to_intervals(raw, adapters.REGISTRY, **how)
    return rows.withColumn("collector_type", F.lit("current"))


@query(
    "registry_intervals",
    sql(f"SELECT {_CORE}, {', '.join(_CONTEXT)} FROM in_range", "in_range"),
)
def registry_intervals(spark, sf_dir):
    rows = adapters.in_window(registry(spark, sf_dir), (START, END))
    return plain(rows.drop("collector_type"), 6)


# --- whole runs -----------------------------------------------------------------------


@query(
    "clamp_service",
    sql(
        "SELECT metric, resource, coerce_action, valid, CAST(count(*) AS BIGINT) AS n, "
        "count(DISTINCT entity_id) AS entities, min(start_ts) AS first_start, "
        "max(end_ts) AS last_end FROM clamped GROUP BY metric, resource, coerce_action, valid",
        "clamped",
    ),
)
def clamp_service(spark, sf_dir):
    by = ("metric", "resource", *AUDIT[2:])
    with copies() as made:
        rows = registry(spark, sf_dir, time_range=(START, END), keep=KEYS, cut=True)
        rows = materialise(adapters.in_window(rows, (START, END)).select(*INTERVAL, *KEYS))
        release(made, but=rows)
        clamped = clamp_hierarchy(rows, hot_limit=HOT_PARENTS, cut=True, keep=("metric", "resource"))
        clamped = materialise(clamped.select("entity_id", "start", "end", *by))
    release(made, but=clamped)
    return clamped.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("entity_id").alias("entities"),
        F.min("start").alias("first_start"),
        F.max("end").alias("last_end"),
    )


def _weekly_wide() -> str:
    first = (
        "SELECT *, total - reservable AS ondemand_capacity, "
        "reservable - committed AS available_reservable, "
        "committed - occupied_reservation AS idle FROM weekly"
    )
    return f"SELECT *, ondemand_capacity - occupied_ondemand AS available_ondemand FROM ({first})"


def _weekly_sql(site: str = "north", metrics: tuple[str, ...] = METRICS + DERIVED) -> str:
    return (
        f"SELECT timestamp, '{site}' AS site, 'current' AS collector_type, resource, metric, "
        f"round(value, 6) + 0.0 AS value FROM ({_weekly_wide()}) "
        f"UNPIVOT (value FOR metric IN ({', '.join(metrics)}))"
    )


@query("process_usage", sql(_weekly_sql(), "weekly"))
def process_usage(spark, sf_dir):
    with copies() as made:
        rows = registry(spark, sf_dir, time_range=(START, END), keep=(*KEYS, *SPEC.group_cols), cut=True)
    rows = adapters.in_window(rows, (START, END))
    valid = valid_intervals(rows, "north", keep=SPEC.group_cols, spent=made)
    return plain(run_usage(valid, SPEC, "7d"), 6)


# Three sites with one set of hosts and devices each. Orders and all that hangs on them are
# dealt out by key, some keys to every site; one site has no instance and no device tables.

_ORDER = {
    "leases": "CAST(id AS BIGINT)",
    "reservations": "CAST(substr(id, 2) AS BIGINT)",
    "computehost_allocations": "CAST(substr(reservation_id, 2) AS BIGINT)",
    "instance_reservations": "CAST(substr(reservation_id, 2) AS BIGINT)",
    "instances": "CAST(id AS BIGINT)",
    "request_specs": "CAST(substr(instance_uuid, 2) AS BIGINT)",
    "instance_actions": "CAST(substr(instance_uuid, 2) AS BIGINT)",
    "instance_actions_events": "CAST(floor(action_id / 10) AS BIGINT)",
    "device_allocations": "CAST(substr(reservation_id, 2) AS BIGINT)",
}
SITES = ("north", "south", "west")
_SMALL_SITE = "west"
_SMALL_METRICS = ("total", "reservable", "committed", "ondemand_capacity", "available_reservable")
_ABSENT = ("nova_instances", "nova_request_specs", "blazar_devices", "blazar_device_allocations")


def _of_site(site: str, key: str) -> str:
    return f"(CAST(floor({key} / 5) AS BIGINT) % {len(SITES)} = {SITES.index(site)} OR {key} % 11 = 0)"


def sites_raw(spark: SparkSession, sf_dir: str) -> dict[str, builders.Tables]:
    """Raw tables of every site."""
    raw = Inputs(spark, sf_dir, kept=("li",)).raw()
    sites = {}
    for site in SITES:
        sites[site] = {
            name: df.where(_of_site(site, _ORDER[RAW_TABLES[name]])) if RAW_TABLES[name] in _ORDER else df
            for name, df in raw.items()
            if site != _SMALL_SITE or name not in _ABSENT
        }
    return sites


def _sites_sql(select, *names: str) -> str:
    """One statement a site over its own views, one below the other; ``select`` makes its body."""
    parts = []
    for site in SITES:
        own = {
            view: f"SELECT * FROM ({VIEWS[view]}) dealt WHERE {_of_site(site, key)}"
            for view, key in _ORDER.items()
        }
        if site == _SMALL_SITE:
            own["registry"] = " UNION ALL ".join(
                f"SELECT * FROM {{{rows}}}" for rows in ("total_rows", "reservable_rows", "committed_rows")
            )
        parts.append(f"SELECT * FROM ({duck(list(names), select(site), {**CTES, **own})})")
    return "\nUNION ALL\n".join(parts)


def _metrics_of(site: str) -> tuple[str, ...]:
    return _SMALL_METRICS if site == _SMALL_SITE else METRICS + DERIVED


def _run_process(spark: SparkSession, sf_dir: str):
    folder = f"{shared_folder(spark)}/usage-{uuid.uuid4().hex}"
    with scratch(spark):
        with copies() as made:
            sites = sites_raw(spark, sf_dir)
        return process(spark, sites, SPEC, folder, "7d", spent=made)


@query("process_sites", _sites_sql(lambda s: _weekly_sql(s, _metrics_of(s)), "weekly"))
def process_sites(spark, sf_dir):
    """The job as users call it: all sites, one plan, written by site and read back."""
    return plain(_run_process(spark, sf_dir).usage, 6)


@query(
    "process_audit",
    "SELECT metric, action, CAST(sum(n) AS BIGINT) AS n FROM ("
    + _sites_sql(
        lambda s: "SELECT metric, coerce_action AS action, count(*) AS n FROM clamped GROUP BY ALL",
        "clamped",
    )
    + ") GROUP BY metric, action",
)
def process_audit(spark, sf_dir):
    """What clamping did in the same job, counted while its result was written."""
    found = _run_process(spark, sf_dir).audit
    return spark.createDataFrame([(a.metric, a.action, a.rows) for a in found], "metric string, action string, n long")


_LEGACY = ("total", "reservable", "committed", "occupied_reservation", "available_reservable", "idle")


def _report_sql(site: str) -> str:
    cached = site != _SMALL_SITE
    current = ", ".join(
        f"round(coalesce(w.{m}, 0), 6) + 0.0 AS {m}_current" if m in _metrics_of(site)
        else f"CAST(0 AS DOUBLE) AS {m}_current"
        for m in METRICS + DERIVED
    )
    legacy = ", ".join(
        f"CASE WHEN w.resource = 'nodes' THEN round(coalesce(c.{m}, 0), 6) + 0.0 ELSE 0.0 END AS {m}_legacy"
        if cached else f"CAST(0 AS DOUBLE) AS {m}_legacy"
        for m in _LEGACY
    )
    return (
        f"SELECT w.timestamp, '{site}' AS site, w.resource, {current}, {legacy} "
        f"FROM ({_weekly_wide()}) w ASOF LEFT JOIN cached c ON w.timestamp >= c.timestamp"
    )


CTES["cached"] = """
    SELECT date AS timestamp, sum(total_hours) / 24 AS total,
           (sum(total_hours) - sum(maint_hours)) / 24 AS reservable,
           (sum(reserved_hours) + sum(used_hours)) / 24 AS committed,
           sum(used_hours) / 24 AS occupied_reservation,
           (sum(total_hours) - sum(maint_hours) - sum(reserved_hours) - sum(used_hours)) / 24
               AS available_reservable,
           sum(reserved_hours) / 24 AS idle
    FROM {daily_cache} GROUP BY date
"""


@query("report_sites", _sites_sql(_report_sql, "weekly", "cached"))
def report_sites(spark, sf_dir):
    """The report job: both collectors of all sites to three file formats, then wide."""
    cache = Inputs(spark, sf_dir)["daily_cache"]
    folder = f"{shared_folder(spark)}/report-{uuid.uuid4().hex}"
    caches = {site: cache for site in SITES if site != _SMALL_SITE}
    with scratch(spark):
        with copies() as made:
            sites = sites_raw(spark, sf_dir)
        wide = report(spark, sites, caches, SPEC, "7d", folder, spent=made)
    return plain(wide, 6)


@query(
    "legacy_counts",
    duck(
        ["daily_cache"],
        """
        SELECT timestamp, 'nodes' AS resource, metric, round(value, 6) + 0.0 AS value FROM (
            SELECT date AS timestamp, sum(total_hours) / 24 AS total,
                   (sum(total_hours) - sum(maint_hours)) / 24 AS reservable,
                   (sum(reserved_hours) + sum(used_hours)) / 24 AS committed,
                   sum(used_hours) / 24 AS occupied_reservation,
                   (sum(total_hours) - sum(maint_hours) - sum(reserved_hours) - sum(used_hours)) / 24
                       AS available_reservable,
                   sum(reserved_hours) / 24 AS idle
            FROM daily_cache GROUP BY date)
        UNPIVOT (value FOR metric IN (total, reservable, committed, occupied_reservation,
                                      available_reservable, idle))
        """,
    ),
)
def legacy_counts(spark, sf_dir):
    return plain(legacy_usage_counts(Inputs(spark, sf_dir)["daily_cache"]), 6)
