"""Input views over the given tables, stated once for Spark SQL and DuckDB.

Every view is one pass (or one aggregation) over whole tables with arithmetic
rules, so its size and its number of keys grow with them. ``{name}`` is a table
or an earlier view, ``{epoch}`` the literal 1995-01-01 and ``{twice}`` repeats each
row with k = 0 and 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.session import materialise

BASE = ("orders", "lineitem", "events", "supplier", "customer", "part")

VIEWS = {
    # events as tagged intervals, both resources still side by side
    "event_wide": """
        SELECT CAST(event_id AS STRING) AS entity_id,
               ts AS start_ts,
               CASE WHEN event_id % 10 = 0 THEN NULL
                    ELSE ts + (event_id % 72) * INTERVAL '1' HOUR END AS end_ts,
               CASE event_type WHEN 'view' THEN 'total'
                               WHEN 'click' THEN 'reservable'
                               WHEN 'signup' THEN 'committed'
                               WHEN 'purchase' THEN 'occupied_reservation'
                               ELSE 'occupied_ondemand' END AS metric,
               CAST(1 AS DOUBLE) AS nodes,
               value AS vcpus,
               concat('s', CAST(user_id % 3 AS STRING)) AS site,
               'current' AS collector_type,
               CASE WHEN event_id % 41 = 0 THEN NULL
                    ELSE concat('h', CAST(user_id AS STRING)) END AS hypervisor_hostname,
               CASE WHEN event_type IN ('click', 'signup')
                    THEN concat('b', CAST(user_id AS STRING)) END AS blazar_host_id,
               CASE WHEN event_type IN ('signup', 'purchase') AND event_id % 37 <> 0
                    THEN concat('r', CAST(user_id AS STRING), '-',
                                CAST(event_id % 3 AS STRING)) END AS blazar_reservation_id,
               CASE WHEN event_type = 'signup' THEN
                    CASE event_id % 4 WHEN 0 THEN 'physical:host'
                                      WHEN 1 THEN 'flavor:instance'
                                      WHEN 2 THEN 'virtual:device' END END AS reservation_type,
               concat('p', CAST(user_id % 40 AS STRING)) AS project_id
        FROM {events}
    """,
    "li": """
        SELECT l_orderkey, l_linenumber,
               min(l_suppkey) AS suppkey, min(l_partkey) AS partkey,
               min(l_shipdate) AS shipdate, min(l_quantity) AS quantity,
               min(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned
        FROM {lineitem} GROUP BY l_orderkey, l_linenumber
    """,
    "compute_nodes": """
        SELECT s_suppkey AS id,
               {epoch} + (s_suppkey * 31 % 1500) * INTERVAL '1' DAY AS created_at,
               CAST(NULL AS TIMESTAMP) AS updated_at,
               CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE
                    {epoch} + (s_suppkey * 31 % 1500 + 900) * INTERVAL '1' DAY END AS deleted_at,
               concat('h', CAST(CAST(floor(s_suppkey / 3) AS BIGINT) AS STRING)) AS hypervisor_hostname,
               CASE WHEN s_nationkey % 2 = 0 THEN 'ironic' ELSE 'QEMU' END AS hypervisor_type,
               CASE WHEN s_suppkey % 97 = 0 THEN 0 ELSE 16 + (s_suppkey % 5) * 16 END AS vcpus,
               1024 * (8 + s_suppkey % 9) AS memory_mb,
               100 + s_suppkey % 7 * 50 AS local_gb,
               CAST(1 + s_suppkey % 3 AS DOUBLE) AS cpu_allocation_ratio,
               CAST(1 AS DOUBLE) AS ram_allocation_ratio,
               CAST(1 AS DOUBLE) AS disk_allocation_ratio
        FROM {supplier}
    """,
    "computehosts": """
        SELECT CAST(id AS STRING) AS id, created_at, deleted_at, hypervisor_hostname,
               hypervisor_type, vcpus, memory_mb, local_gb
        FROM {compute_nodes} WHERE id % 4 <> 0
    """,
    "leases": """
        SELECT CAST(o_orderkey AS STRING) AS id,
               concat('p', CAST(CAST(floor(o_custkey / 30) AS BIGINT) AS STRING)) AS project_id,
               o_orderdate - INTERVAL '1' DAY AS created_at,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '10' DAY END AS deleted_at,
               o_orderdate AS start_date,
               CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE
                    o_orderdate + (o_orderkey % 60 + 1) * INTERVAL '1' DAY END AS end_date
        FROM {orders}
    """,
    "reservations": """
        SELECT concat('r', CAST(o_orderkey AS STRING)) AS id,
               o_orderdate AS created_at, CAST(NULL AS TIMESTAMP) AS deleted_at,
               CAST(o_orderkey AS STRING) AS lease_id,
               CASE o_orderkey % 3 WHEN 0 THEN 'physical:host'
                                   WHEN 1 THEN 'flavor:instance'
                                   ELSE 'virtual:device' END AS resource_type
        FROM {orders}
    """,
    "computehost_allocations": """
        SELECT shipdate AS created_at, CAST(NULL AS TIMESTAMP) AS deleted_at,
               concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS id,
               CAST(suppkey AS STRING) AS compute_host_id,
               concat('r', CAST(l_orderkey AS STRING)) AS reservation_id
        FROM {li}
    """,
    "instance_reservations": """
        SELECT concat('r', CAST(o_orderkey AS STRING)) AS reservation_id,
               4 AS vcpus, 8192 AS memory_mb, 40 AS disk_gb
        FROM {orders} WHERE o_orderkey % 3 = 1
    """,
    "instances": """
        SELECT o_orderkey AS id, concat('i', CAST(o_orderkey AS STRING)) AS uuid,
               o_orderdate AS created_at,
               CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL '40' DAY END AS deleted_at,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS launched_at,
               CAST(NULL AS TIMESTAMP) AS terminated_at,
               'controller' AS host,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE
                    concat('h', CAST(CAST(floor(o_custkey / 45) AS BIGINT) AS STRING)) END AS node,
               2 AS vcpus, 4096 AS memory_mb, 20 AS root_gb
        FROM {orders}
    """,
    "request_specs": """
        SELECT concat('i', CAST(o_orderkey AS STRING)) AS instance_uuid,
               concat('{{"nova_object.data": {{"scheduler_hints": {{',
                      CASE WHEN o_orderkey % 3 = 0 THEN concat('"reservation": ["r',
                           CAST(o_orderkey AS STRING), '"]') ELSE '' END,
                      '}}, "flavor": {{"nova_object.data": {{"name": "',
                      CASE WHEN o_orderkey % 3 = 1 THEN concat('reservation:r',
                           CAST(o_orderkey AS STRING)) ELSE 'm1.small' END,
                      '"}}}}}}}}') AS spec
        FROM {orders}
    """,
    "instance_actions": """
        SELECT shipdate AS created_at, CAST(NULL AS TIMESTAMP) AS deleted_at,
               l_orderkey * 10 + l_linenumber AS id, 'action' AS action,
               concat('i', CAST(l_orderkey AS STRING)) AS instance_uuid,
               shipdate AS start_time, CAST(NULL AS TIMESTAMP) AS finish_time
        FROM {li}
    """,
    "instance_actions_events": """
        SELECT shipdate AS created_at, CAST(NULL AS TIMESTAMP) AS deleted_at,
               (l_orderkey * 10 + l_linenumber) * 2 + k AS id,
               CASE WHEN k = 1 THEN CASE WHEN quantity > 25 THEN 'compute_resize_instance'
                                         ELSE 'conductor_live_migrate' END
                    ELSE CASE l_linenumber % 5
                         WHEN 0 THEN 'compute_terminate_instance'
                         WHEN 1 THEN 'compute_shelve_instance'
                         WHEN 2 THEN 'compute_shelve_offload_instance'
                         WHEN 3 THEN 'compute_unshelve_instance'
                         ELSE 'conductor_migrate_server' END END AS event,
               l_orderkey * 10 + l_linenumber AS action_id,
               shipdate + INTERVAL '1' HOUR AS start_time,
               CAST(NULL AS TIMESTAMP) AS finish_time,
               CASE WHEN k = 0 AND returned = 1 THEN 'Error' ELSE 'Success' END AS result,
               concat('h', CAST(CAST(floor(CASE WHEN k = 0 THEN suppkey / 3
                                                ELSE partkey / 60 END) AS BIGINT) AS STRING)) AS host
        FROM {li} {twice}
    """,
    "devices": """
        SELECT {epoch} + (p_partkey % 900) * INTERVAL '1' DAY AS created_at,
               {epoch} AS updated_at,
               concat('d', CAST(p_partkey AS STRING)) AS id, p_name AS name,
               p_type AS device_type, p_brand AS device_driver,
               p_size % 2 AS reservable, '0' AS deleted,
               CASE WHEN p_partkey % 6 = 0 THEN
                    {epoch} + (p_partkey % 900 + 1200) * INTERVAL '1' DAY END AS deleted_at
        FROM {part}
    """,
    "device_allocations": """
        SELECT shipdate AS created_at, shipdate AS updated_at,
               CAST(NULL AS TIMESTAMP) AS deleted_at, '0' AS deleted,
               concat('da', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS id,
               concat('d', CAST(partkey AS STRING)) AS device_id,
               concat('r', CAST(l_orderkey AS STRING)) AS reservation_id
        FROM {li}
    """,
    "container": """
        SELECT o_orderdate AS created_at, o_orderdate + INTERVAL '5' DAY AS updated_at,
               o_orderkey AS id, concat('c', CAST(o_orderkey AS STRING)) AS uuid,
               o_orderpriority AS name,
               CASE o_orderstatus WHEN 'O' THEN 'Running' WHEN 'F' THEN 'Stopped'
                                  ELSE 'Deleted' END AS status,
               CAST(NULL AS STRING) AS container_id, CAST(NULL AS STRING) AS hostname,
               CAST(NULL AS STRING) AS labels, CAST(NULL AS STRING) AS status_reason,
               CAST(NULL AS STRING) AS host, CAST(NULL AS STRING) AS status_detail,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL
                    ELSE o_orderdate + INTERVAL '1' HOUR END AS started_at,
               CAST(1 + o_orderkey % 4 AS DOUBLE) AS cpu,
               CAST(512 AS DOUBLE) AS memory, 10 AS disk
        FROM {orders}
    """,
    "daily_cache": """
        SELECT o_orderdate AS date, o_orderpriority AS node_type,
               CAST(2 * count(*) AS DOUBLE) AS maint_hours,
               CAST(6 * count(*) AS DOUBLE) AS reserved_hours,
               CAST(5 * count(*) AS DOUBLE) AS used_hours,
               CAST(3 * count(*) AS DOUBLE) AS idle_hours,
               CAST(24 * count(*) AS DOUBLE) AS total_hours
        FROM {orders} GROUP BY o_orderdate, o_orderpriority
    """,
    "event_cache": """
        SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date, event_type AS node_type,
               CAST(1 * count(*) AS DOUBLE) AS maint_hours,
               CAST(5 * count(*) AS DOUBLE) AS reserved_hours,
               CAST(7 * count(*) AS DOUBLE) AS used_hours,
               CAST(2 * count(*) AS DOUBLE) AS idle_hours,
               CAST(24 * count(*) AS DOUBLE) AS total_hours
        FROM {events} GROUP BY CAST(CAST(ts AS DATE) AS TIMESTAMP), event_type
    """,
    "projects": """
        SELECT concat('p', CAST(CAST(floor(c_custkey / 30) AS BIGINT) AS STRING)) AS id,
               min(c_name) AS name
        FROM {customer}
        GROUP BY concat('p', CAST(CAST(floor(c_custkey / 30) AS BIGINT) AS STRING))
    """,
}

# raw table key of the package -> view that plays it
RAW_TABLES = {
    "nova_hosts": "compute_nodes",
    "nova_instances": "instances",
    "nova_request_specs": "request_specs",
    "nova_actions": "instance_actions",
    "nova_action_events": "instance_actions_events",
    "blazar_hosts": "computehosts",
    "blazar_alloc": "computehost_allocations",
    "blazar_res": "reservations",
    "blazar_instance_res": "instance_reservations",
    "blazar_leases": "leases",
    "blazar_devices": "devices",
    "blazar_device_allocations": "device_allocations",
    "zun_containers": "container",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Inputs:
    """Lazily built views of one data folder.

    Those in ``kept`` are written to the shared folder when first asked for: plans that read
    ``li`` for several raw tables group ``lineitem`` once.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, kept: tuple[str, ...] = ()):
        self.spark, self.sf_dir, self.kept = spark, sf_dir, kept
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            built = self._build(name)
            self._built[name] = materialise(built) if name in self.kept else built
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        if name in BASE:
            return table(self.spark, self.sf_dir, name)
        sql = VIEWS[name].replace("{epoch}", "TIMESTAMP_NTZ '1995-01-01 00:00:00'")
        sql = sql.replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)")
        sql = sql.replace("{twice}", "LATERAL VIEW explode(array(0, 1)) pair AS k")
        needed = {n: self[n] for n in (*BASE, *VIEWS) if f"{{{n}}}" in sql}
        return self.spark.sql(sql, **needed)

    def raw(self) -> dict[str, DataFrame]:
        from tideline.sources.tables import SOURCES, contract

        return {
            key: contract(self[view], SOURCES[key]) for key, view in RAW_TABLES.items()
        }

    def event_intervals(self) -> DataFrame:
        wide = self["event_wide"]
        ids = [c for c in wide.columns if c not in ("nodes", "vcpus")]
        return (
            wide.unpivot(ids, ["nodes", "vcpus"], "resource", "value")
            .withColumnRenamed("start_ts", "start")
            .withColumnRenamed("end_ts", "end")
        )


def duck(names: list[str], body: str, extra: dict[str, str] | None = None) -> str:
    """DuckDB text: the wanted views (with what they need) as CTEs, then ``body``."""
    texts = {**VIEWS, **(extra or {})}
    order: list[str] = []

    def need(name: str) -> None:
        if name in order or name not in texts:
            return
        for other in texts:
            if f"{{{other}}}" in texts[name]:
                need(other)
        order.append(name)

    for n in names:
        need(n)
    slots = {n: n for n in (*BASE, *texts)}
    slots["epoch"] = "TIMESTAMP '1995-01-01 00:00:00'"
    slots["twice"] = ", (SELECT unnest([0, 1]) AS k) pair"
    ctes = ",\n".join(f"{n} AS ({texts[n].format(**slots)})" for n in order)
    return f"WITH {ctes}\n{body}"


EVENT_INTERVALS = """
    SELECT * EXCLUDE (nodes, vcpus), 'nodes' AS resource, nodes AS value FROM {event_wide}
    UNION ALL
    SELECT * EXCLUDE (nodes, vcpus), 'vcpus' AS resource, vcpus AS value FROM {event_wide}
"""
