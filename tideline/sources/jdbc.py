"""Database tables to parquet, and the wide output back to a database."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Callable, Iterator

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

logger = logging.getLogger(__name__)

# --- Fixed values: tables to extract, statuses, vendor codes, output table -------

TABLES = {
    "nova": ("compute_nodes", "instances", "instance_actions", "instance_actions_events"),
    "nova_api": ("request_specs",),
    "blazar": (
        "computehosts",
        "computehost_allocations",
        "reservations",
        "instance_reservations",
        "leases",
        "devices",
        "device_allocations",
        "device_extra_capabilities",
        "device_reservations",
    ),
    "zun": ("container", "container_actions", "container_actions_events"),
    "openstack_audit": (
        "audit_blazar_computehosts",
        "audit_blazar_computehost_extra_capabilities",
        "audit_blazar_resource_properties",
        "audit_nova_compute_nodes",
        "audit_nova_services",
        "audit_nova_instances",
        "audit_nova_instance_actions",
        "audit_nova_instance_actions_events",
        "audit_ironic_nodes",
        "audit_blazar_leases",
        "audit_blazar_reservations",
        "audit_blazar_computehost_allocations",
        "audit_blazar_computehost_reservations",
        "audit_blazar_instance_reservations",
        "audit_blazar_device_allocations",
        "audit_blazar_device_reservations",
        "audit_blazar_devices",
        "audit_blazar_device_extra_capabilities",
    ),
}
LEGACY_TABLES = (
    "node_usage_report_cache",
    "node_count_cache",
    "node_usage",
    "node_event",
    "node_maintenance",
    "node_project_usage_report_cache",
)
STATUS_BY_CODE = {
    1044: "AUTH_ERROR",
    1045: "AUTH_ERROR",
    1142: "PERMISSION_ERROR",
    1143: "PERMISSION_ERROR",
    1146: "MISSING",
    2002: "CONNECTION_ERROR",
    2003: "CONNECTION_ERROR",
}
OUTPUT_TABLE = "usage_compat.usage_wide"


@dataclass(frozen=True)
class Slices:
    """How one table is read in parallel: ranges of a numeric or time column."""

    column: str
    lower: str
    upper: str
    count: int


def _causes(exc: BaseException) -> Iterator[object]:
    """The exception and everything that caused it, Java causes included."""
    seen = 0
    current: object | None = exc
    while current is not None and seen < 20:
        yield current
        seen += 1
        java = getattr(current, "java_exception", None) or getattr(current, "_origin", None)
        if java is not None:
            current = java
        elif hasattr(current, "getCause"):
            current = current.getCause()
        else:
            current = getattr(current, "__cause__", None)


def failure_status(exc: BaseException) -> str:
    """Status of a table that could not be read, from the driver's vendor code."""
    for cause in _causes(exc):
        code = getattr(cause, "getErrorCode", None) or getattr(cause, "code", None)
        try:
            code = code() if callable(code) else code
        except Exception:  # a Java object without that method
            continue
        if code in STATUS_BY_CODE:
            return STATUS_BY_CODE[code]
        state = getattr(cause, "getSQLState", None)
        try:
            state = state() if callable(state) else None
        except Exception:
            state = None
        if isinstance(state, str):
            if state.startswith("08"):
                return "CONNECTION_ERROR"
            if state.startswith("42"):
                return "PROGRAMMING_ERROR"
            return "OPERATIONAL_ERROR"
    return "OPERATIONAL_ERROR"


def jdbc_reader(
    spark: SparkSession,
    url: str,
    properties: dict[str, str] | None = None,
    slices: dict[str, Slices] | None = None,
) -> Callable[[str], DataFrame]:
    """Reader of ``schema.table``; tables with ``slices`` are read by many tasks."""

    def read(name: str) -> DataFrame:
        reader = (
            spark.read.format("jdbc")
            .options(**(properties or {}))
            .option("url", url)
            .option("dbtable", name)
            .option("preferTimestampNTZ", "true")
            .option("fetchsize", "10000")
        )
        part = (slices or {}).get(name)
        if part:
            reader = (
                reader.option("partitionColumn", part.column)
                .option("lowerBound", part.lower)
                .option("upperBound", part.upper)
                .option("numPartitions", str(part.count))
            )
        return reader.load()

    return read


def extract(
    read: Callable[[str], DataFrame],
    output: str,
    legacy_schema: str | None = None,
    at_once: int = 4,
) -> dict[str, str]:
    """Write every table to ``<output>/<schema>.<table>.parquet`` (zstd).

    Returns the row count or a failure status per table; one table never stops
    the others. Rows are counted while they are written. ``legacy_schema`` adds
    the daily caches kept in that schema.
    """
    wanted = dict(TABLES)
    if legacy_schema:
        wanted[legacy_schema] = LEGACY_TABLES
    names = [f"{schema}.{table}" for schema, tables in wanted.items() for table in tables]

    def one(name: str) -> str:
        try:
            seen = Observation()
            rows = read(name).observe(seen, F.count(F.lit(1)).alias("rows"))
            rows.write.mode("overwrite").option("compression", "zstd").parquet(
                f"{output}/{name}.parquet"
            )
            return str(seen.get["rows"])
        except Exception as exc:
            status = failure_status(exc)
            logger.warning("%s: %s (%s)", name, status, exc)
            return status

    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(names, pool.map(one, names)))


def write_compat(
    compat: DataFrame,
    url: str,
    table: str = OUTPUT_TABLE,
    overwrite: bool = True,
    properties: dict[str, str] | None = None,
    connections: int = 8,
) -> None:
    """Replace (or create) the wide table; parallel inserts over few connections."""
    (
        compat.write.format("jdbc")
        .options(**(properties or {}))
        .option("url", url)
        .option("dbtable", table)
        .option("numPartitions", str(connections))
        .mode("overwrite" if overwrite else "errorifexists")
        .save()
    )
