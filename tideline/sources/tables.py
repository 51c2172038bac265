"""Raw tables: names, declared columns and loading."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tideline.contracts import conform

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class SourceTable:
    """Database schema and table, and the columns kept from it.

    Times and numbers are cast to their declared type; text columns must already
    be text unless listed in ``as_text``.
    """

    schema: str
    table: str
    columns: dict[str, str]
    as_text: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.schema}.{self.table}"


def _columns(text: str) -> dict[str, str]:
    short = {"ts": "timestamp_ntz", "str": "string", "int": "bigint", "num": "double"}
    pairs = (item.split(":") for item in text.split())
    return {name: short[kind] for name, kind in pairs}


# --- Fixed values: raw tables and their columns ---------------------------------

SOURCES = {
    "nova_hosts": SourceTable(
        "nova",
        "compute_nodes",
        _columns(
            "id:str created_at:ts updated_at:ts deleted_at:ts hypervisor_hostname:str"
            " hypervisor_type:str vcpus:int memory_mb:int local_gb:int"
            " cpu_allocation_ratio:num ram_allocation_ratio:num disk_allocation_ratio:num"
        ),
        as_text=("id", "hypervisor_hostname", "hypervisor_type"),
    ),
    "nova_instances": SourceTable(
        "nova",
        "instances",
        _columns(
            "id:str uuid:str created_at:ts deleted_at:ts launched_at:ts terminated_at:ts"
            " host:str node:str vcpus:int memory_mb:int root_gb:int"
        ),
        as_text=("id",),
    ),
    "nova_request_specs": SourceTable(
        "nova_api", "request_specs", _columns("instance_uuid:str spec:str")
    ),
    "nova_actions": SourceTable(
        "nova",
        "instance_actions",
        _columns(
            "created_at:ts deleted_at:ts id:int action:str instance_uuid:str"
            " start_time:ts finish_time:ts"
        ),
    ),
    "nova_action_events": SourceTable(
        "nova",
        "instance_actions_events",
        _columns(
            "created_at:ts deleted_at:ts id:int event:str action_id:int start_time:ts"
            " finish_time:ts result:str host:str"
        ),
    ),
    "blazar_hosts": SourceTable(
        "blazar",
        "computehosts",
        _columns(
            "id:str created_at:ts deleted_at:ts hypervisor_hostname:str"
            " hypervisor_type:str vcpus:int memory_mb:int local_gb:int"
        ),
    ),
    "blazar_alloc": SourceTable(
        "blazar",
        "computehost_allocations",
        _columns("created_at:ts deleted_at:ts id:str compute_host_id:str reservation_id:str"),
    ),
    "blazar_res": SourceTable(
        "blazar",
        "reservations",
        _columns("id:str created_at:ts deleted_at:ts lease_id:str resource_type:str"),
    ),
    "blazar_instance_res": SourceTable(
        "blazar",
        "instance_reservations",
        _columns("reservation_id:str vcpus:int memory_mb:int disk_gb:int"),
    ),
    "blazar_leases": SourceTable(
        "blazar",
        "leases",
        _columns(
            "id:str project_id:str created_at:ts deleted_at:ts start_date:ts end_date:ts"
        ),
    ),
    "blazar_device_allocations": SourceTable(
        "blazar",
        "device_allocations",
        _columns(
            "created_at:ts updated_at:ts deleted_at:ts deleted:str id:str device_id:str"
            " reservation_id:str"
        ),
    ),
    "blazar_device_extra_capabilities": SourceTable(
        "blazar",
        "device_extra_capabilities",
        _columns(
            "created_at:ts updated_at:ts id:str device_id:str capability_value:str"
            " deleted:str deleted_at:ts"
        ),
    ),
    "blazar_device_reservations": SourceTable(
        "blazar",
        "device_reservations",
        _columns(
            "created_at:ts updated_at:ts deleted_at:ts deleted:str id:str"
            " reservation_id:str count_range:str resource_properties:str before_end:str"
        ),
    ),
    "blazar_devices": SourceTable(
        "blazar",
        "devices",
        _columns(
            "created_at:ts updated_at:ts id:str name:str device_type:str"
            " device_driver:str reservable:int deleted:str deleted_at:ts"
        ),
    ),
    "zun_containers": SourceTable(
        "zun",
        "container",
        _columns(
            "created_at:ts updated_at:ts id:int uuid:str name:str status:str"
            " container_id:str hostname:str labels:str status_reason:str host:str"
            " status_detail:str started_at:ts cpu:num memory:num disk:int"
        ),
    ),
    "zun_container_actions": SourceTable(
        "zun",
        "container_actions",
        _columns(
            "created_at:ts updated_at:ts id:int action:str container_uuid:str"
            " start_time:ts finish_time:ts"
        ),
    ),
    "zun_container_action_events": SourceTable(
        "zun",
        "container_actions_events",
        _columns(
            "created_at:ts updated_at:ts id:int event:str action_id:int start_time:ts"
            " finish_time:ts result:str"
        ),
    ),
}

# Row models that no registered plan reads, for callers who load them by hand.
EXTRA_SOURCES = {
    "nova_services": SourceTable(
        "nova",
        "services",
        _columns("id:int created_at:ts deleted_at:ts host:str binary:str"),
    ),
    "zun_compute_nodes": SourceTable(
        "zun", "compute_node", _columns("created_at:ts updated_at:ts uuid:str hostname:str")
    ),
}


class RawTableError(Exception):
    """A raw table exists but could not be loaded."""


def contract(df: DataFrame, source: SourceTable) -> DataFrame:
    """Declared columns only, cast where that is allowed; a missing column fails."""
    coerce = [c for c, t in source.columns.items() if t != "string" or c in source.as_text]
    return conform(df, source.columns, coerce=coerce, keep_extra=False)


def _is_missing(exc: AnalysisException) -> bool:
    return exc.getCondition() == "PATH_NOT_FOUND"


def load_table(spark: SparkSession, path: str, source: SourceTable) -> DataFrame:
    return contract(spark.read.parquet(f"{path}/{source.name}.parquet"), source)


def load_raw_tables(
    spark: SparkSession, path: str, sources: dict[str, SourceTable] | None = None
) -> dict[str, DataFrame]:
    """All registered tables under ``path``; absent ones are skipped and logged.

    ``path`` is any folder Spark can read. Any failure besides an absent file is
    raised as :class:`RawTableError`.
    """
    tables: dict[str, DataFrame] = {}
    for key, source in (sources or SOURCES).items():
        try:
            tables[key] = load_table(spark, path, source)
        except AnalysisException as exc:
            if not _is_missing(exc):
                raise RawTableError(f"{source.name} in {path}: {exc}") from exc
            logger.warning("no %s in %s, skipped", source.name, path)
        except Exception as exc:
            raise RawTableError(f"{source.name} in {path}: {exc}") from exc
    return tables
