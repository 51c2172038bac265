"""Adapters: one source of rows to intervals of one metric, one row per resource."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline import vocab
from tideline.contracts import as_interval
from tideline.functions.exprs import pick_fraction
from tideline.functions.intervals import touches_window
from tideline.session import materialise
from tideline.sources import builders
from tideline.sources.builders import Tables
from tideline.sources.tables import load_raw_tables

logger = logging.getLogger(__name__)

Expression = str | Callable[[], Column]


def _column(expression: Expression) -> Column:
    return F.expr(expression) if isinstance(expression, str) else expression()


@dataclass(frozen=True)
class Adapter:
    """How rows become intervals.

    ``metric`` and the values of ``resources`` are SQL expressions over the
    source's columns (or functions that return a column). ``needs`` lists the
    raw tables without which the adapter is left out.
    """

    name: str
    entity: str
    metric: Expression
    source: Callable[[Tables], DataFrame]
    resources: dict[str, Expression]
    context: dict[str, str] = field(default_factory=dict)
    start: str = "created_at"
    end: str = "deleted_at"
    needs: tuple[str, ...] = ()

    def intervals(
        self,
        tables: Tables,
        time_range: tuple[datetime, datetime] | None = None,
        keep: Sequence[str] | None = None,
    ) -> DataFrame:
        """Rows of the tables; only those in ``time_range``, with no context but that in ``keep``.

        Where the tables are ``cut``, a source that joins several is written once it has
        those rows and columns, one row for all resources.
        """
        ids = {
            "entity_id": F.col(self.entity),
            "start": F.col(self.start),
            "end": F.col(self.end),
            "metric": _column(self.metric),
            **{dst: F.col(src) for src, dst in self.context.items() if keep is None or dst in keep},
            **{c: F.col(c) for c in builders.scope_of(tables)},
        }
        sizes = {n: _column(e).cast("double") for n, e in self.resources.items()}
        wide = self.source(tables).select(
            *[c.alias(n) for n, c in {**ids, **sizes}.items()]
        )
        if time_range is not None:
            wide = in_window(wide, time_range)
        if builders.is_cut(tables) and len(self.needs) > 1:
            wide = materialise(wide)
        if not sizes:
            return as_interval(wide)  # fails: an interval needs resource and value
        return as_interval(wide.unpivot(list(ids), list(sizes), "resource", "value"))


def to_intervals(
    tables: Tables,
    adapters: Sequence[Adapter],
    time_range: tuple[datetime, datetime] | None = None,
    keep: Sequence[str] | None = None,
    cut: bool = False,
) -> DataFrame:
    """Union of all adapters whose tables are there; missing context columns are NULL.

    ``time_range`` and ``keep`` as for ``Adapter.intervals``; with ``cut`` the adapters run
    one after the other, and each leaves the shared folder a copy of what it joined.
    """
    if cut:
        tables = builders.ScopedTables(tables, builders.scope_of(tables), cut)
    usable = []
    for adapter in adapters:
        absent = [t for t in adapter.needs if t not in tables]
        if absent:
            logger.warning("adapter %s left out, no %s", adapter.name, absent)
        else:
            usable.append(adapter.intervals(tables, time_range, keep))
    if not usable:
        raise ValueError("no adapter has its tables")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), usable)


def sites_to_intervals(
    sites: Mapping[str, Tables],
    adapters: Sequence[Adapter],
    site_column: str = "site",
    time_range: tuple[datetime, datetime] | None = None,
    keep: Sequence[str] | None = None,
    cut: bool = False,
) -> DataFrame:
    """Intervals of all sites in one plan, each row with its site.

    A raw table is scanned once per site and stacked with that of the others. An
    adapter reads the sites that have all its tables, so a table that one site
    lacks neither adds rows there nor leaves the others out. A site for which no
    adapter has its tables fails, as it does alone. The rest as for ``to_intervals``.
    """
    stacked: dict[tuple[str, tuple[str, ...]], DataFrame] = {}

    def stack(key: str, names: tuple[str, ...]) -> DataFrame:
        if (key, names) not in stacked:
            own = [sites[n][key].withColumn(site_column, F.lit(n)) for n in names]
            stacked[key, names] = reduce(DataFrame.unionByName, own)
        return stacked[key, names]

    usable, served = [], set()
    for adapter in adapters:
        names = tuple(n for n, tables in sites.items() if all(t in tables for t in adapter.needs))
        if len(names) < len(sites):
            absent = sorted(set(sites) - set(names))
            logger.warning("adapter %s left out in %s, tables missing", adapter.name, absent)
        if not names:
            continue
        served.update(names)
        keys = set.intersection(*(set(sites[n]) for n in names))
        tables = builders.ScopedTables({k: stack(k, names) for k in keys}, (site_column,), cut)
        usable.append(adapter.intervals(tables, time_range, keep))
    if served != set(sites):
        raise ValueError(f"no adapter has its tables in {sorted(set(sites) - served)}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), usable)


def _scaled(when: str, numerator: str, denominator: str) -> Callable[[], Column]:
    return lambda: pick_fraction(F.expr(when), F.col(numerator), F.col(denominator))


# --- Fixed values: which columns of a source make an interval of which metric -------

HOST_TOTAL = Adapter(
    name="host_total",
    entity="hypervisor_hostname",
    metric="'total'",
    source=lambda t: t["nova_hosts"],
    context={"hypervisor_hostname": "hypervisor_hostname"},
    resources={
        vocab.NODES: "1",
        vocab.VCPUS_OVERCOMMIT: "vcpus * cpu_allocation_ratio",
        vocab.VCPUS: "vcpus",
        vocab.MEMORY_MB: "memory_mb",
        vocab.DISK_GB: "local_gb",
    },
    needs=("nova_hosts",),
)
HOST_RESERVABLE = Adapter(
    name="host_reservable",
    entity="hypervisor_hostname",
    metric="'reservable'",
    source=lambda t: t["blazar_hosts"],
    context={"id": "blazar_host_id", "hypervisor_hostname": "hypervisor_hostname"},
    resources={
        vocab.NODES: "1",
        vocab.VCPUS: "vcpus",
        vocab.MEMORY_MB: "memory_mb",
        vocab.DISK_GB: "local_gb",
    },
    needs=("blazar_hosts",),
)
HOST_COMMITTED = Adapter(
    name="host_committed",
    entity="id",
    metric="'committed'",
    source=builders.host_allocations,
    context={
        "id": "blazar_allocation_id",
        "lease_id": "blazar_lease_id",
        "reservation_id": "blazar_reservation_id",
        "reservation_type": "reservation_type",
        "compute_host_id": "blazar_host_id",
        "hypervisor_hostname": "hypervisor_hostname",
    },
    resources={
        vocab.NODES: _scaled(
            "reservation_type <> 'physical:host'", "effective_vcpus", "host_vcpus"
        ),
        vocab.VCPUS: "effective_vcpus",
        vocab.MEMORY_MB: "effective_memory_mb",
        vocab.DISK_GB: "effective_disk_gb",
    },
    start="effective_start",
    end="effective_end",
    needs=(
        "blazar_alloc",
        "blazar_hosts",
        "blazar_res",
        "blazar_instance_res",
        "blazar_leases",
    ),
)

_OCCUPIED = dict(
    entity="uuid",
    context={
        "uuid": "instance_id",
        "blazar_reservation_id": "blazar_reservation_id",
        "node": "hypervisor_hostname",
    },
    resources={
        vocab.NODES: _scaled("hypervisor_type = 'QEMU'", "vcpus", "host_vcpus"),
        vocab.VCPUS: "vcpus",
        vocab.VCPUS_OVERCOMMIT: "vcpus",
        vocab.MEMORY_MB: "memory_mb",
        vocab.DISK_GB: "root_gb",
    },
    needs=(
        "nova_instances",
        "nova_request_specs",
        "nova_actions",
        "nova_action_events",
        "nova_hosts",
    ),
)
INSTANCE_RESERVED = Adapter(
    name="instance_reserved",
    metric="'occupied_reservation'",
    source=lambda t: builders.instances(t).where(F.col("booking_type") == "reservation"),
    **_OCCUPIED,
)
INSTANCE_ONDEMAND = Adapter(
    name="instance_ondemand",
    metric="'occupied_ondemand'",
    source=lambda t: builders.instances(t).where(F.col("booking_type") == "ondemand"),
    **_OCCUPIED,
)
# Both bookings from one pass over the instances.
INSTANCE_OCCUPIED = Adapter(
    name="instance_occupied",
    metric="concat('occupied_', booking_type)",
    source=builders.instances,
    **_OCCUPIED,
)
DEVICE_RESERVABLE = Adapter(
    name="device_reservable",
    entity="id",
    metric="'reservable'",
    source=lambda t: t["blazar_devices"].where(F.col("reservable") == 1),
    context={"id": "blazar_device_id", "name": "device_name"},
    resources={vocab.NODES: "1"},
    needs=("blazar_devices",),
)
DEVICE_COMMITTED = Adapter(
    name="device_committed",
    entity="id",
    metric="'committed'",
    source=builders.device_allocations,
    context={
        "id": "blazar_allocation_id",
        "lease_id": "blazar_lease_id",
        "reservation_id": "blazar_reservation_id",
        "reservation_type": "reservation_type",
        "device_id": "blazar_device_id",
        "name": "device_name",
        "project_id": "project_id",
    },
    resources={vocab.NODES: "1"},
    start="effective_start",
    end="effective_end",
    needs=("blazar_device_allocations", "blazar_devices", "blazar_res", "blazar_leases"),
)
# Containers have sizes of their own; not in the default registry.
CONTAINER_OCCUPIED = Adapter(
    name="container_occupied",
    entity="uuid",
    metric="'occupied_ondemand'",
    source=builders.containers,
    context={"host": "hypervisor_hostname"},
    resources={vocab.VCPUS: "cpu", vocab.MEMORY_MB: "memory", vocab.DISK_GB: "disk"},
    needs=("zun_containers",),
)

REGISTRY = (
    HOST_TOTAL,
    HOST_RESERVABLE,
    HOST_COMMITTED,
    INSTANCE_OCCUPIED,
    DEVICE_RESERVABLE,
    DEVICE_COMMITTED,
)


def in_window(intervals: DataFrame, time_range: tuple[datetime, datetime]) -> DataFrame:
    """Intervals that touch or overlap the window."""
    return intervals.where(touches_window(F.col("start"), F.col("end"), *time_range))


def load_intervals(
    spark: SparkSession,
    path: str,
    time_range: tuple[datetime, datetime] | None = None,
    adapters: Sequence[Adapter] = REGISTRY,
) -> DataFrame:
    """Intervals of one site's raw tables, optionally only those in a window."""
    intervals = to_intervals(load_raw_tables(spark, path), adapters).withColumn(
        "collector_type", F.lit(vocab.CURRENT)
    )
    return in_window(intervals, time_range) if time_range else intervals
