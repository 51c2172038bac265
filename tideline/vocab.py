"""Closed vocabulary shared by every plan."""

# --- Fixed values: names that stored data and callers rely on -----------------

TOTAL = "total"
RESERVABLE = "reservable"
COMMITTED = "committed"
OCCUPIED_RESERVATION = "occupied_reservation"
OCCUPIED_ONDEMAND = "occupied_ondemand"
BASE_METRICS = (TOTAL, RESERVABLE, COMMITTED, OCCUPIED_RESERVATION, OCCUPIED_ONDEMAND)

ONDEMAND_CAPACITY = "ondemand_capacity"
AVAILABLE_RESERVABLE = "available_reservable"
IDLE = "idle"
AVAILABLE_ONDEMAND = "available_ondemand"

# (result, parent, child): result = parent - child, evaluated top to bottom.
DERIVATIONS = (
    (ONDEMAND_CAPACITY, TOTAL, RESERVABLE),
    (AVAILABLE_RESERVABLE, RESERVABLE, COMMITTED),
    (IDLE, COMMITTED, OCCUPIED_RESERVATION),
    (AVAILABLE_ONDEMAND, ONDEMAND_CAPACITY, OCCUPIED_ONDEMAND),
)

NODES = "nodes"
VCPUS = "vcpus"
VCPUS_OVERCOMMIT = "vcpus_overcommit"
MEMORY_MB = "memory_mb"
DISK_GB = "disk_gb"
GPUS = "gpus"
DEVICES = "devices"

CURRENT = "current"
LEGACY = "legacy"

HOST_SCOPED_RESERVATIONS = ("physical:host", "flavor:instance")
END_EVENTS = (
    "compute_terminate_instance",
    "compute_shelve_offload_instance",
    "compute_shelve_instance",
)
RESUME_EVENTS = ("compute_unshelve_instance",)
TERMINAL_CONTAINER_STATUSES = ("Deleted", "Error", "Stopped")
