"""Loading, builders, adapters, legacy cache, extraction, whole jobs."""

import json
import random
import re
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import day
from tideline.contracts import ContractError, UsageSpec
from tideline.operators import clamp
from tideline.operators.clamp import clamp_hierarchy
from tideline.plans import jobs
from tideline.plans.jobs import process, report, sites_usage, valid_intervals
from tideline.plans.usage import run_usage
from tideline.session import copies, materialise, shared_folder
from tideline.sources import adapters, builders, jdbc
from tideline.sources.legacy import DAILY_CACHE, legacy_usage_counts, read_daily_cache
from tideline.sources.sinks import read_projects, write_report, write_usage
from tideline.sources.tables import (
    SOURCES,
    RawTableError,
    contract,
    load_raw_tables,
)


def table(spark, key, *rows):
    """Rows as dicts; columns that are not given are NULL."""
    columns = SOURCES[key].columns
    ddl = ", ".join(f"{c} {t}" for c, t in columns.items())
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], ddl)


@pytest.fixture(scope="module")
def tables(spark):
    def spec(hint=None, flavor="m1"):
        hints = {"reservation": [hint]} if hint else {}
        return json.dumps(
            {
                "nova_object.data": {
                    "scheduler_hints": hints,
                    "flavor": {"nova_object.data": {"name": flavor}},
                }
            }
        )

    host = dict(memory_mb=10, local_gb=20)
    return {
        "nova_hosts": table(
            spark,
            "nova_hosts",
            dict(id="1", hypervisor_hostname="h1", created_at=day(5), hypervisor_type="QEMU",
                 vcpus=8, cpu_allocation_ratio=2.0, **host),
            dict(id="2", hypervisor_hostname="h1", created_at=day(15), hypervisor_type="ironic",
                 vcpus=16, cpu_allocation_ratio=1.0, **host),
        ),
        "blazar_hosts": table(
            spark,
            "blazar_hosts",
            dict(id="b1", hypervisor_hostname="h1", created_at=day(5), vcpus=8, **host),
            dict(id="b0", hypervisor_hostname="h0", created_at=day(5), vcpus=0, **host),
        ),
        "blazar_leases": table(
            spark,
            "blazar_leases",
            dict(id="l1", project_id="p1", created_at=day(2), start_date=day(3), end_date=day(9)),
            dict(id="l2", project_id="p2", created_at=day(4), start_date=day(3), end_date=day(9),
                 deleted_at=day(6)),
            dict(id="open", project_id="p3", created_at=day(1), start_date=day(3)),
            dict(id="never", project_id="p3", created_at=day(1), start_date=day(5),
                 deleted_at=day(4)),
        ),
        "blazar_res": table(
            spark,
            "blazar_res",
            dict(id="r1", lease_id="l1", resource_type="physical:host"),
            dict(id="r2", lease_id="l2", resource_type="flavor:instance"),
            dict(id="r3", lease_id="open", resource_type="physical:host"),
            dict(id="r4", lease_id="never", resource_type="physical:host"),
        ),
        "blazar_instance_res": table(
            spark, "blazar_instance_res", dict(reservation_id="r2", vcpus=2, memory_mb=3, disk_gb=4)
        ),
        "blazar_alloc": table(
            spark,
            "blazar_alloc",
            dict(id="a1", compute_host_id="b1", reservation_id="r1", deleted_at=day(4)),
            dict(id="a2", compute_host_id="b1", reservation_id="r2"),
            dict(id="a2x", compute_host_id="b0", reservation_id="r2"),
            dict(id="a3", compute_host_id="b1", reservation_id="r3"),
            dict(id="a4", compute_host_id="b1", reservation_id="r4"),
            dict(id="a5", compute_host_id="lost", reservation_id="r1"),
        ),
        "nova_instances": table(
            spark,
            "nova_instances",
            dict(id="1", uuid="kvm", created_at=day(6), launched_at=day(7), node="h1", vcpus=2,
                 deleted_at=day(20)),
            dict(id="2", uuid="metal", created_at=day(16), launched_at=day(16), vcpus=2),
            dict(id="3", uuid="early", created_at=day(1), launched_at=day(1), node="h1", vcpus=4),
            dict(id="4", uuid="unborn", created_at=day(1), node="h1", vcpus=4),
        ),
        "nova_request_specs": table(
            spark,
            "nova_request_specs",
            dict(instance_uuid="kvm", spec=spec(hint="r9", flavor="reservation:r8")),
            dict(instance_uuid="metal", spec=spec(flavor="reservation:r1")),
            dict(instance_uuid="early", spec=spec()),
        ),
        "nova_actions": table(
            spark,
            "nova_actions",
            dict(id=1, instance_uuid="metal", start_time=day(17)),
            dict(id=2, instance_uuid="metal", start_time=day(18)),
            dict(id=3, instance_uuid="metal", start_time=day(19)),
            dict(id=4, instance_uuid="kvm", start_time=day(18)),
        ),
        "nova_action_events": table(
            spark,
            "nova_action_events",
            dict(id=1, action_id=1, event="compute_shelve_instance", result="Success", host="h0"),
            dict(id=2, action_id=2, event="compute_unshelve_instance", result="Success", host="h0"),
            dict(id=3, action_id=3, event="compute_terminate_instance", result="Success", host="h9",
                 start_time=day(1)),
            dict(id=4, action_id=3, event="compute_stop_instance", result="Success", host="h1",
                 start_time=day(1)),
            dict(id=5, action_id=3, event="conductor_x", result="Success", host="ctl"),
            dict(id=6, action_id=4, event="compute_terminate_instance", result="Error", host="h7"),
        ),
        "blazar_devices": table(
            spark,
            "blazar_devices",
            dict(id="d1", name="one", reservable=1, created_at=day(1)),
            dict(id="d2", name="two", reservable=0, created_at=day(1)),
        ),
        "blazar_device_allocations": table(
            spark,
            "blazar_device_allocations",
            dict(id="da1", device_id="d1", reservation_id="r1"),
            dict(id="da2", device_id="d1", reservation_id="r3"),
        ),
        "zun_containers": table(
            spark,
            "zun_containers",
            dict(id=1, uuid="run", status="Running", started_at=day(2), updated_at=day(9), cpu=1.0),
            dict(id=2, uuid="stop", status="Stopped", started_at=day(2), updated_at=day(9), cpu=1.0),
            dict(id=3, uuid="none", status="Error", updated_at=day(9), cpu=1.0),
        ),
    }


def test_allocations_follow_their_lease(tables):
    out = {r.id: r for r in builders.host_allocations(tables).collect()}
    assert set(out) == {"a1", "a2", "a2x", "a5"}  # an open or inverted lease drops out
    assert (out["a1"].effective_start, out["a1"].effective_end) == (day(3), day(9))
    assert (out["a2"].effective_start, out["a2"].effective_end) == (day(4), day(6))
    assert (out["a1"].effective_vcpus, out["a2"].effective_vcpus) == (8, 2)
    assert out["a5"].effective_vcpus is None


def test_committed_fraction_and_zero_capacity(tables):
    rows = adapters.HOST_COMMITTED.intervals(tables).where("resource = 'nodes'").collect()
    assert {r.entity_id: r.value for r in rows} == {"a1": 1.0, "a2": 0.25, "a2x": None, "a5": 1.0}


def test_device_allocations(tables):
    assert [r.id for r in builders.device_allocations(tables).collect()] == ["da1"]
    rows = adapters.DEVICE_RESERVABLE.intervals(tables).collect()
    assert [(r.entity_id, r.device_name, r.value) for r in rows] == [("d1", "one", 1.0)]


def test_events_carry_the_time_of_their_action(tables):
    rows = builders.instance_events(tables).collect()
    assert {(r.event_id, r.start_time.day) for r in rows} == {(1, 17), (2, 18), (3, 19), (4, 19), (5, 19)}


def test_last_host_breaks_ties_by_event(tables):
    got = {r.instance_uuid: r.last_host for r in builders.last_host(tables).collect()}
    assert got == {"metal": "h1"}


def test_end_is_the_first_after_the_last_resume(tables):
    got = {r.instance_uuid: r.event_terminated_at for r in builders.event_end(tables).collect()}
    assert got == {"metal": day(19)}


def test_end_is_null_without_end_events(spark, tables):
    events = table(
        spark,
        "nova_action_events",
        dict(id=1, action_id=1, event="compute_shelve_instance", result="Success"),
        dict(id=2, action_id=2, event="compute_unshelve_instance", result="Success"),
        dict(id=3, action_id=4, event="compute_reboot", result="Success"),
    )
    got = builders.event_end({**tables, "nova_action_events": events}).collect()
    assert {r.instance_uuid: r.event_terminated_at for r in got} == {"metal": None, "kvm": None}


def test_instances(tables):
    out = {r.uuid: r for r in builders.instances(tables).collect()}
    assert set(out) == {"kvm", "metal", "early"}
    kvm, metal, early = out["kvm"], out["metal"], out["early"]
    assert (kvm.blazar_reservation_id, kvm.booking_type, kvm.created_at) == ("r9", "reservation", day(6))
    assert (kvm.hypervisor_type, kvm.host_vcpus, kvm.deleted_at) == ("QEMU", 8, day(20))
    assert (metal.node, metal.hypervisor_type, metal.deleted_at) == ("h1", "ironic", day(19))
    assert metal.blazar_reservation_id == "r1"
    # before the first host record the earliest one counts
    assert (early.booking_type, early.hypervisor_type, early.host_vcpus) == ("ondemand", "QEMU", 8)
    assert "launched_at" not in early.asDict()


def test_both_bookings_from_one_pass(tables):
    def content(df):
        return {(r.entity_id, r.metric, r.resource, r.value) for r in df.collect()}

    apart = content(adapters.INSTANCE_RESERVED.intervals(tables)) | content(
        adapters.INSTANCE_ONDEMAND.intervals(tables)
    )
    together = content(adapters.INSTANCE_OCCUPIED.intervals(tables))
    assert together == apart
    assert ("kvm", "occupied_reservation", "nodes", 0.25) in together
    assert ("metal", "occupied_reservation", "nodes", 1.0) in together


def test_containers_end_only_when_terminal(tables):
    out = {r.uuid: r.deleted_at for r in builders.containers(tables).collect()}
    assert out == {"run": None, "stop": day(9)}


def test_registry_skips_adapters_without_tables(tables):
    some = {k: tables[k] for k in ("nova_hosts", "blazar_devices")}
    out = adapters.to_intervals(some, adapters.REGISTRY)
    assert {r.metric for r in out.select("metric").distinct().collect()} == {"total", "reservable"}
    assert {"hypervisor_hostname", "device_name"} <= set(out.columns)
    with pytest.raises(ValueError):
        adapters.to_intervals({}, adapters.REGISTRY)


def test_adapter_without_resources_fails(tables):
    bare = adapters.Adapter("bare", "id", "'x'", lambda t: t["nova_hosts"], resources={})
    with pytest.raises(ContractError):
        bare.intervals(tables)


def test_own_adapter_gives_the_interval_contract(frame):
    source = frame([("a", day(1), None)], "id string, created_at ts, deleted_at ts")
    own = adapters.Adapter("own", "id", "'reservable'", lambda _: source, {"nodes": "1"})
    row = own.intervals({}).first()
    assert tuple(row) == ("a", day(1), None, "reservable", "nodes", 1.0)


# --- files ----------------------------------------------------------------------------


def write_raw(tables, folder):
    for key, df in tables.items():
        df.write.parquet(f"{folder}/{SOURCES[key].name}.parquet")


def test_contract_drops_casts_and_refuses(spark):
    df = spark.sql(
        "SELECT 7 AS id, timestamp_ntz'2024-01-01' created_at, timestamp_ntz'2024-01-01' updated_at, "
        "NULL deleted_at, 'h' hypervisor_hostname, 't' hypervisor_type, cast(1 as int) vcpus, "
        "1 memory_mb, 1 local_gb, cast(1 as float) cpu_allocation_ratio, 1 ram_allocation_ratio, "
        "1 disk_allocation_ratio, 'x' AS other"
    )
    out = contract(df, SOURCES["nova_hosts"])
    assert out.dtypes == list(SOURCES["nova_hosts"].columns.items())
    with pytest.raises(ContractError):
        contract(df.drop("vcpus"), SOURCES["nova_hosts"])
    leases = "SELECT 1 AS id, 'p' project_id, NULL created_at, NULL deleted_at, NULL start_date, NULL end_date"
    with pytest.raises(ContractError):
        contract(spark.sql(leases), SOURCES["blazar_leases"])


def test_loader_skips_absent_and_raises_on_broken(spark, tables, tmp_path):
    write_raw({k: tables[k] for k in ("nova_hosts", "blazar_leases")}, tmp_path)
    assert set(load_raw_tables(spark, str(tmp_path))) == {"nova_hosts", "blazar_leases"}
    tables["blazar_leases"].drop("end_date").write.mode("overwrite").parquet(
        f"{tmp_path}/blazar.leases.parquet"
    )
    with pytest.raises(RawTableError, match="blazar.leases"):
        load_raw_tables(spark, str(tmp_path))


def test_process_writes_sites_and_leaves_broken_ones_out(spark, tables, tmp_path):
    good, bad, out = tmp_path / "good", tmp_path / "bad", tmp_path / "out"
    write_raw(tables, good)
    tables["nova_hosts"].drop("vcpus").write.parquet(f"{bad}/nova.compute_nodes.parquet")
    spec = UsageSpec(("metric", "resource", "site", "collector_type"), (day(1), day(25)))
    exported = []
    usage = process(
        spark,
        {"north": str(good), "broken": str(bad), "south": str(good)},
        spec,
        str(out),
        "1d",
        export=exported.append,
    ).usage
    assert sorted(p.name for p in out.iterdir() if "=" in p.name) == ["site=north", "site=south"]
    nodes = usage.where("site = 'north' and resource = 'nodes' and metric = 'total'")
    levels = {r.timestamp.day: r.value for r in nodes.collect()}
    assert (levels[4], levels[5], levels[20]) == (0.0, 1.0, 2.0)
    assert {r.site for r in exported[0].collect()} == {"north", "south"}
    with pytest.raises(RawTableError):
        process(spark, {"broken": str(bad)}, spec, str(out), "1d")


KINDS = ("compute_terminate_instance", "compute_shelve_instance", "compute_unshelve_instance", "compute_resize", "other")


def test_instance_with_a_third_of_all_events(spark):
    rng = random.Random(8)
    names = ["hot"] * 600 + [f"i{n % 200}" for n in range(1200)]
    actions = [
        dict(id=n, instance_uuid=u, start_time=rng.choice([None, day(rng.randint(1, 28), rng.randrange(24))]))
        for n, u in enumerate(names)
    ]
    events = [
        dict(id=n * 2 + k, action_id=n, event=rng.choice(KINDS), result=rng.choice(["Success"] * 4 + ["Error"]), host=f"h{rng.randrange(9)}")
        for n in range(len(names))
        for k in range(rng.randint(1, 2))
    ]
    raw = {
        "nova_actions": table(spark, "nova_actions", *actions),
        "nova_action_events": table(spark, "nova_action_events", *events),
    }
    expected = {}
    times = {a["id"]: (a["instance_uuid"], a["start_time"]) for a in actions}
    seen = {}
    for e in events:
        if e["result"] == "Success":
            name, at = times[e["action_id"]]
            seen.setdefault(name, []).append((at, e["id"], e["event"], e["host"]))
    for name, own in seen.items():
        resumes = [at for at, _, kind, _ in own if kind == "compute_unshelve_instance" and at]
        ends = [at for at, _, kind, _ in own if kind in KINDS[:2] and at and (not resumes or at > max(resumes))]
        hosts = [(at is not None, at or day(1), i, h) for at, i, kind, h in own if kind.startswith("compute_")]
        expected[name] = (min(ends, default=None), max(hosts)[3] if hosts else None)
    facts = builders.instance_facts(raw)
    assert {r.instance_uuid: (r.event_terminated_at, r.last_host) for r in facts.collect()} == expected
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" not in plan and "Generate" not in plan  # no row is copied
    # both sides by action, then by instance and day, then by instance
    fresh = builders.instance_facts(raw)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange\b", fresh)) <= 4


def test_allocations_with_repeated_and_missing_keys(spark):
    rng = random.Random(4)

    def some(n):
        return rng.choice([None, *map(str, range(n))])

    def rows(n, **columns):
        return [{c: make() for c, make in columns.items()} for _ in range(n)]

    def at():
        return rng.choice([None, day(rng.randint(1, 28))])

    data = {
        "blazar_alloc": [dict(r, id=str(i)) for i, r in enumerate(rows(60, compute_host_id=lambda: some(4), reservation_id=lambda: some(9)))],
        "blazar_hosts": rows(6, id=lambda: some(3), vcpus=lambda: rng.randint(1, 9)),
        "blazar_res": rows(14, id=lambda: some(7), lease_id=lambda: some(8), resource_type=lambda: rng.choice([None, "physical:host", "flavor:instance"])),
        "blazar_instance_res": rows(8, reservation_id=lambda: some(9), vcpus=lambda: rng.randint(1, 9)),
        "blazar_leases": rows(12, id=lambda: some(7), start_date=at, created_at=at, end_date=at, deleted_at=at),
    }

    def met(key, column, value):
        return [r for r in data[key] if value is not None and r[column] == value] or [{}]

    expected = []
    for a in data["blazar_alloc"]:
        for r in met("blazar_res", "id", a["reservation_id"]):
            for lease in met("blazar_leases", "id", r.get("lease_id")):
                starts = [t for t in (lease.get("start_date"), lease.get("created_at")) if t]
                ends = [t for t in (lease.get("end_date"), lease.get("deleted_at")) if t]
                if not starts or not ends or max(starts) > min(ends):
                    continue
                for h in met("blazar_hosts", "id", a["compute_host_id"]):
                    for f in met("blazar_instance_res", "reservation_id", a["reservation_id"]):
                        own = f if r["resource_type"] == "flavor:instance" else h
                        expected.append((a["id"], r["lease_id"], max(starts), min(ends), own.get("vcpus")))
    found = builders.host_allocations({k: table(spark, k, *v) for k, v in data.items()})
    names = ("id", "lease_id", "effective_start", "effective_end", "effective_vcpus")
    assert expected and sorted(map(str, expected)) == sorted(str(tuple(r[n] for n in names)) for r in found.collect())


# --- several sites in one plan --------------------------------------------------------


def sites_of(spark, tables):
    """Sites that share ids but not rows; one without instances, one without half an adapter's tables."""
    late = {**tables, "blazar_leases": tables["blazar_leases"].withColumn("end_date", F.lit(day(7)))}
    north = {**tables, "nova_hosts": tables["nova_hosts"].where("id = '1'")}
    bare = {k: v for k, v in late.items() if not k.startswith("nova_instances")}
    half = {k: v for k, v in tables.items() if k not in ("nova_actions", "blazar_instance_res")}
    return {"north": north, "south": late, "bare": bare, "half": half}


def content(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("interval", [None, "1d"])
def test_sites_together_equal_each_alone(spark, tables, interval):
    sites = sites_of(spark, tables)
    spec = UsageSpec(("metric", "resource", "site", "collector_type"), (day(4), day(25)))
    together = content(sites_usage(sites, spec, interval))
    alone = []
    for name, raw in sites.items():
        intervals = adapters.to_intervals(raw, adapters.REGISTRY).withColumn("collector_type", F.lit("current"))
        valid = valid_intervals(adapters.in_window(intervals, spec.time_range), name)
        alone += content(run_usage(valid, spec, interval))
    assert together == sorted(alone, key=str)
    metrics = {}
    names = sorted(("timestamp", "value", "metric", "resource", "site", "collector_type"))
    for row in together:
        r = dict(zip(names, row))
        metrics.setdefault(r["site"], set()).add(r["metric"])
    assert "occupied_ondemand" in metrics["south"] and "occupied_ondemand" not in metrics["bare"]
    assert "occupied_reservation" not in metrics["half"] and "reservable" in metrics["half"]


def jobs_of(spark, sites, spec, out, name):
    context = spark.sparkContext
    context.setJobGroup(name, name)
    process(spark, sites, spec, out, "1d")
    context.setJobGroup("others", "others")
    return len(context.statusTracker().getJobIdsForGroup(name))


def test_more_sites_need_no_more_jobs(spark, tables, tmp_path):
    spec = UsageSpec(("metric", "resource", "site", "collector_type"), (day(1), day(25)))
    one = jobs_of(spark, {"a": tables}, spec, f"{tmp_path}/one", "one-site")
    many = jobs_of(spark, {c: tables for c in "abcd"}, spec, f"{tmp_path}/many", "many-sites")
    assert 0 < many <= one + 3  # adaptive stages of one query count as jobs of their own


def test_audit_comes_with_the_run(spark, tables, tmp_path):
    sites = sites_of(spark, tables)
    spec = UsageSpec(("metric", "resource", "site", "collector_type"), (day(1), day(25)))
    done = process(spark, sites, spec, f"{tmp_path}/out", "1d")
    found = {(a.metric, a.action): a.rows for a in done.audit}
    rows = adapters.in_window(adapters.sites_to_intervals(sites, adapters.REGISTRY), spec.time_range)
    counted = clamp_hierarchy(rows, ["site"]).groupBy("metric", "coerce_action").count()
    assert found == {(r.metric, r.coerce_action): r["count"] for r in counted.collect()}
    assert any(action != "none" for _, action in found)
    assert process(spark, sites, spec, f"{tmp_path}/lazy", "1d", cut=False).audit == []


def test_copies_of_a_run_hold_what_it_reads(spark, tables, monkeypatch):
    copies = []

    def noted(df, *given, **named):
        copies.append((df.columns, *given, named.get("partition_by")))
        return materialise(df, *given, **named)

    monkeypatch.setattr(jobs, "materialise", noted)
    monkeypatch.setattr(clamp, "materialise", noted)
    spec = UsageSpec(("metric", "resource", "site", "collector_type"), (day(4), day(25)))
    sites_usage({"north": tables}, spec, "1d")
    assert len(copies) == 4 and all(place is None for _, place in copies)
    unread = {"blazar_allocation_id", "blazar_lease_id", "instance_id", "blazar_device_id", "device_name", "project_id"}
    assert not any(unread & set(columns) for columns, _ in copies)


def test_joined_sources_are_written_in_steps(spark, tables, monkeypatch):
    made = {}

    def noted(module):
        def write(df):
            made.setdefault(module.__name__, []).append(df.columns)
            return materialise(df)

        monkeypatch.setattr(module, "materialise", write)

    noted(adapters)
    noted(builders)
    window = (day(4), day(25))
    whole = adapters.in_window(adapters.to_intervals(tables, adapters.REGISTRY), window)
    assert not made
    keep = ("hypervisor_hostname", "blazar_reservation_id")
    cut = adapters.to_intervals(tables, adapters.REGISTRY, window, keep, cut=True)
    assert content(cut) == content(whole.select(*cut.columns))
    # allocations of hosts and of devices, instances; events with their instance, facts of instances
    assert [len(made[m.__name__]) for m in (adapters, builders)] == [3, 2]
    unread = {"blazar_lease_id", "instance_id", "blazar_device_id", "device_name", "project_id"}
    assert not any(unread & set(columns) for columns in made[adapters.__name__])


def test_spent_copies_of_a_run_go(spark, tables):
    folder = Path(shared_folder(spark).removeprefix("file://"))
    before = {*folder.glob("tideline-*")}
    with copies() as given:
        own = {**tables, "blazar_leases": materialise(tables["blazar_leases"])}
    spec = UsageSpec(("metric", "resource", "site", "collector_type"), (day(4), day(25)))
    usage = sites_usage({"north": own}, spec, "1d", spent=given)
    assert len({*folder.glob("tideline-*")} - before) == 1  # only the valid intervals
    assert content(usage) == content(sites_usage({"north": tables}, spec, "1d", cut=False)) != []


def test_sites_fail_as_they_do_alone(spark, tables, frame):
    with pytest.raises(ValueError, match="no adapter has its tables in .'empty'"):
        adapters.sites_to_intervals({"north": tables, "empty": {}}, adapters.REGISTRY)
    df = frame(
        [("a", day(1), None, "speed", "nodes", 1.0, "n")],
        "entity_id string, start ts, end ts, metric string, resource string, value double, site string",
    )
    spec = UsageSpec(("metric", "resource", "site"), (day(1), day(5)))
    with pytest.raises(Exception, match="not planned for: speed"):
        run_usage(df, spec, "1d", scope=["site"]).collect()
    got = run_usage(df, spec, "1d", metrics=["speed"], scope=["site"]).collect()
    assert {(r.metric, r.value) for r in got} == {("speed", 1.0)}


def cache_rows(spark):
    ddl = ", ".join(f"{c} {t}" for c, t in DAILY_CACHE.items())
    return spark.createDataFrame(
        [
            (day(1), "a", 24.0, 48.0, 24.0, 0.0, 240.0),
            (day(1), "b", 0.0, 0.0, 24.0, 0.0, 24.0),
            (day(2), "a", None, 24.0, 0.0, 0.0, 48.0),
        ],
        ddl,
    )


def test_legacy_counts(spark):
    got = {(r.timestamp.day, r.metric): r.value for r in legacy_usage_counts(cache_rows(spark)).collect()}
    assert {k[1]: v for k, v in got.items() if k[0] == 1} == {
        "total": 11.0,
        "reservable": 10.0,
        "committed": 4.0,
        "occupied_reservation": 2.0,
        "available_reservable": 6.0,
        "idle": 2.0,
    }
    assert got[(2, "reservable")] == 2.0


def test_legacy_cache_may_be_absent(spark, tmp_path):
    empty = read_daily_cache(spark, f"{tmp_path}/none.parquet")
    assert empty.columns == list(DAILY_CACHE) and legacy_usage_counts(empty).count() == 0


def test_report_of_both_collectors(spark, tables, tmp_path):
    write_raw(tables, tmp_path / "raw")
    cache_rows(spark).write.parquet(f"{tmp_path}/cache.parquet")
    spec = UsageSpec(("metric", "resource", "site", "collector_type"), (day(1), day(9)))
    wide = report(
        spark,
        {"north": f"{tmp_path}/raw"},
        {"north": f"{tmp_path}/cache.parquet"},
        spec,
        "1d",
        f"{tmp_path}/out",
    )
    rows = {r.timestamp.day: r for r in wide.where("resource = 'nodes'").collect()}
    assert (rows[1].total_legacy, rows[8].total_legacy) == (11.0, 2.0)
    assert (rows[4].total_current, rows[5].total_current) == (0.0, 1.0)
    for kind in ("parquet", "json", "csv"):
        assert (tmp_path / "out" / f"usage_timeline.{kind}").is_dir()


def test_sinks_round_trip(spark, frame, tmp_path):
    df = frame(
        [(day(1, 3), 1.5, "total", "north"), (day(2), None, "total", "south")],
        "timestamp ts, value double, metric string, site string",
    )
    write_usage(df, f"{tmp_path}/usage")
    back = spark.read.parquet(f"{tmp_path}/usage").select(df.columns)
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    write_report(df, str(tmp_path), "r")
    csv = spark.read.schema(df.schema).option("header", True).csv(f"{tmp_path}/r.csv")
    assert sorted(csv.collect(), key=str) == sorted(df.collect(), key=str)


def test_projects_lookup(spark, tmp_path):
    path = tmp_path / "projects.json"
    path.write_text(json.dumps([{"ID": "p1", "Name": "One", "More": 1}, {"ID": "p2", "Name": "Two"}]))
    got = {r.id: r.name for r in read_projects(spark, str(path)).collect()}
    assert got == {"p1": "One", "p2": "Two"}


# --- databases: the reader is replaced, no database is started --------------------------


class Refused(Exception):
    def __init__(self, code):
        super().__init__(code)
        self.code = code


def test_extract_reports_every_table(spark, tmp_path):
    failures = {
        "nova.instances": Refused(1146),
        "blazar.leases": Refused(1142),
        "zun.container": Refused(1045),
        "blazar.devices": Refused(2003),
        "nova.instance_actions": RuntimeError("odd"),
    }

    def read(name):
        if name in failures:
            raise failures[name]
        return spark.range(3)

    got = jdbc.extract(read, str(tmp_path), legacy_schema="old_usage")
    assert len(got) == 41
    assert got["nova.compute_nodes"] == "3" and got["old_usage.node_usage"] == "3"
    assert {t: got[t] for t in failures} == {
        "nova.instances": "MISSING",
        "blazar.leases": "PERMISSION_ERROR",
        "zun.container": "AUTH_ERROR",
        "blazar.devices": "CONNECTION_ERROR",
        "nova.instance_actions": "OPERATIONAL_ERROR",
    }
    assert spark.read.parquet(f"{tmp_path}/blazar.computehosts.parquet").count() == 3


def test_failure_status_follows_causes():
    try:
        try:
            raise Refused(1143)
        except Refused as inner:
            raise RuntimeError("wrapped") from inner
    except RuntimeError as exc:
        assert jdbc.failure_status(exc) == "PERMISSION_ERROR"


class Recorder:
    """Stands in for a reader or writer: keeps what it is told, returns itself."""

    def __init__(self):
        self.told, self.done = {}, None
        self.read = self.write = self

    def format(self, name):
        return self.option("format", name)

    def option(self, key, value):
        self.told[key] = str(value)
        return self

    def options(self, **more):
        self.told.update(more)
        return self

    def mode(self, name):
        return self.option("mode", name)

    def load(self):
        self.done = dict(self.told)
        return self

    save = load


def test_database_reads_are_sliced_where_asked():
    slices = {"nova.instances": jdbc.Slices("id", "1", "9000", 12)}
    session = Recorder()
    read = jdbc.jdbc_reader(session, "jdbc:x://db", {"user": "u"}, slices)
    read("nova.instances")
    assert session.done == {
        "format": "jdbc", "user": "u", "url": "jdbc:x://db", "dbtable": "nova.instances",
        "preferTimestampNTZ": "true", "fetchsize": "10000", "partitionColumn": "id",
        "lowerBound": "1", "upperBound": "9000", "numPartitions": "12",
    }
    session.told.clear()
    read("nova.services")
    assert session.done["dbtable"] == "nova.services" and "partitionColumn" not in session.done


@pytest.mark.parametrize("overwrite, mode", [(True, "overwrite"), (False, "errorifexists")])
def test_database_export_replaces_one_table(overwrite, mode):
    frame = Recorder()
    jdbc.write_compat(frame, "jdbc:x://db", overwrite=overwrite, properties={"user": "u"}, connections=3)
    assert frame.done == {
        "format": "jdbc", "user": "u", "url": "jdbc:x://db", "dbtable": jdbc.OUTPUT_TABLE,
        "numPartitions": "3", "mode": mode,
    }
