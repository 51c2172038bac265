"""Clamp contract, hierarchy, and the path for keys with very many parents."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import day
from tideline.operators.clamp import (
    apply_temporal_clamp,
    clamp_hierarchy,
    first_per_key,
    hot_keys,
)
from tideline.operators.clamp import _clamp

SCHEMA = "start ts, end ts, key string"

# name: (child (start, end), parents [(start, end)], expected {(start, end, valid, action)})
# Numbers are days of January 2024, None an open end.
CASES = {
    "inside": ((10, 20), [(5, 25)], [(10, 20, True, "none")]),
    "starts_early": ((3, 15), [(5, 25)], [(5, 15, True, "clipped")]),
    "ends_late": ((10, 30), [(5, 25)], [(10, 25, True, "clipped")]),
    "both_ends": ((3, 30), [(5, 25)], [(5, 25, True, "clipped")]),
    "no_such_key": ((10, 20), [], [(10, 20, False, "orphan")]),
    "before_all": ((5, 8), [(10, 25)], [(5, 8, False, "orphan")]),
    "early_starter": ((5, 15), [(10, 25)], [(10, 15, True, "clipped")]),
    "after_all": ((26, 28), [(5, 25)], [(26, 28, False, "orphan")]),
    "touches_end": ((25, 30), [(5, 25)], [(25, 30, False, "orphan")]),
    "touches_start": ((1, 5), [(5, 25)], [(1, 5, False, "orphan")]),
    "open_child": ((10, None), [(5, 25)], [(10, 25, True, "clipped")]),
    "open_parent": ((10, 20), [(5, None)], [(10, 20, True, "none")]),
    "both_open": ((10, None), [(5, None)], [(10, None, True, "none")]),
    "second_era": ((15, 20), [(1, 8), (10, 25)], [(15, 20, True, "none")]),
    "two_eras": (
        (5, 20),
        [(1, 10), (15, 25)],
        [(5, 10, True, "clipped"), (15, 20, True, "clipped")],
    ),
    "open_over_eras": (
        (1, None),
        [(5, 10), (15, 25)],
        [(5, 10, True, "clipped"), (15, 25, True, "clipped")],
    ),
    "in_the_gap": ((11, 14), [(5, 10), (15, 25)], [(11, 14, False, "orphan")]),
    "twin_parents": (
        (10, 20),
        [(5, 25), (5, 25)],
        [(10, 20, True, "none"), (10, 20, True, "none")],
    ),
    "zero_length": ((10, 10), [(5, 25)], [(10, 10, True, "none")]),
    "zero_at_parent_start": ((5, 5), [(5, 25)], [(5, 5, False, "orphan")]),
}


def at(n):
    return None if n is None else day(n)


@pytest.fixture(scope="module", params=[None, 0], ids=["by_key", "by_time_nodes"])
def clamped(request, frame):
    children = [(at(s), at(e), name) for name, ((s, e), _, _) in CASES.items()]
    parents = [(at(s), at(e), name) for name, (_, ps, _) in CASES.items() for s, e in ps]
    parents.append((None, None, "no_such_key"))  # a parent without start matches nothing
    out = apply_temporal_clamp(
        frame(children, SCHEMA), frame(parents, SCHEMA), ["key"], hot_limit=request.param
    )
    return out.collect()


@pytest.mark.parametrize("name", CASES)
def test_cases(clamped, name):
    (start, end), _, expected = CASES[name]
    got = [r for r in clamped if r.key == name]
    assert sorted(
        [(r.start, r.end, r.valid, r.coerce_action) for r in got], key=str
    ) == sorted([(at(s), at(e), v, a) for s, e, v, a in expected], key=str)
    assert {(r.original_start, r.original_end) for r in got} == {(at(start), at(end))}


def test_null_key_and_columns(frame):
    children = frame([(day(10), day(20), None, "keep")], SCHEMA + ", extra string")
    parents = frame([(day(5), day(25), None, "leak")], SCHEMA + ", validator_only string")
    out = apply_temporal_clamp(children, parents, ["key"])
    assert out.columns == [
        "start",
        "end",
        "key",
        "extra",
        "original_start",
        "original_end",
        "valid",
        "coerce_action",
    ]
    row = out.first()
    assert (row.valid, row.coerce_action, row.extra) == (False, "null_key", "keep")


def test_require_parent_is_three_valued(frame):
    children = frame(
        [
            (day(10), day(20), "A", True),
            (day(10), day(20), "elsewhere", False),
            (day(10), day(20), None, False),
            (day(10), day(20), "A", None),
        ],
        SCHEMA + ", needs boolean",
    )
    parents = frame([(day(5), day(25), "A")], SCHEMA)
    out = apply_temporal_clamp(children, parents, ["key"], F.col("needs"))
    got = [(r.key, r.valid, r.coerce_action) for r in out.collect()]
    assert sorted(got, key=str) == [
        ("A", True, "none"),
        ("elsewhere", True, "none"),
        (None, True, "none"),
    ]


def test_missing_key_is_an_error(frame):
    df = frame([(day(1), day(2), "A")], SCHEMA)
    with pytest.raises(ValueError, match="need the key columns"):
        apply_temporal_clamp(df, df, ["host"])


def test_copies_of_a_child_stay(frame):
    children = frame([(day(10), day(20), "A")] * 3 + [(day(26), None, "A")] * 2, SCHEMA)
    parents = frame([(day(5), day(25), "A")], SCHEMA)
    for limit in (None, 0):
        out = apply_temporal_clamp(children, parents, ["key"], hot_limit=limit)
        assert sorted(r.coerce_action for r in out.collect()) == ["none"] * 3 + ["orphan"] * 2


def test_both_paths_match_brute_force(frame):
    rng = random.Random(11)

    def intervals(n):
        rows = []
        for _ in range(n):
            start = day(1) + timedelta(hours=rng.randrange(4000))
            length = rng.choice([None, 0, 1, 7, 50, 900, -5])
            end = None if length is None else start + timedelta(hours=length)
            rows.append((start, end, rng.choice(["hot", "hot", "hot", "cold"])))
        return rows

    children, parents = intervals(80), intervals(60)
    expected = []
    for s, e, k in children:
        over = [
            (ps, pe)
            for ps, pe, pk in parents
            if pk == k and (pe is None or s < pe) and (e is None or e > ps)
        ]
        for ps, pe in over:
            inside = s >= ps and (pe is None or (e is not None and e <= pe))
            ends = [x for x in (e, pe) if x is not None]
            expected.append(
                (k, max(s, ps), min(ends) if ends else None, "none" if inside else "clipped")
            )
        if not over:
            expected.append((k, s, e, "orphan"))
    for limit in (None, 25):
        out = apply_temporal_clamp(
            frame(children, SCHEMA), frame(parents, SCHEMA), ["key"], hot_limit=limit
        )
        got = [(r.key, r.start, r.end, r.coerce_action) for r in out.collect()]
        assert sorted(got, key=str) == sorted(expected, key=str)


def test_hot_keys_are_those_above_the_limit(frame):
    parents = frame([(day(1), None, "A")] * 3 + [(day(1), None, "B")], SCHEMA)
    assert [r.key for r in hot_keys(parents, ["key"], 2).collect()] == ["A"]


LEVELS = (
    "entity_id string, start ts, end ts, metric string, resource string, value double, "
    "hypervisor_hostname string, blazar_host_id string, blazar_reservation_id string, "
    "reservation_type string"
)
CHAIN = [
    ("host1", day(1), day(5), "total", "nodes", 1.0, "host1", None, None, None),
    ("bl1", day(1), day(6), "reservable", "nodes", 1.0, "host1", "b1", None, None),
    ("al1", day(1), day(9), "committed", "nodes", 1.0, "host1", "b1", "r1", "physical:host"),
    ("in1", day(2), None, "occupied_reservation", "nodes", 1.0, "host1", None, "r1", None),
    ("od1", day(1), day(9), "occupied_ondemand", "nodes", 1.0, "nowhere", None, None, None),
]


def test_hierarchy_chains_the_clamps(frame):
    out = clamp_hierarchy(frame(CHAIN, LEVELS)).collect()
    got = {r.entity_id: (r.end, r.coerce_action) for r in out}
    assert got == {
        "host1": (day(5), "none"),
        "bl1": (day(5), "clipped"),
        "al1": (day(5), "clipped"),
        "in1": (day(5), "clipped"),
        "od1": (day(9), "none"),
    }


def test_hierarchy_rules_per_level(frame):
    rows = CHAIN + [
        # a reservable row without host needs no parent
        ("dev", day(1), None, "reservable", "nodes", 1.0, None, None, None, None),
        # device allocations are exempt; an unknown reservation type drops the row
        ("da", day(1), day(2), "committed", "nodes", 1.0, None, None, "r2", "virtual:device"),
        ("gone", day(1), day(2), "committed", "nodes", 1.0, "host1", "b1", "r3", None),
        # committed has no overcommitted vcpus, so these are always orphans
        ("oc", day(1), day(2), "occupied_reservation", "vcpus_overcommit", 1.0, "host1", None, "r1", None),
        # an orphaned parent still bounds its children one level down
        ("bl2", day(20), day(25), "reservable", "nodes", 1.0, "host1", "b2", None, None),
        ("al2", day(19), day(26), "committed", "nodes", 1.0, "host1", "b2", "r4", "flavor:instance"),
    ]
    out = clamp_hierarchy(frame(rows, LEVELS)).collect()
    got = {r.entity_id: (r.valid, r.coerce_action, r.start, r.end) for r in out}
    assert got["dev"][:2] == (True, "none")
    assert got["da"][:2] == (True, "none")
    assert "gone" not in got
    assert got["oc"][:2] == (False, "orphan")
    assert got["bl2"][:2] == (False, "orphan")
    assert got["al2"] == (True, "clipped", day(20), day(25))


def test_parents_without_a_key_are_no_hot_key(frame):
    parents = frame([(day(1), day(2), k) for k in (None, None, None, "a", "a", "b")], SCHEMA)
    assert [r.key for r in hot_keys(parents, ["key"], 1).collect()] == ["a"]
    children = frame(
        [("x", day(1), day(2), None), ("y", day(1), day(2), "b"), ("z", day(4), day(5), "a")],
        "entity_id string, start ts, end ts, key string",
    )
    plain = apply_temporal_clamp(children, parents, ["key"])
    checked = apply_temporal_clamp(children, parents, ["key"], hot_limit=2)
    assert sorted(checked.collect(), key=str) == sorted(plain.collect(), key=str)
    assert "_hot" not in checked._jdf.queryExecution().optimizedPlan().toString()


def test_hierarchy_scope_and_cut_change_nothing_else(frame):
    df = frame(CHAIN, LEVELS)
    two = df.withColumn("site", F.lit("x")).unionByName(
        df.where("metric <> 'total'").withColumn("site", F.lit("y"))
    )
    plain = clamp_hierarchy(two, scope=["site"])
    cut = clamp_hierarchy(two, scope=["site"], hot_limit=0, cut=True)
    rows = {(r.site, r.entity_id, r.end, r.coerce_action) for r in plain.collect()}
    assert ("x", "bl1", day(5), "clipped") in rows
    assert ("y", "bl1", day(6), "orphan") in rows
    assert rows == {(r.site, r.entity_id, r.end, r.coerce_action) for r in cut.collect()}


def test_first_parent_per_key_order(frame):
    children = frame(
        [
            ("late", day(8), day(9), "A"),
            ("split", day(2), day(20), "A"),
            ("lost", day(25), day(26), "A"),
        ],
        "entity_id string, start ts, end ts, key string",
    )
    parents = frame([(day(3), day(5), "A"), (day(7), day(10), "A")], SCHEMA)
    tagged = _clamp(children, parents, ["key"], None, None)
    assert tuple(first_per_key(tagged, ["key"]).first()) == ("A", day(25), day(26))
    matched = tagged.where("coerce_action <> 'orphan'")
    assert tuple(first_per_key(matched, ["key"]).first()) == ("A", day(3), day(5))


def test_children_that_must_not_match_stay_out_of_the_join(frame):
    schema = "entity_id string, start ts, end ts, host string, kind string"
    children = frame(
        [(str(n), day(1 + n % 9), day(5 + n % 9) if n % 4 else None, host, kind)
         for n, (host, kind) in enumerate((h, k) for h in ("a", "b", None) for k in ("in", "out", None) for _ in range(6))],
        schema,
    )
    parents = frame([("p", day(3), day(8), "a", "in"), ("q", day(6), None, "a", "in")], schema)
    needs = F.col("kind") == "in"
    plain = apply_temporal_clamp(children, parents, ["host"], needs)
    checked = apply_temporal_clamp(children, parents, ["host"], needs, hot_limit=100)
    assert sorted(checked.collect(), key=str) == sorted(plain.collect(), key=str)
    text = checked._jdf.queryExecution().optimizedPlan().toString()
    assert text.startswith("Union")
