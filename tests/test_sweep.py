"""Intervals to deltas and counts."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import day
from tideline.functions.buckets import micros, py_micros
from tideline.operators.scan import Measure, asof_join, cut_rows, dense_cuts, running
from tideline.operators.sweep import (
    deltas_to_counts,
    intervals_to_counts,
    intervals_to_deltas,
)

SCHEMA = "start ts, end ts, group string"


def values(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_deltas_open_and_close(frame):
    out = intervals_to_deltas(frame([(day(1), day(2), "a")], SCHEMA), "start", "end", ["group"])
    assert values(out, "timestamp") == [(day(1), "a", 1), (day(2), "a", -1)]


def test_deltas_without_end_never_close(frame):
    out = intervals_to_deltas(frame([(day(1), None, "a")], SCHEMA), "start", "end", ["group"])
    assert values(out, "timestamp") == [(day(1), "a", 1)]


def test_deltas_carry_the_value(frame):
    df = frame([(day(1), day(2), "a", 32)], SCHEMA + ", vcpus bigint")
    out = intervals_to_deltas(df, "start", "end", ["group"], "vcpus")
    assert [r.change for r in out.orderBy("timestamp").collect()] == [32, -32]


def test_deltas_keep_several_group_columns(frame):
    df = frame([(day(1), None, "a", "x")], SCHEMA + ", other string")
    out = intervals_to_deltas(df, "start", "end", ["group", "other"])
    assert out.columns == ["timestamp", "group", "other", "change"]


def test_counts_accumulate_per_group_and_merge_instants(frame):
    df = frame(
        [(day(1), 1, "a"), (day(1), 1, "a"), (day(2), -1, "a"), (day(1), 1, "b")],
        "timestamp ts, change bigint, group string",
    )
    out = deltas_to_counts(df, ["group"]).select("group", "timestamp", "value")
    assert values(out, "group", "timestamp") == [
        ("a", day(1), 2),
        ("a", day(2), 1),
        ("b", day(1), 1),
    ]


def counted(frame, rows, groups=("group",)):
    out = intervals_to_counts(frame(rows, SCHEMA), "start", "end", list(groups))
    return [r.value for r in out.orderBy(*groups, "timestamp").collect()]


def test_count_is_one_then_zero(frame):
    assert counted(frame, [(day(1), day(2), "a")]) == [1, 0]


def test_overlapping_intervals_stack(frame):
    assert counted(frame, [(day(1), day(3), "a"), (day(2), day(4), "a")]) == [1, 2, 1, 0]


def test_open_interval_stays(frame):
    assert counted(frame, [(day(1), None, "a")]) == [1]


def test_groups_do_not_mix(frame):
    assert counted(frame, [(day(1), day(2), "a"), (day(1), day(2), "b")]) == [1, 0, 1, 0]


def test_adjacent_intervals_are_seamless(frame):
    assert counted(frame, [(day(1), day(2), "a"), (day(2), day(3), "a")]) == [1, 1, 0]


def test_no_group_columns(frame):
    assert counted(frame, [(day(1), day(2), "a"), (day(1), day(3), "b")], ()) == [2, 1, 0]


def test_null_group_is_a_group(frame):
    assert counted(frame, [(day(1), day(2), None), (day(1), None, "b")]) == [1, 0, 1]


def test_zero_length_nets_to_zero_and_backwards_goes_negative(frame):
    assert counted(frame, [(day(1), day(1), "a")]) == [0]
    assert counted(frame, [(day(3), day(2), "a")]) == [-1, 0]


def test_null_values_count_as_zero(frame):
    df = frame(
        [(day(1), None, "a", None), (day(2), None, "a", 2.0)], SCHEMA + ", v double"
    )
    out = intervals_to_counts(df, "start", "end", ["group"], "v")
    assert [r.value for r in out.orderBy("timestamp").collect()] == [0.0, 2.0]


@pytest.mark.parametrize("slice_us", [None, 1, 3_600_000_000, 10**15])
def test_counts_match_the_definition_for_any_slice(frame, slice_us):
    rng = random.Random(7)
    t0 = datetime(2024, 1, 1)
    rows = []
    for _ in range(120):
        start = t0 + timedelta(minutes=rng.randrange(2000))
        length = rng.choice([None, 0, 30, 90, 600])
        end = None if length is None else start + timedelta(minutes=length)
        rows.append((start, end, rng.choice("abc")))
    out = intervals_to_counts(
        frame(rows, SCHEMA), "start", "end", ["group"], slice_us=slice_us
    ).collect()
    instants = {(r[2], t) for r in rows for t in r[:2] if t is not None}
    assert {(r.group, r.timestamp) for r in out} == instants
    for r in out:
        open_now = sum(
            1
            for s, e, g in rows
            if g == r.group and s <= r.timestamp and (e is None or e > r.timestamp)
        )
        assert r.value == open_now


def test_micros_ignore_the_session_zone(spark, frame):
    t = datetime(2024, 3, 31, 2, 30, 15, 123456)  # does not exist in Berlin
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        got = frame([(t,)], "t ts").select(micros(F.col("t"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == py_micros(t)


def test_running_last_and_max_across_slices(frame):
    df = frame(
        [("a", day(1), 5), ("a", day(2), None), ("a", day(4), 3), ("b", day(3), None)],
        "g string, t ts, v int",
    )
    out = running(df, ["g"], "t", [Measure("l", "last", "v"), Measure("m", "max", "v")])
    got = [(r.g, r.t.day, r.l, r.m) for r in out.orderBy("g", "t").collect()]
    assert got == [("a", 1, 5, 5), ("a", 2, 5, 5), ("a", 4, 3, 5), ("b", 3, None, None)]


@pytest.mark.parametrize("limit", [None, 1, 2])
def test_asof_takes_equal_instants_and_the_last_tie(frame, limit):
    left = frame(
        [(1, "n", day(1)), (2, "n", day(5)), (3, "n", day(9)), (4, None, day(9))],
        "id int, node string, at ts",
    )
    right = frame(
        [("n", day(5), 1, "old"), ("n", day(5), 2, "new"), (None, day(1), 3, "none")],
        "node string, since ts, rid int, kind string",
    )
    out = asof_join(left, right, ["node"], "at", "since", ["kind"], ["rid"], era_limit=limit)
    got = [(r.id, r.kind) for r in out.orderBy("id").collect()]
    assert got == [(1, None), (2, "new"), (3, "new"), (4, None)]


# --- slices whose edges come from the data ----------------------------------------------


def dense_rows(frame):
    """A third of all rows in one quarter of an hour of one group, the rest thin; a NULL group and time."""
    rng = random.Random(5)
    dense = [(day(9) + timedelta(microseconds=rng.randrange(900_000_000)), "hot", rng.choice([1, -1])) for _ in range(1500)]
    thin = [(day(1) + timedelta(seconds=rng.randrange(2_500_000)), g, 1) for g in ("hot", "b", None) for _ in range(1000)]
    same = [(day(9, 1), "b", 1)] * 40
    return frame(dense + thin + same + [(None, "hot", 5), (None, None, 1)], "at ts, group string, v bigint")


def test_dense_slices_give_the_plain_result(frame):
    df = dense_rows(frame).withColumn("tie", F.monotonically_increasing_id())
    measures = [Measure("total", "sum", "v"), Measure("top", "max", "v"), Measure("held", "last", "v")]
    for exclusive in (False, True):
        plain = running(df, ["group"], "at", measures, ["tie"], slice_us=None, exclusive=exclusive)
        cut = running(df, ["group"], "at", measures, ["tie"], slice_rows=100, exclusive=exclusive)
        assert sorted(map(str, cut.collect())) == sorted(map(str, plain.select(cut.columns).collect()))


def test_what_comes_after_a_row_and_the_whole(frame):
    rows = dense_rows(frame).groupBy("at", "group").agg(F.sum("v").alias("v")).where("at is not null")
    measures = [Measure("after", "next", "v"), Measure("all", "whole", "v"), Measure("so_far", "sum", "v")]
    plain = running(rows, ["group"], "at", measures, slice_us=None)
    expected = {}
    for r in rows.collect():
        expected.setdefault(r.group, []).append((r["at"], r.v))
    for group, own in expected.items():
        own.sort()
        expected[group] = [
            (at, sum(v for _, v in own[: i + 1]), own[i + 1][1] if i + 1 < len(own) else None, sum(v for _, v in own))
            for i, (at, v) in enumerate(own)
        ]
    for out in (plain, running(rows, ["group"], "at", measures), running(rows, ["group"], "at", measures, slice_rows=100)):
        found = {}
        for r in out.collect():
            found.setdefault(r.group, []).append((r["at"], r.so_far, r.after, r["all"]))
        assert {g: sorted(own) for g, own in found.items()} == expected


def test_dense_slices_are_even(frame):
    rows = dense_rows(frame).withColumns({"_us": micros(F.col("at")), "_slice": F.to_date("at")})
    cell = ["group", "_slice"]
    cuts = dense_cuts(rows, cell, "_us", 100)
    parts = cut_rows(rows, cuts, cell, "_us").groupBy(*cell, "_part").count()
    sizes = {(r.group, r._slice, r._part): r["count"] for r in parts.collect()}
    hot = {k: n for k, n in sizes.items() if n and k[0] == "hot" and k[1] == day(9).date()}
    assert len(hot) >= 12 and max(hot.values()) < 250 and sum(hot.values()) > 1500
    assert sum(sizes.values()) == rows.count()
    # rows of one instant stay together; edges do not depend on how rows lie in partitions
    again = {(r.group, r._slice): r._edges for r in dense_cuts(rows.repartition(9), cell, "_us", 100).collect()}
    assert set(again) == {(r.group, r._slice) for r in cuts.collect()}
    assert dense_cuts(rows, cell, "_us", 10_000) is None
    assert dense_cuts(rows.limit(0), cell, "_us", 1) is None


def test_two_levels_of_edges_find_the_right_part(frame, spark):
    rows = spark.range(5000).select(F.lit("a").alias("g"), F.col("id").alias("at"))
    cuts = dense_cuts(rows, ["g"], "at", 40)
    edges = cuts.first()._edges
    assert len(edges) == 124
    for r in cut_rows(rows, cuts, ["g"], "at").collect():
        assert r._part == sum(e <= r["at"] for e in edges)


def test_setting_cuts_as_well(spark, frame):
    df = dense_rows(frame).where("at is not null")
    plain = sorted(map(str, deltas_to_counts(df.select(F.col("at").alias("timestamp"), "group", F.col("v").alias("change")), ["group"]).collect()))
    spark.conf.set("tideline.slice.rows", "200")
    try:
        cut = deltas_to_counts(df.select(F.col("at").alias("timestamp"), "group", F.col("v").alias("change")), ["group"])
        assert sorted(map(str, cut.collect())) == plain
    finally:
        spark.conf.unset("tideline.slice.rows")
