"""Align, sample, average."""

import random
from datetime import datetime, timedelta

import pytest

from tests.conftest import day
from tideline.functions.buckets import Buckets
from tideline.operators.rolling import trailing_mean
from tideline.operators.steps import (
    align_step_functions,
    resample_step_function,
    resample_time_weighted,
)

SCHEMA = "ts ts, val double, group string"
TWO = [(day(1), 10.0, "a"), (day(3), 30.0, "b")]


def rows(df):
    return [(r.group, r.ts, r.val) for r in df.orderBy("group", "ts").collect()]


def test_align_fills_to_the_union_of_instants(frame):
    out = align_step_functions(frame(TWO, SCHEMA), "ts", "val", ["group"])
    assert rows(out) == [
        ("a", day(1), 10.0),
        ("a", day(3), 10.0),
        ("b", day(1), None),
        ("b", day(3), 30.0),
    ]


def test_align_keeps_groups_apart(frame):
    data = [(day(1), 10.0, "a"), (day(2), 20.0, "a"), (day(2), 100.0, "b")]
    out = align_step_functions(frame(data, SCHEMA), "ts", "val", ["group"])
    assert [v for _, _, v in rows(out)] == [10.0, 20.0, None, 100.0]


def test_align_composite_and_null_groups(frame):
    data = [(day(1), 10.0, "cpu", "x"), (day(2), 20.0, None, "x")]
    out = align_step_functions(
        frame(data, "ts ts, val double, kind string, source string"),
        "ts",
        "val",
        ["kind", "source"],
    )
    got = {(r.kind, r.ts.day): r.val for r in out.collect()}
    assert got == {("cpu", 1): 10.0, ("cpu", 2): 10.0, (None, 1): None, (None, 2): 20.0}


def sampled(frame, data, interval, lo, hi, fn=resample_step_function):
    return rows(fn(frame(data, SCHEMA), "ts", "val", interval, ["group"], (lo, hi)))


def test_point_sample_sees_an_event_on_the_edge(frame):
    got = sampled(frame, [(day(2), 5.0, "a")], "1d", day(1), day(4))
    assert got == [("a", day(1), 0.0), ("a", day(2), 5.0), ("a", day(3), 5.0)]


def test_point_sample_keeps_levels_from_before_the_window(frame):
    got = sampled(frame, [(day(1), 5.0, "a"), (day(2, 6), 7.0, "a")], "1d", day(2), day(4))
    assert got == [("a", day(2), 5.0), ("a", day(3), 7.0)]


def test_point_sample_takes_the_latest_of_a_bucket(frame):
    data = [(day(1, 1), 1.0, "a"), (day(1, 9), 2.0, "a"), (day(1, 5), 3.0, "a")]
    assert sampled(frame, data, "1d", day(1), day(3)) == [
        ("a", day(1), 0.0),
        ("a", day(2), 2.0),
    ]


def test_point_sample_emits_groups_that_start_late(frame):
    got = sampled(frame, [(day(9), 5.0, "a")], "1d", day(1), day(3))
    assert got == [("a", day(1), 0.0), ("a", day(2), 0.0)]


@pytest.mark.parametrize(
    "interval, edges",
    [
        ("12h", [day(1), day(1, 12), day(2), day(2, 12), day(3)]),
        ("1d12h", [day(1), day(2, 12)]),
        ("1w", [day(1)]),
    ],
)
def test_fixed_intervals(frame, interval, edges):
    got = sampled(frame, [(day(1), 5.0, "a")], interval, day(1), day(3, 1))
    assert [t for _, t, _ in got] == edges


def test_calendar_intervals(frame):
    got = sampled(
        frame,
        [(day(1), 1.0, "a"), (day(1, 0, 2), 2.0, "a"), (day(2, 0, 2), 3.0, "a")],
        "1mo",
        day(1),
        day(15, 0, 4),
    )
    assert [(t.month, t.day, v) for _, t, v in got] == [
        (1, 1, 1.0),
        (2, 1, 2.0),
        (3, 1, 3.0),
        (4, 1, 3.0),
    ]


def test_interval_text_is_checked():
    for bad in ("", "d", "1x", "1mo2d"):
        with pytest.raises(ValueError):
            Buckets.parse(bad, (day(1), day(2)))


def test_bucket_edges_stop_before_the_end(spark):
    buckets = Buckets.parse("1d", (day(1), day(3)))
    assert [r[0] for r in buckets.edges(spark).collect()] == [day(1), day(2)]
    assert Buckets.parse("1d", (day(3), day(1))).count == 0


def weighted(frame, data, lo, hi):
    return sampled(frame, data, "1d", lo, hi, resample_time_weighted)


def test_weighted_follows_duration(frame):
    data = [(day(1), 1.0, "a"), (day(1, 23), 100.0, "a")]
    assert weighted(frame, data, day(1), day(2))[0][2] == pytest.approx(123 / 24)


def test_weighted_event_spans_buckets(frame):
    got = weighted(frame, [(day(1), 10.0, "a")], day(1), day(4))
    assert [v for _, _, v in got] == [10.0, 10.0, 10.0]


def test_weighted_clips_at_bucket_edges(frame):
    data = [(day(1, 18), 1.0, "a"), (day(2, 6), 2.0, "a")]
    got = [v for _, _, v in weighted(frame, data, day(1), day(3))]
    assert got == [pytest.approx(1.0), pytest.approx(42 / 24)]


def test_weighted_is_null_before_the_first_event(frame):
    got = weighted(frame, [(day(3), 10.0, "a")], day(1), day(4))
    assert [v for _, _, v in got] == [None, None, 10.0]


def test_weighted_groups_get_all_buckets(frame):
    data = [(day(1), 10.0, "a"), (day(3), 30.0, "b")]
    got = weighted(frame, data, day(1), day(4))
    assert [v for _, _, v in got] == [10.0, 10.0, 10.0, None, None, 30.0]


def test_weighted_event_on_an_edge_and_before_the_window(frame):
    data = [(day(1), 4.0, "a"), (day(3), 8.0, "a")]
    assert [v for _, _, v in weighted(frame, data, day(2), day(5))] == [4.0, 8.0, 8.0]


def test_weighted_last_bucket_ends_with_the_window(frame):
    data = [(day(1), 1.0, "a"), (day(1, 6), 3.0, "a")]
    assert [v for _, _, v in weighted(frame, data, day(1), day(1, 12))] == [2.0]


def test_weighted_matches_minute_by_minute(frame):
    rng = random.Random(3)
    t0 = day(1)
    events = sorted(rng.sample(range(4 * 1440), 40))
    data = [(t0 + timedelta(minutes=m), float(rng.randrange(9)), "a") for m in events]
    got = weighted(frame, data, day(2), day(5))
    for i, (_, bucket, value) in enumerate(got):
        level = []
        for m in range(1440):
            at = bucket + timedelta(minutes=m)
            before = [v for t, v, _ in data if t <= at]
            if before:
                level.append(before[-1])
        assert value == pytest.approx(sum(level) / len(level))


def test_trailing_mean_includes_both_ends_and_skips_gaps(frame):
    data = [
        (day(1), 1.0, "a"),
        (day(4), 3.0, "a"),
        (day(5), None, "a"),
        (day(6), float("nan"), "a"),
        (day(7), 8.0, "a"),
        (day(20), 4.0, "a"),
        (day(4), 50.0, "b"),
    ]
    out = trailing_mean(frame(data, SCHEMA), ["group"], "ts", "val", 3, "mean")
    got = [(r.group, r.ts.day, r.mean) for r in out.orderBy("group", "ts").collect()]
    assert got == [
        ("a", 1, 1.0),
        ("a", 4, 2.0),
        ("a", 5, None),
        ("a", 6, None),
        ("a", 7, 5.5),
        ("a", 20, 4.0),
        ("b", 4, 50.0),
    ]
