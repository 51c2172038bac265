"""Chart series and project summaries."""

from datetime import datetime

import pytest

from tests.conftest import day
from tideline.plans import series

WIDE = (
    "timestamp ts, site string, resource string, total_current double, reservable_current double, "
    "occupied_reservation_current double, occupied_ondemand_current double, idle_current double, "
    "available_reservable_current double, available_ondemand_current double, reservable_legacy double"
)


@pytest.fixture(scope="module")
def wide(frame):
    return frame(
        [
            (day(1), "kvm_x", "nodes", 20.0, 10.0, 4.0, 2.0, 1.0, -3.0, 5.0, 12.0),
            (day(1), "metal", "nodes", 0.0, 8.0, 2.0, 1.0, 2.0, 4.0, 7.0, 6.0),
            (day(2), "metal", "nodes", 9.0, 8.0, 0.0, 0.0, 0.0, 0.0, 0.0, 8.0),
        ],
        WIDE,
    )


def layers(df, site, d=1):
    rows = [r for r in df.orderBy("position").collect() if r.site == site and r.timestamp == day(d)]
    return [(r.layer, r.value, r.band_lower, r.band_upper, round(r.pct_upper, 4)) for r in rows]


def test_stack_with_ondemand(wide):
    assert layers(series.stacked_usage(wide), "kvm_x") == [
        ("occupied_ondemand", 2.0, 0.0, 2.0, 10.0),
        ("occupied_reservation", 4.0, 2.0, 6.0, 30.0),
        ("idle", 1.0, 6.0, 7.0, 35.0),
        ("available", 2.0, 7.0, 9.0, 45.0),
    ]


def test_bands_clip_negatives_but_percentages_do_not(wide):
    out = series.stacked_usage(wide, include_ondemand=False)
    assert layers(out, "kvm_x")[-1] == ("available", -3.0, 5.0, 5.0, 20.0)


def test_stack_merges_idle_and_takes_other_denominators(wide):
    out = series.stacked_usage(wide, False, True, "reservable_legacy")
    assert layers(out, "metal") == [
        ("occupied_reservation", 4.0, 0.0, 4.0, 66.6667),
        ("available", 4.0, 4.0, 8.0, 133.3333),
    ]


def test_zero_denominator_counts_as_one(wide):
    assert layers(series.stacked_usage(wide), "metal")[0][4] == 100.0


def test_site_comparison(wide):
    rows = {
        (r.site, r.timestamp.day): (r.used, r.available, r.capacity, r.pct)
        for r in series.site_comparison(wide).collect()
    }
    assert rows[("kvm_x", 1)] == (7.0, 2.0, 20.0, pytest.approx(700 / 9))
    assert rows[("metal", 1)] == (5.0, 4.0, 8.0, pytest.approx(500 / 9))
    assert rows[("metal", 2)] == (0.0, 0.0, 8.0, None)
    assert rows[("*", 1)] == (12.0, 6.0, 28.0, pytest.approx(1200 / 18))


def test_display_order(wide):
    out = series.with_site_position(wide, ["metal", "kvm_x", "other"], preferred=["kvm_x"])
    assert {r.site: r.position for r in out.collect()} == {"kvm_x": 0, "metal": 1}


def test_collector_gap(wide):
    rows = {(r.site, r.timestamp.day): r for r in series.collector_gap(wide).collect()}
    assert rows[("kvm_x", 1)].missing_history == 2.0
    assert rows[("metal", 1)].untracked_maintenance == 2.0
    assert rows[("metal", 2)].missing_history is None
    assert rows[("metal", 2)].untracked_maintenance is None
    with pytest.raises(ValueError):
        series.collector_gap(wide.drop("reservable_legacy"))


def test_nearest_sample_prefers_the_earlier_on_a_tie(frame):
    df = frame([(day(1), 1.0), (day(3), 3.0), (day(9), 9.0)], "timestamp ts, v double")
    marks = [("tie", day(2)), ("past", datetime(2023, 1, 1)), ("late", day(20))]
    out = series.nearest_samples(df, ["v"], marks).collect()
    assert {r.label: r.v for r in out} == {"tie": 1.0, "past": 1.0, "late": 9.0}


def test_ops_user_split(frame):
    df = frame(
        [
            (day(1), "reservable", "devices", False, 10.0),
            (day(1), "committed", "devices", True, 2.0),
            (day(1), "committed", "devices", False, 3.0),
            (day(1), "committed", "nodes", False, 99.0),
            (day(2), "reservable", "devices", False, 10.0),
        ],
        "timestamp ts, metric string, resource string, ops boolean, value double",
    )
    rows = series.ops_user_split(df).collect()
    assert [tuple(r) for r in rows] == [(day(1), 2.0, 3.0, 10.0, 5.0)]


def test_ops_flag_and_project_summary(frame):
    df = frame(
        [("committed", p) for p in ("p1", "p2", "p2", None)] + [("reservable", None)],
        "metric string, project_id string",
    )
    flags = {r.project_id: r.ops for r in series.with_ops_flag(df, ["p1"]).collect()}
    assert flags == {"p1": True, "p2": False, None: False}
    names = frame([("p2", "Two")], "id string, name string")
    rows = series.project_summary(df, names, ["p1"], top=2).collect()
    assert [(r.project_id, r.allocations, r.name, r.ops) for r in rows] == [
        ("p2", 2, "Two", False),
        (None, 1, None, None),
    ]
