"""Contracts, stages, whole runs, wide outputs."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import day
from tideline import vocab
from tideline.contracts import (
    INTERVAL,
    ContractError,
    TIMELINE,
    UsageSpec,
    as_interval,
    as_timeline,
    conform,
    group_columns,
)
from tideline.operators.derive import (
    collapse_dimension,
    combine_cols,
    compute_derived_metrics,
    to_wide,
)
from tideline.plans import usage
from tideline.plans.compat import to_compat_format
from tideline.sources.adapters import in_window

YEAR = (datetime(2024, 1, 1), datetime(2024, 12, 31))
SPEC = UsageSpec(("metric", "resource"), YEAR)
LONG = "timestamp ts, metric string, resource string, value double"


def test_conform_reorders_and_keeps_extras(frame):
    df = frame([(1, 2, "x")], "extra bigint, b bigint, a string")
    assert conform(df, {"a": "string", "b": "bigint"}).columns == ["a", "b", "extra"]


def test_conform_checks_types_and_presence(frame):
    df = frame([(1, 2)], "a bigint, b bigint")
    with pytest.raises(ContractError, match="types"):
        conform(df, {"a": "string", "b": "bigint"})
    with pytest.raises(ContractError, match="missing"):
        conform(df, {"c": "bigint"})
    assert conform(df, {"a": "double"}, coerce=["a"], keep_extra=False).dtypes == [("a", "double")]


def test_interval_end_may_be_untyped_but_value_may_not(spark):
    row = spark.sql(
        "SELECT 'e' entity_id, timestamp_ntz'2024-01-01' start, NULL end, 'm' metric, "
        "'r' resource, 1.5D value"
    )
    assert dict(as_interval(row).dtypes)["end"] == "timestamp_ntz"
    with pytest.raises(ContractError):
        as_interval(row.withColumn("value", F.lit(1)))
    assert dict(as_timeline(
        row.select(F.col("start").alias("timestamp"), "metric", "resource", F.lit(1).alias("value"))
    ).dtypes)["value"] == "double"


def test_group_columns_are_sorted():
    assert group_columns(TIMELINE, ("timestamp", "value")) == ("metric", "resource")
    assert group_columns(INTERVAL, ("start", "end", "value")) == ("entity_id", "metric", "resource")


def test_spec_names_missing_columns(frame):
    with pytest.raises(ValueError, match="group_cols not in data.*site"):
        UsageSpec(("metric", "site"), YEAR).validate_against(frame([("x",)], "metric string"))


def test_window_prefilter_is_inclusive(frame):
    df = frame(
        [("a", day(1), day(2)), ("b", day(5), None), ("c", day(1), day(1)), ("d", day(6), None)],
        "id string, start ts, end ts",
    )
    assert {r.id for r in in_window(df, (day(2), day(5))).collect()} == {"a", "b"}


def test_clip_cuts_after_the_window_only(frame):
    times = [day(1), day(3, 6), day(6, 17), day(6, 18), day(6, 19), day(30)]
    spec = UsageSpec(("metric", "resource"), (day(3, 6), day(6, 18)))
    df = frame([(t, "committed", r, 2.5) for t in times for r in ("disk", None)], LONG)
    kept = usage.clip_to_window(df, spec).collect()
    assert sorted((r.timestamp, str(r.resource)) for r in kept) == [
        (t, r) for t in times[:4] for r in ("None", "disk")
    ]


def test_collapse_equals_a_plain_sum(frame):
    rows = [
        (day(d), metric, status, value)
        for d in (2, 7)
        for metric in ("idle", "total", None)
        for status, value in (("up", 4), ("down", 9), (None, 30), ("up", None), ("lost", 100))
    ]
    spec = UsageSpec(("status", "metric"), YEAR)
    df = frame(rows, "timestamp ts, metric string, status string, value bigint")
    for exclude in (None, ["down"], ["up", "lost", "down"]):
        sums = {}
        for d, metric, status, value in rows:
            if not exclude or (status is not None and status not in exclude):
                sums[d, metric] = sums.get((d, metric), 0) + (value or 0)
        out, rest = collapse_dimension(df, spec, "status", exclude)
        assert rest == UsageSpec(("metric",), YEAR)
        assert {(r.timestamp, r.metric): r.value for r in out.collect()} == sums
    with pytest.raises(ValueError, match="colour.*status, metric"):
        collapse_dimension(df, spec, "colour")


def test_collapse_of_only_null_values_is_zero(frame):
    df = frame([(day(1), "idle", "up", None)], "timestamp ts, metric string, status string, value bigint")
    out, _ = collapse_dimension(df, UsageSpec(("metric", "status"), YEAR), "status")
    assert [r.value for r in out.collect()] == [0]


LONG_SITE = "timestamp ts, metric string, resource string, site string, value double"


def test_wide_output_names_what_is_doubled(frame):
    rows = [(day(1), m, "disk", s, v) for m, s, v in (("idle", "n", 1.0), ("total", "n", None), ("idle", None, 3.0))]
    wide = to_wide(frame(rows, LONG_SITE), values=["idle", "total", "absent"])
    assert {r.site: (r.idle, r.total, r.absent) for r in wide.collect()} == {"n": (1.0, 0.0, 0.0), None: (3.0, 0.0, 0.0)}
    for again in (rows[0], rows[1], (*rows[2][:4], None)):
        with pytest.raises(Exception, match=f"more than one row for .*site={again[3] or 'NULL'}.*metric={again[1]}"):
            to_wide(frame([*rows, again], LONG_SITE)).collect()
    # unlisted keys keep their row, as zeros
    only = to_wide(frame(rows[:1], LONG_SITE), values=["total"]).collect()
    assert [(r.site, r.total) for r in only] == [("n", 0.0)]


def by_metric(df, *extra):
    return {(r.metric, *[r[e] for e in extra]): r.value for r in df.collect()}


def test_derived_metrics_are_differences(frame):
    sizes = {("total", "disk"): 90.5, ("reservable", "disk"): 20.0, ("committed", "disk"): 22.0,
             ("reservable", None): 7.0, ("occupied_reservation", None): 3.0}
    df = frame([(day(3), m, r, v) for (m, r), v in sizes.items()], LONG)
    got = by_metric(compute_derived_metrics(df, SPEC), "resource")
    for resource in ("disk", None):
        of = {m: sizes.get((m, resource), 0.0) for m in ("total", "reservable", "committed", "occupied_reservation")}
        assert got["ondemand_capacity", resource] == of["total"] - of["reservable"]
        assert got["available_reservable", resource] == of["reservable"] - of["committed"]
        assert got["idle", resource] == of["committed"] - of["occupied_reservation"]
    assert not any(m == "available_ondemand" for m, _ in got)


def test_derived_chain_and_zero_fill(frame):
    df = frame(
        [
            (day(1), "total", "a", 10.0),
            (day(1), "reservable", "a", 4.0),
            (day(1), "occupied_ondemand", "a", 1.0),
            (day(1), "reservable", "b", 2.0),
        ],
        LONG,
    )
    got = by_metric(compute_derived_metrics(df, SPEC), "resource")
    assert got[("ondemand_capacity", "a")] == 6.0
    assert got[("available_ondemand", "a")] == 5.0
    assert got[("total", "b")] == 0.0 and got[("ondemand_capacity", "b")] == -2.0


INTERVALS = "entity_id string, start ts, end ts, metric string, resource string, value double"


def test_run_gives_derived_metrics(frame):
    df = frame(
        [
            ("a", day(1), day(3), "reservable", "vcpu", 1.0),
            ("b", day(1), day(3), "committed", "vcpu", 1.0),
        ],
        INTERVALS,
    )
    spec = UsageSpec(("metric", "resource"), (day(1), day(5)))
    got = {(r.metric, r.timestamp.day): r.value for r in usage.run_usage(df, spec).collect()}
    assert got == {
        ("reservable", 1): 1.0,
        ("reservable", 3): 0.0,
        ("committed", 1): 1.0,
        ("committed", 3): 0.0,
        ("available_reservable", 1): 0.0,
        ("available_reservable", 3): 0.0,
    }


def staged(df, spec, interval):
    counts = usage.clip_to_window(usage.interval_counts(df, spec), spec)
    derived = compute_derived_metrics(usage.align_timestamps(counts, spec), spec)
    return usage.resample(derived, interval, spec) if interval else derived


@pytest.mark.parametrize("interval", [None, "1d", "7h"])
def test_run_equals_its_stages(frame, interval):
    rows = [
        ("a", day(1), day(9), "total", "vcpu", 3.0),
        ("b", day(2, 5), None, "total", "vcpu", 4.0),
        ("c", day(3), day(3), "reservable", "vcpu", 2.0),
        ("d", day(4, 7), day(6), "committed", "nodes", 1.0),
        ("e", day(25), None, "occupied_ondemand", "nodes", 1.0),  # after the window
        ("f", day(8), day(20), "reservable", None, 5.0),
        ("g", day(2), day(4), "committed", "vcpu", None),
    ]
    spec = UsageSpec(("metric", "resource"), (day(2), day(8)))
    df = frame(rows, INTERVALS)

    def content(out):
        return sorted(
            ((r.timestamp, r.metric, r.resource, r.value) for r in out.collect()), key=str
        )

    assert content(usage.run_usage(df, spec, interval)) == content(staged(df, spec, interval))


def test_given_metrics_need_no_extra_pass(frame):
    df = frame([("a", day(1), day(3), "total", "vcpu", 1.0)], INTERVALS)
    spec = UsageSpec(("metric", "resource"), (day(1), day(5)))
    out = usage.run_usage(df, spec, "1d", metrics=["total"])
    assert [r.value for r in out.orderBy("timestamp").collect()] == [1.0, 1.0, 0.0, 0.0]


def test_site_context_and_weighted_stage(frame):
    df = frame([(day(1), "total", "vcpu", 2.0)], LONG)
    out = usage.add_site_context(df, "north")
    assert (out.first().site, out.first().collector_type) == ("north", "current")
    spec = UsageSpec(("metric", "resource"), (day(1), day(3)))
    assert [r.value for r in usage.resample_weighted(df, "1d", spec).collect()] == [2.0, 2.0]


WIDE = "timestamp ts, site string, resource string, metric string, collector_type string, value double"


def test_combined_key_is_null_with_a_null_part(frame):
    df = frame([(day(1), "s", "r", "m", None, 1.0), (day(1), "s", "r", "m", "c", 1.0)], WIDE)
    out, name = combine_cols(df, ["metric", "collector_type"])
    assert name == "metric_collector_type"
    assert {r[name] for r in out.collect()} == {None, "m_c"}


def test_to_wide_fills_with_zero(frame):
    df = frame(
        [
            (day(1), "s", "nodes", "total", "current", 3.0),
            (day(1), "s", "nodes", "total", "legacy", 4.0),
            (day(2), "s", "nodes", "total", "legacy", 5.0),
        ],
        WIDE,
    )
    out = to_wide(df, ["metric", "collector_type"]).orderBy("timestamp").collect()
    assert [(r.total_current, r.total_legacy) for r in out] == [(3.0, 4.0), (0.0, 5.0)]


def test_compat_falls_back_per_site(frame):
    def rows(site, **values):
        return [(day(1), site, "nodes", m, "current", v) for m, v in values.items()]

    df = frame(
        rows("a", total=9.0, reservable=5.0, committed=3.0, occupied_reservation=2.0, occupied_ondemand=1.0)
        + rows("b", reservable=5.0, committed=3.0)
        + [(day(1), "a", "vcpus", "total", "current", 99.0)]
        + [(day(1), "a", "nodes", "total", "legacy", 99.0)],
        WIDE,
    )
    out = to_compat_format(df)
    got = {r.site: tuple(r)[3:] for r in out.collect()}
    assert out.columns == [
        "time",
        "site",
        "resource",
        "total",
        "reservable",
        "committed",
        "occupied_ondemand",
        "occupied_reserved",
        "active_ondemand",
        "active_reserved",
    ]
    assert got == {
        "a": (9.0, 5.0, 3.0, 1.0, 2.0, 1.0, 2.0),
        "b": (5.0, 5.0, 3.0, 0.0, 3.0, 0.0, 3.0),
    }


def test_vocabulary_has_nine_metrics():
    assert len({*vocab.BASE_METRICS, *[d[0] for d in vocab.DERIVATIONS]}) == 9
