"""Runs against a plain forward fill, and where their plan shuffles."""

import random

import pytest

from tests.conftest import day
from tideline.contracts import UsageSpec
from tideline.operators import runs
from tideline.plans.usage import run_usage

CHANGES = "at ts, site string, g string, a double, b double"


def filled(rows):
    """Every group at every instant of its site: the sums so far."""
    out = []
    for site, g in {(r[1], r[2]) for r in rows}:
        for at in sorted({r[0] for r in rows if r[1] == site}):
            own = [r for r in rows if r[1:3] == (site, g) and r[0] <= at]
            out.append((at, site, g, sum(r[3] or 0 for r in own), sum(r[4] or 0 for r in own)))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk, slice_rows", [(3, None), (1024, None), (5, 20)])
def test_expanded_runs_equal_a_forward_fill(frame, monkeypatch, chunk, slice_rows):
    monkeypatch.setattr(runs, "CHUNK", chunk)
    rng = random.Random(chunk)
    instants = [day(d, h) for d in range(1, 9) for h in (0, 7, 13)]
    rows = []
    for site in ("n", "s", None):
        for g in ("x", "y", None):
            for at in rng.sample(instants, rng.randint(1, 9)):
                rows.append((at, site, g, float(rng.randint(-3, 9)), rng.choice([None, 1.0])))
    changes = frame(rows, CHANGES)
    numbered = runs.number_instants(changes, "at", ["site"], slice_rows)
    made = runs.to_runs(changes, numbered, "at", ["site", "g"], ["a", "b"], ["site"], slice_rows)
    assert made.count() <= len(rows) + 9
    out = runs.expand(made, numbered, "at", ["site"]).select("at", "site", "g", "a", "b")
    assert sorted(map(tuple, out.collect()), key=str) == filled(rows)


def test_no_scope_means_one(frame):
    rows = [(day(1), "n", "x", 1.0, 0.0), (day(2), "s", "y", 2.0, 0.0), (day(3), "n", "x", 1.0, 1.0)]
    changes = frame(rows, CHANGES)
    numbered = runs.number_instants(changes, "at")
    out = runs.expand(runs.to_runs(changes, numbered, "at", ["g"], ["a"]), numbered, "at")
    assert sorted((r["at"].day, r.g, r.a) for r in out.collect()) == [
        (1, "x", 1.0), (1, "y", 0.0), (2, "x", 1.0), (2, "y", 2.0), (3, "x", 2.0), (3, "y", 2.0),
    ]
    assert runs.expand(made := runs.to_runs(changes.limit(0), numbered, "at", ["g"], ["a"]), numbered, "at").count() == 0
    assert made.columns == ["g", "_from", "_to", "a"]


def test_rows_are_written_out_behind_the_last_shuffle(frame):
    df = frame(
        [("a", day(1), day(3), "total", "vcpu", 1.0), ("b", day(2), None, "idle", "nodes", 1.0)],
        "entity_id string, start ts, end ts, metric string, resource string, value double",
    )
    out = run_usage(df, UsageSpec(("metric", "resource"), (day(1), day(9))), metrics=["total", "idle"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Generate explode(slice(")]
    assert "Exchange" not in above and "Window" not in above and "Sort " not in above
