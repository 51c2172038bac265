"""Every registered query against its SQL statement in DuckDB, and plan facts."""

import re

import duckdb
import pytest

import __spark_entry__ as entry_module
from workload import reports, service, timeline

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
QUERIES, STATEMENTS = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def test_every_query_has_a_statement():
    usage = {name for part in (timeline, service, reports) for name in part.QUERIES}
    assert usage <= set(STATEMENTS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_matches_statement(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    mine = sorted(tuple(str(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(STATEMENTS[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = sorted(tuple(str(r[i]) for i in order) for r in cursor.fetchall())
    assert mine == theirs
    # no plan pairs rows without a key
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan(df))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_runs(spark):
    assert entry_module.entry(spark).count() > 0


def test_sampled_usage_shuffles_only_reduced_rows(spark):
    text = plan(QUERIES["usage_daily"](spark, DATA))
    assert len(re.findall(r"\bExchange\b", text)) == 2
    assert text.count("FileScan") == 1
    assert "partial_sum" in text


def test_window_filter_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["overlap_filter"](spark, DATA))
    assert re.search(r"PushedFilters: \[.*LessThanOrEqual\(ts", text)
    assert "props" not in re.search(r"ReadSchema: \S+", text).group(0)


def test_registry_groups_lineitem_once(spark):
    assert "lineitem.parquet" not in plan(QUERIES["registry_intervals"](spark, DATA))
