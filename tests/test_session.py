"""Written copies: what stays, what goes, what is used again."""

import time

import pytest
from pyspark.sql import Observation, functions as F

from tests.conftest import day
from tideline.session import copies, materialise, release, scratch, shared_folder
from tideline.sources.sinks import write_usage


def folders(spark):
    import os

    return {n for n in os.listdir(shared_folder(spark).removeprefix("file://")) if n.startswith("tideline-")}


def test_scratch_goes_with_its_block(spark):
    before = folders(spark)
    with scratch(spark) as run:
        a = materialise(spark.range(10))
        b = materialise(a.where("id > 4"))
        assert b.count() == 5 and run.made == 2 and len(folders(spark) - before) == 1
    assert folders(spark) == before
    with pytest.raises(RuntimeError), scratch(spark):
        materialise(spark.range(3))
        raise RuntimeError
    assert folders(spark) == before
    # outside a block copies stay, as lazy results read them
    assert materialise(spark.range(3)).count() == 3 and len(folders(spark) - before) == 1


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in found.mkString("\n").split("\n") if "/shuffle_" in f}


def test_shuffles_of_a_copy_go_when_it_is_whole(spark):
    before = shuffle_files(spark)
    counted = spark.range(1000, numPartitions=4).groupBy((F.col("id") % 7).alias("k")).count()
    copy = materialise(counted)
    for _ in range(50):  # files are removed in the background
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert sorted(copy.collect()) == sorted(counted.collect()) and len(counted.collect()) == 7


def test_spent_copies_are_released(spark, tmp_path):
    before = folders(spark)
    with copies() as made:
        a = materialise(spark.range(10))
        with copies() as inner:
            b = materialise(a.where("id > 4"))
    assert made == [a, b] and inner == [b]
    release(made, but=b)
    assert b.count() == 5 and len(folders(spark) - before) == 1
    source = f"{tmp_path}/source"
    spark.range(10).write.parquet(source)
    with scratch(spark, "kept"), copies() as made:
        a = materialise(spark.read.parquet(source))
        release(made)
        assert a.count() == 10  # the next run of this name may need it


def steps(spark, source, fail):
    with scratch(spark, "rerun") as run:
        seen = Observation("seen")
        first = spark.read.parquet(source).withColumn("twice", F.col("id") * 2)
        first = materialise(first.observe(seen, F.count(F.lit(1)).alias("n")), observed=seen)
        second = materialise(first.where("twice > 6"), partition_by="twice")
        if fail:
            raise RuntimeError
        third = materialise(second.groupBy().count())
        return run.made, run.reused, first.tideline_observed["n"], third.first()["count"]


def test_failed_run_of_a_name_is_taken_up(spark, tmp_path):
    before, source = folders(spark), f"{tmp_path}/source"
    spark.range(10).write.parquet(source)
    with pytest.raises(RuntimeError):
        steps(spark, source, True)
    assert "tideline-run-rerun" in folders(spark)
    assert steps(spark, source, False) == (1, 2, 10, 6)
    assert folders(spark) == before
    # nothing is left to use; and what came from other input is not used
    assert steps(spark, source, False) == (3, 0, 10, 6)
    with pytest.raises(RuntimeError):
        steps(spark, source, True)
    spark.range(20).write.mode("overwrite").parquet(source)
    assert steps(spark, source, False) == (3, 0, 20, 16)


def test_usage_files_let_readers_skip(spark, tmp_path):
    import pyarrow.parquet as pq

    metrics, resources = [f"m{i}" for i in range(6)], ["disk", "nodes"]
    rows = spark.range(200_000).select(
        (F.lit(day(1)).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (F.col("id") % 8760).cast("int"))).alias("timestamp"),
        F.rand(3).alias("value"),
        F.element_at(F.array(*map(F.lit, metrics)), (F.col("id") % 6 + 1).cast("int")).alias("metric"),
        F.element_at(F.array(*map(F.lit, resources)), (F.col("id") % 2 + 1).cast("int")).alias("resource"),
        F.lit("north").alias("site"),
    )
    path = f"{tmp_path}/usage"
    write_usage(rows.repartition(5), path, row_group_bytes=64 * 1024)
    wanted = "metric = 'm2' and resource = 'disk' and timestamp >= '2024-03-01' and timestamp < '2024-04-01'"
    groups = hit = 0
    for file in (tmp_path / "usage" / "site=north").glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        place = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            stats = {n: meta.row_group(g).column(i).statistics for n, i in place.items()}
            groups += 1
            hit += (
                stats["metric"].min <= "m2" <= stats["metric"].max
                and stats["resource"].min <= "disk" <= stats["resource"].max
                and stats["timestamp"].min < day(1, month=4)
                and stats["timestamp"].max >= day(1, month=3)
            )
    assert groups >= 20 and hit <= groups // 6
    read = spark.read.parquet(path).where(wanted)
    assert read.count() == rows.where(wanted).count() > 0
    scan = read.select("value")
    scan.collect()
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(metric,m2)" in plan
