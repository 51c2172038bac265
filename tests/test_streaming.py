"""Deltas of a stream equal those of the same rows in a batch."""

import random
from datetime import timedelta

from tests.conftest import day
from tideline.operators.sweep import deltas_to_counts, intervals_to_counts
from tideline.streaming.deltas import append_deltas
from tideline.streaming.sweep import append_counts

SCHEMA = "entity_id string, start ts, end ts, metric string, resource string, value double"


def test_streamed_deltas_build_the_same_counts(spark, frame, tmp_path):
    first = frame([("a", day(1), day(3), "total", "nodes", 2.0)], SCHEMA)
    second = frame([("b", day(2), None, "total", "nodes", 5.0)], SCHEMA)
    source, out, mark = (f"{tmp_path}/{n}" for n in ("in", "out", "mark"))
    for part in (first, second):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(part.schema).parquet(source)
        append_deltas(stream, ["metric"], out, mark).awaitTermination()
    streamed = deltas_to_counts(spark.read.parquet(out), ["metric"])
    batch = intervals_to_counts(first.union(second), "start", "end", ["metric"], "value")
    assert sorted(streamed.collect()) == sorted(batch.collect())
    assert [r.value for r in batch.orderBy("timestamp").collect()] == [2.0, 7.0, 5.0]


# --- stateful sweep ---------------------------------------------------------------------


def streamed(spark, batches, schema, folder, groups, **options):
    """Finished counts of batches that arrive one after another."""
    for i, rows in enumerate(batches):
        rows.coalesce(1).write.parquet(f"{folder}/in/{i:03d}")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")
    query = append_counts(source, groups, f"{folder}/out", f"{folder}/mark", **options)
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out"), query


def numbers(df):
    return sorted((r.timestamp, r.metric, round(r.value, 6)) for r in df.collect())


def test_any_order_within_the_watermark_equals_the_batch(spark, frame, tmp_path):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        start = day(1) + timedelta(seconds=rng.randrange(5 * 86_400), microseconds=rng.randrange(3))
        end = rng.choice([None, start, start + timedelta(seconds=rng.randrange(90_000)), start - timedelta(seconds=5)])
        rows.append((str(i), start, end, rng.choice(["total", "idle", None]), "nodes", rng.choice([1.0, 2.5, None])))
    rows += rows[:20]  # repeated rows count again
    arrival = sorted(rows, key=lambda r: r[1] + timedelta(seconds=rng.randrange(10_000)))
    last = [("end", day(20), None, "close", "nodes", 1.0)]
    chunks = [arrival[i : i + 60] for i in range(0, len(arrival), 60)] + [last, last]
    batches = [frame(c, SCHEMA) for c in chunks]
    out, query = streamed(spark, batches, batches[0].schema, str(tmp_path), ["metric"], delay="3 hours", slot_seconds=600)
    batch = intervals_to_counts(frame(rows, SCHEMA), "start", "end", ["metric"], "value")
    assert numbers(out) == numbers(batch)
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress if p["stateOperators"]) == 0


def test_late_rows_are_left_out_whole(spark, frame, tmp_path):
    first = frame([("a", day(10), None, "total", "nodes", 1.0)], SCHEMA)
    second = frame([("b", day(11), None, "total", "nodes", 2.0)], SCHEMA)
    late = frame([("c", day(3), day(12), "total", "nodes", 100.0), ("d", day(11, 5), day(12), "total", "nodes", 4.0)], SCHEMA)
    last = frame([("e", day(20), None, "close", "nodes", 1.0)], SCHEMA)
    out, _ = streamed(spark, [first, second, late, last, last], first.schema, str(tmp_path), ["metric"], delay="1 day")
    assert numbers(out) == [
        (day(10), "total", 1.0),
        (day(11), "total", 3.0),
        (day(11, 5), "total", 7.0),
        (day(12), "total", 3.0),
    ]


def test_restart_goes_on_from_the_state(spark, frame, tmp_path):
    first = frame([("a", day(1), day(9), "total", "nodes", 1.0)], SCHEMA)
    out, _ = streamed(spark, [first], first.schema, str(tmp_path), ["metric"], delay="1 hour")
    assert out.count() == 0  # nothing is final yet
    for i, rows in enumerate(([("b", day(2), None, "total", "nodes", 5.0)], [("c", day(12), None, "x", "nodes", 1.0)])):
        frame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/9{i}")
    source = spark.readStream.schema(first.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    append_counts(source, ["metric"], f"{tmp_path}/out", f"{tmp_path}/mark", delay="1 hour").awaitTermination()
    assert numbers(spark.read.parquet(f"{tmp_path}/out")) == [
        (day(1), "total", 1.0),
        (day(2), "total", 6.0),
        (day(9), "total", 5.0),
    ]
