"""Step functions of an interval stream, finished behind a watermark.

State per group: the level after the last finished instant, and the changes ahead
of it, kept by time slot. A slot ends with a timer; when the watermark passes the
end, its instants are put in order, added to the level and emitted. Input may come
in any order as long as it is not later than the watermark allows, and the rows
emitted are those of the batch sweep up to there. An open interval waits as no
state at all, an end in the future as one pending change.

An interval's event time is its earlier bound. A row whose event time is not after
the watermark is late and left out whole (so its end never closes what did not
open); the query's progress counts such rows. A row without a start has no instant
and is left out too; an end before its start gives the same rows as in a batch.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tideline.contracts import as_interval
from tideline.functions.buckets import MICROS, micros

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_BATCH = 10_000


class Sweep(StatefulProcessor):
    """Levels per group from changes, slot by slot."""

    def __init__(self, groups: Sequence[str], slot_ms: int):
        self.groups, self.slot_ms = list(groups), slot_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.level = handle.getValueState("level", "value double")
        self.pending = handle.getMapState(
            "pending", "slot long", "times array<long>, changes array<double>"
        )

    def _add(self, slot: int, times: list[int], changes: list[float]) -> None:
        if self.pending.containsKey((slot,)):
            held = self.pending.getValue((slot,))
            merged = dict(zip(held[0], held[1]))
        else:
            merged = {}
            self.handle.registerTimer((slot + 1) * self.slot_ms)
        for t, c in zip(times, changes):
            merged[t] = merged.get(t, 0.0) + c
        self.pending.updateValue((slot,), (list(merged), list(merged.values())))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        parts = []
        for df in rows:
            df = df[df["first_us"] > now] if now > 0 else df
            closing = df[df["end_us"].notna()]
            for side, sign in ((df[["start_us", "value"]], 1.0), (closing[["end_us", "value"]], -1.0)):
                parts.append(pd.DataFrame({"t": side.iloc[:, 0].astype("int64"), "c": sign * side["value"]}))
        if parts:
            changes = pd.concat(parts).groupby("t", sort=True)["c"].sum()
            slots = changes.index // (self.slot_ms * 1000)
            for slot, own in changes.groupby(slots):
                self._add(int(slot), own.index.tolist(), own.tolist())
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        slot = expiredTimerInfo.getExpiryTimeInMs() // self.slot_ms - 1
        if not self.pending.containsKey((slot,)):
            return
        times, changes = self.pending.getValue((slot,))
        self.pending.removeKey((slot,))
        level = self.level.get()[0] if self.level.exists() else 0.0
        ordered = pd.Series(list(changes), index=list(times)).sort_index()
        levels = ordered.cumsum() + level
        self.level.update((float(levels.iloc[-1]),))
        for at in range(0, len(levels), _BATCH):
            some = levels.iloc[at : at + _BATCH]
            columns = {"us": some.index.astype("int64"), "value": some.to_numpy()}
            yield pd.DataFrame({**columns, **{g: [k] * len(some) for g, k in zip(self.groups, key)}})


def counts_of_stream(
    intervals: DataFrame, groups: Sequence[str], delay: str, slot_seconds: int = 60
) -> DataFrame:
    """``timestamp, *groups, value`` as a streaming frame (append mode), one row per changed instant.

    ``delay`` is how much later than the newest row an interval may arrive. Rows come when the
    watermark passes their slot; longer slots cost fewer timers and more delay.
    The session needs the RocksDB state store (``use_rocksdb``).
    """
    rows = as_interval(intervals).where(F.col("start").isNotNull())
    stamped = rows.select(
        *groups,
        # a watermark asks for an instant; the zone-less time counts as one of UTC
        F.timestamp_micros(micros(F.least("start", "end"))).alias("first"),
        micros(F.least("start", "end")).alias("first_us"),
        micros(F.col("start")).alias("start_us"),
        micros(F.col("end")).alias("end_us"),
        F.coalesce("value", F.lit(0.0)).alias("value"),
    ).withWatermark("first", delay)
    kinds = [T.StructField(g, rows.schema[g].dataType) for g in groups]
    schema = T.StructType([T.StructField("us", T.LongType()), T.StructField("value", T.DoubleType()), *kinds])
    swept = stamped.groupBy(*groups).transformWithStateInPandas(
        Sweep(groups, slot_seconds * 1000), schema, "append", "eventTime"
    )
    seconds = (F.col("us") / F.lit(MICROS).cast("decimal(7,0)")).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    at = epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return swept.select(at.alias("timestamp"), *groups, "value")


def use_rocksdb(spark: SparkSession) -> None:
    """State of this kind needs the RocksDB store; it also keeps state out of the heap."""
    spark.conf.set(_PROVIDER, _ROCKSDB)


def append_counts(
    intervals: DataFrame,
    groups: Sequence[str],
    output: str,
    checkpoint: str,
    delay: str,
    slot_seconds: int = 60,
    **trigger,
) -> StreamingQuery:
    """Append the finished counts of an interval stream to a parquet folder.

    ``trigger`` goes to ``DataStreamWriter.trigger`` (``availableNow=True`` by
    default). A row is written once, also after a restart from ``checkpoint``.
    """
    use_rocksdb(intervals.sparkSession)
    return (
        counts_of_stream(intervals, groups, delay, slot_seconds)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
