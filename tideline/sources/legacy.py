"""Daily hours cache of an earlier collector, as a timeline of node counts."""

from __future__ import annotations

from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline import vocab
from tideline.contracts import as_timeline, conform

HOURS_PER_DAY = 24
HOURS = ("maint_hours", "reserved_hours", "used_hours", "idle_hours", "total_hours")
DAILY_CACHE = {
    "date": "timestamp_ntz",
    "node_type": "string",
    **{h: "double" for h in HOURS},
}


def read_daily_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache file, or an empty frame of its schema when there is none."""
    try:
        raw = spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        ddl = ", ".join(f"{c} {t}" for c, t in DAILY_CACHE.items())
        return spark.createDataFrame([], ddl)
    return conform(raw, DAILY_CACHE, coerce=("date", *HOURS), keep_extra=False)


def legacy_usage_counts(cache: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Hours summed over node types per day, as average counts per metric.

    Reserved hours were hours reserved but unused, so they are the idle part and
    committed is reserved plus used. One aggregation: the rows are unique per day
    and metric afterwards, for each value of ``scope`` (a site).
    """
    daily = cache.groupBy("date", *scope).agg(
        *[F.coalesce(F.sum(h), F.lit(0.0)).alias(h) for h in HOURS]
    )
    total, maint = F.col("total_hours"), F.col("maint_hours")
    reserved, used = F.col("reserved_hours"), F.col("used_hours")
    hours = {
        vocab.TOTAL: total,
        vocab.RESERVABLE: total - maint,
        vocab.COMMITTED: reserved + used,
        vocab.OCCUPIED_RESERVATION: used,
        vocab.AVAILABLE_RESERVABLE: (total - maint) - (reserved + used),
        vocab.IDLE: reserved,
    }
    wide = daily.select(
        F.col("date").alias("timestamp"),
        *scope,
        *[(h / HOURS_PER_DAY).alias(m) for m, h in hours.items()],
    )
    long = wide.unpivot(["timestamp", *scope], list(hours), "metric", "value")
    return as_timeline(long.withColumn("resource", F.lit(vocab.NODES)))
