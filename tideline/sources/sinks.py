"""Files read and written around the plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


#: Order of rows within a site: what readers filter on, coarse to fine.
USAGE_ORDER = ("resource", "metric", "timestamp")


def write_usage(usage: DataFrame, path: str, row_group_bytes: int | None = None) -> None:
    """Parquet, one folder per site, laid out for readers of one metric or some weeks.

    Rows are dealt out by ranges and sorted, so that a file, and each row group and page
    in it, covers a short stretch of ``USAGE_ORDER``, and the minimum and maximum that
    Parquet keeps of each let readers skip the rest.
    """
    order = [c for c in USAGE_ORDER if c in usage.columns]
    laid_out = usage.repartitionByRange("site", *order).sortWithinPartitions("site", *order)
    writer = laid_out.write.mode("overwrite").partitionBy("site")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def write_report(usage: DataFrame, folder: str, name: str = "usage_timeline") -> DataFrame:
    """The same rows as parquet, JSON lines and CSV with a header; returns the parquet.

    The plan runs once: the other two are copies of the parquet files.
    """
    path = f"{folder}/{name}.parquet"
    usage.write.mode("overwrite").parquet(path)
    written = usage.sparkSession.read.schema(usage.schema).parquet(path)
    written.write.mode("overwrite").json(f"{folder}/{name}.json")
    written.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}.csv")
    return written


def read_projects(spark: SparkSession, path: str) -> DataFrame:
    """Project names from a JSON list of objects with ``ID`` and ``Name``."""
    raw = spark.read.schema("ID string, Name string").option("multiLine", True).json(path)
    return raw.select(F.col("ID").alias("id"), F.col("Name").alias("name"))
