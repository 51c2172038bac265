"""Trailing means over days."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from tideline.operators.scan import SESSION, Measure, running


def trailing_mean(
    df: DataFrame,
    series: Sequence[str],
    time: str,
    value: str,
    days: int,
    out: str,
    slice_us: int | None = SESSION,
) -> DataFrame:
    """Mean of the last ``days`` days, both ends included, per series.

    NULL or NaN values give NULL and enter no mean. Every value is added at its
    instant and taken out right after its last day, so the mean is a running sum
    over a running count whatever the width of the window. Expects one row per
    series and instant.
    """
    known = F.when(~F.isnan(value), F.col(value))
    rows = df.withColumns({"_known": known, "_at": F.col(time), "_leaves": F.lit(0)})
    leaving = rows.where(F.col("_known").isNotNull()).select(
        *series,
        (F.col("_at") + F.make_dt_interval(days=F.lit(days))).alias("_at"),
        F.lit(1).alias("_leaves"),
        (-F.col("_known")).alias("_change"),
        F.lit(-1).alias("_one"),
    )
    entering = rows.withColumns(
        {"_change": F.col("_known"), "_one": F.col("_known").isNotNull().cast("int")}
    )
    both = entering.unionByName(leaving, allowMissingColumns=True)
    summed = running(
        both,
        series,
        "_at",
        [Measure("_sum", "sum", "_change"), Measure("_n", "sum", "_one")],
        ties=["_leaves"],
        slice_us=slice_us,
    ).where(F.col("_leaves") == 0)
    mean = F.when(F.col("_known").isNotNull(), F.col("_sum") / F.col("_n"))
    return summed.select(*df.columns, mean.alias(out))
