"""The wide output table that older dashboards read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tideline import vocab
from tideline.contracts import COMPAT, as_usage, conform


def to_compat_format(usage: DataFrame) -> DataFrame:
    """Current node usage, one row per time and site, in exactly ten columns.

    A site without any total uses its reservable count, one without reserved
    occupancy its committed count, one without on-demand occupancy 0.
    """
    rows = as_usage(usage).where(
        (F.col("collector_type") == vocab.CURRENT) & (F.col("resource") == vocab.NODES)
    )

    def metric(name: str) -> Column:
        mine = F.col("metric") == name
        total = F.coalesce(F.sum(F.when(mine, F.col("value"))), F.lit(0.0))
        return F.when(F.count(F.when(mine, True)) > 0, total).alias(name)

    wide = rows.groupBy("timestamp", "site").agg(*[metric(m) for m in vocab.BASE_METRICS])
    fallback = {
        vocab.TOTAL: F.col(vocab.RESERVABLE),
        vocab.OCCUPIED_RESERVATION: F.col(vocab.COMMITTED),
        vocab.OCCUPIED_ONDEMAND: F.lit(0.0),
    }
    # sites are few: the aggregate is one row per site
    known = wide.groupBy(F.col("site").alias("_site")).agg(
        *[F.count(m).alias(f"_n_{m}") for m in fallback]
    )
    joined = wide.join(known, F.col("site").eqNullSafe(F.col("_site")))
    filled = {
        m: F.when(F.col(f"_n_{m}") == 0, other).otherwise(F.col(m))
        for m, other in fallback.items()
    }
    joined = joined.withColumns(filled)
    out = joined.select(
        F.col("timestamp").alias("time"),
        "site",
        F.lit(vocab.NODES).alias("resource"),
        vocab.TOTAL,
        vocab.RESERVABLE,
        vocab.COMMITTED,
        vocab.OCCUPIED_ONDEMAND,
        F.col(vocab.OCCUPIED_RESERVATION).alias("occupied_reserved"),
        F.col(vocab.OCCUPIED_ONDEMAND).alias("active_ondemand"),
        F.col(vocab.OCCUPIED_RESERVATION).alias("active_reserved"),
    )
    return conform(out, COMPAT, keep_extra=False)
