"""The one stage that runs unchanged on a stream.

Intervals become deltas row by row, so a stream of intervals can be turned into
a growing delta table. Everything later orders events by time over the whole
history; it stays a batch plan over that table.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tideline.contracts import as_interval
from tideline.operators.sweep import intervals_to_deltas


def append_deltas(
    intervals: DataFrame,
    groups: Sequence[str],
    output: str,
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Append the deltas of an interval stream to a parquet folder.

    ``trigger`` goes to ``DataStreamWriter.trigger`` (``availableNow=True`` by
    default). The file sink and ``checkpoint`` make each interval count once.
    """
    deltas = intervals_to_deltas(as_interval(intervals), "start", "end", groups, "value")
    return (
        deltas.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
