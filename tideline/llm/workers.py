"""Where Python workers find this package, and how much they are sent at once."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Texts that are sent to a worker at once: the default, 64 MB, is held several times over by either side,
#: which made 2801 MB of an executor out of 2368 for the corpus pipeline.
BATCH_BYTES = "4m"

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let workers import this package from where the driver has it, and bound Arrow batches by bytes.

    That is enough on one machine and where executors share the folder; elsewhere
    the package goes along with ``--py-files`` as usual, and this does no harm. A
    session that sets a size of batches itself keeps it.
    """
    if spark.conf.get(_BATCH_BYTES, "67108864b") == "67108864b":
        spark.conf.set(_BATCH_BYTES, BATCH_BYTES)
    held = spark.sparkContext.environment
    paths = [p for p in held.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        held["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])
