"""Session settings, and the one place where lineage is cut: written copies and their life."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def builder(app: str = "tideline") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors see, from ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a fresh
    temporary folder that is kept in the session's settings.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = spark.conf.get("tideline.local.folder", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="tideline-")
        spark.conf.set("tideline.local.folder", folder)
    return folder


class Scratch:
    """The scratch tables of one run, in a folder of their own.

    Every table has an entry in the run's manifest, written once the table is whole
    and naming the plan and the input files it came from. A later run of the same
    name finds the entry and reads the table instead of computing it.
    """

    def __init__(self, spark: SparkSession, name: str | None = None):
        self.spark, self.name = spark, name
        self.folder = f"{shared_folder(spark)}/tideline-run-{name or uuid.uuid4().hex}"
        self.made = self.reused = 0

    def _path(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.folder, *parts)))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def key(self, df: DataFrame, partition_by: str | None) -> str:
        """Place in the run, plan and inputs; an input file that was written again has another time."""
        inputs = hashlib.sha256(repr((df.schema.jsonValue(), partition_by)).encode())
        for file in sorted(df.inputFiles()):
            fs_path = self.spark._jvm.org.apache.hadoop.fs.Path(file)
            status = fs_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).getFileStatus(fs_path)
            inputs.update(f"{file} {status.getLen()} {status.getModificationTime()}".encode())
        place = self.made + self.reused
        return f"{place:03d}-{df.semanticHash() & 0xFFFFFFFF:08x}-{inputs.hexdigest()[:16]}"

    def entry(self, key: str) -> dict | None:
        """What the manifest has on a table; None if it was never finished."""
        fs, path = self._path("manifest", f"{key}.json")
        if not fs.exists(path):
            return None
        return json.loads(self.spark.read.text(path.toString(), wholetext=True).first()[0])

    def record(self, key: str, entry: dict) -> None:
        fs, path = self._path("manifest", f"{key}.json")
        out = fs.create(path, True)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()

    def remove(self) -> None:
        fs, path = self._path()
        fs.delete(path, True)


_run: ContextVar[Scratch | None] = ContextVar("tideline_run", default=None)
_noted: ContextVar[tuple[list, ...]] = ContextVar("tideline_noted", default=())
#: Removes the shuffle files of a query when it ends, in place of when the driver next collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def scratch(spark: SparkSession, name: str | None = None) -> Iterator[Scratch]:
    """Tables that ``materialise`` writes meanwhile go when the block ends.

    With a ``name``, a block that fails leaves them, and the next one of that name
    goes on from those whose plan and inputs are the same. What is read after the
    block must be written elsewhere. Two blocks of one name must not run at once.
    """
    run = Scratch(spark, name)
    token = _run.set(run)
    try:
        yield run
    except BaseException:
        if name is None:
            run.remove()
        raise
    else:
        run.remove()
    finally:
        _run.reset(token)


@contextmanager
def copies() -> Iterator[list[DataFrame]]:
    """The copies that ``materialise`` writes meanwhile, for ``release`` once nothing reads them."""
    made: list[DataFrame] = []
    token = _noted.set((*_noted.get(), made))
    try:
        yield made
    finally:
        _noted.reset(token)


def release(spent: Iterable[DataFrame], but: DataFrame | None = None) -> None:
    """Delete copies that no plan reads any more, all except ``but``.

    Those of a run that has a name stay until it ends: after a failure the next one reads them.
    """
    for copy in spent:
        if copy is but or copy.tideline_path is None:
            continue
        path = copy.sparkSession._jvm.org.apache.hadoop.fs.Path(copy.tideline_path)
        path.getFileSystem(copy.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs meanwhile are removed when it ends, since its copy is whole."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialise(
    df: DataFrame, partition_by: str | None = None, observed: Observation | None = None
) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The copy is columnar, so later readers still prune columns, push filters and
    (with ``partition_by``) skip whole directories, and a lost executor costs
    one re-read instead of the whole lineage. What its plan shuffled goes once the copy
    is whole. In a ``scratch`` block the copy belongs
    to the run. ``observed`` is an observation of ``df``; its metrics stay on the result,
    under ``tideline_observed``, also where an earlier copy is read.
    """
    spark, run = df.sparkSession, _run.get()
    key = entry = None
    if run is None:
        path = f"{shared_folder(spark)}/tideline-{uuid.uuid4().hex}"
    elif run.name is None:
        path = f"{run.folder}/{run.made:03d}"
    else:
        key = run.key(df, partition_by)
        entry = run.entry(key)
        path = f"{run.folder}/{key}"
    if entry is None:
        # a table without an entry is what a failed attempt left
        writer = df.write.mode("overwrite" if key else "errorifexists")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        with _shuffles_go(spark):
            writer.option("compression", "zstd").parquet(path)
        entry = {"observed": observed.get if observed else {}}
        if key:
            run.record(key, entry)
        if run:
            run.made += 1
    else:
        run.reused += 1
    copy = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    copy.tideline_observed = entry["observed"]
    copy.tideline_path = None if key else path
    for made in _noted.get():
        made.append(copy)
    return copy
