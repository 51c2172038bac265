"""A corpus pipeline: quality, near duplicates, decontamination, secrets, mixing.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes each
result as Parquet to the shared folder and reads it back as the next one's input.
All stages but the last return the columns of ``documents``.

What happens to a document: one that the quality classifier scores below its
threshold goes (so does an empty one); of each class of near duplicates the one
with the least id stays; one that holds a benchmark item goes; secrets are
replaced by a mark, and ``n_chars`` follows; the last stage returns a row for each
document that the mix takes, with the words taken.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import decontaminate, mixing, near_duplicates, quality_classifier, secrets
from tideline.llm.workers import importable
from tideline.session import materialise


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality, by a classifier fitted on the labels of the corpus."""
    importable(spark)
    model = quality_classifier.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.keep_good(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    importable(spark)
    return near_duplicates.drop_near_duplicates(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    importable(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced."""
    importable(spark)
    return secrets.redact(docs, secrets.fit(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, and how many of their words."""
    return mixing.mix(docs).where(F.col("taken") > 0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("near duplicates", one_of_each),
    ("benchmark decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("mixing", mixed),
]

#: The stages train models, sketch and scan; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
