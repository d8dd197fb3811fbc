"""From raw documents to training shards: stages that read what their predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterline.llm.common import stored, table
from meterline.llm.decontaminate import decontaminated
from meterline.llm.mixing import mixed
from meterline.llm.near_duplicates import deduplicated
from meterline.llm.quality import accepted
from meterline.llm.sharding import shard_report

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality ranking accepts."""
    return accepted(docs, table(spark, folder, "labels"))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group linked by five-word shingles with a similarity of 0.8 or more."""
    return deduplicated(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without any ten-word window of the benchmark."""
    return decontaminated(docs, table(spark, folder, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask."""
    return mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Where each document goes: doc_id, size, checksum, shard and slot."""
    return shard_report(docs).drop("grown_shard")


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

# The ranking is learned by iteration and the shards follow from propagated labels, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents of a folder; each reads what the one before has stored."""
    docs = table(spark, folder, "documents")
    for position, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, folder)
        if position + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
