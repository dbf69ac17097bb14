"""Corpus pipeline: quality filter, near-duplicate removal, benchmark
decontamination, source mixing, sharding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's
``docs``.  All but the last return the columns of ``documents``.  Each stage works
on all that its predecessor kept.  Null texts and ids, repeated rows, empty
tables and further columns are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm.common import stored, table, workers_find_package
from ledgerlens.llm.decontaminate import decontaminated
from ledgerlens.llm.mixing import mix_sources
from ledgerlens.llm.quality import keep_good
from ledgerlens.llm.queries import SHARD_BYTES
from ledgerlens.llm.sharding import assign_shards
from ledgerlens.llm.simhash import keep_one_each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, does not reject."""
    workers_find_package(spark)
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one of the smallest doc_id."""
    workers_find_package(spark)
    return keep_one_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as its source's target takes it."""
    return mix_sources(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard, shard_bytes and doc_bytes."""
    return assign_shards(docs, SHARD_BYTES)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]

#: The classifier and XXH64 fingerprints are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written to the shared
    folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
