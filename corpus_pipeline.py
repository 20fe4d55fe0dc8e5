"""A corpus cleaned, mixed and sharded: five operators in a row, each stage written as a table.

Every stage works on all that its predecessor kept; all but the last give the columns of
``documents``. Executors may be lost at any time: each stage starts from the table before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from slipmatch.llm import decontaminate, language, mixing, near_dedup, slots
from slipmatch.llm.queries import SHARDS, own_folder
from slipmatch.llm.tables import load
from slipmatch.sources.shared import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Stages take documents from a similarity of 0.8 on.
SIMILARITY = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; rejected ones go."""
    found = language.predicted(docs, language.learned(docs))
    return found.where(~F.col("rejected")).select("document.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; documents without words all stay."""
    return near_dedup.deduplicated(docs, SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, load(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as they are taken, the last of a source cut to its quota."""
    return mixing.drawn(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and place of each document of the mix."""
    placed = slots.shard(docs, SHARDS, own_folder(spark, "slot-map"))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "virtual_slot")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("shards", shards),
]

# Minhash, trained models and apportionment are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
