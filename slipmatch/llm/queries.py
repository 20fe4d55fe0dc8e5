"""The operators as registered queries, with production parameters over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from slipmatch.llm import (
    decontaminate,
    html,
    language,
    mixing,
    near_dedup,
    neighbours,
    phrases,
    repeats,
    resampling,
    slots,
    token_files,
    tokens,
)
from slipmatch.llm.tables import load
from slipmatch.llm.url_filter import ALLOW, BLOCK, Rule, judge_urls
from slipmatch.session import shared_dir

# The rules of the URL filter.
RULES = (
    Rule("org", "", ALLOW),
    Rule("example.org", "es/", BLOCK),
    Rule("example.org", "en/1", BLOCK),
    Rule("com", "fr/", ALLOW),
    Rule("com", "de/", BLOCK),
)
# Hosts with one of these labels are on the block list.
LISTED_LABELS = ("casino-win", "ads-track")
LISTED = r"(^|\.)(" + "|".join(LISTED_LABELS) + r")(\.|$)"
SHARDS = 16
END_ID = 2


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(load(spark, sf_dir, "pages"), RULES, F.col("host").rlike(LISTED))


def own_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/slipmatch/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = slots.shard(load(spark, sf_dir, "documents"), SHARDS, own_folder(spark, "slot-map"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        "law",
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed(load(spark, sf_dir, "documents"))
    return mixed.select(F.col("document.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(load(spark, sf_dir, "documents"), 85)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(load(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    found = language.predicted(docs.select("doc_id", "text"), language.learned(docs))
    doc_id = F.col("document.doc_id")
    return found.select(
        doc_id.alias("doc_id"),
        language.held_out("document.doc_id").alias("held_out"),
        "lang_pred",
        "score",
        "rejected",
    )


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(load(spark, sf_dir, "pages"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = tokens.TokenCache(spark, own_folder(spark, "token-counts"))
    return tokens.token_counts(load(spark, sf_dir, "documents"), tokenizer_file(), cache)


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(load(spark, sf_dir, "documents"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = own_folder(spark, "token-files")
    found = token_files.stored(load(spark, sf_dir, "documents"), tokenizer_file(), END_ID, folder)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_sharding": op2_sharding,
        "op3_mixing": op3_mixing,
        "op4_near_dedup": op4_near_dedup,
        "op5_decontamination": op5_decontamination,
        "op6_repeats": op6_repeats,
        "op7_language_id": op7_language_id,
        "op8_html_extraction": op8_html_extraction,
        "op9_neighbours": op9_neighbours,
        "op10_token_counts": op10_token_counts,
        "op11_collocations": op11_collocations,
        "op12_resampling": op12_resampling,
        "op13_token_files": op13_token_files,
    }
