"""Registered queries of the subpackage: whole tables, production parameters, full results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm import (
    alignment, conversation_repair, covertree, curriculum, licences, minhash, oracle, packing, preference, pseudonyms, quality, secret_scan, sharding, warc,
)
from stridelake.llm.common import documents, stored
from stridelake.session import scratch

TOKENIZER = "word_bpe_49k.json"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "lang", "text")
    judged = quality.assess(docs, carry=("doc_id", "lang"))
    return judged


def op2_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = preference.sampled_pairs(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return preference.format_pairs(turns)


def op3_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = curriculum.placed_mix(documents(spark, sf_dir, "doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "positions", "places")


def op4_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(documents(spark, sf_dir, "doc_id", "text"))


def op5_cover_tree_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return warc.read_archives(spark, path, schema)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op8_licence_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return licences.scan(docs, licences.known_digests(spark)).select("doc_id", "digest", "licence")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(documents(spark, sf_dir, "doc_id", "text"), TOKENIZER, with_ids=False)
    return packed.select("doc_id", "piece", "start", "length", F.col("ids_crc32"), "sequence_id", "offset")


def op10_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir, "doc_id", "text"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir, "doc_id", "text"))
    counts = [F.size(secret_scan.of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in secret_scan.KINDS]
    base = F.sha2(secret_scan.written(secret_scan.of_kind(*secret_scan.BASE)), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), secret_scan.written(F.col("secrets")).alias("spans"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_repair.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return conversation_repair.repair(turns, F.col("present"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align(documents(spark, sf_dir, "doc_id", "text"), BYTE_LEVEL, PIECES)
    found = alignment.scored(stored(aligned, "aligned"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    fn.__name__: fn
    for fn in (op1_quality_rules, op2_preference_pairs, op3_curriculum_mix, op4_feistel_pseudonyms, op5_cover_tree_pairs,
               op6_warc_round_trip, op7_near_duplicates, op8_licence_digests, op9_best_fit_packing, op10_label_propagation_shards,
               op11_secret_scan, op12_conversation_repair, op13_token_alignment)
}


def statements() -> dict[str, str]:
    """SQL for the queries that it can express."""
    return oracle.statements()
