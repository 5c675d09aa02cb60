"""Registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.llm import (exact, infill, language, lines, mixing, near, packing, passages, pieces,
                        preferences, quality, runs, sharding)
from crease.llm.common import documents
from crease.session import table_path

N_SHARDS = 40


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.remove_boilerplate(documents(spark, sf_dir)).select(
        "doc_id", "text", "n_lines", "n_removed")


def op2_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir)).select(
        "doc_id", *quality.FEATURES, "base_failed", "kept")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact.exact_dedup(documents(spark, sf_dir), digest_all=True)
    return rows.withColumn("text_sha256", F.lower(F.hex("text_sha256")))


def op4_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(documents(spark, sf_dir)).drop("_hash")


def op5_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(table_path(sf_dir, "conversations"))
    convs = preferences.stored_conversations(turns)
    pairs = preferences.pairs_by_first_turn(convs).unionByName(
        preferences.pairs_by_stale_reply(convs))
    return preferences.format_pairs(pairs)


def op6_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_by_bytes(documents(spark, sf_dir), N_SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                       "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op8_flow_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix_sizes(documents(spark, sf_dir))
    return rows.select("doc_id", "size", "own.source_size", "own.target",
                       (F.col("size") * F.col("copies")).alias("taken"))


def op9_passage_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a null doc_id has no fold: it is neither learned from nor part of the learned share
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1,
                          F.lit(True))
    return language.identify(documents(spark, sf_dir), ~held_out, carry={"held_out": held_out})


def op11_piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pieces.encode(documents(spark, sf_dir), decoded=True)
    return rows.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(runs.with_planted_runs(documents(spark, sf_dir)))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", runs.strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = infill.fill_in_middle(documents(spark, sf_dir))
    back = infill.restored(F.col("output"), F.col("form"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_host_quality": op2_host_quality,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_minhash_forest": op4_minhash_forest,
    "op5_preference_format": op5_preference_format,
    "op6_histogram_shards": op6_histogram_shards,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_flow_mixing": op8_flow_mixing,
    "op9_passage_chaining": op9_passage_chaining,
    "op10_language_id": op10_language_id,
    "op11_piece_tokens": op11_piece_tokens,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_fill_in_middle": op13_fill_in_middle,
}
