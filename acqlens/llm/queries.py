"""The operators bound to the given tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from acqlens.llm import (chat, collocations, convrepair, decontam, epsgrid, idmatrix, linededup, sospack, suffixes, superminhash, topk,
                         toxicity, warc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_dictionary_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.write_and_read(table(spark, sf_dir, "pages"))


def op3_spaced_seed_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_chat_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_report(chat.probe(table(spark, sf_dir, "conversations")))


def op5_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_report(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.suffix_report(table(spark, sf_dir, "documents"))


def op8_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sospack.pack_documents(table(spark, sf_dir, "documents"))


def op9_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_report(table(spark, sf_dir, "documents"))


def op10_id_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idmatrix.id_matrices(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convrepair.repair_report(table(spark, sf_dir, "conversations"))


def op12_setm_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_grid_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epsgrid.vector_report(table(spark, sf_dir, "embeddings"))


REGISTRY = {f.__name__: f for f in (
    op1_threshold_top_k, op2_dictionary_warc, op3_spaced_seed_overlaps, op4_chat_template,
    op5_toxicity_chain, op6_line_dedup, op7_suffix_dedup, op8_sum_of_squares_packing,
    op9_super_minhash, op10_id_matrices, op11_conversation_repair, op12_setm_collocations,
    op13_grid_order_join,
)}
