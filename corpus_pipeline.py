"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as Parquet to the shared folder and rereads it as the next stage's documents, so
every stage works on all that its predecessor kept and a lost executor repeats
one stage at most.  All stages but the last return the columns of documents.

Rows with a null id or a null text pass through the filters unless a stage finds
something in them; an empty table stays empty; rows that share an id stay or go
together; extra columns are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from acqlens.llm import decontam, linededup, sospack, superminhash, toxicity
from acqlens.llm.common import free_name, stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go."""
    return toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them; n_chars follows."""
    kept = linededup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    groups = superminhash.near_groups(docs)
    name = free_name(docs, "llm_gone")
    gone = stored(groups.where("doc <> component").select(F.col("doc").alias(name)).distinct(), "gone")
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontam.without_overlaps(docs, _table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become pieces with their place in a sequence."""
    return sospack.pack_documents(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_dedup_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

#: SQL can state neither the classifier nor the tokenizer; tests/llm holds the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
