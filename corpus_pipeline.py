"""A training corpus from raw documents: judge, thin out, clean, mix, pack."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.llm import mixing, packing, quality, repeats, simhash
from parcelspark.llm.common import has_words, read, remove, scratch_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the trees' verdict."""
    trees = quality.train(docs, read(spark, sf_dir, "labels"))
    return quality.judge(docs, trees).where("_kept").select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs, radius=3, shingle=3)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 200 bytes that start elsewhere too; documents that lose all their words go.

    A cut through the bytes of one character leaves it out of the text.
    """
    found = repeats.remove_repeats(docs, length=200, as_text=True)
    text = F.when(F.col("_n_removed") == 0, F.col("text")).otherwise(F.col("_kept"))
    kept = found.withColumn("text", text).where((F.col("_n_removed") == 0) | has_words(F.col("text")))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, each as often as it takes it."""
    return mixing.repeat(mixing.mix(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder, read again as the next input, and
    removed when that is written. The last one stays."""
    docs = read(spark, sf_dir, "documents")
    folder, before = f"{scratch_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs


#: The trees and the packing have no SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None
