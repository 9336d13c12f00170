"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.llm import (
    html_text, importance, mixing, negatives, neighbours, packing, quality, repeats, scoring, simhash, tokens,
    toxicity, warc,
)
from parcelspark.llm.common import read, scratch_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document, linked at 3 or fewer differing bits."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), radius=3, shingle=3)
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document loses to repeated strings of 200 bytes, and a digest of what stays."""
    found = repeats.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"), length=200)
    return found.select(
        "doc_id",
        F.col("_n_bytes").alias("n_bytes"),
        F.col("_n_removed").alias("n_removed"),
        F.col("_n_spans").alias("n_spans"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


ORACLE["op10_suffix_array_dedup"] = repeats.ORACLE_SQL


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, whether it fails the base rules, and the verdict of the trees."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    trees = quality.train(docs, read(spark, sf_dir, "labels"))
    found = quality.judge(docs, trees)
    return found.select(
        "doc_id", *(F.col(f"_{c}").alias(c) for c in (*quality.COUNTS, "base_failed", "kept", "score"))
    )


@query
def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op7_quality_rules counts, and its base rules, which SQL can express."""
    return op7_quality_rules(spark, sf_dir).select("doc_id", *quality.COUNTS, "base_failed")


ORACLE["quality_counts"] = quality.COUNTS_SQL


@query
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes, with its source's size and target."""
    mixed = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_times")).alias("taken"),
    )


ORACLE["op9_mix_sources"] = mixing.ORACLE_SQL


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    return packing.pack(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return tokens.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labelled ones that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


@query
def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors found for each vector whose id is divisible by 50."""
    return neighbours.search(read(spark, sf_dir, "embeddings"), every=50, k=5)


@query
def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-likelihood of every document, by counts and by the recurrent model."""
    return scoring.score(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def lm_base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op5_lm_scores gives by counts, which SQL can express; scores to three places."""
    return op5_lm_scores(spark, sf_dir).drop("score").withColumn("base_score", F.round("base_score", 3))


ORACLE["lm_base_scores"] = scoring.BASE_SQL


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.train(pages))


@query
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of all pages as the archives have them."""
    return warc.archive(read(spark, sf_dir, "pages"), f"{scratch_folder(spark)}/warc-{uuid.uuid4().hex}")


ORACLE["op11_warc"] = warc.ORACLE_SQL


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the five best positives of each anchor."""
    return negatives.mine(read(spark, sf_dir, "embeddings"))


ORACLE["op12_hard_negatives"] = negatives.ORACLE_SQL


@query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn by how much their words are like those of the benchmark."""
    return importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLE["op13_importance_resampling"] = importance.ORACLE_SQL
