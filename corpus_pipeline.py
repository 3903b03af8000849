"""From raw documents to tokens: toxic documents, copies and near copies go, sources are mixed, the rest is encoded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, exact_dedup, jaccard_join, mixing, toxicity
from tidemark.llm.common import discard, materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those judged toxic."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with one of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with one of each component of alike texts: shingles of five words, similarity 0.8."""
    return jaccard_join.drop_near_copies(docs, words=5, num=80, den=100)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs as often as their source's rate and their draw say."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids, their number and checksums, of each document."""
    return bpe.encode_decode(docs, decoded=False)


STAGES: list[tuple[str, Stage]] = [("toxicity", toxic), ("exact_dedup", copies), ("ngram_jaccard", near_copies), ("mixing", mixed), ("byte_bpe", encoded)]

#: SQL can't express the toxicity model, the draws and the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage over what the one before it kept, written and read again in between."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        if name != STAGES[0][0]:
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
