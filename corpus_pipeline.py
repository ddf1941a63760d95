"""From raw documents to a balanced training corpus: language, near-duplicates, benchmark leaks, mix, shards."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import lang_pieces, mixing, order_minhash, packing, spaced_seeds
from millrace.llm.common import landed, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; the rest (no letters, or torn between languages) goes."""
    return lang_pieces.identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return order_minhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return spaced_seeds.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their place in the mix at tempered weights (mix_slot, mix_row)."""
    return mixing.ordered(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard."""
    return packing.sharded(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
    ("shards", shards),
]

# Training a model, Order MinHash and packing are not SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        docs = landed(out) if name != STAGES[-1][0] else out
    return docs
