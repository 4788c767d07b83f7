"""A training corpus in four stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which ``run`` writes as Parquet and reads back as the next stage's documents.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from agroframe.llm import mixing, neardup, packing, toxicity
from agroframe.llm.common import table
from agroframe.llm.tokens import byte_bpe
from agroframe.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted toxicity is below the threshold."""
    model = toxicity.fit(toxicity.sample(docs, table(spark, sf_dir, "labels")))
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of every near-duplicate group (5 words, 0.8)."""
    return neardup.keep_one(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that the expected token mix meets the tempered targets."""
    return mixing.sample(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document cut into power-of-two sequences; a small cache, as executors hold much from earlier stages."""
    return packing.digest(packing.pack(docs, byte_bpe(cached_units=200_000)))


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_copies), ("mixing", mix_sources), ("packing", pack_sequences)]

# learned scores and tokenizer ids are beyond SQL; tests/llm/test_pipeline.py checks every stage by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
