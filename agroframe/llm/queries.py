"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroframe.llm import ann, chat, dac, html, mixing, neardup, packing, postings, resample, rollup, runs, sketch, toxicity
from agroframe.llm.common import table
from agroframe.llm.tokens import byte_bpe, word_bpe
from agroframe.session import ensure_checkpoint_dir, materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.edited_pairs(table(spark, sf_dir, "documents"))


@_query
def op2_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_conversations(turns))


@_query
def op3_one_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, centres = ann.index(table(spark, sf_dir, "embeddings"))
    return ann.search(codes, centres, codes.where("id % 20 = 0"), k=20)


@_query
def op4_dac_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark)}/dac-{uuid.uuid4().hex}"
    dac.write_store(table(spark, sf_dir, "documents"), path, word_bpe())
    return dac.read_documents(dac.open_store(spark, path))


@_query
def op5_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load every document under two tokenizer versions, revise, delete copies, and replay batches."""
    docs = materialize(rollup.word_counts(table(spark, sf_dir, "documents")), "counts")
    first = docs.groupBy("digest").agg(F.min("doc_id").alias("first"))
    copies = docs.join(first, "digest").where("doc_id > first")
    batches = {
        "load": rollup.change(docs, "words-1", None, "words"),
        "second-version": rollup.change(docs, "words-2", None, "marks"),
        "drop-addresses": rollup.change(docs.where("plain <> words"), "words-1", "words", "plain"),
        "drop-copies": rollup.change(copies, "words-1", "plain", None)
        .unionByName(rollup.change(copies, "words-2", "marks", None)),
    }
    store = rollup.Rollup(spark, f"{ensure_checkpoint_dir(spark)}/rollup-{uuid.uuid4().hex}")
    for name in ["load", "second-version", "load", "drop-addresses", "drop-copies", "drop-addresses"]:
        store.apply(name, batches[name])  # the repeated ones change nothing
    return store.totals()


ORACLES["op5_token_rollup"] = rollup.ORACLE


@_query
def op6_raked_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).withColumn("probability", F.round("probability", 6))


ORACLES["op6_raked_mix"] = mixing.ORACLE


@_query
def op7_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(table(spark, sf_dir, "documents"), k=3, percent=85)


@_query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.fit(toxicity.sample(docs, labels)))


@_query
def op9_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), byte_bpe()))


@_query
def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@_query
def op11_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op11_positional_index"] = postings.ORACLE


@_query
def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_target_resampling"] = resample.ORACLE


@_query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.runs_of(table(spark, sf_dir, "documents"), runs.planted, texts=False)
