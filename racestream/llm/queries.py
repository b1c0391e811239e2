"""The registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racestream.llm import (
    chat,
    fill_in_middle,
    gated_lm,
    host_quality,
    language,
    minhash,
    mixing,
    packing,
    periodic_runs,
    personal_data,
    polytope,
    secret_scan,
    sharding,
)
from racestream.llm.tables import read


def op1_crf_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    return personal_data.find(read(spark, folder, "documents"))


def op2_host_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The counts and the verdict of every document."""
    return host_quality.report(read(spark, folder, "documents"))


def op3_tensored_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate documents: three-word shingles, similarity of 0.85 or more."""
    return minhash.near_duplicates(read(spark, folder, "documents"), words=3, percent=85)


def op4_raked_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Half of all tokens, drawn so that sources, languages and topics reach their tempered shares."""
    return mixing.sample(read(spark, folder, "documents"))


def op5_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one more whose texts hold the marks of a template, read back from their windows."""
    marked = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", marked), (-7, 1, "assistant", marked)], chat.SCHEMA)
    conversations = read(spark, folder, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    return chat.digests(chat.windows(conversations.unionByName(more)))


def op6_cross_polytope(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate vectors: cosine of 0.93 or more."""
    return polytope.near_duplicates(read(spark, folder, "embeddings"))


def op7_lookup_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """The shard of every document, among 256."""
    shards = [f"shard-{i:05d}" for i in range(256)]
    return sharding.place(read(spark, folder, "documents"), "doc_id", shards).select("doc_id", "slot", "shard")


def op8_ppm_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document."""
    return language.predict(read(spark, folder, "documents"))


def op9_gated_lm(spark: SparkSession, folder: str) -> DataFrame:
    """The log-likelihood of every document."""
    return gated_lm.score_documents(read(spark, folder, "documents"))


def op10_nnls_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return packing.pack(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_crf_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document."""
    return secret_scan.find(read(spark, folder, "documents"))


def op12_learned_rank_fim(spark: SparkSession, folder: str) -> DataFrame:
    """Every document arranged for filling in its middle, and restored."""
    return fill_in_middle.digests(fill_in_middle.transform(read(spark, folder, "documents")))


def op13_block_convolution_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The periodic runs of every document; a tenth of them is made to repeat a part of its words."""
    return periodic_runs.digests(periodic_runs.find(periodic_runs.repeated(read(spark, folder, "documents"))))


QUERIES = {
    "op1_crf_personal_data": op1_crf_personal_data,
    "op2_host_quality": op2_host_quality,
    "op3_tensored_minhash": op3_tensored_minhash,
    "op4_raked_mixture": op4_raked_mixture,
    "op5_chat_windows": op5_chat_windows,
    "op6_cross_polytope": op6_cross_polytope,
    "op7_lookup_sharding": op7_lookup_sharding,
    "op8_ppm_language": op8_ppm_language,
    "op9_gated_lm": op9_gated_lm,
    "op10_nnls_packing": op10_nnls_packing,
    "op11_crf_secrets": op11_crf_secrets,
    "op12_learned_rank_fim": op12_learned_rank_fim,
    "op13_block_convolution_runs": op13_block_convolution_runs,
}
