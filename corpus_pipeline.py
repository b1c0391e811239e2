"""From raw documents to packed sequences: the stages of the corpus pipeline, each one an operator of ``racestream.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents that its predecessor kept. All but the last return the
columns of the documents. Extra columns pass through all stages but the last, whatever their names; repeated rows are rows of their own, except that
near-duplicates keep one of each group; an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from racestream.llm import host_quality, minhash, mixing, packing, personal_data
from racestream.llm.tables import read, small_batches
from racestream.session import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule, from hosts that are not condemned; null and empty texts go, a null source has no host verdict."""
    small_batches(spark)
    return host_quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles have a similarity of 0.8 or more."""
    small_batches(spark)
    return minhash.keep_one(docs, words=5, percent=80)


def personal_data_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    small_batches(spark)
    return personal_data.mask(docs)


def target_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics approach their tempered shares."""
    small_batches(spark)
    return mixing.thin(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data_masked),
    ("target_mixture", target_mixture),
    ("packing", packed),
]

#: None: the trained tagger, the tokenizer and the packing have no SQL form. Tests compare the rows of every stage, and the pieces of
#: the whole run, with plain Python on a small table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages in order to the documents; each reads what its predecessor wrote."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
