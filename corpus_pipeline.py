"""A corpus from raw documents to token ids, in five stages of the ``llm`` operators.

Every stage works on all that the one before has kept and has written as Parquet. Stages
before the last return the columns of their input, whatever these are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontaminate, language, mixing, simhash, simple8b
from tillroll.llm.common import stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that the network knows; undetermined texts go."""
    network = language.fit(docs, "text", "lang")
    return language.identify(docs, network).where(language.accepted()).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Of rows that share that id, the text with the smallest hash stays, and of equal texts one.
    Rows without an id cannot be compared and stay.
    """
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target shares of clean, low and toxic tokens ask for."""
    labelled = mixing.label_domains(table(spark, sf_dir, "labels"))
    return mixing.mixed(docs, labelled, mixing.TARGETS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the ids in the binary format and reports each document from the files."""
    path = simple8b.write_ids(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return simple8b.read_ids(spark, path).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32"
    )


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix", mix),
    ("token_ids", token_ids),
]

#: Networks, hashes of shingles and tokenizers are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
