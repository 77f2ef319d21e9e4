"""The registered queries of this subpackage: each operator over whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (
    decontaminate,
    language,
    licences,
    mixing,
    pii,
    prefix_trie,
    quality,
    simhash,
    simple8b,
    spelling,
    token_counts,
    toxicity,
    vectors,
)
from tillroll.llm.common import fold, table
from tillroll.sources.session import shared_folder


def op1_pii_boosting(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    trees = pii.fit(documents)
    return pii.personal_data(documents, trees).withColumnRenamed("id", "doc_id")


def op2_simple8b_ids(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    path = simple8b.write_ids(documents, public_tokenizers.path("byte_bpe_50k.json"))
    return simple8b.read_ids(spark, path).withColumnRenamed("id", "doc_id")


def op3_simhash_blocks(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_copies(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op4_sign_hashing(spark: SparkSession, folder: str) -> DataFrame:
    found = vectors.near_vectors(table(spark, folder, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )


def op5_licence_dice(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.licence_matches(table(spark, folder, "documents"))
    return found.withColumnRenamed("id", "doc_id")


def op6_suffix_arrays(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return found.select(
        "row.doc_id",
        "found.n_words",
        decontaminate.n_hit().alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "found.items"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op7_soft_mixing(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.rates(
        table(spark, folder, "documents"),
        mixing.label_domains(table(spark, folder, "labels")),
        mixing.TARGETS,
    )
    return found.withColumnRenamed("id", "doc_id")


def op8_toxic_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    learnt = labels.where(fold("doc_id", 5) != 0)
    index = toxicity.fit(documents, learnt)
    return toxicity.score(documents, index).select(
        F.col("id").alias("doc_id"),
        F.coalesce(fold("id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
    )


def op9_digest_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Starts from an empty store, so that every content is encoded once."""
    counts = token_counts.token_counts(
        table(spark, folder, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        shared_folder(spark, "token-counts"),
    )
    return counts.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > token_counts.CONTEXT_TOKENS).alias("over_limit"),
    )


def op10_byte_network(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    network = language.fit(documents.where(fold("doc_id", 4) != 2), "text", "lang")
    return language.identify(documents.select("doc_id", "text"), network).select(
        "row.doc_id",
        F.coalesce(fold("row.doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        "found.score",
    )


def op11_weak_supervision(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.quality(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "quality",
    )


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    lists = prefix_trie.turn_lists(table(spark, folder, "conversations"))
    found = prefix_trie.prefix_trie(prefix_trie.with_shared_openings(lists))
    return found.select(
        F.col("least").alias("conv_id"),
        "depth",
        F.col("parent_least").alias("parent_conv_id"),
        F.col("n_members").alias("n_convs"),
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )


def op13_trie_frontier(spark: SparkSession, folder: str) -> DataFrame:
    found = spelling.runs(table(spark, folder, "documents"), least_length=spelling.LEAST_LENGTH)
    words = spelling.vocabulary(spelling.with_slips(found))
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_pii_boosting,
        op2_simple8b_ids,
        op3_simhash_blocks,
        op4_sign_hashing,
        op5_licence_dice,
        op6_suffix_arrays,
        op7_soft_mixing,
        op8_toxic_neighbours,
        op9_digest_counts,
        op10_byte_network,
        op11_weak_supervision,
        op12_prefix_trie,
        op13_trie_frontier,
    )
}
