"""Token counts behind a cache of digests.

A text is normalised in a way that cannot change its number of tokens, and digested. Counts
are stored under the digest of the content and that of the tokenizer. A run joins the digests
of all documents with the store, encodes each missing content once, appends the counts to
the store, and answers from it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import join_spread, map_batches, slices, stored
from tillroll.llm.words import WordCounts, version

_CACHE = "tokenizer string, digest binary, n_tokens long"
CONTEXT_TOKENS = 2048


def normalised(text: Column) -> Column:
    """Runs of spaces and line breaks as one space, none at the ends; null as empty.

    Tokens of this family hold no white space, so only the breaks between words matter.
    """
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[ \n]+", " "))


def cached(spark: SparkSession, path: str) -> DataFrame:
    """Stored counts; none if nothing was stored yet."""
    try:
        return spark.read.schema(_CACHE).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _CACHE)


def _count(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = WordCounts(path)
        for batch in slices(batches, 512):
            found = [counts.of(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], names=["digest", "n_tokens"]
            )

    return count


def token_counts(
    documents: DataFrame,
    tokenizer_path: str,
    cache_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, n_bytes, n_tokens) for every row, and the store at ``cache_path`` completed.

    Null and empty texts have no bytes and no tokens. Repeated rows stay; copies share one
    count. If a run is repeated after a failure, contents may be stored twice with equal
    counts; reading takes one of them.
    """
    spark = documents.sparkSession
    tokenizer = version(tokenizer_path)
    text = F.col(text_column)
    content = normalised(text)
    digest = F.unhex(F.sha2(content, 256))
    known = cached(spark, cache_path).where(F.col("tokenizer") == tokenizer)
    misses = (
        documents.select(digest.alias("digest"), content.alias("content"))
        .groupBy("digest").agg(F.first("content").alias("content"))
        .join(known.select("digest"), "digest", "left_anti")
    )
    fresh = map_batches(misses, _count(tokenizer_path), "digest binary, n_tokens long")
    fresh.select(F.lit(tokenizer).alias("tokenizer"), "digest", "n_tokens").write.mode(
        "append"
    ).parquet(cache_path)
    known = cached(spark, cache_path).where(F.col("tokenizer") == tokenizer)
    counts = known.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    asked = documents.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        digest.alias("digest"),
    )
    # a third of all rows may have one content
    found = join_spread(stored(asked, "asked"), counts, ["digest"], F.xxhash64("id"), "left")
    return found.select("id", "n_bytes", "n_tokens")
