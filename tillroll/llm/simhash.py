"""Near copies by SimHash: fingerprints, links over shared blocks of bits, components.

Pigeonhole blocks: a fingerprint is split into ``blocks`` runs of bits. Two fingerprints
that differ in at most ``distance`` bits agree in at least ``blocks - distance`` whole
runs, so they share one of the keys made of that many runs. Keys are joined, members of a
key are verified by their Hamming distance, and a spanning forest of the verified links
goes to the component search. No pair list of a group is ever written.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import join_spread, map_batches, slices, stored, text_bytes
from tillroll.llm.components import cells, connected, forest

SEED = 42
SHINGLE_WORDS = 3
BLOCKS = 6
DISTANCE = 3
_HASHES_AT_ONCE = 1 << 16


def fingerprints(texts: list[bytes | None], shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """One unsigned 64-bit fingerprint for each UTF-8 text.

    A-Z are lower-cased, words are split at ASCII white space, and a bit is set if over half
    of the shingles' XXH64 have it; a text with fewer words is one shingle, and null or a
    text without words gives zero. Long texts are counted in bounded pieces.
    """
    ones = np.zeros((len(texts), 64), np.int64)
    totals = np.zeros(len(texts), np.int64)
    held: list[int] = []
    owners: list[int] = []
    starts: list[int] = []

    def count() -> None:
        if held:
            bits = np.unpackbits(
                np.array(held, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
            )
            # pieces of one text may be counted together
            np.add.at(ones, owners, np.add.reduceat(bits, starts, axis=0, dtype=np.int64))
            held.clear(), owners.clear(), starts.clear()

    digest = xxhash.xxh64_intdigest
    for row, text in enumerate(texts):
        words = text.lower().split() if text else []
        if not words:
            continue
        shingles = max(1, len(words) - shingle_words + 1)
        totals[row] = shingles
        for first in range(0, shingles, _HASHES_AT_ONCE):
            part = words[first : first + _HASHES_AT_ONCE + shingle_words - 1]
            if len(held) + len(part) > 2 * _HASHES_AT_ONCE:
                count()
            owners.append(row)
            starts.append(len(held))
            if len(words) < shingle_words:
                held.append(digest(b" ".join(words), SEED))
            else:
                runs = zip(*(part[k:] for k in range(shingle_words)))
                held.extend([digest(b" ".join(run), SEED) for run in runs])
    count()
    return np.packbits(2 * ones > totals[:, None], axis=1, bitorder="little").view("<u8").ravel()


def with_fingerprints(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, fp): the fingerprint's 64 bits as a signed bigint, one row per input row."""

    def fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512):
            found = fingerprints(text_bytes(batch.column(1))).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found)], names=["id", "fp"]
            )

    source = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column))
    return map_batches(source, fingerprint, "id long, fp long")


def block_masks(blocks: int = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """Masks of every ``blocks - distance`` runs of bits, as signed 64-bit integers."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    runs = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(runs, blocks - distance)]
    return [mask - (1 << 64) if mask >> 63 else mask for mask in masks]


def _verify(distance: int):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            lists = batch.column(2)
            a, b = [], []
            for row in range(batch.num_rows):
                items = lists[row].values
                part = items.field("part").to_numpy()
                item = items.field("_item")
                fp = item.field("fp").to_numpy().view(np.uint64)
                rep = item.field("rep").to_numpy()
                near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= distance
                if low[row] != high[row]:
                    near &= part[:, None] != part[None, :]
                np.fill_diagonal(near, False)
                for i, j in forest(near) if near.any() else ():
                    a.append(rep[i])
                    b.append(rep[j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
            )

    return linked


def near_copies(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    blocks: int = BLOCKS,
    distance: int = DISTANCE,
) -> DataFrame:
    """(id, fp, component): the smallest id reachable over links of at most ``distance`` bits.

    Null and empty texts have fingerprint zero and link like any other. Rows without an id
    get a fingerprint, take no part in links and have a null component. Repeated ids and
    rows stay separate rows. An empty table gives an empty result.
    """
    prints = stored(with_fingerprints(documents, id_column, text_column), "fingerprints")
    classes = prints.where("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("rep"))
    masks = block_masks(blocks, distance)
    keyed = classes.select(
        "fp",
        "rep",
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(k).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                    for k, m in enumerate(masks)
                )
            )
        ).alias("at"),
    ).select("fp", "rep", "at.table", "at.key")
    groups = cells(keyed, ["table", "key"], F.struct("fp", "rep"), F.xxhash64("fp"))
    links = map_batches(groups, _verify(distance), "a long, b long")
    # one id may stand for several fingerprints: its texts differ, and it joins their classes
    shared = prints.where("id IS NOT NULL").join(
        prints.groupBy("id").agg(F.min("fp").alias("one"), F.max("fp").alias("other"))
        .where("one <> other").select("id"),
        "id",
    )
    shared = shared.join(classes, "fp").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    roots = connected(links.union(shared))
    named = classes.join(roots, F.col("rep") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "rep").alias("component")
    )
    # a third of all rows may have one fingerprint
    found = join_spread(prints, named, ["fp"], F.xxhash64("id"), "left")
    return found.select(
        "id", "fp", F.when(F.col("id").isNotNull(), F.col("component")).alias("component")
    )


def one_of_each(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """The documents, with all their columns, that represent their groups of near copies.

    Of each component the row with the smallest id stays; of rows that share that id, the
    one whose text has the smallest hash, and of equal ones any single one. Rows without an id stay.
    """
    found = near_copies(documents, id_column, text_column, **options)
    kept = found.where("id = component").select("id").distinct()
    rows = documents.select(
        F.struct("*").alias("_row"),
        F.col(id_column).cast("long").alias("_id"),
        F.xxhash64(F.col(text_column)).alias("_hash"),
    )
    first = Window.partitionBy("_id").orderBy("_hash")
    one = (
        rows.join(kept, F.col("_id") == F.col("id"), "left_semi")
        .withColumn("_n", F.row_number().over(first))
        .where("_n = 1")
    )
    return one.select("_row.*").unionByName(documents.where(F.col(id_column).isNull()))
