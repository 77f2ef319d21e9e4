"""Token ids of a corpus in a word-aligned binary format, written and read by Spark.

Format. Every block holds the ids of whole documents, packed by Simple-8b: the high four
bits of a 64-bit word are a selector that tells how many ids of how many bits the low 60
bits hold. An id too wide for the widest selector is an escape: it has a word to itself.
A block is little-endian::

    magic "S8B1", version (u32), documents (u32), ids (u64), words (u32), frames (u32)
    first id of each frame of FRAME_WORDS words (u64 each)
    number of ids of each document (u32 each)
    the words (u64 each)

Frame offsets allow decoding from the middle of a block; words of one selector are
decoded together. Blocks are rows of a Parquet table (shard, block, first_id, n_ids, ids of
the documents, payload), sorted by document, so that any store that Spark can write will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import map_batches, slices
from tillroll.llm.words import byte_level_ids
from tillroll.sources.session import shared_folder

END_ID = 0
#: A block is closed by the document that brings it to so many ids.
BLOCK_IDS = 1 << 16
FRAME_WORDS = 512
# Ids per word and bits per id of selectors 0 to 12. Selector 15 marks an
# escape: the low 60 bits are one id. The others are not used.
SELECTORS = [
    (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12),
    (4, 15), (3, 20), (2, 30),
]
ESCAPE = 15
_HEADER = struct.Struct("<4sIIQII")
_MAGIC, _VERSION = b"S8B1", 1


#: Bits of the numbers below 2**16, which most ids are.
_SMALL_BITS = np.frexp(np.arange(1 << 16))[1].astype(np.uint8)


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs; above 2**53 perhaps one more."""
    if not ids.size or int(ids.max()) < _SMALL_BITS.size:
        return _SMALL_BITS[ids.astype(np.int64)]
    return np.frexp(ids.astype(np.float64))[1].astype(np.uint8)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and the number of ids in each, for ids below 2**60 taken in order.

    Each word takes the selector with the most ids that fit; the last word may be part full.
    """
    ids = np.asarray(ids, np.uint64)
    if ids.size and int(ids.max()) >> 60:
        raise ValueError("an id needs more than 60 bits")
    choice = np.full(ids.size, ESCAPE, np.int8)
    # bits of the widest of the next ``span`` ids; past the end nothing is wide
    span, widest = 1, _bits(ids)
    for selector in range(len(SELECTORS) - 1, -1, -1):
        count, bits = SELECTORS[selector]
        shifted = widest[count - span :]
        widest = widest.copy()
        np.maximum(widest[: shifted.size], shifted, out=widest[: shifted.size])
        span = count
        fits = widest <= bits
        if not fits.any():
            break
        choice[fits] = selector
    sizes = np.array([c for c, _ in SELECTORS] + [1] * (16 - len(SELECTORS)))
    step = sizes[choice].tolist()
    heads: list[int] = []
    at, end, push = 0, ids.size, heads.append
    while at < end:
        push(at)
        at += step[at]
    heads = np.array(heads, np.int64)
    chosen = choice[heads]
    counts = np.minimum(sizes[chosen], ids.size - heads)
    words = chosen.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(chosen):
        own = np.flatnonzero(chosen == selector)
        if selector == ESCAPE:
            words[own] |= ids[heads[own]]
            continue
        count, bits = SELECTORS[selector]
        for k in range(count):
            have = own[counts[own] > k]
            words[have] |= ids[heads[have] + k] << np.uint64(bits * k)
    return words, counts


def unpack(words: np.ndarray, n_ids: int) -> np.ndarray:
    """The first ``n_ids`` ids of a run of words, as unsigned 64-bit integers."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    sizes = np.array([c for c, _ in SELECTORS] + [1] * (16 - len(SELECTORS)))[chosen]
    heads = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint64)
    for selector in np.unique(chosen):
        own = np.flatnonzero(chosen == selector)
        count, bits = (1, 60) if selector == ESCAPE else SELECTORS[selector]
        mask = np.uint64((1 << bits) - 1)
        for k in range(count):
            out[heads[own] + k] = (words[own] >> np.uint64(bits * k)) & mask
    return out[:n_ids]


def write_block(documents: list[np.ndarray]) -> bytes:
    """One block of the format from the ids of its documents."""
    sizes = np.array([d.size for d in documents], "<u4")
    words, counts = pack(np.concatenate([*documents, np.zeros(0, np.uint64)]))
    firsts = np.concatenate([[0], np.cumsum(counts)])[:-1][::FRAME_WORDS].astype("<u8")
    header = _HEADER.pack(
        _MAGIC, _VERSION, sizes.size, int(sizes.sum()), words.size, firsts.size
    )
    return b"".join([header, firsts.tobytes(), sizes.tobytes(), words.astype("<u8").tobytes()])


def read_block(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a block and the number of ids of each of its documents."""
    firsts, sizes, words, n_ids = _parts(payload)
    return unpack(words, n_ids), sizes


def read_range(payload: bytes, first: int, last: int) -> np.ndarray:
    """Ids ``first`` to ``last`` (past the end) of a block, decoding only their frames."""
    firsts, _, words, n_ids = _parts(payload)
    last = min(last, n_ids)
    if first >= last:
        return np.zeros(0, np.uint64)
    low = int(np.searchsorted(firsts, first, "right")) - 1
    high = int(np.searchsorted(firsts, last - 1, "right"))
    end = int(firsts[high]) if high < firsts.size else n_ids
    base = int(firsts[low])
    return unpack(words[low * FRAME_WORDS : high * FRAME_WORDS], end - base)[first - base : last - base]


def _parts(payload: bytes):
    magic, version, n_docs, n_ids, n_words, n_frames = _HEADER.unpack_from(payload)
    if magic != _MAGIC or version != _VERSION:
        raise ValueError("not a block of this format")
    at = _HEADER.size
    firsts = np.frombuffer(payload, "<u8", n_frames, at)
    sizes = np.frombuffer(payload, "<u4", n_docs, at + 8 * n_frames)
    words = np.frombuffer(payload, "<u8", n_words, at + 8 * n_frames + 4 * n_docs)
    return firsts, sizes, words, n_ids


_BLOCKS = "shard int, block int, first_id long, n_ids long, doc_ids array<bigint>, payload binary"


def _encode(path: str, end_id: int, block_ids: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = byte_level_ids(path).of
        end = np.array([end_id], np.uint64)
        shard = TaskContext.get().partitionId()
        schema = pa.schema(
            [
                ("shard", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()),
                ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("payload", pa.binary()),
            ]
        )
        names: list = []
        held: list[np.ndarray] = []
        size = first = block = 0

        def close() -> pa.RecordBatch:
            row = [[shard], [block], [first], [size], [names], [write_block(held)]]
            return pa.RecordBatch.from_arrays(
                [pa.array(value, field.type) for value, field in zip(row, schema)], schema=schema
            )

        for batch in slices(batches, 256):
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names.append(name)
                held.append(np.concatenate([ids_of(text), end]))
                size += held[-1].size
                if size >= block_ids:
                    yield close()
                    first, block = first + size, block + 1
                    names, held, size = [], [], 0
        if held:
            yield close()

    return encode


def write_ids(
    documents: DataFrame,
    tokenizer_path: str,
    path: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
) -> str:
    """Writes the ids of every text, each followed by ``end_id``, in ascending id order.

    Documents are range-partitioned by id and encoded once, in their place; ``shard`` is
    the place of the range. Null and empty texts consist of the end id. Rows without an id
    come first; rows that share an id are ordered by their texts' hashes. An empty table gives no blocks.
    """
    path = path or shared_folder(documents.sparkSession, "token-ids")
    source = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    # a third of all rows may share an id: the text's hash spreads them over ranges
    order = ["id", F.xxhash64("text"), "text"]
    ordered = source.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    blocks = map_batches(ordered, _encode(tokenizer_path, end_id, block_ids), _BLOCKS)
    blocks.write.option("compression", "zstd").parquet(path)
    return path


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 8):
        names, starts, sizes, sums, ids = [], [], [], [], []
        for row in batch.to_pylist():
            found, counts = read_block(row["payload"])
            found = found.astype("<u4")
            at = 0
            for name, count in zip(row["doc_ids"], counts.tolist()):
                own = found[at : at + count]
                names.append(name)
                starts.append(row["first_id"] + at)
                sizes.append(count)
                sums.append(zlib.crc32(own.tobytes()))
                at += count
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (names, starts, sizes, sums)],
            names=["id", "start", "n_tokens", "ids_crc32"],
        )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document of a written corpus, from its files.

    ``start`` counts the ids of all documents before. The offsets of shards are one row for
    each written range, so they are summed in one task and broadcast.
    """
    blocks = spark.read.schema(_BLOCKS).parquet(path)
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    offsets = shards.select("shard", F.coalesce(before, F.lit(0)).alias("offset"))
    placed = blocks.join(F.broadcast(offsets), "shard").select(
        (F.col("first_id") + F.col("offset")).alias("first_id"), "doc_ids", "payload"
    )
    return map_batches(placed, _decode, "id long, start long, n_tokens long, ids_crc32 long")
