"""Near copies of embeddings: sign hashing, exact cosines, components.

Random hyperplanes give each vector ``bits`` signs in each of several tables. Vectors of one
label that share all signs of a table meet, and their cosine is computed in double
precision. The number of bits follows the number of vectors, so that groups stay small, and
the number of tables follows from the bits, so that a pair at the threshold meets with
probability ``RECALL`` or more at every size.

Equal vectors of a label are one class with a size; a pair is counted in the first table
where it meets. Groups are cut into cells, and a cell gives sums of links and a spanning
forest, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import join_spread, map_batches, slices, stored
from tillroll.llm.components import cells, connected, forest

THRESHOLD = 0.93
RECALL = 0.998
SEED = 11
_GROUP = 32


def plan(vectors: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables): groups of some ``_GROUP`` unrelated vectors, and the recall asked for."""
    bits = min(62, max(8, math.ceil(math.log2(max(1, vectors) / _GROUP))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def planes(dimensions: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dimensions]).normal(size=(dimensions, bits * tables))


def _unit(values: np.ndarray) -> np.ndarray:
    # scaling by the largest component first keeps squares from overflowing
    scaled = values / np.abs(values).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def _sign(bits: int, tables: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in slices(batches, 2048):
            rows = batch.column(0).to_pylist()
            signs: list = [None] * len(rows)
            by_size: dict[int, list[int]] = {}
            for k, row in enumerate(rows):
                by_size.setdefault(len(row), []).append(k)
            for size, own in by_size.items():
                unit = _unit(np.array([rows[k] for k in own], np.float64))
                side = unit @ planes(size, bits, tables) > 0
                keys = side.reshape(len(own), tables, bits) @ weights
                for k, key in zip(own, keys):
                    signs[k] = key
            array = pa.array([s.tolist() for s in signs], pa.list_(pa.int64()))
            yield batch.append_column("signs", array)

    return sign


def _verify(threshold: float):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            a, b, many = [], [], []
            for low, high, number, items in zip(*(c.to_pylist() for c in batch.columns)):
                part = np.array([i["part"] for i in items])
                item = [i["_item"] for i in items]
                rep = np.array([i["rep"] for i in item])
                size = np.array([i["size"] for i in item])
                signs = np.array([i["signs"] for i in item])
                unit = _unit(np.array([i["vector"] for i in item], np.float64))
                near = unit @ unit.T >= threshold
                if low != high:
                    near &= part[:, None] != part[None, :]
                np.fill_diagonal(near, False)
                if not near.any():
                    continue
                for earlier in range(number):
                    near &= signs[:, None, earlier] != signs[None, :, earlier]
                for k in np.flatnonzero(near.any(axis=1)):
                    a.append(rep[k]), b.append(None), many.append(int(size[near[k]].sum()))
                for i, j in forest(near):
                    a.append(rep[i]), b.append(rep[j]), many.append(0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (a, b, many)], names=["a", "b", "many"]
            )

    return linked


def near_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """(id, n_links, component): direct links and the smallest id reachable, one row per row.

    Vectors link if their labels are equal and their cosine is at least ``threshold``. A null
    label, a vector that is null, empty or zero, or one with a null, NaN or infinite component
    links with nothing; so does a vector of another length. Repeated ids stay separate rows
    that link like others. Rows without an id link with nothing and have a null component. An
    empty table gives an empty result.
    """
    vector, label = F.col(vector_column).cast("array<double>"), F.col(label_column)
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    good = F.col(id_column).isNotNull() & label.isNotNull() & finite & F.exists(vector, lambda x: x != 0)
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"),
        F.when(good, label).alias("label"),
        # adding zero turns minus zero into zero, so that equal vectors are equal
        F.when(good, F.transform(vector, lambda x: x + F.lit(0.0))).alias("vector"),
    )
    key = F.when(F.col("vector").isNotNull(), F.sha2(F.concat_ws(" ", "label", "vector_text"), 256))
    rows = stored(
        rows.withColumn("vector_text", F.col("vector").cast("string")).withColumn("class", key)
        .drop("vector_text"),
        "vectors",
    )
    classes = (
        rows.where("class IS NOT NULL").groupBy("class")
        .agg(F.first("label").alias("label"), F.first("vector").alias("vector"),
             F.min("id").alias("least"), F.count("*").alias("size"))
    )
    # classes are numbered, as an id may have several
    classes = stored(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    many = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan(many, threshold, recall)
    signed = classes.select("vector", "label", "rep", "size")
    signed = map_batches(signed, 
        _sign(bits, tables),
        f"vector array<double>, label {dict(classes.dtypes)['label']}, rep long, size long, signs array<bigint>",
    )
    keyed = signed.select(
        "vector", "label", "rep", "size", "signs", F.posexplode("signs").alias("table", "sign")
    )
    item = F.struct("vector", "rep", "size", "signs")
    groups = cells(keyed, ["table", "label", "sign"], item, F.xxhash64("rep"), keep=("table",))
    pairs = stored(
        map_batches(groups.select("lo", "hi", "table", "items"), _verify(threshold), "a long, b long, many long"),
        "pairs",
    )
    # an id with several vectors joins their classes
    ids = rows.where("class IS NOT NULL")
    several = ids.groupBy("id").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x <> y")
    own = (
        ids.join(several.select("id"), "id").join(classes.select("class", "rep"), "class")
        .select("id", "rep").distinct()
    )
    shared = own.join(own.groupBy("id").agg(F.min("rep").alias("a")), "id")
    links = pairs.where("b IS NOT NULL").select("a", "b")
    roots = connected(links.union(shared.select("a", F.col("rep").alias("b"))))
    outside = pairs.where("b IS NULL").groupBy("a").agg(F.sum("many").alias("outside"))
    named = (
        classes.select("class", "rep", "least", "size")
        .join(outside, F.col("rep") == F.col("a"), "left")
        .join(roots, F.col("rep") == F.col("node"), "left")
        .select(
            "class",
            "least",
            (F.col("size") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"),
            F.coalesce("root", "rep").alias("root"),
        )
    )
    smallest = named.groupBy("root").agg(F.min("least").alias("component"))
    named = join_spread(named, smallest, ["root"], F.xxhash64("class")).drop("root", "least")
    found = join_spread(rows, named, ["class"], F.xxhash64("id"), "left")
    return found.select(
        "id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"),
    )
