"""Links inside groups of any size, and connected components of the links.

Nothing here is gathered on the driver: a group is cut into cells of bounded size, and
components come from rounds of joins over tables in the shared folder.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import join_counted, stored

#: Members of a group that share a cell. A larger group becomes a triangle of cells, one
#: for each pair of its parts, so a task never holds more than about two parts.
CELL_ROWS = 1024


def cells(
    keyed: DataFrame,
    keys: list[str],
    item: Column,
    spread: Column,
    cell_rows: int = CELL_ROWS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Groups of equal ``keys`` as rows (lo, hi, items), two or more items in each.

    Each pair of items of a group meets in exactly one cell where lo < hi, or lo = hi if
    both are in the same part. ``items`` is an array of struct<part int, item>; ``spread``
    is the hash that deals items to the parts of a large group. ``keep`` names keys to return.
    """
    large = stored(
        keyed.groupBy(*keys).count().where(F.col("count") > cell_rows),
        "large-groups",
    ).select(*keys, F.ceil(F.col("count") / cell_rows).cast("int").alias("_parts"))
    placed = keyed.select(*keys, item.alias("_item"), spread.alias("_spread"))
    placed = join_counted(placed, large, keys, "left")
    parts = F.coalesce("_parts", F.lit(1))
    placed = placed.withColumn("_part", F.pmod("_spread", parts).cast("int"))
    placed = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), parts - 1)))
    return (
        placed.groupBy(
            *keys,
            F.least("_part", "_other").alias("lo"),
            F.greatest("_part", "_other").alias("hi"),
        )
        .agg(F.collect_list(F.struct(F.col("_part").alias("part"), "_item")).alias("items"))
        .where(F.size("items") > 1)
        .select("lo", "hi", "items", *keep)
    )


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a symmetric boolean matrix, as pairs of positions."""
    waiting = linked.any(axis=1)
    edges = []
    for root in np.flatnonzero(waiting):
        if not waiting[root]:
            continue
        waiting[root] = False
        front = np.array([root])
        while front.size:
            reached = linked[front].any(axis=0) & waiting
            front = np.flatnonzero(reached)
            waiting[front] = False
            edges.extend((int(root), int(x)) for x in front)
    return edges


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b): root is the smallest node reachable.

    Alternating large and small stars: each round joins the links with the minimum of each
    neighbourhood and is written to the shared folder. Rounds end when the links repeat;
    their number grows with the logarithm of a component's width. Links with a null end
    and loops count for nothing.
    """
    edges = stored(
        links.where("a <> b").select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u"))
        .distinct(),
        "links",
    )
    before = None
    while (now := _digest(edges)) != before:
        before = now
        if now[0] == 0:
            break
        both = edges.select("u", "v").union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low)
        edges = stored(
            small.where("u <> v").select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u"))
            .distinct(),
            "links",
        )
    roots = edges.groupBy("u").agg(F.min("v").alias("v"))
    return roots.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _digest(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))
        ).first()
    )
