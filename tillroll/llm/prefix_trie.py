"""The prefix trie of all conversations, from member intervals in their sorted order.

A turn is a digest, a conversation the row of its turns' digests. Conversations are sorted by
these rows, so the members of a node of the trie, that is of a prefix, are neighbours. In
blocks of the sorted order, the lengths of the longest common prefixes of neighbours (LCPs)
go into a sparse table of range minima. Every prefix of every conversation is a candidate
and searches the ends of its interval to the left and to the right in that table, each
search by itself: an interval reaches as far as no LCP falls below the prefix's length. No
stack is kept, and candidates of a block are searched side by side in numpy.

Nodes whose interval ends inside a block are finished there. The others are prefixes of the
block's first or last conversation: two paths with sums for each node. Paths are the
conversations of the next level, whose blocks are worked in the same way, until one block
holds all. So no task holds more than a block, whatever share of the conversations has a
prefix in common, and a level has some ten thousandth of the rows of the level before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import map_batches, stored

#: Bytes of a turn's digest.
WIDTH = 16
_LEAST_ROWS = 8
_NONE = np.iinfo(np.int64).max
_NO_ENDS = hashlib.sha256().hexdigest()

#: What a path has for each of its nodes, the root first.
_SIZE, _COUNT, _LEAST, _CHILDREN, _LEAVES, _SAVED = range(6)
_FINISHED, _PATH, _OPEN, _ENDS = range(4)
_ROWS = """
    kind int, block long, slot long, node binary, parent binary, depth long, least long,
    parent_least long, n_members long, n_children long, n_leaves long, saved long,
    ends string, key binary, stats binary
"""
_NAMES = [column.split()[0] for column in _ROWS.split(",")]


def turn_lists(
    conversations: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """(id, turns): each conversation's turns in order, as (turn, digest, size of the text).

    Turns without a number come first; equal numbers are ordered by the turns' digests, so
    that a repeated row is a repeated turn. A null role or text is an empty one. Rows without
    an id belong to no conversation. Ids are whole numbers. A conversation has to fit into
    a task as 30 bytes a turn.
    """
    role = F.coalesce(F.col(role_column), F.lit(""))
    text = F.coalesce(F.col(text_column), F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"),
        F.struct(
            F.col(turn_column).alias("turn"),
            F.substring(F.unhex(F.sha2(whole, 256)), 1, WIDTH).alias("digest"),
            F.octet_length(text).cast("long").alias("size"),
        ).alias("at"),
    )
    return turns.groupBy("id").agg(F.sort_array(F.collect_list("at")).alias("turns"))


def with_shared_openings(lists: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """Conversations rebuilt on the opening of the one whose id is the next lower multiple.

    The first h turns are those of conversation ``id - id % every`` (all if it has fewer, none
    if there is no such conversation), the others its own after its first h; h is the id's
    crc32, as decimal text, modulo ``most``.
    """
    own = lists.select("id", "turns", (F.col("id") - F.col("id") % every).alias("_base"))
    openings = lists.where(F.col("id") % every == 0).select(
        F.col("id").alias("_base"), F.slice("turns", 1, most - 1).alias("_opening")
    )
    h = (F.crc32(F.col("id").cast("string")) % most).cast("int")
    # a slice past the end is empty
    opening = F.coalesce(F.slice("_opening", F.lit(1), h), F.slice("turns", 1, 0))
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return own.join(openings, "_base", "left").select("id", F.concat(opening, rest).alias("turns"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, turns) to (id, key, sizes): digests and sizes of a conversation side by side."""
    for batch in batches:
        keys, sizes = [], []
        for turns in batch.column(1):
            both = turns.values
            keys.append(b"".join(both.field("digest").to_pylist()) if len(both) else b"")
            sizes.append(both.field("size").to_numpy().tobytes() if len(both) else b"")
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.binary())],
            names=["id", "key", "sizes"],
        )


def _common(a: bytes, b: bytes) -> int:
    """Turns that two keys have in common from their start, by bisection."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        middle = (low + high + 1) // 2
        if a[low * WIDTH : middle * WIDTH] == b[low * WIDTH : middle * WIDTH]:
            low = middle
        else:
            high = middle - 1
    return low


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Minima of the 1, 2, 4, ... values from each position on, as far as they reach."""
    levels = [values]
    while 2 << (len(levels) - 1) <= values.size:
        half, before = 1 << (len(levels) - 1), levels[-1]
        levels.append(np.minimum(before[:-half], before[half:]))
    return levels


def left_ends(table: list[np.ndarray], rows: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """First member of each candidate: the lowest row that no LCP below its depth cuts off.

    ``table`` is over LCPs, the one at position p being that of rows p and p + 1.
    """
    at = rows.copy()
    for k in range(len(table) - 1, -1, -1):
        step = 1 << k
        able = np.flatnonzero(at >= step)
        able = able[table[k][at[able] - step] >= depths[able]]
        at[able] -= step
    return at


def right_ends(table: list[np.ndarray], rows: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """Last member of each candidate: the highest row that no LCP below its depth cuts off."""
    at = rows.copy()
    for k in range(len(table) - 1, -1, -1):
        able = np.flatnonzero(at < table[k].size)
        able = able[table[k][at[able]] >= depths[able]]
        at[able] += 1 << k
    return at


class Size(NamedTuple):
    """A block ends with the row that brings it to so many rows, or to so many turns.

    It has ``_LEAST_ROWS`` rows at least: with fewer, its two paths might not be fewer than its
    rows.
    """

    rows: int
    turns: int


BLOCK = Size(rows=1 << 16, turns=1 << 19)
#: Ids in a piece of the text that a node's hash goes over.
_PIECE_IDS = 1 << 10


class _Block(NamedTuple):
    """Nodes of a block in preorder, and where the nodes of each path are among them."""

    row: np.ndarray
    end: np.ndarray
    depth: np.ndarray
    parent: np.ndarray
    open: np.ndarray
    stats: np.ndarray
    offset: np.ndarray
    node_of: np.ndarray


def _block(keys: list[bytes], stats: np.ndarray, final: bool) -> _Block:
    """The trie of sorted keys. ``stats`` has a row for each key and depth, zero included.

    Numbers of open nodes lack what other blocks have; their leaves and savings are those of
    finished nodes below them, without those below open children.
    """
    n = len(keys)
    depths = np.array([len(key) // WIDTH for key in keys], np.int64)
    lcp = np.array([_common(a, b) for a, b in zip(keys, keys[1:])], np.int64)
    offset = np.concatenate([[0], np.cumsum(depths + 1)])
    row = np.repeat(np.arange(n), depths + 1)
    depth = np.arange(row.size) - offset[row]
    table = sparse_table(lcp) if lcp.size else []
    first, last = left_ends(table, row, depth), right_ends(table, row, depth)
    # a prefix is the node of its first member
    own = first == row
    node_of = (np.cumsum(own) - 1)[offset[first] + depth]
    row, end, depth = row[own], last[own], depth[own]
    parent = np.full(row.size, -1)
    parent[depth > 0] = node_of[offset[row] + depth - 1][depth > 0]
    is_open = np.zeros(row.size, bool) if final else (row == 0) | (end == n - 1)
    total = np.zeros((row.size, 6), np.int64)
    total[:, _SIZE] = stats[own, _SIZE]
    total[:, _LEAST] = _NONE
    np.minimum.at(total[:, _LEAST], node_of, stats[:, _LEAST])
    for k in (_COUNT, _CHILDREN, _LEAVES, _SAVED):
        np.add.at(total[:, k], node_of, stats[:, k])
    finished = ~is_open
    np.add.at(total[:, _CHILDREN], parent[finished & (depth > 0)], 1)
    total[:, _LEAVES] += finished & (total[:, _CHILDREN] == 0)
    total[finished, _SAVED] += ((total[:, _COUNT] - 1) * total[:, _SIZE])[finished]
    # what is below a node follows it in preorder
    past = np.searchsorted(row, end, "right")
    inner = np.flatnonzero(is_open & (depth > 0))
    for k in (_LEAVES, _SAVED):
        sums = np.concatenate([[0], np.cumsum(total[:, k])])
        below = sums[past] - sums[:-1]
        total[:, k] = below
        np.subtract.at(total[:, k], parent[inner], below[inner])
    return _Block(row, end, depth, parent, is_open, total, offset, node_of)


def _ids(key: bytes) -> list[bytes]:
    """An id for each prefix of a key, the root first; each follows from the one before."""
    found = [b""]
    for at in range(0, len(key), WIDTH):
        found.append(hashlib.sha256(found[-1] + key[at : at + WIDTH]).digest())
    return found


def _paths(block: _Block, n: int) -> dict[int, np.ndarray]:
    """Nodes of the first and the last row of a block, by row."""
    return {
        k: block.node_of[block.offset[k] : block.offset[k + 1]] for k in dict.fromkeys((0, n - 1))
    }


def _filled(n: int, **columns) -> pa.RecordBatch:
    """``n`` rows of the common form from some of its columns; a single value is repeated."""
    types = dict(zip(_NAMES, (column.split()[1] for column in _ROWS.split(","))))
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    arrays = []
    for name in _NAMES:
        value = columns.get(name)
        kind = kinds[types[name]]
        if isinstance(value, (list, np.ndarray, pa.Array)):
            arrays.append(pa.array(value, kind))
        else:
            arrays.append(pa.array([value] * n, kind))
    return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


def _results(
    keys: list[bytes], block: _Block, number: int, ids: np.ndarray | None, named: bool
) -> Iterator[pa.RecordBatch]:
    """Rows of a block: finished nodes, its two paths, their open nodes, and ends of these.

    ``ids`` are those of the conversations on the first level. Nodes get ids if ``named``.
    """
    n, done = len(keys), np.flatnonzero(~block.open)
    paths = _paths(block, n)
    total = block.stats
    ends = [_NO_ENDS] * block.row.size
    if ids is not None:
        # each conversation ends at the node of its whole key; equal keys are neighbours
        full = block.node_of[block.offset[1:] - 1]
        starts = np.flatnonzero(np.concatenate([[True], full[1:] != full[:-1]]))
        kept = []
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), n]):
            text = ",".join(map(str, ids[a:b].tolist()))
            if not block.open[full[a]]:
                ends[full[a]] = hashlib.sha256(text.encode()).hexdigest()
                continue
            for at in range(a, b, _PIECE_IDS):
                piece = ids[at : min(b, at + _PIECE_IDS)]
                kept.append((int(full[a]), int(piece[0]), ",".join(map(str, piece.tolist()))))
    names: dict[int, bytes] = {}
    slots: dict[int, int] = {}
    if named or block.open.any():
        for k, nodes in paths.items():
            for d, (node, name) in enumerate(zip(nodes.tolist(), _ids(keys[k]))):
                if block.open[node]:
                    names[node] = name
                    slots.setdefault(node, -1 - d if k else d)
    if named:
        for node in done.tolist():
            key = keys[block.row[node]][: block.depth[node] * WIDTH]
            up = names.get(int(block.parent[node]))
            names[node] = hashlib.sha256(up + key[-WIDTH:]).digest() if up is not None else b""
    if done.size:
        parents = block.parent[done]
        above = [None if p < 0 or block.open[p] else int(total[p, _LEAST]) for p in parents.tolist()]
        yield _filled(
            done.size, kind=_FINISHED, block=number, depth=block.depth[done],
            slot=[slots.get(p) for p in parents.tolist()],
            node=[names.get(x) for x in done.tolist()], parent=[names.get(p) for p in parents.tolist()],
            least=total[done, _LEAST], parent_least=above, n_members=total[done, _COUNT],
            n_children=total[done, _CHILDREN], n_leaves=total[done, _LEAVES], saved=total[done, _SAVED],
            ends=[ends[x] for x in done.tolist()],
        )
    if not block.open.any():
        return
    stats = []
    for k, nodes in paths.items():
        path = total[nodes]
        if k:  # nodes that the first row has as well are counted there
            shared = block.row[nodes] == 0
            path[shared, _COUNT:] = 0
            path[shared, _LEAST] = _NONE
        stats.append(path.tobytes())
    yield _filled(len(paths), kind=_PATH, key=[keys[k] for k in paths], stats=stats)
    if ids is not None:
        # by node, as (block, slot): children name their parent so
        yield _filled(
            len(slots), kind=_OPEN, block=number, slot=list(slots.values()),
            node=[names[node] for node in slots],
        )
        if kept:
            yield _filled(
                len(kept), kind=_ENDS, node=[names[node] for node, _, _ in kept],
                least=[first for _, first, _ in kept], ends=[text for _, _, text in kept],
            )


def _first_level(size: Size):
    """Blocks of sorted (id, key, sizes)."""

    def stats(held):
        rows = sum(len(key) // WIDTH + 1 for _, key, _ in held)
        out = np.zeros((rows, 6), np.int64)
        out[:, _COUNT] = 1
        at = 0
        for own, key, sizes in held:
            past = at + len(key) // WIDTH + 1
            out[at:past, _LEAST] = own
            out[at + 1 : past, _SIZE] = np.frombuffer(sizes, np.int64)
            at = past
        return out

    def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, held in _held(batches, size):
            keys = [key for _, key, _ in held]
            block = _block(keys, stats(held), final=False)
            yield from _results(keys, block, number, np.array([x[0] for x in held], np.int64), named=False)

    return level


def _next_level(size: Size | None):
    """Blocks of sorted (key, stats); without a size all rows of the task are the last one."""

    def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, held in _held(batches, size):
            keys = [key for key, _ in held]
            stats = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 6) for _, x in held])
            yield from _results(keys, _block(keys, stats, size is None), number, None, named=True)

    return level


def _held(batches: Iterator[pa.RecordBatch], size: Size | None) -> Iterator[tuple[int, list]]:
    """Numbered blocks of rows; without a size all rows of the task are one."""
    number, held, turns = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        at = batch.schema.get_field_index("key")
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            held.append(row)
            turns += len(row[at]) // WIDTH + 1
            if size and (len(held) >= size.rows or turns >= size.turns) and len(held) >= _LEAST_ROWS:
                yield number, held
                number, held, turns = number + 1, [], 0
    if held:
        yield number, held


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, least, ends) sorted by node and least to (node, ends): one hash over all pieces.

    Only the hash of the node at hand is kept, not its pieces.
    """
    at, digest = None, None
    for batch in batches:
        nodes, found = [], []
        for node, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if digest is not None and node == at:
                digest.update(b",")
            else:
                if digest is not None:
                    nodes.append(at)
                    found.append(digest.hexdigest())
                at, digest = node, hashlib.sha256()
            digest.update(text.encode())
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.binary()), pa.array(found, pa.string())], names=["node", "ends"]
        )
    if digest is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([at], pa.binary()), pa.array([digest.hexdigest()])], names=["node", "ends"]
        )


def prefix_trie(lists: DataFrame, block: Size = BLOCK) -> DataFrame:
    """One row per node of the trie of ``lists`` (id, turns), as :func:`turn_lists` gives them.

    Columns: ``least``, the smallest id of the members, that is of the conversations that
    start with the node's turns; depth; ``parent_least``; n_members; n_children; n_leaves, the
    childless nodes in its subtree, itself included; saved, summed over the subtree: each
    node's members but one times the bytes of its last text; ends, the SHA-256 of the ids, in
    ascending order and joined by commas, of the members that have no further turn. The root
    has depth 0 and no text; conversations without turns are its members alone. Ids are
    expected to be distinct. An empty table gives an empty result.

    The hash of a node that most conversations end at goes over all their ids in order, as
    SHA-256 can not be put together from parts; ids reach it as long pieces of text, some
    thousand ids in each.
    """
    packed = stored(map_batches(lists, _packed, "id long, key binary, sizes binary"), "conversations")
    ordered = packed.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    first = stored(map_batches(ordered, _first_level(block), _ROWS), "trie")
    paths, levels = first.where(F.col("kind") == _PATH).select("key", "stats"), []
    while True:
        rows, size = paths.agg(F.count("*"), F.coalesce(F.sum(F.length("stats")), F.lit(0))).first()
        final = rows <= _LEAST_ROWS or rows <= block.rows and size <= 48 * block.turns
        if final:
            ordered = paths.repartition(1).sortWithinPartitions("key")
        else:
            parts = max(2, 2 * size // (48 * block.turns), 2 * rows // block.rows)
            ordered = paths.repartitionByRange(parts, "key").sortWithinPartitions("key")
        levels.append(stored(map_batches(ordered, _next_level(None if final else block), _ROWS), "trie"))
        if final:
            break
        paths = levels[-1].where(F.col("kind") == _PATH).select("key", "stats")
    upper = levels[0]
    for level in levels[1:]:
        upper = upper.union(level)
    upper = upper.where(F.col("kind") == _FINISHED)
    ends = first.where(F.col("kind") == _ENDS).select("node", "least", "ends")
    ends = map_batches(
        ends.repartition("node").sortWithinPartitions("node", "least"), _hashed, "node binary, ends string"
    )
    least = upper.select(F.col("node").alias("_node"), F.col("least").alias("_above"))
    rest = ["depth", "n_members", "n_children", "n_leaves", "saved"]
    upper = (
        upper.drop("ends").join(ends, "node", "left")
        .join(least, F.col("parent") == F.col("_node"), "left")
        .select("least", "_above", F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends"), *rest)
    )
    # nodes with an open parent name it by its place in their block, so no parent is a hot key
    places = (
        first.where(F.col("kind") == _OPEN).select("block", "slot", F.col("node").alias("_node"))
        .join(least, "_node").drop("_node")
    )
    lower = (
        first.where(F.col("kind") == _FINISHED).join(places, ["block", "slot"], "left")
        .select("least", F.coalesce("parent_least", "_above").alias("_above"), "ends", *rest)
    )
    found = lower.unionByName(upper)
    return found.select(
        "least", "depth", F.col("_above").alias("parent_least"), "n_members", "n_children",
        "n_leaves", "saved", "ends",
    )
