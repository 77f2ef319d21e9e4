import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import TESTDATA

from tillroll.llm import prefix_trie
from tillroll.llm.queries import QUERIES

SCHEMA = "conv_id long, turn int, role string, text string"
COLUMNS = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
)


def rebuilt(rows):
    """{id: turns} of (conv_id, turn, role, text) rows with distinct turn numbers."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def plain_trie(sequences):
    """Rows of every node by looking at every prefix."""
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    below = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves = 0 if children[node] else 1
        for child in children[node]:
            leaves, saved = leaves + below[child][0], saved + below[child][1]
        below[node] = leaves, saved
    rows = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(sequences[c]) == len(node))
        rows.append((
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children[node]),
            *below[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=repr)


def ours(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.select(*COLUMNS).collect()), key=repr)


def table(spark, rows, tmp_path, schema=SCHEMA):
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "conversations.parquet"))
    return str(tmp_path)


def test_query_equals_brute_force(spark):
    folder = f"{TESTDATA}/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert ours(QUERIES["op12_prefix_trie"](spark, folder)) == plain_trie(rebuilt(rows))


@pytest.mark.parametrize("seed", range(3))
def test_random_tries_equal_brute_force(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(600), 300):
        for turn in range(rng.randrange(1, 12)):
            rows.append((c, turn, rng.choice(["user", "bot"]) if turn > 1 else "user", rng.choice(["é", "b", "cc"]) if turn else "hi"))
    rng.shuffle(rows)
    assert ours(QUERIES["op12_prefix_trie"](spark, table(spark, rows, tmp_path))) == plain_trie(rebuilt(rows))


def rows_of(sequences):
    """Blocks over blocks, without Spark: what the levels give, by (node id, ...)."""
    order = sorted(sequences, key=lambda c: (b"".join(sequences[c]), c))
    return [(c, b"".join(sequences[c])) for c in order]


@pytest.mark.parametrize("seed", range(6))
def test_blocks_of_any_size_give_one_trie(seed):
    """Nodes finished in blocks and, level by level, on paths make up the trie of all rows."""
    rng = random.Random(seed)
    digests = [bytes([k]) * prefix_trie.WIDTH for k in range(3)]
    sequences = {c: [rng.choice(digests) for _ in range(rng.randrange(7))] for c in range(200)}
    rows = rows_of(sequences)
    keys, size = [key for _, key in rows], rng.choice([1, 2, 7, 50, 500])

    def stats(part):
        out = []
        for c, key in part:
            for d in range(len(key) // prefix_trie.WIDTH + 1):
                out.append([3 * (d > 0), 1, c, 0, 0, 0])
        return np.array(out, np.int64)

    found = []

    def finished(keys, block):
        for k in np.flatnonzero(~block.open):
            prefix = keys[block.row[k]][: block.depth[k] * prefix_trie.WIDTH]
            found.append((prefix, *block.stats[k, 1:].tolist()))

    def paths(keys, block):
        out = []
        for k, nodes in prefix_trie._paths(block, len(keys)).items():
            path = block.stats[nodes]
            if k:
                path[block.row[nodes] == 0, 1:] = 0
                path[block.row[nodes] == 0, 2] = prefix_trie._NONE
            out.append((keys[k], path))
        return out

    level = []
    for at in range(0, len(rows), size):
        part = rows[at : at + size]
        block = prefix_trie._block([k for _, k in part], stats(part), False)
        finished([k for _, k in part], block)
        level += paths([k for _, k in part], block)
    while len(level) > 12:
        after = []
        for at in range(0, len(level), 9):
            part = level[at : at + 9]
            block = prefix_trie._block([k for k, _ in part], np.concatenate([x for _, x in part]), False)
            finished([k for k, _ in part], block)
            after += paths([k for k, _ in part], block)
        level = after
    block = prefix_trie._block([k for k, _ in level], np.concatenate([x for _, x in level]), True)
    finished([k for k, _ in level], block)
    plain = prefix_trie._block(keys, stats(rows), True)
    whole, found = found, []
    finished(keys, plain)
    assert sorted(whole) == sorted(found)
    assert len(found) == len({k[: d * 16] for k in keys for d in range(len(k) // 16 + 1)})


def test_extents_by_range_minima_equal_a_scan():
    rng = np.random.default_rng(2)
    lcp = rng.integers(0, 4, 300)
    levels = prefix_trie.sparse_table(lcp)
    rows, depths = rng.integers(0, 301, 500), rng.integers(0, 5, 500)
    left, right = prefix_trie.left_ends(levels, rows, depths), prefix_trie.right_ends(levels, rows, depths)
    for row, depth, a, b in zip(rows, depths, left, right):
        x = y = row
        while x > 0 and lcp[x - 1] >= depth:
            x -= 1
        while y < 300 and lcp[y] >= depth:
            y += 1
        assert (a, b) == (x, y)


def test_several_levels_in_spark(spark):
    rng = random.Random(9)
    rows = [(c, t, "u", rng.choice("ab") if t else "hot" if c % 3 else "x") for c in range(800) for t in range(rng.randrange(1, 6))]
    rows += [(c, t, "u", "same") for c in range(1000, 1300) for t in range(3)]
    lists = prefix_trie.turn_lists(spark.createDataFrame(rows, SCHEMA))
    found = prefix_trie.prefix_trie(prefix_trie.with_shared_openings(lists), prefix_trie.Size(16, 40))
    names = dict(zip(found.columns, COLUMNS[:1] + COLUMNS[1:]))
    assert ours(found.withColumnsRenamed(names)) == plain_trie(rebuilt(rows))


def test_odd_rows(spark, tmp_path):
    rows = [(0, None, None, None), (0, 1, "user", None), (1, 0, "user", ""), (2, 5, "a", "x" * 300_000),
            (-3, 0, "u", "minus"), (None, 0, "user", "lost"), (7, 2, "u", "late"), (7, None, "u", "first"),
            *((11, t, "u", str(t % 2)) for t in range(5000)), *((10, t, "u", str(t % 2)) for t in range(5000))]
    mine = [r for r in rows if r[0] != -3]
    assert ours(QUERIES["op12_prefix_trie"](spark, table(spark, mine, tmp_path))) == plain_trie(rebuilt(mine))
    # a negative id belongs to the multiple of five towards zero
    lists = prefix_trie.turn_lists(spark.createDataFrame([(-3, 0, "u", "m"), (0, 0, "u", "z")], SCHEMA))
    assert prefix_trie.with_shared_openings(lists).count() == 2


def test_empty_repeated_and_clashing(spark, tmp_path):
    schema = SCHEMA + ", id int, turns string, key string, kind int, node long"
    empty = prefix_trie.turn_lists(spark.createDataFrame([], schema))
    assert prefix_trie.prefix_trie(prefix_trie.with_shared_openings(empty)).collect() == []
    rows = [(5, 1, "u", "a", 1, "t", "k", 1, 2)] * 3 + [(5, 1, "u", "b", 1, "t", "k", 1, 2)]
    found = prefix_trie.prefix_trie(prefix_trie.turn_lists(spark.createDataFrame(rows, schema))).collect()
    assert sorted(r.depth for r in found) == [0, 1, 2, 3, 4]  # a repeated row is a repeated turn
    assert all(r.n_members == 1 for r in found)
