import random

import numpy as np
import pytest

import brute
from tillroll.llm import components, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, threshold=0.93):
    good = {}
    for i, v, label in rows:
        if i is None or label is None or not v or None in v:
            continue
        a = np.array(v, np.float32).astype(float)
        if np.isfinite(a).all() and a.any():
            good[i] = (label, a / np.linalg.norm(a))
    links = [
        (a, b) for a in good for b in good
        if a < b and good[a][0] == good[b][0] and len(good[a][1]) == len(good[b][1])
        and good[a][1] @ good[b][1] >= threshold
    ]
    root = components_of([r[0] for r in rows if r[0] is not None], links)
    count = {i: 0 for i in root}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return sorted((i, count[i], root[i]) for i in root)


def components_of(nodes, links):
    return brute.components(nodes, links)


def found(frame):
    got = vectors.near_vectors(frame).where("id IS NOT NULL").collect()
    return sorted(tuple(r) for r in got)


def clustered(n, seed, noise):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, 16))
    out = []
    for k in range(n):
        v = centers[k % 6] + noise * rng.normal(size=16)
        out.append((k, [float(x) for x in v.astype(np.float32)], k % 3 % 2))
    return out


@pytest.mark.parametrize("noise", [0.02, 0.2, 1.0])
def test_links_equal_brute_force(make, noise):
    rows = clustered(90, 3, noise)
    assert found(make.frame(rows, SCHEMA)) == expected(rows)


def test_cells_of_large_groups(make, monkeypatch):
    monkeypatch.setattr(components, "CELL_ROWS", 5)
    rows = clustered(60, 4, 0.05)
    assert found(make.frame(rows, SCHEMA)) == expected(rows)


def test_odd_vectors_link_with_nothing(make):
    v = [1.0, 2.0, 0.0]
    rows = [
        (1, v, 1), (2, v, 1), (3, v, None), (4, None, 1), (5, [], 1), (6, [0.0, -0.0, 0.0], 1),
        (7, [1.0, None, 2.0], 1), (8, [float("nan"), 1.0, 1.0], 1), (9, [float("inf"), 1.0, 1.0], 1),
        (10, [2.0, 4.0, -0.0], 1), (11, [1.0, 2.0], 1), (12, v, 2), (13, [1e38, 2e38, 0.0], 1),
    ]
    assert found(make.frame(rows, SCHEMA)) == expected(rows)
    assert found(make.frame([], SCHEMA)) == []


def test_copies_are_counted_without_pairs(make):
    rows = [(k, [1.0, 2.0, 3.0], 1) for k in range(200)] + [(500, [1.0, 2.0, 3.05], 1)]
    got = found(make.frame(rows, SCHEMA).repartition(3))
    assert got == [(k, 200, 0) for k in range(200)] + [(500, 200, 0)]


def test_null_ids_and_repeated_rows(make):
    rows = [(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1)]
    got = vectors.near_vectors(make.frame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(4, 1, 4), (4, 1, 4), (None, 0, None)], key=repr)


def by_rows(rows, threshold=0.93):
    """Links between rows; rows of one id are in one component."""
    unit = [np.array(v) / np.linalg.norm(v) for _, v, _ in rows]
    many = range(len(rows))
    links = [(a, b) for a in many for b in many if a < b and rows[a][2] == rows[b][2] and unit[a] @ unit[b] >= threshold]
    same = [(a, b) for a in many for b in many if a < b and rows[a][0] == rows[b][0]]
    root = components_of(many, links + same)
    least = {k: min(rows[j][0] for j in many if root[j] == root[k]) for k in many}
    return sorted((rows[k][0], sum(k in link for link in links), least[k]) for k in many)


def test_an_id_with_different_vectors_keeps_its_links_apart(make):
    rows = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 2), (2, [1.0, 0.01], 1), (3, [0.01, 1.0], 2), (3, [0.02, 1.0], 2),
            (0, [1.0, 1.0], 1), (9, [-1.0, 0.0], 1)]
    assert found(make.frame(rows, SCHEMA)) == by_rows(rows)
    rng = np.random.default_rng(7)
    rows = [(int(rng.integers(40)), v, label) for _, v, label in clustered(80, 6, 0.15)]
    assert found(make.frame(rows, SCHEMA)) == by_rows(rows)


def test_the_plan_keeps_the_recall_at_every_size():
    for n in (0, 10, 10_000, 10**9):
        bits, tables = vectors.plan(n)
        meet = (1 - np.arccos(0.93) / np.pi) ** bits
        assert 1 - (1 - meet) ** tables >= vectors.RECALL


def test_random_pairs_at_the_threshold_are_found(make):
    rng = random.Random(5)
    rows = []
    for k in range(150):
        a = np.array([rng.gauss(0, 1) for _ in range(32)])
        b = np.array([rng.gauss(0, 1) for _ in range(32)])
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        cosine = 0.931
        c = cosine * a + np.sqrt(1 - cosine**2) * b
        rows += [(2 * k, a.tolist(), k), (2 * k + 1, c.tolist(), k)]
    linked = sum(n for _, n, _ in found(make.frame(rows, SCHEMA)))
    assert linked >= 0.95 * 300
