import random

import brute
from conftest import TESTDATA
from pyspark.sql import functions as F

from tillroll.llm import components, simhash

SCHEMA = "doc_id long, text string"
ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two"), (6, "ONE Two"), (7, "one two three"),
    (8, "é É ß x y z"), (9, "a\x0bb\x0cc d e f"), (10, "same same same same"),
]


def found(frame):
    rows = simhash.near_copies(frame).collect()
    return sorted((r["id"], r["fp"] % (1 << 64), r["component"]) for r in rows)


def expected(rows):
    return sorted((i, *v) for i, v in brute.near_copies(rows).items())


def family(size, words=60, seed=1):
    """Near copies of one text, each with one or two words changed."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(1000)}" for _ in range(words)]
    out = []
    for k in range(size):
        own = list(base)
        own[rng.randrange(words)] = f"x{rng.randrange(50)}"
        out.append((100 + k, " ".join(own)))
    return out


def test_fingerprints_equal_the_definition():
    texts = [t for _, t in ODD] + [t for _, t in family(20)] + ["lorem ipsum " * 200]
    packed = [None if t is None else t.encode() for t in texts]
    assert simhash.fingerprints(packed).tolist() == [brute.simhash(t) for t in texts]


def test_long_texts_are_counted_in_pieces(monkeypatch):
    monkeypatch.setattr(simhash, "_HASHES_AT_ONCE", 7)
    texts = [t for _, t in family(10)]
    got = simhash.fingerprints([t.encode() for t in texts])
    assert got.tolist() == [brute.simhash(t) for t in texts]


def test_links_and_components_equal_brute_force(make):
    rows = ODD + family(60) + [(900 + k, f"text {k} of its own with words {k * k}") for k in range(20)]
    assert found(make.frame(rows, SCHEMA)) == expected(rows)


def test_large_groups_are_cut_into_cells(make, spark, monkeypatch):
    rows = family(60)
    keyed = make.frame([(k, k % 2) for k in range(40)], "x long, key int")
    cells = components.cells(keyed, ["key"], F.struct("x"), F.xxhash64("x"), cell_rows=4)
    seen = {}
    for row in cells.collect():
        items = [(i["part"], i["_item"]["x"]) for i in row["items"]]
        assert len(items) <= 4 * 4
        for a in items:
            for b in items:
                if a[1] < b[1] and (row["lo"] == row["hi"] or a[0] != b[0]):
                    pair = (a[1], b[1])
                    seen[pair] = seen.get(pair, 0) + 1
    wanted = {(a, b) for a in range(40) for b in range(a + 1, 40) if a % 2 == b % 2}
    assert set(seen) == wanted and set(seen.values()) == {1}
    monkeypatch.setattr(components, "CELL_ROWS", 4)
    assert found(make.frame(rows, SCHEMA)) == expected(rows)


def test_long_chains_are_followed(make):
    links = make.frame([(k, k + 1) for k in range(300)] + [(5, 5), (None, 3), (1000, 999)], "a long, b long")
    roots = {r["node"]: r["root"] for r in components.connected(links).collect()}
    assert roots == {**{k: 0 for k in range(1, 301)}, 1000: 999}
    assert components.connected(make.frame([], "a long, b long")).count() == 0


def test_null_ids_repeated_rows_and_ids(make):
    rows = [(None, "one two three four"), (7, "one two three four"), (7, "one two three four"),
            (9, "quite another text than that"), (9, "one two three four"), (12, "quite another text than that")]
    got = found(make.frame(rows[1:], SCHEMA))
    assert [c for _, _, c in got] == [7, 7, 7, 7, 7]
    null = simhash.near_copies(make.frame(rows, SCHEMA)).where("id IS NULL").collect()
    assert len(null) == 1 and null[0]["component"] is None
    assert simhash.near_copies(make.frame([], SCHEMA)).count() == 0


def test_one_of_each_keeps_all_columns_and_one_row_of_a_group(make, rows):
    frame = make.frame(
        [(3, "a b c d", "x"), (2, "a b c d", "y"), (2, "a b c d", "y"), (None, "a b c d", None), (5, "e f g", None)],
        "doc_id long, text string, component string",
    ).withColumns({"fp": F.lit(1), "id": F.lit(2), "_n": F.lit(3)})
    kept = simhash.one_of_each(frame)
    assert kept.columns == frame.columns
    assert rows(kept, "doc_id", "component") == sorted([(2, "y"), (None, None), (5, None)], key=repr)


def test_query_equals_brute_force(spark):
    from tillroll.llm.queries import op3_simhash_blocks

    folder = f"{TESTDATA}/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in op3_simhash_blocks(spark, folder).collect())
    assert got == sorted((i, f"{fp:016x}", c) for i, (fp, c) in brute.near_copies(docs).items())
