import random

import brute
import pytest
from pyspark.sql import functions as F

from tillroll.llm import decontaminate as d

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def found(docs, items, **options):
    got = d.contamination(docs, items, **options).select(
        "row.doc_id", "found.n_words", d.n_hit().alias("n"), "found.items", d.contaminated().alias("c")
    )
    return sorted([tuple(r) for r in got.collect()], key=repr)


def expected(docs, items):
    out = []
    for i, text in docs:
        n, hit, names = brute.contamination(text, items)
        out.append((i, n, hit, names, hit > 0 and 20 * hit >= n))
    return sorted(out, key=repr)


def planted(seed, vocabulary):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    items = [(k, " ".join(word() for _ in range(rng.choice([1, 2, 5, 13, 14, 40])))) for k in range(12)]
    items += [(50, None), (51, " . "), (None, "null id item here"), (3, "again " * 20)]
    docs = []
    for k in range(40):
        text = [word() for _ in range(rng.randrange(120))]
        if k % 3 == 0:
            own = items[rng.randrange(12)][1].split()
            a = rng.randrange(len(own))
            text[rng.randrange(len(text) + 1) : 0] = own[a : a + rng.randrange(1, 50)]
        docs.append((k, " ".join(text)))
    docs += [(100, None), (101, ""), (102, "..."), (103, "Null, ID! item HERE"), (104, "again " * 300)]
    return docs, items


@pytest.mark.parametrize("seed, vocabulary", [(1, 400), (2, 6), (3, 2)])
def test_hits_equal_brute_force(make, seed, vocabulary):
    docs, items = planted(seed, vocabulary)
    assert found(make.frame(docs, DOCS), make.frame(items, ITEMS)) == expected(docs, items)


def test_blocks_of_items_and_small_shards_give_the_same(make, monkeypatch):
    docs, items = planted(4, 30)
    frames = make.frame(docs, DOCS), make.frame(items, ITEMS)
    assert found(*frames, block_chars=40) == expected(docs, items)
    shard = d._Shard(d.TestSuffixes.of([(str(n), t) for n, t in items], 13))
    texts = [[shard.tests.numbers.get(w, 0) for w in d.words_of((t or "").encode())] for _, t in docs]
    whole = shard.scan(texts)
    monkeypatch.setattr(d, "SHARD_WORDS", 17)
    monkeypatch.setattr(d, "_PAIRS_AT_ONCE", 3)
    assert shard.scan(texts) == whole


def test_longest_match_and_its_places(make):
    item = [f"q{k}" for k in range(30)]
    docs = [(1, " ".join(["x", *item[4:20], "y", *item[2:29], "z"]))]
    got = d.contamination(make.frame(docs, DOCS), make.frame([(8, " ".join(item))], ITEMS))
    match = got.select("found.matches").first()[0]
    assert [tuple(m) for m in match] == [("8", 27, 18, 2)]


def test_suffix_array_is_in_order():
    import numpy as np

    rng = np.random.default_rng(0)
    words = np.concatenate([rng.integers(0, 3, 500), np.zeros(40, int)])
    at = np.flatnonzero(words[:500] > 0)
    array = d.suffix_array(words, at, 20)
    keys = [tuple(words[p : p + 20]) for p in array]
    assert keys == sorted(keys) and sorted(array) == at.tolist()


def test_columns_stay_and_empty_tables(make, rows):
    docs = make.frame([(1, "clean text", "a"), (2, "one two three", None)],
                      "doc_id long, text string, found string").withColumns({"row": F.lit(1), "n_words": F.lit(2)})
    items = make.frame([(1, "two three"), (1, "two three")], ITEMS)
    kept = d.without_contaminated(docs, items)
    assert kept.columns == docs.columns and rows(kept) == [(1, "clean text", "a", 1, 2)]
    assert d.without_contaminated(docs, items.limit(0)).count() == 2
    assert d.without_contaminated(docs.limit(0), items).count() == 0
