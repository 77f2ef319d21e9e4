import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from brute import ASCII_LOWER
from conftest import TESTDATA

from tillroll.llm import common, spelling
from tillroll.llm.queries import QUERIES


def plain_words(rows):
    """{word: n} of (doc_id, text) rows."""
    counts = Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII_LOWER)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def near_words(words):
    """{word: set of words one edit away}, by the words that result from leaving out letters."""
    masked, near = defaultdict(set), defaultdict(set)
    for w in words:
        for k in range(len(w)):
            masked[w[:k], w[k + 1 :]].add(w)
            cut = w[:k] + w[k + 1 :]
            if cut in words:
                near[w].add(cut)
                near[cut].add(w)
    for group in masked.values():
        for w in group:
            near[w] |= group - {w}
    return near


def plain_variants(words, times=10):
    near = near_words(words)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(rows, key=repr)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def ours(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=repr)


def test_query_equals_brute_force(spark):
    folder = f"{TESTDATA}/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    expected = plain_variants(plain_words(rows))
    assert any(r[1] is not None for r in expected) and len(expected) > 1000
    assert ours(QUERIES["op13_trie_frontier"](spark, folder)) == expected


def frame(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


@pytest.mark.parametrize("least", [1, 7])
def test_random_words_equal_brute_force(spark, least):
    rng = random.Random(least)
    words = {"".join(rng.choices("abé", k=rng.randrange(least, least + 5))): rng.choice([2, 3, 30, 400, 5000]) for _ in range(700)}
    assert ours(spelling.variants(frame(spark, words), least)) == plain_variants(words)


def test_long_words_and_runs_of_letters(spark):
    rng = random.Random(5)
    words = {"a" * k: 10 ** (k % 5) for k in range(7, 90)}
    for size in (23, 24, 25, 26, 35, 36, 37, 54, 60, 3000):
        for _ in range(3):
            own = "".join(rng.choices("xyzµàÿ", k=size))
            words[own] = 50_000
            for k in {0, 1, size // 2, size - 2, size - 1}:
                words[own[:k] + own[k + 1 :]] = 3
                words[own[:k] + "q" + own[k:]] = 2
                words[own[:k] + "Q" + own[k + 1 :]] = 4000
            words[own + "q"] = 7
    assert ours(spelling.variants(frame(spark, words))) == plain_variants(words)


def test_hot_nodes_are_salted(spark, monkeypatch):
    rng = random.Random(8)
    words = {"common" + "".join(rng.choices("abcd", k=rng.randrange(1, 6))): rng.choice([2, 50]) for _ in range(900)}
    monkeypatch.setattr(spelling, "_NODE_WORDS", 20)
    assert ours(spelling.variants(frame(spark, words))) == plain_variants(words)


def test_spread_joins_lose_and_repeat_nothing(spark):
    left = spark.createDataFrame([(k, "hot" if k < 500 else None if k < 510 else f"k{k}") for k in range(900)], "id long, key string")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k600", 3), ("none", 4)], "key string, x int")
    for how in ("inner", "left"):
        plain = left.join(right, "key", how)
        found = common.join_spread(left, right, ["key"], left["id"] * 7, how, key_rows=16)
        assert sorted(map(repr, found.select("id", "key", "x").collect())) == sorted(map(repr, plain.select("id", "key", "x").collect()))


def test_slips_and_odd_texts(spark, tmp_path):
    rng = random.Random(1)
    rows = [(k, " ".join("".join(rng.choices("abÀÿ÷×B", k=9)) for _ in range(4))) for k in range(200)]
    rows += [(1, rows[1][1]), (None, "Nothing nothing NOTHING nothin"), (9, None), (10, ""), (11, "1234 \n\t"),
             (12, "ſpecial speciaL special" * 2), (13, "wordsword " * 30_000), (13, "wordsword " * 30_000), (14, "z" * 20_000), (14, "z" * 20_000)]
    schema = "doc_id long, text string, word string, n long, id int, run string, side int, t string"
    frame = spark.createDataFrame([(*r, "w", 1, 2, "r", 0, "t") for r in rows], schema)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    assert ours(QUERIES["op13_trie_frontier"](spark, str(tmp_path))) == plain_variants(plain_words(rows))


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    words = spelling.vocabulary(spelling.with_slips(spelling.runs(empty)))
    assert spelling.variants(words).collect() == []
