import math
import random
import re
from collections import Counter

import pytest
from conftest import TESTDATA

from tillroll.llm import quality
from tillroll.llm.queries import QUERIES

FOLDER = f"{TESTDATA}/sf0.001"


def base(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, by their definitions."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    often = Counter(runs)
    covered = {k + j for k, run in enumerate(runs) if often[run] > 1 for j in range(8)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


def failed(n_words, _, __, ___, repeated):
    return n_words < 20 or 100 * repeated > 30 * n_words


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def odd_texts():
    rng = random.Random(4)
    few = ["".join(rng.choices("ab é#\n\t ", k=rng.randrange(60))) for _ in range(300)]
    loops = [" ".join(rng.choices(["a", "b"], k=rng.randrange(6, 60))) for _ in range(200)]
    return few + loops + [
        None, "", " \n\t", "a" * 50_000, "word " * 9, " ".join(["x"] * 40_000),
        "1 2 3 4 5 6 7 8 1 2 3 4 5 6 7 8", "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7", "a\x0bb\x0cc\rd\x1ce f",
        "same\nsame\n \n \nsame ", "𝄞 😀 <é>\n𝄞 😀 <é>",
    ]


def test_measures_equal_their_definitions(spark):
    texts = odd_texts()
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.id: tuple(r[n] for n in NAMES) for r in quality.measured(frame).collect()}
    assert found == {k: base(t) for k, t in enumerate(texts)}


@pytest.fixture(scope="module")
def judged(spark):
    return QUERIES["op11_weak_supervision"](spark, f"{TESTDATA}/sf0.01").collect()


def test_query_equals_brute_force(spark, judged):
    documents = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").collect()
    assert len(judged) == len(documents)
    texts = {d.doc_id: d.text for d in documents}
    rules = {r.id: r for r in quality.measured(spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")).collect()}
    votes = {k: tuple(plain_vote(rule, r) for rule in quality.RULES) for k, r in rules.items()}
    good, right = plain_estimate(list(votes.values()))
    for row in judged:
        own = base(texts[row.doc_id])
        assert tuple(row[n] for n in NAMES) == own
        assert row.base_failed == failed(*own)
        p = plain_posterior(votes[row.doc_id], good, right)
        assert math.isclose(p, row.quality, abs_tol=1e-6)
        assert row.kept == (not row.base_failed and row.quality >= 0.5)


def plain_vote(rule, row):
    """A rule by its name, written out."""
    n = row.n_words
    lines = row.n_lines
    x = {
        "length": lambda: n,
        "word_length": lambda: abs(row.word_chars / n - 5.5) if n else None,
        "symbols": lambda: row.n_symbols / n if n else None,
        "repeated_lines": lambda: row.n_dup_lines / lines if lines > 1 else None,
        "repeated_words": lambda: row.n_repeat_words / n if n else None,
        "letters": lambda: row.n_letter_words / n if n else None,
        "sentences": lambda: row.n_closed_lines / lines if lines else None,
        "variety": lambda: row.n_distinct_words / min(n, 2000) if n else None,
    }[rule.name]()
    if x is None:
        return None
    if rule.good < rule.bad:
        return 1 if x <= rule.good else 0 if x >= rule.bad else None
    return 1 if x >= rule.good else 0 if x <= rule.bad else None


def plain_posterior(votes, good, right):
    shares = [good, 1 - good]
    for vote, a, b in zip(votes, *right):
        if vote is not None:
            shares[0] *= a if vote else 1 - a
            shares[1] *= 1 - b if vote else b
    return shares[0] / sum(shares)


def plain_estimate(votes):
    """Expectation-maximisation text by text, a fixed and large number of rounds."""
    good, right = 0.5, [[0.95] * len(votes[0]), [0.3] * len(votes[0])]
    for _ in range(1500):
        p = [plain_posterior(v, good, right) for v in votes]
        a, b = [], []
        for j in range(len(votes[0])):
            asked = [(v[j], q) for v, q in zip(votes, p) if v[j] is not None]
            a.append((9.5 + sum(q for v, q in asked if v)) / (10 + sum(q for _, q in asked)))
            b.append((3.0 + sum(1 - q for v, q in asked if not v)) / (10 + sum(1 - q for _, q in asked)))
        a = [max(0.98, x) for x in a]
        right = [a, [max(1 - x, y) for x, y in zip(a, b)]]
        good = (1 + sum(p)) / (2 + len(p))
    return good, right


def test_verdicts_agree_with_labels_that_were_not_used(spark):
    found = QUERIES["op11_weak_supervision"](spark, f"{TESTDATA}/sf0.1")
    labels = spark.read.parquet(f"{TESTDATA}/sf0.1/labels.parquet")
    rows = found.join(labels, "doc_id").select(labels["quality"].alias("good"), "kept", "base_failed").collect()
    clean = [r for r in rows if r.good == 1 and not r.base_failed]
    poor = [r for r in rows if r.good == 0]
    assert sum(r.kept for r in clean) / len(clean) >= 0.99
    assert sum(not r.kept for r in poor) / len(poor) >= 0.7
    assert sum(not r.kept and not r.base_failed for r in poor) > 100  # beyond the base rules


def test_estimate_finds_planted_accuracies():
    rng = random.Random(3)
    truth = [(0.99, 0.9), (0.99, 0.6), (0.985, 0.8), (0.995, 0.7)]
    counts = Counter()
    for _ in range(60_000):
        good = rng.random() < 0.8
        vote = lambda a, b: None if rng.random() < 0.2 else int((rng.random() < a) if good else (rng.random() >= b))
        counts[tuple(vote(a, b) for a, b in truth)] += 1
    found = quality.estimate(counts, 4)
    assert abs(found.good - 0.8) < 0.02
    assert all(abs(a - x) < 0.02 for (a, _), x in zip(truth, found.right_on_good))
    assert all(abs(b - x) < 0.05 for (_, b), x in zip(truth, found.right_on_bad))


def test_odd_tables(spark):
    schema = "doc_id long, text string, id int, n_words string, quality double, _text int, _words int"
    empty = quality.quality(spark.createDataFrame([], schema))
    assert empty.collect() == []
    rows = [(1, "a b", 7, "x", 0.1, 1, 2), (1, "a b", 7, "x", 0.1, 1, 2), (None, None, None, None, None, None, None),
            (2, "", 1, "", 0.0, 0, 0), (3, "Long text. " * 3000, 1, "", 0.0, 0, 0)]
    found = quality.quality(spark.createDataFrame(rows, schema)).collect()
    assert sorted(str(r.id) for r in found) == ["1", "1", "2", "3", "None"]
    assert all(0 <= r.quality <= 1 and not r.kept for r in found)
    text_ids = spark.createDataFrame([("k", "a b c")], "name string, body string")
    assert quality.quality(text_ids, "name", "body").first().id == "k"
