"""Toxicity by the nearest labelled examples under TF-IDF cosine.

The fit takes a bounded sample of labelled documents, chooses the terms that go with the
label, and stores the examples as an inverted index: for every term the examples that hold
it with their weights, cut into blocks, and the largest weight of each block. A document's
neighbours are searched exactly: the block maxima bound the cosine of all examples of a
block, blocks are opened from the highest bound down, and the search ends when no bound
reaches the k-th cosine found. Neighbours vote with their cosine; a calibration fitted on
the examples, each scored without itself, turns votes into probabilities.

Terms are whole words and, for what these leave unexplained, words' beginnings and their
repeats, which catch compounds.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import bounded_sample, map_batches, slices, text_bytes

#: Labelled documents in the index at most.
EXAMPLES = 4000
#: Terms at most, those that depend most on the label.
TERMS = 4096
NEIGHBOURS = 25
BLOCK = 64
#: Chi-squared of a term and the label, from which it is a term of the index: six documents
#: or more at a tenth of toxic ones.
_LEAST_CHI = 45.0
#: Lengths of words' beginnings, and the number of occurrences that are told apart.
STEMS = (4, 5, 7)
REPEATS = 3
# ASCII characters other than letters end a word; A-Z are lowered.
_TABLE = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256)).lower()


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def stems_of(words: list[bytes]) -> Iterator[bytes]:
    """Beginnings of the longer words, each as often as it occurs."""
    for size in STEMS:
        yield from [w[:size] + b"*" for w in words if len(w) > size]


def repeats(counts: Mapping[bytes, int]) -> Iterator[bytes]:
    """A term for every time that a beginning occurs, up to ``REPEATS``."""
    for stem, n in counts.items():
        for k in range(2, min(n, REPEATS) + 1):
            yield b"%b%d" % (stem, k)


@dataclass
class Index:
    """Examples by term, in blocks, and the calibration.

    Examples with one vector are one entry with its number of rows and toxic rows; postings
    of term t are ``entries[first[t]:first[t + 1]]`` with ``weights``, and ``maxima`` has
    their largest weight by (term, block). ``evidence`` is a document id of each entry.
    """

    terms: dict[bytes, int]
    stems: frozenset[bytes]
    idf: np.ndarray
    entries: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    first: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    maxima: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    rows: np.ndarray = field(default_factory=lambda: np.zeros(0))
    toxic: np.ndarray = field(default_factory=lambda: np.zeros(0))
    evidence: list = field(default_factory=list)
    prior: float = 0.0
    blank: float = 0.0
    slope: float = 1.0
    offset: float = 0.0

    def vector(self, text: bytes | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
        """Terms and unit TF-IDF weights of a text; empty if it holds no term."""
        words = words_of(text)
        counts = Counter(filter(self.terms.__contains__, words))
        stems = Counter(filter(self.stems.__contains__, stems_of(words)))
        counts.update(t for t in (*stems, *repeats(stems)) if t in self.terms)
        known = sorted((self.terms[t], n) for t, n in counts.items())
        if not known:
            return (), ()
        weights = np.array([(1 + np.log(n)) * self.idf[t] for t, n in known])
        weights /= np.sqrt((weights**2).sum())
        return tuple(t for t, _ in known), tuple(np.round(weights, 12))

    def cosines(self, terms, weights, low: int, high: int) -> np.ndarray:
        """Exact cosines with the entries ``low`` to ``high``."""
        total = np.zeros(high - low)
        for t, w in zip(terms, weights):
            a, b = self.first[t], self.first[t + 1]
            a, b = a + np.searchsorted(self.entries[a:b], [low, high])
            total[self.entries[a:b] - low] += w * self.weights[a:b]
        return total

    def nearest(self, terms, weights, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Entries with the k largest positive cosines, counted in rows, ties included.

        ``without`` leaves one row of that entry out.
        """
        bounds = np.zeros(self.maxima.shape[1])
        for t, w in zip(terms, weights):
            bounds += w * self.maxima[t]
        found, near = np.zeros(0, np.int64), np.zeros(0)
        least = 0.0
        for block in np.argsort(-bounds, kind="stable"):
            # a bound may be a rounding error short of a cosine that it bounds
            if bounds[block] <= 0 or bounds[block] + 1e-9 < least:
                break
            low = int(block) * BLOCK
            high = min(low + BLOCK, self.rows.size)
            cosine = np.round(self.cosines(terms, weights, low, high), 9)
            keep = np.flatnonzero((cosine > 0) & (cosine >= least))
            found = np.concatenate([found, low + keep])
            near = np.concatenate([near, cosine[keep]])
            order = np.lexsort((found, -near))
            found, near = found[order], near[order]
            many = np.cumsum(self.rows[found] - (found == without))
            if many.size and many[-1] >= k:
                least = near[np.searchsorted(many, k)]
                found, near = found[near >= least], near[near >= least]
        return found, near

    def vote(self, found, near, without: int = -1, label: float = 0.0) -> float:
        """Share of toxic rows among the neighbours by cosine, with a little of the prior."""
        rows, toxic = self.rows[found] * 1.0, self.toxic[found] * 1.0
        own = found == without
        rows[own] -= 1
        toxic[own] -= label
        return float((near @ toxic + self.prior) / (near @ rows + 1))

    def score(self, text: bytes | None) -> tuple[float, list]:
        """Calibrated probability, and the ids of the neighbours that weigh most."""
        terms, weights = self.vector(text)
        if not terms:
            return self.blank, []
        found, near = self.nearest(terms, weights, NEIGHBOURS)
        return self.calibrated(self.vote(found, near)), [self.evidence[i] for i in found[:3]]

    def calibrated(self, vote):
        return 1 / (1 + np.exp(-(self.slope * vote + self.offset)))


def build(samples: list[tuple[bytes, int, object]]) -> Index:
    """An index from (text, label 0 or 1, document id)."""
    labels = np.array([y for _, y, _ in samples], float)
    n, p = len(samples), float(labels.mean()) if len(samples) else 0.0
    split = [words_of(text) for text, _, _ in samples]
    whole = [set(words) for words in split]
    chosen, frequent = _strongest(whole, labels)
    # what words' beginnings add, in the examples that no chosen word explains
    rest = [k for k in range(n) if not whole[k] & chosen.keys()]
    begun = []
    for k in rest:
        stems = Counter(stems_of(split[k]))
        begun.append({*stems, *repeats(stems)})
    more, frequent_more = _strongest(begun, labels[rest])
    terms = sorted({**chosen, **more}, key=lambda t: (-{**chosen, **more}[t], t))[:TERMS]
    df = {**frequent, **frequent_more}
    index = Index(
        {t: k for k, t in enumerate(terms)},
        frozenset(t[: t.index(b"*") + 1] for t in terms if b"*" in t),
        np.array([np.log((1 + n) / (1 + df[t])) + 1 for t in terms]),
        prior=p,
    )
    groups: dict[tuple, list] = {}
    blank = []
    for (text, y, name) in samples:
        vector = index.vector(text)
        if vector[0]:
            groups.setdefault(vector, []).append((y, name))
        else:
            blank.append(y)
    index.blank = (sum(blank) + p) / (len(blank) + 1)
    _post(index, groups)
    _calibrate(index, groups)
    return index


def _strongest(sets: list, labels: np.ndarray) -> tuple[dict, Counter]:
    """Terms that go with the label by chi-squared, and the sets that hold each term."""
    everywhere, with_label = Counter(), Counter()
    for terms, y in zip(sets, labels):
        everywhere.update(terms)
        if y:
            with_label.update(terms)
    p, strength = float(labels.mean()) if len(sets) else 0.0, {}
    for term, df in everywhere.items():
        expected = df * p
        if with_label[term] > expected:
            chi = (with_label[term] - expected) ** 2 / (expected * (1 - p) + 1e-9)
            if chi >= _LEAST_CHI:
                strength[term] = chi
    return strength, everywhere


def _post(index: Index, groups: dict) -> None:
    ordered = sorted(groups)
    index.rows = np.array([len(groups[v]) for v in ordered], float)
    index.toxic = np.array([sum(y for y, _ in groups[v]) for v in ordered], float)
    index.evidence = [min((n for _, n in groups[v] if n is not None), default=None) for v in ordered]
    index.maxima = np.zeros((len(index.terms), -(-len(ordered) // BLOCK)))
    postings = sorted(
        (t, entry, w) for entry, (terms, weights) in enumerate(ordered) for t, w in zip(terms, weights)
    )
    index.entries = np.array([e for _, e, _ in postings], np.int64)
    index.weights = np.array([w for _, _, w in postings])
    of = np.array([t for t, _, _ in postings], np.int64)
    index.first = np.searchsorted(of, np.arange(len(index.terms) + 1))
    np.maximum.at(index.maxima, (of, index.entries // BLOCK), index.weights)


def _calibrate(index: Index, groups: dict) -> None:
    """A logistic curve through the votes of the examples, each without its own row."""
    votes, labels = [0.0, 1.0], [0.0, 1.0]
    for entry, (terms, weights) in enumerate(sorted(groups)):
        found, near = index.nearest(terms, weights, NEIGHBOURS, without=entry)
        for y in (0.0, 1.0):
            many = index.toxic[entry] if y else index.rows[entry] - index.toxic[entry]
            if many:
                votes += [index.vote(found, near, entry, y)] * int(many)
                labels += [y] * int(many)
    x = np.stack([np.array(votes), np.ones(len(votes))], 1)
    y, fitted = np.array(labels), np.array([1.0, -0.5])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ fitted, -30, 30)))
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        fitted += np.linalg.solve(bend, x.T @ (y - p) - 0.1 * (fitted - [1.0, -0.5]))
    index.slope, index.offset = float(fitted[0]), float(fitted[1])


def fit(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    rows: int = EXAMPLES,
) -> Index:
    """Indexes the texts of at most ``rows`` labels that are 0 or 1, chosen by hashes of their ids."""
    label = F.col(label_column)
    usable = labels.where(label.isin(0, 1) & F.col(id_column).isNotNull()).select(
        id_column, label.cast("int").alias("_label")
    )
    chosen = F.broadcast(bounded_sample(usable, id_column, rows))  # EXAMPLES small rows at most
    # further columns of the documents may have any name
    texts = documents.where(F.col(text_column).isNotNull()).select(id_column, F.col(text_column).alias("_text"))
    found = texts.join(chosen, id_column).select(
        F.col("_text").alias("t"), F.col("_label").alias("y"), F.col(id_column).alias("id")
    )
    samples = bounded_sample(found, "id", rows).collect()
    return build(sorted((r["t"].encode(), r["y"], r["id"]) for r in samples))


def score(
    documents: DataFrame, index: Index, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, score, evidence): the probability that label 1 holds, and the nearest examples' ids.

    A null or empty text, or one that shares no term with the index, gets the share of label 1
    among such examples and no evidence. Repeated rows stay. An index of no examples gives 0.
    Evidence is a list of whole numbers, or of strings if ids are of another type.
    """
    kind = documents.schema[id_column].dataType.simpleString()
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    listed, made = ("bigint", pa.int64()) if whole else ("string", pa.string())
    shown = int if whole else str
    shared = documents.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512):
            found = [shared.value.score(text) for text in text_bytes(batch.column(1))]
            scores = pa.array([float(s) for s, _ in found], pa.float64())
            evidence = pa.array([[shown(e) for e in near if e is not None] for _, near in found],
                                pa.list_(made))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), scores, evidence], names=["id", "score", "evidence"]
            )

    source = documents.select(F.col(id_column).alias("id"), F.col(text_column))
    return map_batches(source, run, f"id {kind}, score double, evidence array<{listed}>")
