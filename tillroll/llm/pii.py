"""Personal data by candidate gradient boosting.

Generators with high recall propose overlapping spans of four kinds; among them are all
spans that the strict base patterns find. Boosted trees score each other candidate by its
format and its surroundings, the scores are calibrated on held-out candidates, and those
above a threshold become redactions beside the base spans.

The trees are trained here on a bounded sample of documents, on candidates that the base
patterns do not see. Their truth is planted: of the base spans of a text some are written anew
in a form that only the generators know (positive), some give way to look-alikes such as
versions, prices, dates and serial numbers (negative), all in the surroundings of real ones.
Candidates that the text holds besides are negative. Planting follows the text alone, so a
rerun gives the same.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import bounded_sample, map_batches, slices, stored

KINDS = ("email", "ip", "card", "phone")
#: Documents with digits or an at sign that the trees are trained on, at most.
TRAINING_ROWS = 3000
#: Times that each of them is planted, with other spans and forms.
PLANTINGS = 8
#: Candidates of these that come to the driver, at most.
TRAINING_CANDIDATES = 20_000
#: Calibrated probability from which a candidate that is no base span is redacted.
THRESHOLD = 0.95
_ROUNDS, _DEPTH, _BINS, _RATE = 40, 3, 32, 0.2
_AROUND = 24

# The base patterns. The lookbehinds only skip starts inside a run of digits,
# where no leftmost match can start; they keep long runs linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")

# Generators: wider than the base patterns, they may overlap each other.
_WIDE = {
    "email": re.compile(
        r"(?<![\w.%+-])[\w.%+-]{1,64} ?(?:@|\(at\)|\[at\]) ?[\w-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]) ?[\w-]{1,63}){1,8}"
    ),
    "ip": re.compile(r"(?<![\w.])[0-9]{1,4}(?: ?[.,:_-] ?[0-9]{1,4}){3}(?![\w.])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[\x20._/-]{0,2}[0-9]){11,22}(?![0-9])"),
    "phone": re.compile(r"(?<![\w+])(?:\+|00)?\(?[0-9](?:[\x20()./-]{0,3}[0-9]){6,14}(?![0-9])"),
}

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Matches of the email pattern, found from each at sign so that long words cost once."""
    last, at = 0, text.find("@")
    while at >= 0:
        start, domain = at, _DOMAIN.match(text, at + 1)
        if domain:
            while start > last and (text[start - 1].isalnum() and text[start - 1].isascii()
                                    or text[start - 1] in "._%+-"):
                start -= 1
            if start < at:
                yield "email", start, domain.end()
                last = domain.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[Span]:
    """Spans of the strict patterns: leftmost matches of each kind that pass its check."""
    spans = list(_emails(text)) if "@" in text else []
    for match in _IP.finditer(text):
        parts = match[0].split(".")
        if all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in parts):
            spans.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in match[0]) <= 15:
                spans.append(("phone", *match.span()))
    return in_order(spans)


def in_order(spans: list[Span]) -> list[Span]:
    """By start, then kind as listed, then end."""
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def candidates(text: str) -> list[Span]:
    """What the generators propose, all kinds together."""
    if not re.search(r"[0-9]{2}|@|\(at\)|\[at\]", text):
        return []
    return [(k, *m.span()) for k, pattern in _WIDE.items() for m in pattern.finditer(text)]


def features(text: str, span: Span) -> list[float]:
    """Format of a candidate and what stands around it; no validator's result is among them."""
    kind, start, end = span
    own = text[start:end]
    before, after = text[max(0, start - _AROUND) : start], text[end : end + _AROUND]
    digits = sum(c.isdigit() for c in own)
    runs = [len(r) for r in re.findall(r"[0-9]+", own)] or [0]
    left, right = before[-1:], after[:1]
    return [
        KINDS.index(kind), len(own), digits, digits / len(own), len(runs), max(runs), min(runs),
        own.count("."), own.count("-"), own.count(" "), own.count("("), own.count(")"), own.count("@"),
        own.count("+"), own.count(",") + own.count("_") + own.count("/") + own.count(":"),
        sum(c.isalpha() for c in own), float(own[:1] == "+"), float(own[:1] == "0"),
        float(left.isalnum()), float(left.isspace() or not left), float(left in "\"'=#"),
        float(right.isalnum()), float(right.isspace() or not right), float(right in "\"'%"),
        float(right in ".,;"), sum(c.isdigit() for c in before), sum(c.isdigit() for c in after),
        float("=" in before[-3:]), float(bool(re.search(r"[0-9a-f]{6,}\Z", before))),
        float(bool(re.match(r"[0-9a-f]{6,}", after))),
    ]


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Trees:
    """Boosted trees of fixed depth over binned features, and the calibration of their sums."""

    cuts: list[np.ndarray]
    feature: np.ndarray  # tree, inner node
    bin: np.ndarray
    leaf: np.ndarray  # tree, leaf
    slope: float = 1.0
    offset: float = 0.0

    @staticmethod
    def bins(cuts: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, rows[:, k], "right") for k, c in enumerate(cuts)], 1)

    def raw(self, rows: np.ndarray) -> np.ndarray:
        binned, total = self.bins(self.cuts, rows), np.zeros(len(rows))
        index = np.arange(len(rows))
        for feature, cut, leaf in zip(self.feature, self.bin, self.leaf):
            node = np.zeros(len(rows), np.int64)
            for _ in range(_DEPTH):
                node = 2 * node + 1 + (binned[index, feature[node]] > cut[node])
            total += leaf[node - (2**_DEPTH - 1)]
        return total

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return _logistic(self.slope * self.raw(rows) + self.offset)


def boost(rows: np.ndarray, labels: np.ndarray, held: np.ndarray) -> Trees:
    """Logistic gradient boosting on the rows not held out, calibrated on those held out."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, _BINS)[1:-1])) for c in rows.T]
    binned = Trees.bins(cuts, rows)
    inner, leaves = 2**_DEPTH - 1, 2**_DEPTH
    trees = Trees(cuts, *(np.zeros((_ROUNDS, n), np.int64) for n in (inner, inner)),
                  np.zeros((_ROUNDS, leaves)))
    x, y = binned[~held], labels[~held].astype(float)
    total = np.zeros(len(y))
    for tree in range(_ROUNDS):
        p = _logistic(total)
        slope, bend = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for at in range(inner):
            own = np.flatnonzero(node == at)
            trees.feature[tree, at], trees.bin[tree, at] = _split(x[own], slope[own], bend[own])
            go = x[own, trees.feature[tree, at]] > trees.bin[tree, at]
            node[own] = 2 * at + 1 + go
        node -= inner
        g, h = np.bincount(node, slope, leaves), np.bincount(node, bend, leaves)
        trees.leaf[tree] = _RATE * g / (h + 1.0)
        total += trees.leaf[tree][node]
    _calibrate(trees, rows[held], labels[held])
    return trees


def _split(x: np.ndarray, slope: np.ndarray, bend: np.ndarray) -> tuple[int, int]:
    """The feature and bin with the largest gain; ties go to the first."""
    best = (1e-9, 0, _BINS)
    for k in range(x.shape[1]) if len(x) else ():
        g = np.cumsum(np.bincount(x[:, k], slope, _BINS + 1))
        h = np.cumsum(np.bincount(x[:, k], bend, _BINS + 1))
        gain = g**2 / (h + 1) + (g[-1] - g) ** 2 / (h[-1] - h + 1) - g[-1] ** 2 / (h[-1] + 1)
        at = int(gain.argmax())
        if gain[at] > best[0]:
            best = (float(gain[at]), k, at)
    return best[1], best[2]


def _calibrate(trees: Trees, rows: np.ndarray, labels: np.ndarray) -> None:
    """Platt scaling: a logistic curve from tree sums to the share of positives."""
    if len(rows) == 0:
        return
    raw = trees.raw(rows)
    # targets a little inside 0 and 1, by the numbers of each class
    n = labels.sum()
    target = np.where(labels, (n + 1) / (n + 2), 1 / (len(labels) - n + 2))
    x = np.stack([raw, np.ones(len(raw))], 1)

    def loss(weights: np.ndarray) -> float:
        # a small ridge keeps the curve finite where the classes are separate
        z = x @ weights
        return float((np.logaddexp(0, z) - target * z).sum() + 0.05 * (weights**2).sum())

    weights = np.array([1.0, 0.0])
    for _ in range(100):
        p = _logistic(x @ weights)
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        step, share = np.linalg.solve(bend, x.T @ (target - p) - 0.1 * weights), 1.0
        while share > 1e-6 and loss(weights + share * step) >= loss(weights):
            share /= 2
        if share <= 1e-6:  # at the minimum
            break
        weights = weights + share * step
    trees.slope, trees.offset = float(weights[0]), float(weights[1])


def disguised(kind: str, own: str, rng: random.Random) -> str:
    """A base span in a form that the generators know and the base patterns do not."""
    if kind == "email":
        dot = rng.choice([".", "(dot)", " (dot) ", "[dot]"])
        local, domain = own.split("@", 1)
        return local + rng.choice(["(at)", "[at]", " (at) ", " @ "]) + domain.replace(".", dot)
    if kind == "ip":
        return own.replace(".", rng.choice([",", " . ", "-", ":", "_"]))
    if kind == "card":
        digits = re.sub("[^0-9]", "", own)
        return rng.choice([".", "/", "_", "  "]).join(digits[k : k + 4] for k in range(0, len(digits), 4))
    form = rng.randrange(3)
    return ("00" + own[1:], own[1:], re.sub(r"[\x20.()-]+", "/", own))[form]


def look_alike(rng: random.Random) -> str:
    """Digits that are no personal data: a version, price, date, serial or order number."""
    def some(low: int, high: int) -> int:
        return rng.randint(low, high)

    return rng.choice([
        f"version {some(1, 20)}.{some(0, 30)}.{some(0, 9)}.{some(300, 9999)}",
        f"{some(1, 99)},{some(100, 999)},{some(100, 999)}.{some(10, 99)} USD",
        f"20{some(10, 29)}-0{some(1, 9)}-{some(10, 28)} {some(10, 23)}:{some(10, 59)}:{some(10, 59)}",
        f"SN-{some(0, 10**14):016d}",
        f"order {some(10**7, 10**8)}-{some(100, 999)}",
        f"{some(10, 99)}.{some(10, 99)}.{some(1000, 9999)} - {some(10, 99)}.{some(10, 99)}.{some(1000, 9999)}",
    ])


def planted(text: str, again: int = 0) -> tuple[str, list[Span]]:
    """The text with a third of its base spans disguised and a third replaced by look-alikes,
    and where the disguised ones are; ``again`` gives other choices."""
    rng = random.Random(zlib.crc32(text.encode("utf-8", "replace"), again))
    parts, spans, at, length = [], [], 0, 0
    for kind, start, end in base_spans(text):
        if start < at:
            continue
        form = rng.randrange(3)
        own = (text[start:end], None, None)[form] or (
            disguised(kind, text[start:end], rng) if form == 1 else look_alike(rng)
        )
        parts += [text[at:start], own]
        length += start - at
        if form == 1:
            spans.append((kind, length, length + len(own)))
        length, at = length + len(own), end
    return "".join([*parts, text[at:]]), spans


def found_again(span: Span, real: list[Span]) -> bool:
    """Whether a span is of the kind of a real one and shares four fifths of both with it."""
    kind, start, end = span
    return any(
        k == kind and 5 * (min(end, b) - max(start, a)) >= 4 * (max(end, b) - min(start, a)) for k, a, b in real
    )


def examples(text: str) -> list[tuple[list[float], bool]]:
    """Features and truth of the candidates that touch no base span, after planting."""
    made = []
    for again in range(PLANTINGS):
        changed, real = planted(text, again)
        base = base_spans(changed)
        other = [span for span in candidates(changed) if not _covered(span, base)]
        made += [(features(changed, span), found_again(span, real)) for span in other]
        if changed == text and not base:  # nothing to plant
            break
    return made


def fit(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rows: int = TRAINING_ROWS,
) -> Trees | None:
    """Trains on candidates of at most ``rows`` texts, chosen by hashes of their ids.

    Texts stay with the tasks; the driver gets the features of at most ``TRAINING_CANDIDATES``
    candidates. Rows without an id are not trained on. Without candidates of both classes
    there are no trees, and only base spans are found.
    """
    source = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("t"))
    usable = source.where(F.col("t").rlike("[0-9]{2}|@") & F.col("id").isNotNull())
    chosen = F.broadcast(bounded_sample(usable.select("id"), "id", rows))  # ``rows`` ids at most
    texts = usable.join(chosen.distinct(), "id").select(F.col("id").cast("string").alias("id"), "t")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            keys, rows, labels = [], [], []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for k, (row, real) in enumerate(examples(text)):
                    keys.append(f"{name}:{k}")
                    rows.append(row)
                    labels.append(real)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(rows, pa.list_(pa.float64())), pa.array(labels, pa.bool_())],
                names=["key", "row", "real"],
            )

    rows_made = stored(map_batches(texts, made, "key string, row array<double>, real boolean"), "pii-candidates")
    taken = sorted(tuple(r) for r in bounded_sample(rows_made, "key", TRAINING_CANDIDATES).collect())
    labels = np.array([real for _, _, real in taken], bool)
    if len(set(labels.tolist())) < 2:
        return None
    # whole texts are held out for the calibration
    held = np.array([zlib.crc32(key.rsplit(":", 1)[0].encode()) % 4 == 0 for key, _, _ in taken])
    return boost(np.array([row for _, row, _ in taken]), labels, held)


def _covered(span: Span, base: list[Span]) -> bool:
    return any(s[1] < span[2] and span[1] < s[2] for s in base)


def find(text: str, trees: Trees | None, threshold: float = THRESHOLD) -> tuple[list[Span], list[Span]]:
    """Base spans, and those with the selected candidates that touch no base span or better one."""
    base = base_spans(text)
    other = [s for s in candidates(text) if not _covered(s, base)] if trees else []
    if not other:
        return base, base
    sure = trees.probability(np.array([features(text, s) for s in other]))
    taken: list[Span] = []
    for k in sorted(np.flatnonzero(sure >= threshold), key=lambda k: (-sure[k], other[k][1:], other[k])):
        if not _covered(other[k], taken):
            taken.append(other[k])
    return base, in_order(base + taken)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def personal_data(
    documents: DataFrame,
    trees: Trees | None,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: numbers of base spans, their digest, and all spans.

    Places count code points, the end exclusive. Null and empty texts have no spans.
    Repeated rows stay; further columns are not read.
    """
    kind = documents.schema[id_column].dataType.simpleString()
    shared = documents.sparkSession.sparkContext.broadcast(trees)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512):
            numbers, digests, all_spans = [], [], []
            for text in batch.column(1).to_pylist():
                base, spans = find(text or "", shared.value, threshold)
                count = Counter(s[0] for s in base)
                numbers.append([count[k] for k in KINDS])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                all_spans.append(joined(spans))
            columns = [pa.array([n[k] for n in numbers], pa.int64()) for k in range(4)]
            columns += [pa.array(x, pa.string()) for x in (digests, all_spans)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns],
                names=["id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    source = documents.select(F.col(id_column).alias("id"), F.col(text_column))
    return map_batches(source, scan, f"id {kind}, {FOUND}")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans as one."""
    listed = F.transform(
        F.filter(F.split(spans, ","), lambda s: s != ""), lambda s: F.split(s, ":")
    )
    start = F.aggregate(
        listed,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda done, s: F.when(
            s[2].cast("int") > done["at"],
            F.struct(
                F.concat(
                    done["out"],
                    F.when(
                        s[1].cast("int") >= done["at"],
                        F.concat(
                            F.substring(text, done["at"] + 1, s[1].cast("int") - done["at"]),
                            F.lit("["), s[0], F.lit("]"),
                        ),
                    ).otherwise(F.lit("")),
                ).alias("out"),
                s[2].cast("int").alias("at"),
            ),
        ).otherwise(done),
    )
    return F.concat(start["out"], F.substring(text, start["at"] + 1, F.length(text)))
