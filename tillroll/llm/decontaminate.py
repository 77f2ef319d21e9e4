"""Benchmark decontamination with suffix arrays over the training documents.

Each task cuts its documents into shards of ``SHARD_WORDS`` words and builds a suffix array
of every shard. The suffixes of all test items are binary-searched in each of them. A test
suffix that shares a window with a training suffix is extended to its longest verbatim
match, and the words of a document inside such matches are its hits.

Words are numbered by the vocabulary of the test items. A training suffix can match only if
its first words occur in that order in some item, so the array of a shard leaves the others
out; results are those of the full array.

The test items are broadcast in blocks of at most about ``BLOCK_CHARS`` characters, one
pass over the documents for each block; hits are handed from pass to pass inside the row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import map_batches, slices, text_bytes

WINDOW_WORDS = 13
SHARD_WORDS = 1 << 17
BLOCK_CHARS = 16 << 20
_ANCHOR_WORDS = 4
_PAIRS_AT_ONCE = 1 << 20
# ASCII characters other than letters and digits end a word; A-Z are lowered.
_TABLE = bytes(
    byte if byte >= 0x80 or chr(byte).isalnum() else 0x20 for byte in range(256)
).lower()

MATCH = "struct<item:string,words:bigint,doc_start:bigint,item_start:bigint>"
FOUND = (
    "n_words long, spans array<struct<first:bigint,last:bigint>>, "
    f"items array<string>, matches array<{MATCH}>"
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


@dataclass
class TestSuffixes:
    """The suffixes of a block of items that are at least one window long.

    ``words`` holds all items' word numbers, each item ended by -1. A suffix starts at
    ``at`` and must match ``need`` words. ``owner`` is the item's index in ``names``, -1
    where an item has no id.
    """

    numbers: dict[bytes, int]
    words: np.ndarray
    at: np.ndarray
    need: np.ndarray
    owner: np.ndarray
    start: np.ndarray
    names: list[str]
    anchor: int

    @classmethod
    def of(cls, items: list[tuple[str | None, str | None]], window: int) -> TestSuffixes:
        numbers: dict[bytes, int] = {}
        words, at, need, owner, start = [], [], [], [], []
        names = sorted({name for name, _ in items if name is not None})
        place = {name: k for k, name in enumerate(names)}
        for name, text in items:
            item = [numbers.setdefault(w, len(numbers) + 1) for w in words_of((text or "").encode())]
            size = min(window, len(item))
            for k in range(len(item) - size + 1) if item else ():
                at.append(len(words) + k)
                start.append(k)
                need.append(size)
                owner.append(place.get(name, -1))
            words += [*item, -1]
        made = [np.array(x, np.int64) for x in (words, at, need, owner, start)]
        return cls(numbers, *made, names, min([_ANCHOR_WORDS, *need]))


def _anchors(words: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """One number for the ``length`` words at each place; different runs may share one."""
    code = np.zeros(at.size, np.uint64)
    for k in range(length):
        code = code * np.uint64(0x9E3779B97F4A7C15) + words[at + k].astype(np.uint64)
    return code


def suffix_array(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The places ``at`` in the order of their suffixes' first ``depth`` words or more.

    Prefix doubling over all places' ranks; ``words`` must end with ``depth`` numbers below
    those of any word.
    """
    if at.size == 0:
        return at
    keys = np.zeros((at.size, 0), np.int64)
    order, rank = np.arange(at.size), np.zeros(at.size, np.int64)
    done = 0
    while done < depth:
        # the next words of suffixes that are still tied; others keep their rank
        step = min(4, depth - done)
        keys = np.stack([words[at + done + k] for k in range(step)][::-1] + [rank])
        order = np.lexsort(keys)
        ordered = keys[:, order]
        new = np.any(ordered[:, 1:] != ordered[:, :-1], axis=0)
        rank[order] = np.concatenate([[0], np.cumsum(new)])
        done += step
        if new.all():
            break
    return at[order]


def _compare(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray, need: np.ndarray):
    """-1, 0 or 1: the first ``need`` words at ``at_a`` against those at ``at_b``."""
    sign = np.zeros(at_a.size, np.int64)
    open_ = np.arange(at_a.size)
    for k in range(int(need.max(initial=0))):
        open_ = open_[need[open_] > k]
        if not open_.size:
            break
        step = np.sign(a[at_a[open_] + k] - b[at_b[open_] + k])
        sign[open_] = step
        open_ = open_[step == 0]
    return sign


def search(
    words: np.ndarray, array: np.ndarray, tests: TestSuffixes, chosen: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """First and past-last places in the suffix array that match each chosen test suffix."""
    bounds = []
    for strict in (False, True):
        low = np.zeros(chosen.size, np.int64)
        high = np.full(chosen.size, array.size)
        while (active := np.flatnonzero(low < high)).size:
            middle = (low[active] + high[active]) // 2
            sign = _compare(
                words, array[middle], tests.words, tests.at[chosen[active]], tests.need[chosen[active]]
            )
            right = sign <= 0 if strict else sign < 0
            low[active[right]] = middle[right] + 1
            high[active[~right]] = middle[~right]
        bounds.append(low)
    return bounds[0], bounds[1]


def _extend(words: np.ndarray, p: np.ndarray, tests: TestSuffixes, q: np.ndarray) -> np.ndarray:
    """Words that the training suffix at ``p`` and the test suffix at ``q`` share."""
    length = np.zeros(p.size, np.int64)
    open_ = np.arange(p.size)
    while open_.size:
        same = words[p[open_] + length[open_]] == tests.words[q[open_] + length[open_]]
        open_ = open_[same]
        length[open_] += 1
    return length


class _Shard:
    """Word numbers of one or more documents, each ended by 0, with their longest matches."""

    def __init__(self, tests: TestSuffixes):
        self.tests = tests
        self.known = np.sort(_anchors(tests.words, tests.at, tests.anchor))
        self.depth = int(tests.need.max(initial=1))

    def scan(self, documents: list[list[int]]) -> list[tuple[list, dict]]:
        """For each document its hit spans and, by item, the longest match and its places."""
        tests = self.tests
        sizes = np.array([len(d) + 1 for d in documents], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        words = np.zeros(int(starts[-1]) + self.depth, np.int64)
        for first, document in zip(starts, documents):
            words[first : first + len(document)] = document
        found: list[tuple[list, dict]] = [([], {}) for _ in documents]
        hit = np.zeros(words.size + 1, np.int64)
        for low in range(0, int(starts[-1]), SHARD_WORDS):
            self._shard(words, low, min(low + SHARD_WORDS, int(starts[-1])), starts, hit, found)
        covered = np.cumsum(hit) > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
        for first, last in edges.reshape(-1, 2):
            doc = int(np.searchsorted(starts, first, "right")) - 1
            found[doc][0].append((int(first - starts[doc]), int(last - starts[doc])))
        return found

    def _shard(self, words, low, high, starts, hit, found) -> None:
        tests = self.tests
        at = low + np.flatnonzero(words[low:high] > 0)
        codes = _anchors(words, at, tests.anchor)
        near = np.searchsorted(self.known, codes)
        at = at[self.known[np.minimum(near, self.known.size - 1)] == codes]
        if not at.size:
            return
        array = suffix_array(words, at, self.depth)
        here = np.unique(_anchors(words, at, tests.anchor))
        chosen = np.flatnonzero(np.isin(_anchors(tests.words, tests.at, tests.anchor), here))
        first, last = search(words, array, tests, chosen)
        some = last > first
        chosen, first, last = chosen[some], first[some], last[some]
        begin = 0
        while begin < chosen.size:
            # as many test suffixes at once as have a bounded number of matches
            many = np.cumsum(last[begin:] - first[begin:])
            end = begin + max(1, int(np.searchsorted(many, _PAIRS_AT_ONCE, "right")))
            count = last[begin:end] - first[begin:end]
            test = np.repeat(chosen[begin:end], count)
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            p = array[place + np.repeat(first[begin:end], count)]
            begin = end
            np.add.at(hit, p, 1)
            np.add.at(hit, p + tests.need[test], -1)
            # a match is reported from its first word: the words before must differ
            q = tests.at[test]
            opens = (p == 0) | (tests.start[test] == 0)
            opens |= words[p - 1] != tests.words[q - 1]
            opens &= tests.owner[test] >= 0
            p, q, test = p[opens], q[opens], test[opens]
            length = _extend(words, p, tests, q)
            doc = np.searchsorted(starts, p, "right") - 1
            # for each document and item the longest, then the first
            order = np.lexsort((tests.start[test], p, -length, tests.owner[test], doc))
            doc, owner = doc[order], tests.owner[test][order]
            lead = np.ones(order.size, bool)
            lead[1:] = (doc[1:] != doc[:-1]) | (owner[1:] != owner[:-1])
            for k in np.flatnonzero(lead):
                j = order[k]
                match = (int(length[j]), int(p[j] - starts[doc[k]]), int(tests.start[test[j]]))
                name = tests.names[owner[k]]
                best = found[doc[k]][1].get(name)
                if best is None or (-match[0], match[1:]) < (-best[0], best[1:]):
                    found[doc[k]][1][name] = match


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if merged and first <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], last))
        else:
            merged.append((first, last))
    return merged


def _pass(tests):
    """Adds one block of items to what the passes before have found in each document."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard(tests.value)
        get = tests.value.numbers.get
        for batch in slices(batches, 256):
            earlier = batch.column("found").to_pylist()
            documents = [[get(w, 0) for w in words_of(t)] for t in text_bytes(batch.column("text"))]
            results: list[tuple[list, dict]] = []
            first = 0
            while first < len(documents):
                last, size = first + 1, len(documents[first])
                while last < len(documents) and size + len(documents[last]) < SHARD_WORDS:
                    size += len(documents[last])
                    last += 1
                results += shard.scan(documents[first:last])
                first = last
            made = []
            for document, (spans, best), old in zip(documents, results, earlier):
                if old is not None:
                    spans += [(s["first"], s["last"]) for s in old["spans"]]
                    for m in old["matches"]:
                        was = (m["words"], m["doc_start"], m["item_start"])
                        now = best.get(m["item"], was)
                        best[m["item"]] = min(was, now, key=lambda x: (-x[0], x[1:]))
                made.append(
                    {
                        "n_words": len(document),
                        "spans": [{"first": f, "last": l} for f, l in _merge(spans)],
                        "items": sorted(best),
                        "matches": [
                            dict(item=i, words=best[i][0], doc_start=best[i][1], item_start=best[i][2])
                            for i in sorted(best)
                        ],
                    }
                )
            column = pa.array(made, type=batch.schema.field("found").type)
            place = batch.schema.get_field_index("found")
            yield batch.set_column(place, batch.schema.field("found"), column)

    return scan


def contamination(
    documents: DataFrame,
    items: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW_WORDS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(row, found): each document whole as a struct, and what the items have in common with it.

    ``found`` holds n_words, the hit word ``spans`` (first, past last), the sorted ``items``
    with occurring windows and their longest ``matches`` with places in both texts. An item
    shorter than the window is one window; an item without words matches nothing; the
    windows of items without an id count as hits but are not listed, and rows that share an
    id are one item. Null and empty documents have no words. Repeated documents are kept as
    they are. Without items nothing is found.
    """
    spark = documents.sparkSession
    listed = items.select(
        F.col(item_column).cast("string").alias("id"), F.col(item_text_column).alias("text")
    )
    total = listed.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    frame = documents.select(
        F.struct("*").alias("row"),
        F.col(text_column).alias("text"),
        F.lit(None).cast(f"struct<{_struct(FOUND)}>").alias("found"),
    )
    block = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    for k in range(blocks):
        # each block is a bounded share of the items; only one is on the driver at a time
        rows = [tuple(r) for r in listed.where(block == k).collect()]
        tests = spark.sparkContext.broadcast(TestSuffixes.of(rows, window))
        frame = map_batches(frame, _pass(tests), frame.schema)
    return frame.select("row", "found")


def _struct(columns: str) -> str:
    """Column definitions ``a long, b array<...>`` as the fields of a struct type."""
    out, depth = [], 0
    for part in columns.replace(", ", ",").split(","):
        if depth == 0:
            part = part.replace(" ", ":", 1)
        out.append(part)
        depth += part.count("<") - part.count(">")
    return ",".join(out)


def n_hit(found: str = "found"):
    spans = F.col(f"{found}.spans")
    return F.aggregate(
        spans, F.lit(0).cast("long"), lambda total, s: total + s["last"] - s["first"]
    )


def contaminated(found: str = "found"):
    """Whether a twentieth or more of a document's words are hit."""
    return (n_hit(found) > 0) & (20 * n_hit(found) >= F.col(f"{found}.n_words"))


def without_contaminated(documents: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, that are not contaminated by the items."""
    return (
        contamination(documents, items, **options).where(~contaminated()).select("row.*")
    )
