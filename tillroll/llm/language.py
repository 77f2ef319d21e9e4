"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of ``WINDOW_BYTES`` bytes in both directions, gives every byte a
distribution over the languages, and a document's probabilities are the mean over its
letter bytes. All windows of a document count. It is trained here in numpy by
backpropagation through time, on a bounded sample of labelled documents.

Gates are piecewise linear (clipped) instead of logistic, which numpy computes several times faster.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import bounded_sample, map_batches, slices, text_bytes

#: Labelled documents used for the fit, at most: those with the smallest hashes.
TRAINING_ROWS = 2000
WINDOW_BYTES = 128
HIDDEN = 8
_TRAIN_BYTES = 48
_BATCH = 128
_STEPS = 400
_WINDOWS_AT_ONCE = 2048
UNDETERMINED = "und"


@dataclass
class Network:
    """Weights: input (2, 3H, 256), recurrent (2, 3H, H), output (languages, 2H) and bias."""

    languages: list[str]
    inputs: np.ndarray
    recurrent: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def label(self, windows: np.ndarray) -> np.ndarray:
        """Probabilities (time, language, window) for byte windows (time, window)."""
        time, many = windows.shape
        size = self.recurrent.shape[2]
        states = np.empty((2, time, size, many), np.float32)
        mixed = np.empty((3 * size, many), np.float32)
        read = np.empty((3 * size, many), np.float32)
        for way in (0, 1):
            state = np.zeros((size, many), np.float32)
            for step in range(time) if way == 0 else range(time - 1, -1, -1):
                np.take(self.inputs[way], windows[step], axis=1, out=read, mode="clip")
                np.matmul(self.recurrent[way], state, out=mixed)
                gates = read[: 2 * size]
                gates += mixed[: 2 * size]
                np.clip(gates, 0, 1, out=gates)
                fresh = mixed[2 * size :]
                fresh *= gates[:size]
                fresh += read[2 * size :]
                np.clip(fresh, -1, 1, out=fresh)
                state -= fresh
                state *= gates[size:]
                state += fresh
                states[way, step] = state
        scores = np.matmul(self.output[:, :size], states[0])
        scores += np.matmul(self.output[:, size:], states[1])
        scores += self.bias[:, None]
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores


def train(samples: list[tuple[bytes, str]], seed: int = 7) -> Network:
    """Fits the network to labelled texts; without any it knows no language."""
    languages = sorted({label for _, label in samples})
    random = np.random.default_rng(seed)
    size, kinds = HIDDEN, max(1, len(languages))
    weights = {
        "inputs": random.normal(0, 0.3, (2, 3 * size, 256)).astype(np.float32),
        "recurrent": random.normal(0, 0.3, (2, 3 * size, size)).astype(np.float32),
        "output": random.normal(0, 0.3, (kinds, 2 * size)).astype(np.float32),
        "bias": np.zeros(kinds, np.float32),
    }
    weights["inputs"][:, : 2 * size] += 0.5  # the middle of a clipped gate
    if len(languages) > 1:
        _descend(weights, samples, languages, random)
    return Network(languages, **weights)


def _descend(weights, samples, languages, random) -> None:
    # windows of a language are drawn alike often, whatever its share of the sample
    by_language = [
        [np.frombuffer(t, np.uint8) for t, label in samples if label == name] for name in languages
    ]
    by_language = [[t for t in texts if t.size] or [np.zeros(1, np.uint8)] for texts in by_language]
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in weights.items()}
    for step in range(1, _STEPS + 1):
        labels = random.integers(0, len(languages), _BATCH)
        x = np.zeros((_TRAIN_BYTES, _BATCH), np.int64)
        for k, y in enumerate(labels):
            text = by_language[y][random.integers(len(by_language[y]))]
            at = random.integers(max(1, text.size - _TRAIN_BYTES + 1))
            piece = text[at : at + _TRAIN_BYTES]
            x[: piece.size, k] = piece
        rate = 0.01 * (1 - 0.9 * step / _STEPS)
        for name, slope in _slopes(weights, x, labels).items():
            first, second = moment[name]
            first += 0.1 * (slope - first)
            second += 0.001 * (slope * slope - second)
            scaled = first / (1 - 0.9**step)
            weights[name] -= rate * scaled / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)


def _slopes(weights, x, labels) -> dict[str, np.ndarray]:
    """Gradient of the mean cross-entropy of every position, through time in both directions."""
    time, many = x.shape
    size = HIDDEN
    inputs, recurrent, output = weights["inputs"], weights["recurrent"], weights["output"]
    kept = {}
    states = np.zeros((2, time + 2, size, many), np.float32)  # with a zero state at both ends
    for way in (0, 1):
        for step in range(time) if way == 0 else range(time - 1, -1, -1):
            old = states[way, step] if way == 0 else states[way, step + 2]
            mixed = recurrent[way] @ old
            read = inputs[way][:, x[step]]
            raw = read[: 2 * size] + mixed[: 2 * size]
            gates = np.clip(raw, 0, 1)
            fresh_raw = read[2 * size :] + gates[:size] * mixed[2 * size :]
            fresh = np.clip(fresh_raw, -1, 1)
            states[way, step + 1] = fresh + gates[size:] * (old - fresh)
            kept[way, step] = (old, mixed, raw, gates, fresh_raw, fresh)
    both = np.concatenate([states[0, 1:-1], states[1, 1:-1]], axis=1)
    scores = np.matmul(output, both) + weights["bias"][:, None]
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    scores /= scores.sum(axis=1, keepdims=True)
    scores[:, labels, np.arange(many)] -= 1
    scores /= time * many
    slope = {name: np.zeros_like(value) for name, value in weights.items()}
    slope["output"] = np.einsum("tlb,thb->lh", scores, both)
    slope["bias"] = scores.sum(axis=(0, 2))
    back = np.matmul(output.T, scores)
    for way in (0, 1):
        carried = np.zeros((size, many), np.float32)
        for step in range(time - 1, -1, -1) if way == 0 else range(time):
            old, mixed, raw, gates, fresh_raw, fresh = kept[way, step]
            d = carried + back[step, way * size : (way + 1) * size]
            d_fresh = d * (1 - gates[size:]) * ((fresh_raw > -1) & (fresh_raw < 1))
            inside = (raw > 0) & (raw < 1)
            d_gates = np.concatenate([d_fresh * mixed[2 * size :], d * (old - fresh)]) * inside
            d_mixed = np.concatenate([d_gates, d_fresh * gates[:size]])
            d_read = np.concatenate([d_gates, d_fresh])
            read_at = np.zeros((256, many), np.float32)
            read_at[x[step], np.arange(many)] = 1
            slope["inputs"][way] += d_read @ read_at.T
            slope["recurrent"][way] += d_mixed @ old.T
            carried = d * gates[size:] + recurrent[way].T @ d_mixed
    return slope


def fit(
    labelled: DataFrame,
    text_column: str,
    label_column: str,
    id_column: str = "doc_id",
    rows: int = TRAINING_ROWS,
) -> Network:
    """Trains on at most ``rows`` rows with text and label, chosen by hashes of their ids.

    Windows are drawn from anywhere in the whole texts.
    """
    text, label = F.col(text_column), F.col(label_column)
    usable = labelled.where(text.isNotNull() & (text != "") & label.isNotNull()).select(
        text.alias("text"), label.cast("string").alias("label"), F.col(id_column).alias("id")
    )
    chosen = bounded_sample(usable, "id", rows).collect()
    return train(sorted((r["text"].encode(), r["label"]) for r in chosen))


def _letters() -> np.ndarray:
    """Bytes that belong to letters, all bytes outside ASCII among them."""
    return np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])


def _identify(network):
    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = network.value
        letter = _letters()
        kinds = len(net.languages)
        for batch in slices(batches, 256):
            texts = text_bytes(batch.column("text"))
            pooled = np.zeros((len(texts), max(1, kinds)))
            counted = np.zeros(len(texts))
            for owners, block in _windows(texts):
                if kinds < 2:
                    continue
                labelled = net.label(np.ascontiguousarray(block.T))
                mask = letter[block.T]
                labelled *= mask[:, None, :]
                np.add.at(pooled, owners, labelled.sum(axis=0).T)
                np.add.at(counted, owners, mask.sum(axis=0))
            if kinds == 1:
                counted[:] = pooled[:, 0] = 1
            pooled /= np.maximum(counted, 1)[:, None]
            best = pooled.argmax(axis=1)
            known = (counted > 0) & (kinds > 0)
            names = [
                net.languages[k] if ok and has_letter(t) else UNDETERMINED
                for t, k, ok in zip(texts, best, known)
            ]
            score = [
                float(pooled[i, k]) if name != UNDETERMINED else 0.0
                for i, (k, name) in enumerate(zip(best, names))
            ]
            place = batch.schema.get_field_index("found")
            field = batch.schema.field("found")
            made = pa.array(
                [{"lang": n, "score": min(1.0, s)} for n, s in zip(names, score)], type=field.type
            )
            yield batch.set_column(place, field, made)

    return identify


def has_letter(text: bytes | None) -> bool:
    """Whether a text has a letter of any script."""
    if not text:
        return False
    return text.isalpha() or any(c.isalpha() for c in text.decode("utf-8", "replace"))


def _windows(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of windows (window, time) with their texts' positions; ends are padded with 0."""
    owners: list[np.ndarray] = []
    blocks: list[np.ndarray] = []
    held = 0
    for row, text in enumerate(texts):
        data = text or b""
        for first in range(0, len(data), WINDOW_BYTES * _WINDOWS_AT_ONCE):
            piece = data[first : first + WINDOW_BYTES * _WINDOWS_AT_ONCE]
            many = -(-len(piece) // WINDOW_BYTES)
            piece = piece.ljust(many * WINDOW_BYTES, b"\0")
            blocks.append(np.frombuffer(piece, np.uint8).reshape(many, WINDOW_BYTES))
            owners.append(np.full(many, row))
            held += many
            if held >= _WINDOWS_AT_ONCE:
                yield np.concatenate(owners), np.concatenate(blocks)
                owners, blocks, held = [], [], 0
    if held:
        yield np.concatenate(owners), np.concatenate(blocks)


def identify(documents: DataFrame, network: Network, text_column: str = "text") -> DataFrame:
    """(row, found): each document whole as a struct, its language and score.

    ``found.lang`` is a learned label, or ``und`` with score 0 for a text that is null or
    has no letter; ``found.score`` is the pooled probability of that language. Repeated
    rows and further columns stay as they are; an empty table gives an empty result. A
    network trained on a single label gives it to all; one trained on none gives ``und``.
    """
    shared = documents.sparkSession.sparkContext.broadcast(network)
    frame = documents.select(
        F.struct("*").alias("row"),
        F.col(text_column).alias("text"),
        F.lit(None).cast("struct<lang:string,score:double>").alias("found"),
    )
    return map_batches(frame, _identify(shared), frame.schema).select("row", "found")


def accepted(found: str = "found", least_score: float = 0.3) -> Column:
    """Documents of a known language whose pooled probability is not below ``least_score``."""
    return (F.col(f"{found}.lang") != UNDETERMINED) & (F.col(f"{found}.score") >= least_score)
