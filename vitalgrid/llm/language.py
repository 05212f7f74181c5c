"""Language identification: a bidirectional gated recurrent network over bytes.

A text is read as UTF-8 bytes in windows of ``WINDOW``. One gated recurrent layer runs over each window
forwards and one backwards; from both states a softmax labels every byte, and the probabilities of all
bytes of the document are pooled. The network is trained in numpy by backpropagation through time on
windows drawn from a bounded sample of documents.

Gates use ``0.5 + 0.5 * x / (1 + |x|)`` and the new state ``x / (1 + |x|)``: the shape of the usual curves
at a fraction of their cost, as every byte of the corpus passes through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import crc_remainder
from vitalgrid.llm.tokens import text_slices

WINDOW = 96
HIDDEN = 8
#: expected and most training documents of a language, and windows taken from each
SAMPLE_PER_LANGUAGE = 400
WINDOWS_PER_DOCUMENT = 4
STEPS, BATCH, RATE = 500, 64, 0.02
#: windows computed side by side when scoring: their states stay in the processor's cache
SIDE_BY_SIDE = 2048
UNDETERMINED = "und"
_PAD = 256


def _curve(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _slope(y: np.ndarray) -> np.ndarray:
    """Derivative of the curve, from its value."""
    return (1 - np.abs(y)) ** 2


@dataclass
class Direction:
    """One gated recurrent layer. Columns of the weights: update gate, reset gate, new state."""

    byte: np.ndarray  # (257, 3H): what each byte adds, biases included
    state: np.ndarray  # (H, 3H)

    def run(self, windows: np.ndarray, record: list | None = None) -> np.ndarray:
        """States after each byte, (steps, windows, H); ``windows`` is (steps, windows) of bytes."""
        h = self.state.shape[0]
        steps, n = windows.shape
        states = np.empty((steps + 1, n, h), np.float32)
        states[0] = 0
        gates_w, new_w = self.state[:, :2 * h], self.state[:, 2 * h:]
        for t in range(steps):
            before, added = states[t], self.byte.take(windows[t], axis=0)
            gates = before @ gates_w
            gates += added[:, :2 * h]
            gates = _curve(gates)
            opened = 0.5 + 0.5 * gates
            update, reset = opened[:, :h], opened[:, h:]
            new = (before * reset) @ new_w
            new += added[:, 2 * h:]
            new = _curve(new)
            np.subtract(new, before, out=states[t + 1])
            states[t + 1] *= update
            states[t + 1] += before
            if record is not None:
                record.append((gates, opened, new))
        return states

    def backward(self, windows: np.ndarray, states: np.ndarray, record: list, error: np.ndarray):
        """Gradients of the weights, given the error at each state (steps, windows, H)."""
        h = self.state.shape[0]
        byte, state = np.zeros_like(self.byte), np.zeros_like(self.state)
        carried = np.zeros_like(error[0])
        for t in reversed(range(len(windows))):
            gates, opened, new = record[t]
            before = states[t]
            update, reset = opened[:, :h], opened[:, h:]
            total = error[t] + carried
            to_new = total * update * _slope(new)
            to_update = total * (new - before) * 0.5 * _slope(gates[:, :h])
            to_reset_state = to_new @ self.state[:, 2 * h:].T
            to_reset = to_reset_state * before * 0.5 * _slope(gates[:, h:])
            into = np.concatenate([to_update, to_reset, to_new], axis=1)
            np.add.at(byte, windows[t], into)
            state[:, :2 * h] += before.T @ into[:, :2 * h]
            state[:, 2 * h:] += (before * reset).T @ to_new
            carried = total * (1 - update) + to_reset_state * reset + into[:, :2 * h] @ self.state[:, :2 * h].T
        return byte, state


@dataclass
class Network:
    languages: list[str]
    forwards: Direction
    backwards: Direction
    output: np.ndarray  # (2H, languages)
    offset: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return [self.forwards.byte, self.forwards.state, self.backwards.byte, self.backwards.state,
                self.output, self.offset]

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Label probabilities of every byte, (steps, windows, languages)."""
        h = self.forwards.state.shape[0]
        ahead = self.forwards.run(windows)[1:]
        back = self.backwards.run(windows[::-1])[:0:-1]
        scores = ahead @ self.output[:h] + back @ self.output[h:] + self.offset
        scores -= scores.max(-1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(-1, keepdims=True)
        return scores

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean log loss over all bytes that are not padding; ``labels`` one to a window."""
        h = self.forwards.state.shape[0]
        notes_a, notes_b = [], []
        ahead = self.forwards.run(windows, notes_a)
        flipped = windows[::-1]
        back = self.backwards.run(flipped, notes_b)
        both = np.concatenate([ahead[1:], back[:0:-1]], axis=2)
        scores = both @ self.output + self.offset
        scores -= scores.max(-1, keepdims=True)
        error = np.exp(scores)
        error /= error.sum(-1, keepdims=True)
        error[:, np.arange(len(labels)), labels] -= 1
        counted = (windows != _PAD)[..., None]
        error *= counted / max(1, counted.sum())
        output = np.einsum("tnh,tnl->hl", both, error)
        into = error @ self.output.T
        return [*self.forwards.backward(windows, ahead, notes_a, into[..., :h]),
                *self.backwards.backward(flipped, back, notes_b, into[::-1, :, h:]),
                output, error.sum((0, 1))]


def fresh_network(languages: list[str], seed: int = 11, hidden: int = HIDDEN) -> Network:
    rng = np.random.default_rng(seed)

    def normal(*shape: int) -> np.ndarray:
        return rng.normal(0, 0.3, shape).astype(np.float32)

    def direction() -> Direction:
        byte = normal(257, 3 * hidden)
        byte[:, :hidden] -= 1.0  # states change slowly at first
        byte[_PAD] = 0
        return Direction(byte, normal(hidden, 3 * hidden))

    return Network(languages, direction(), direction(), normal(2 * hidden, len(languages)),
                   np.zeros(len(languages), np.float32))


def windows_of(data: bytes, window: int = WINDOW) -> np.ndarray:
    """The bytes in windows side by side, (window, number); the last one is padded."""
    codes = np.frombuffer(data, np.uint8)
    n = -(-len(codes) // window)
    padded = np.full(n * window, _PAD, np.int16)
    padded[:len(codes)] = codes
    return padded.reshape(n, window).T


def train(examples: dict[str, list[bytes]], seed: int = 11, steps: int = STEPS) -> Network:
    """Backpropagation through time with running means of gradients (Adam); languages are drawn evenly."""
    languages = sorted(examples)
    network = fresh_network(languages, seed)
    pools = [np.concatenate([windows_of(x) for x in examples[k]], axis=1) for k in languages]
    rng = np.random.default_rng(seed)
    weights = network.weights()
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        labels = rng.integers(0, len(languages), BATCH)
        drawn = np.stack([pools[k][:, rng.integers(0, pools[k].shape[1])] for k in labels], axis=1)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for w, g, m, v in zip(weights, network.gradients(drawn, labels), first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (rate / (1 - 0.9 ** step)) * m / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return network


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def classify(texts: list[str | None], network: Network) -> tuple[list[str], list[float]]:
    """Language and pooled probability of each text: the mean over all its bytes.

    A text that is null, empty or has no letter is ``und`` with probability 0.
    """
    found, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    if not network.languages:
        return found, scores
    owners, pieces, sizes = [], [], np.zeros(len(texts))
    total = np.zeros((len(texts), len(network.languages)))

    def flush() -> None:
        if not pieces:
            return
        windows = np.concatenate(pieces, axis=1)
        owner = np.repeat(owners, [p.shape[1] for p in pieces])
        for i in range(0, windows.shape[1], SIDE_BY_SIDE):
            part = np.ascontiguousarray(windows[:, i:i + SIDE_BY_SIDE])
            chances = network.probabilities(part)
            chances *= (part != _PAD)[..., None]
            np.add.at(total, owner[i:i + SIDE_BY_SIDE], chances.sum(0))
        owners.clear()
        pieces.clear()

    waiting = 0
    for i, text in enumerate(texts):
        if not has_letter(text):
            continue
        data = text.encode("utf-8", "surrogatepass")
        sizes[i] = len(data)
        # a long text in several goes, so that memory does not grow with it
        step = WINDOW * SIDE_BY_SIDE
        for at in range(0, len(data), step):
            pieces.append(windows_of(data[at:at + step]))
            owners.append(i)
            waiting += pieces[-1].shape[1]
            if waiting >= 4 * SIDE_BY_SIDE:
                flush()
                waiting = 0
    flush()
    for i in np.flatnonzero(sizes):
        best = int(total[i].argmax())
        found[i] = network.languages[best]
        scores[i] = min(1.0, float(total[i, best] / sizes[i]))
    return found, scores


def _windows_drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some windows of each training text, spread over the whole of it."""
    for batch in batches:
        drawn = []
        for text in batch.column(2):
            data = (text.as_py() or "").encode("utf-8", "surrogatepass")
            span = max(0, len(data) - WINDOW)
            starts = sorted({span * i // max(1, WINDOWS_PER_DOCUMENT - 1) for i in range(WINDOWS_PER_DOCUMENT)})
            drawn.append([data[s:s + WINDOW] for s in starts if data])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(drawn, pa.list_(pa.binary()))], names=["doc_id", "lang", "drawn"])


def learnable(docs: DataFrame) -> DataFrame:
    """Documents that may be learned from; a quarter of the ids is held out."""
    return docs.where((crc_remainder("doc_id", 4) != 2) & F.col("lang").isNotNull())


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, seed: int = 11) -> Network:
    """Train on a sample of ``docs(doc_id, text, lang)``: about ``per_language`` documents of each language.

    A document is in the sample if a hash of its id falls below its language's share, so the sample is
    the same on every run; at most four times the expected number are taken.
    """
    sizes = {r["lang"]: r["n"] for r in docs.where("lang is not null").groupBy("lang").agg(
        F.count("*").alias("n")).collect()}
    if not sizes:
        return fresh_network([], seed)
    shares = docs.sparkSession.createDataFrame(
        [(k, min(1.0, per_language / n)) for k, n in sizes.items()], "_lang string, _share double")
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    sample = docs.select("doc_id", "lang", F.col("text").cast("string").alias("text")).join(
        F.broadcast(shares), F.col("lang") == F.col("_lang")).where(chance < F.col("_share")).select(
        "doc_id", "lang", "text")
    kind = dict(sample.dtypes)["doc_id"]
    drawn = sample.mapInArrow(_windows_drawn, f"doc_id {kind}, lang string, drawn array<binary>")
    rows = drawn.orderBy(F.xxhash64("doc_id"), "doc_id", F.hash("drawn")).limit(4 * per_language * len(sizes)).collect()
    examples: dict[str, list[bytes]] = {}
    for row in rows:
        examples.setdefault(row["lang"], []).extend(bytes(x) for x in row["drawn"])
    examples = {k: v for k, v in examples.items() if v}
    return train(examples, seed) if examples else fresh_network([], seed)


def _predict(batches: Iterator[pa.RecordBatch], network: Network) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        found, scores = classify(batch.column(1).to_pylist(), network)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.string()), pa.array(scores, pa.float64())],
            names=["doc_id", "lang_pred", "score"])


def identify(docs: DataFrame, network: Network) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row, from its whole text and nothing else.

    Null and empty texts and those without a letter are ``und`` with score 0, as is every text if
    nothing could be learned. Repeated rows and null ids are kept; an empty table gives no rows; other
    columns are ignored.
    """
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = dict(chosen.dtypes)["doc_id"]
    return chosen.mapInArrow(
        lambda batches: _predict(batches, network), f"doc_id {kind}, lang_pred string, score double")
