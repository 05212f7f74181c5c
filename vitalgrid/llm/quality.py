"""Quality classifier: supervised subword embeddings.

Words, the character n-grams inside them and pairs of neighbouring words are hashed to rows of one table
of learned vectors. A document is the average of the vectors of all its features; a softmax over the two
labels follows. Table and output are trained by stochastic gradient descent in numpy on a bounded sample
of labelled documents. A trained table is folded with the output into one number for each row, so whole
texts are scored by adding numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import crc_remainder, handing_back
from vitalgrid.llm.near_dedup import mix64
from vitalgrid.llm.tokens import Numbers, text_slices

ROWS = 1 << 18
DIMENSIONS = 16
NGRAMS = (3, 4)
#: most training documents of each label
SAMPLE_PER_LABEL = 1500
#: passes over the sample, and the fewest single steps, for small samples
EPOCHS, LEAST_STEPS = 6, 6000
RATE = 0.5
THRESHOLD = 0.3
#: features without meaning that every document has besides its own, so that few words decide little
BLANKS = 50
REMEMBERED_WORDS = 150_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _row(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (mix64(hashes + np.uint64(kind * int(_ODD) % 2 ** 64)) % np.uint64(ROWS)).astype(np.int64)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table rows of the features inside each word, whose word each is, and a hash of each word.

    All words at once: n-grams are rolling hashes over the joined words, bounded by marks.
    """
    coded = [w.encode("utf-8", "surrogatepass") for w in words]
    data = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in coded), np.uint8).astype(np.uint64)
    size = np.array([len(w) + 2 for w in coded], np.int64)
    ends = np.cumsum(size)
    owner = np.repeat(np.arange(len(words)), size)
    left = ends[owner] - np.arange(len(data))  # bytes of the word from here on
    # whole words: position-dependent sums of mixed bytes
    place = size[owner] - left
    mixed = mix64(data * _ODD + place.astype(np.uint64))
    whole = mix64(np.add.reduceat(mixed, ends - size)) if len(words) else np.zeros(0, np.uint64)
    rows, owners = [_row(whole, 1)], [np.arange(len(words))]
    hashes, width = data + np.uint64(1), 1
    for n in NGRAMS:
        while width < n:
            hashes = hashes[:-1] * _ODD + data[width:] + np.uint64(1)
            width += 1
        inside = np.flatnonzero(left[:len(hashes)] >= n)
        rows.append(_row(hashes[inside], n))
        owners.append(owner[inside])
    return np.concatenate(rows), np.concatenate(owners), whole


class Features:
    """Splits texts into numbered words and remembers the features of each word."""

    def __init__(self):
        self.number = Numbers()
        self.known = 0

    def numbered(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Word numbers of all texts, number of words of each text, and the new words."""
        words: list[str] = []
        counts = []
        for text in texts:
            found = text.split() if text else []
            words.extend(found)
            counts.append(len(found))
        at = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        new = self.number.after(self.known)
        self.known += len(new)
        return at, np.array(counts, np.int64), new


def _pairs(whole: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of neighbouring words, and the text of each pair."""
    text = np.repeat(np.arange(len(counts)), counts)
    inside = np.flatnonzero(text[1:] == text[:-1]) if len(text) else np.zeros(0, np.int64)
    first, second = whole[inside], whole[inside + 1]
    # a word and itself are one pair for all words: what marks stuttering is not the word
    return _row(np.where(first == second, np.uint64(1), first * _ODD + second), 2), text[inside]


@dataclass(frozen=True)
class Model:
    """``weight`` of each table row and ``bias``: log odds of label 1 are the average weight plus bias."""

    weight: np.ndarray
    bias: float

    def scorer(self):
        return _Scorer(self)


class _Scorer:
    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.features = Features()
        self.sums = np.zeros(0)
        self.sizes = np.zeros(0)
        self.whole = np.zeros(0, np.uint64)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.features.known > REMEMBERED_WORDS:
            self._forget()
        at, counts, new = self.features.numbered(texts)
        if new:
            rows, owners, whole = word_features(new)
            self.sums = np.concatenate([self.sums, np.bincount(owners, self.model.weight[rows], len(new))])
            self.sizes = np.concatenate([self.sizes, np.bincount(owners, minlength=len(new))])
            self.whole = np.concatenate([self.whole, whole])
        n = len(counts)
        text = np.repeat(np.arange(n), counts)
        rows, of = _pairs(self.whole[at], counts)
        total = np.bincount(text, self.sums[at], n) + np.bincount(of, self.model.weight[rows], n)
        size = np.bincount(text, self.sizes[at], n) + np.bincount(of, minlength=n)
        logit = total / (size + BLANKS) + self.model.bias
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def text_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct table rows of a whole text and how often each occurs."""
    features = Features()
    at, counts, new = features.numbered([text])
    if not new:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    rows, owners, whole = word_features(new)
    times = np.bincount(at, minlength=len(new))
    pairs, _ = _pairs(whole[at], counts)
    found, inverse = np.unique(np.concatenate([rows, pairs]), return_inverse=True)
    often = np.bincount(inverse, np.concatenate([times[owners], np.ones(len(pairs))]))
    return found.astype(np.int32), often.astype(np.float32)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            rows, often = text_features(batch.column(2)[i].as_py())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1),
                 pa.array([rows.tobytes()], pa.binary()), pa.array([often.tobytes()], pa.binary())],
                names=["doc_id", "label", "rows", "often"])


def train(examples: list[tuple[int, np.ndarray, np.ndarray]], prior: float, seed: int = 7) -> Model:
    """Stochastic gradient descent, one document at a time, in an order fixed by ``seed``.

    Both labels take part equally often. ``prior`` is the share of label 1 among all labelled
    documents; how it differs from one half goes into the bias.
    """
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1, 1, (ROWS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    output = np.zeros((DIMENSIONS, 2), np.float32)
    offset = np.zeros(2, np.float32)
    of_label = [np.array([i for i, e in enumerate(examples) if e[0] == k], np.int64) for k in (0, 1)]
    present = [x for x in of_label if len(x)]
    passes = max(EPOCHS, -(-LEAST_STEPS // max(1, len(examples))))
    steps, done = passes * sum(max(map(len, present)) for _ in present), 0
    for _ in range(passes if present else 0):
        most = max(map(len, present))
        even = np.concatenate([np.resize(rng.permutation(x), most) for x in present])
        for i in rng.permutation(even):
            label, rows, often = examples[i]
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            share = often / (often.sum() + BLANKS)
            hidden = share @ table[rows] if len(rows) else np.zeros(DIMENSIONS, np.float32)
            scores = hidden @ output + offset
            error = np.exp(scores - scores.max())
            error /= error.sum()
            error[label] -= 1
            back = output @ error
            output -= rate * np.outer(hidden, error)
            offset -= rate * error * np.float32(0.1)
            # every feature takes a full share of the error, as features are many and rare
            table[rows] -= rate * np.minimum(share * 20, 1)[:, None] * back
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    shift = np.log(prior / (1 - prior)) if len(present) == 2 else 0.0
    weight = table @ (output[:, 1] - output[:, 0])
    return Model(weight.astype(np.float64), float(offset[1] - offset[0] + shift))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL, seed: int = 7) -> Model:
    """Train on at most ``per_label`` documents of each label, those with the smallest id hashes.

    ``labels`` (``doc_id, quality``) says which documents may be learned from; where a document has
    several labels the smallest counts, null labels and labels other than 0 and 1 are left out.
    Without labels the model gives 0.5 to every text.
    """
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(
        F.min("quality").cast("int").alias("label"))
    numbers = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    drawn = known.where("label = 0").orderBy(*by_hash).limit(per_label).unionAll(
        known.where("label = 1").orderBy(*by_hash).limit(per_label))
    # at most 2 * per_label ids
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        F.broadcast(drawn), "doc_id").select("doc_id", "label", "text")
    kind = dict(texts.dtypes)["doc_id"]
    rows = texts.mapInArrow(lambda batches: handing_back(_extract(batches)), f"doc_id {kind}, label int, rows binary, often binary")
    found = sorted(rows.dropDuplicates(["doc_id"]).collect(), key=lambda r: r["doc_id"])
    examples = [(r["label"], np.frombuffer(r["rows"], np.int32), np.frombuffer(r["often"], np.float32)) for r in found]
    total = sum(numbers.values())
    return train(examples, numbers.get(1, 0) / total if total else 0.5, seed)


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    scorer = model.scorer()
    for batch in text_slices(batches, "_text"):
        found = scorer.scores(batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found)], names=[*batch.schema.names[1:], "score"])


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``score`` of every row, from its whole text and nothing else.

    Null and empty texts get the score of a text without features. Repeated rows, null ids and other
    columns are of no effect; an empty table gives no rows.
    """
    chosen = docs.select(F.col("text").cast("string").alias("_text"), *keep)
    schema = ", ".join(f"`{c}` {t}" for c, t in chosen.dtypes[1:]) + ", score double"
    return chosen.mapInArrow(lambda batches: handing_back(_score(batches, model)), schema)


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns, in one scan."""
    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in text_slices(batches, "text"):
            yield batch.filter(pa.array(scorer.scores(batch.column("text").to_pylist()) >= threshold))

    return docs.mapInArrow(lambda batches: handing_back(good(batches)), docs.schema)


def learnable(labels: DataFrame) -> DataFrame:
    """Labels that may be learned from; a fifth of the ids is held out."""
    return labels.where(crc_remainder("doc_id", 5) != 0)
