"""Quality classifier: naive Bayes support vectors.

n-gram indicators of a document are scaled by the log-count ratio of the two classes, and a
linear model with hinge loss is fitted to the scaled rows by dual coordinate descent.  A sigmoid
fitted on rows that the descent did not see turns margins into probabilities.

The n-grams are words and word pairs, repetitions of a word (two to five in a row), and runs of
one to six kinds of characters (capital, small, digit, each mark on its own; neighbours of the
same kind count once).  They are hashed to 2**18 indices, so the model has a fixed size, which is
what is broadcast.

The fit takes at most ``SAMPLE`` labelled rows, those with the least hash of doc_id: a documented
bound on the labels, the same at any size.  Scoring reads every whole text and shuffles nothing.

Nulls and edges: a null text counts as empty and is scored like any other.  Labels that are null
or contradict each other for a doc_id teach nothing.  Without a label 0 every score is 1, with
labels 0 only every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import held_out, save

SAMPLE = 12_000
BITS = 18
THRESHOLD = 0.7
#: Kinds of bytes: capitals, small letters and all beyond ASCII, digits, blanks; other bytes are kinds of their own.
KINDS = np.arange(256, dtype=np.uint64)
KINDS[ord("A") : ord("Z") + 1] = ord("A")
KINDS[ord("a") : ord("z") + 1] = ord("a")
KINDS[0x80:] = ord("a")
KINDS[ord("0") : ord("9") + 1] = ord("0")
KINDS[[9, 10, 11, 12, 13]] = ord(" ")
MIX = np.uint64(0x9E3779B97F4A7C15)


def index(values: np.ndarray, family: int) -> np.ndarray:
    return ((values + np.uint64(family)) * MIX) >> np.uint64(64 - BITS)


def features(text: str | None) -> np.ndarray:
    """Sorted indices of the n-grams that occur in the text."""
    raw = (text or "").encode()
    words = raw.lower().split()
    hashes = np.fromiter(map(crc32, words), dtype=np.uint64, count=len(words)) * MIX
    found = [index(hashes, 1), index(hashes[:-1] * np.uint64(3) + hashes[1:], 2)]
    same = hashes[1:] == hashes[:-1]
    repeats = same
    for n in range(4):
        if not repeats.any():
            break
        found.append(index(np.array([n], dtype=np.uint64), 3))
        repeats = repeats[1:] & same[n + 1 :]
    kinds = KINDS[np.frombuffer(raw, dtype=np.uint8)]
    kinds = kinds[np.append(True, kinds[1:] != kinds[:-1])] if len(kinds) else kinds
    run = np.zeros(len(kinds), dtype=np.uint64)
    for n in range(1, 7):
        if len(kinds) < n:
            break
        run = run[: len(kinds) - n + 1] * np.uint64(257) + kinds[n - 1 :]
        found.append(index(few(run), 10 + n))
    return np.unique(np.concatenate(found)).astype(np.int32)


def few(values: np.ndarray) -> np.ndarray:
    return np.unique(values) if len(values) < 4096 else np.unique(np.concatenate([np.unique(x) for x in np.array_split(values, len(values) // 2048)]))


@dataclass(frozen=True)
class Model:
    """margin = sum of ``weight`` / sqrt(sum of ``square``) + bias; score = 1 / (1 + exp(slope * margin + offset))."""

    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    offset: float
    constant: float | None = None

    def score(self, found: np.ndarray) -> float:
        if self.constant is not None:
            return self.constant
        margin = self.margin(found)
        return float(1 / (1 + np.exp(np.clip(self.slope * margin + self.offset, -500, 500))))

    def margin(self, found: np.ndarray) -> float:
        length = float(self.square[found].sum()) ** 0.5
        return (float(self.weight[found].sum()) / length if length else 0.0) + self.bias


def log_count_ratio(rows: list[np.ndarray], labels: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """Logarithm of the ratio of an n-gram's shares in the two classes, counts smoothed."""
    counts = [np.full(1 << BITS, smoothing) for _ in range(2)]
    for found, label in zip(rows, labels):
        counts[int(label)][found] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def descend(rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, cost: float, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for a linear model with hinge loss; the bias is a feature of value 1."""
    weight, bias, y = np.zeros(1 << BITS), 0.0, np.where(labels > 0, 1.0, -1.0)
    alpha = np.zeros(len(rows))
    curve = np.array([float(v @ v) + 1 for v in values])
    # Each class gets the same total cost.
    most = cost * len(rows) / 2 / np.where(labels > 0, max(1, (labels > 0).sum()), max(1, (labels <= 0).sum()))
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            slope = y[i] * (weight[rows[i]] @ values[i] + bias) - 1
            now = min(max(alpha[i] - slope / curve[i], 0.0), most[i])
            if now != alpha[i]:
                step = (now - alpha[i]) * y[i]
                weight[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = now
        if moved < 1e-3 * cost:
            break
    return weight, bias


def sigmoid(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a sigmoid, by Newton steps on smoothed targets."""
    n1, n0 = (labels > 0).sum(), (labels <= 0).sum()
    target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 0.0, float(np.log((n0 + 1) / (n1 + 1)))

    def loss(a: float, b: float) -> float:
        z = a * margins + b
        return float((target * z + np.logaddexp(0, -z)).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(np.clip(a * margins + b, -500, 500)))
        g, w = target - p, p * (1 - p) + 1e-9
        gradient = np.array([(g * margins).sum(), g.sum()])
        hessian = np.array([[(w * margins**2).sum() + 1e-6, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-6]])
        da, db = np.linalg.solve(hessian, -gradient)
        step = 1.0
        while step > 1e-6 and loss(a + step * da, b + step * db) > loss(a, b):
            step /= 2
        a, b = a + step * da, b + step * db
        if abs(step * da) + abs(step * db) < 1e-7:
            break
    return float(a), float(b)


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, epochs: int = 20, seed: int = 7) -> Model:
    none = np.zeros(0)
    if not len(labels) or labels.min() > 0:
        return Model(none, none, 0, 0, 0, 1.0)
    if labels.max() <= 0:
        return Model(none, none, 0, 0, 0, 0.0)

    def fitted(own: np.ndarray) -> Model:
        ratio = log_count_ratio([rows[i] for i in own], labels[own])
        values = [ratio[rows[i]] / max(1e-12, np.linalg.norm(ratio[rows[i]])) for i in own]
        weight, bias = descend([rows[i] for i in own], values, labels[own], cost, epochs, seed)
        return Model((weight * ratio).astype(np.float32), (ratio**2).astype(np.float32), bias, -1, 0)

    # Margins of each row from a model that has not seen it, for the sigmoid.
    fold = np.arange(len(rows)) % 3
    margins = np.zeros(len(rows))
    for k in range(3):
        own = np.flatnonzero(fold != k)
        if len(np.unique(labels[own] > 0)) == 2:
            part = fitted(own)
            for i in np.flatnonzero(fold == k):
                margins[i] = part.margin(rows[i])
    whole = fitted(np.arange(len(rows)))
    slope, offset = sigmoid(margins, labels)
    return Model(whole.weight, whole.square, whole.bias, slope, offset)


def sampled(labels: DataFrame, sample: int, parts: int, held: int) -> DataFrame:
    """(doc_id, label) of at most ``sample`` training labels, by the hash of doc_id."""
    clear = labels.where(F.col("quality").isNotNull() & ~held_out(parts, held)).groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("most"))
    return clear.where("label = most").select("doc_id", "label").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, parts: int = 4, held: int = 2) -> Model:
    """Fit on the sampled labels; the rows' n-grams meet in one task, at most ``sample`` of them."""
    chosen = save(sampled(labels, sample, parts, held), "sample")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([features(t) for t in batch.column("text").to_pylist()], pa.list_(pa.int32()))],
                ["doc_id", "label", "found"],
            )

    # ``chosen`` has at most ``sample`` rows of two numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = rows.select("doc_id", F.col("label").cast("long").alias("label"), "text").mapInArrow(extract, "doc_id long, label long, found array<int>")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(i, y, np.asarray(x.values)) for b in batches for i, y, x in zip(b.column("doc_id").to_pylist(), b.column("label").to_pylist(), b.column("found"))]
        rows.sort(key=lambda r: (crc32(str(r[0]).encode()), r[0], len(r[2])))
        model = fit([r[2] for r in rows], np.array([r[1] for r in rows]))
        numbers = [model.bias, model.slope, model.offset, np.nan if model.constant is None else model.constant]
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.weight.astype(np.float32).tobytes()], pa.binary()), pa.array([model.square.astype(np.float32).tobytes()], pa.binary()), pa.array([numbers], pa.list_(pa.float64()))],
            ["weight", "square", "numbers"],
        )

    fitted = save(found, "features").repartition(1).mapInArrow(learn, "weight binary, square binary, numbers array<double>").first()
    if fitted is None:
        return fit([], np.zeros(0))
    bias, slope, offset, constant = fitted.numbers
    return Model(
        np.frombuffer(fitted.weight, dtype=np.float32), np.frombuffer(fitted.square, dtype=np.float32), bias, slope, offset,
        None if np.isnan(constant) else constant,
    )


def score(docs: DataFrame, model: Model, carry: list[str] | None = None) -> DataFrame:
    """``doc`` (the columns ``carry``, by default all) with score."""
    carry = docs.columns if carry is None else carry
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("doc"), F.col("text").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = [model.score(features(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(scores, pa.float64())], ["doc", "score"])

    return packed.mapInArrow(run, packed.select("doc").schema.add("score", "double"))
