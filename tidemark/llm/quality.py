"""Quality classifier: averaged vectors of hashed words and subwords, with softmax output, trained by numpy SGD.

A document's features are its character 3- and 4-grams, its words, its pairs of neighbouring words, and whether a word
repeats the one before (or two before). Each is hashed to a row of a table of learned vectors; a kind's vectors are
averaged over the document and the averages summed; a linear layer and softmax give the classes. Training is stochastic
gradient descent over documents, deterministic by seed, on a bounded sample: about SAMPLE rows of each class, picked by
a hash. As both classes are sampled alike, the log odds are then shifted to the classes' true shares.

The average and the output layer are linear, so for scoring the two are multiplied out: one number for each table row.
Scoring is one pass without a shuffle.

Defined results: null and empty texts have no features and get the bias alone. Without labels of both classes every
score is the share of label 1 among those labels (0.5 without any). Texts count whole. Each row gives one result row;
an empty table an empty result; other columns are ignored. Label rows for unknown documents and null labels are passed
over; two labels of one document both count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import ngrams
from tidemark.llm.common import fold

BITS = 14
#: Table rows of each kind: 3-grams, 4-grams, words, word pairs, repeats.
KINDS = 5
ROWS = 4 * (1 << BITS) + 4
DIM = 12
SAMPLE = 3000
EPOCHS = 6
#: Small samples take more epochs, to make so many updates.
UPDATES = 20_000
RATE = 0.3
#: How much faster the table learns than the layer: a row takes part in a document with a small share only.
STEP = 2.0
#: What the softmax is trained towards for the wrong and the right class; it keeps the weights from growing without end.
SMOOTH = 0.02
THRESHOLD = 0.7


def features(text: str | None) -> list[np.ndarray]:
    """Table rows by kind, repeats included."""
    c = ngrams.codes(text or "")
    if not len(c):
        return []
    w = ngrams.word_hashes(c)
    step = 1 << BITS
    out = [ngrams.char_grams(c, 3, BITS), ngrams.char_grams(c, 4, BITS) + step, ngrams.bucket(w, BITS) + 2 * step]
    if len(w) > 1:
        out.append(ngrams.bucket(w[:-1] * np.uint64(3) + w[1:], BITS) + 3 * step)
        again = (w[1:] == w[:-1]).astype(np.int64)
        again[1:] += 2 * (w[2:] == w[:-2])
        out.append(again + 4 * step)
    return [x for x in out if len(x)]


@dataclass
class Model:
    weights: np.ndarray | None
    bias: float

    def logit(self, text: str | None) -> float:
        if self.weights is None:
            return self.bias
        return self.bias + sum(float(self.weights[x].mean()) for x in features(text))


class _Bags:
    """Table rows and weights of each text, many texts to an array: large arrays go back to the system when freed."""

    CHUNK = 256

    def __init__(self, texts: list[str | None]) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for at in range(0, len(texts), self.CHUNK):
            rows, weights, cuts = [], [], [0]
            for t in texts[at : at + self.CHUNK]:
                size = 0
                for x in features(t):
                    u, n = np.unique(x, return_counts=True)
                    rows.append(u.astype(np.int32))
                    weights.append((n / len(x)).astype(np.float32))
                    size += len(u)
                cuts.append(cuts[-1] + size)
            join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
            self.parts.append((join(rows, np.int32), join(weights, np.float32), np.asarray(cuts)))
        self.n = len(texts)

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        rows, weights, cuts = self.parts[k // self.CHUNK]
        a, b = cuts[k % self.CHUNK], cuts[k % self.CHUNK + 1]
        return rows[a:b], weights[a:b]


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -500, 500))))


def train(texts: list[str | None], labels: list[int], shares: tuple[float, float] | None = None, seed: int = 5) -> Model:
    """`shares`: how many rows of class 0 and 1 there are in truth."""
    y = np.asarray(labels, int)
    n1 = int(y.sum())
    if not 0 < n1 < len(y):
        p = n1 / len(y) if len(y) else 0.5
        return Model(None, float(np.clip(np.log(p / (1 - p)) if 0 < p < 1 else (40 if p else -40), -40, 40)))
    docs = _Bags(texts)
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIM, 1 / DIM, (ROWS, DIM)).astype(np.float32)
    out, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    epochs = max(EPOCHS, -(-UPDATES // len(docs)))
    total, done = epochs * len(docs), 0
    for _ in range(epochs):
        for k in rng.permutation(len(docs)):
            rows, weights = docs[k]
            rate = RATE * (1 - done / total)
            done += 1
            h = weights @ table[rows] if len(rows) else np.zeros(DIM, np.float32)
            z = out @ h + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p -= SMOOTH
            p[y[k]] -= 1 - 2 * SMOOTH
            back = p @ out
            out -= rate * np.outer(p, h)
            bias -= rate * p * 0.1
            if len(rows):
                table[rows] -= rate * STEP * weights[:, None] * back
    way = out[1] - out[0]
    prior = np.log((shares[1] / shares[0]) / (n1 / (len(y) - n1))) if shares and min(shares) > 0 else 0.0
    return Model(table @ way, float(bias[1] - bias[0] + prior))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = SAMPLE) -> Model:
    """Fit on at most about `per_class` labelled rows of each class; the caller leaves held-out labels out."""
    named = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col("id").isNotNull())
    sizes = {r["label"]: r["count"] for r in named.groupBy("label").count().collect()}
    picked = F.broadcast(ngrams.sample(named, "label", per_class, "id", "label"))  # bounded by per_class
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(picked, "id").select("id", "text", "label")
    got = sorted(rows.collect(), key=lambda r: (r["id"], r["label"], r["text"] or ""))
    return train([r["text"] for r in got], [r["label"] for r in got], (sizes.get(0, 0), sizes.get(1, 0)))


def predict(docs: DataFrame, model: Model, held_out: Column, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id_col, held_out, score, predicted) for each row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.asarray([_sigmoid(model.logit(t.as_py())) for t in batch.column(2)], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))], names=["id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 4, held: int = 2) -> DataFrame:
    """Fit on labels of the folds other than `held`, score all."""
    out = fold(F.col(id_col), folds) == held
    model = fit(docs, labels.where(~out), id_col, text_col, label_col)
    return predict(docs, model, out, id_col, text_col)


def keep_good(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, all their columns, whose score reaches `threshold`."""
    schema, names = docs.schema, docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([_sigmoid(model.logit(t.as_py())) >= threshold for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, schema)
