"""Language identification by nearest centroid.

A text becomes counts of hashed character n-grams (one to three, lower case, anything but letters one boundary), times
inverse document frequency, normalised. Each language has a few centroids, found by spherical k-means, as languages mix
kinds of text. The nearest centroid by cosine gives the language and the score. A text farther from it than nearly all
of its own training texts were is rejected (`rejected`; with `reject` it gets `und`).

The model is fitted on a bounded sample of labelled rows: about SAMPLE of each language, picked by a hash. Predictions
use the text alone and run in one pass without a shuffle.

Defined results: null texts and texts without a letter get `und` and the score 0, as do all texts where no row is
labelled. Texts of any length count whole. Each row gives one result row; an empty table an empty result. Other columns
are ignored, whatever their names.
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

ORDERS = (1, 2, 3)
BITS = 12
WIDTH = len(ORDERS) << BITS
CENTROIDS = 4
SAMPLE = 600
UNKNOWN = "und"
#: A text is rejected under this share of the cosine that 99 in 100 training texts of its centroid reach.
REJECT_SHARE = 0.5


def counts(text: str | None) -> np.ndarray | None:
    """The n-gram counts, or None for a text without a letter."""
    c = ngrams.codes((text or "").lower())
    known = ngrams.letters()[c]
    if not known.any():
        return None
    c = np.where(known, c, np.uint64(0))
    keep = known | np.concatenate(([True], known[:-1]))
    c = np.concatenate(([np.uint64(0)], c[keep], [np.uint64(0)]))
    return np.concatenate([np.bincount(ngrams.char_grams(c, n, BITS), minlength=1 << BITS) for n in ORDERS]).astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    floor: np.ndarray

    def vectors(self, raw: np.ndarray) -> np.ndarray:
        v = np.sqrt(raw) * self.idf
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def predict(self, raw: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        near = self.vectors(raw) @ self.centroids.T
        best = near.argmax(axis=1)
        score = np.clip(near[np.arange(len(best)), best], 0, 1)
        return [self.languages[self.owner[b]] for b in best], score, score < self.floor[best]


def _spherical(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means by cosine; the first centres are the mean and then whatever is farthest, so it needs no chance."""
    centres = [v.mean(axis=0)]
    for _ in range(min(k, len(v)) - 1):
        centres.append(v[np.max([v @ (c / max(np.linalg.norm(c), 1e-9)) for c in centres], axis=0).argmin()])
    centres = np.asarray(centres)
    for _ in range(rounds):
        own = (v @ centres.T).argmax(axis=1)
        centres = np.asarray([v[own == j].mean(axis=0) if (own == j).any() else centres[j] for j in range(len(centres))])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    return centres


def train(texts: list[str | None], languages: list[str], k: int = CENTROIDS) -> Model | None:
    kept = [(v, lang) for v, lang in ((counts(t), lang) for t, lang in zip(texts, languages)) if v is not None]
    if not kept:
        return None
    raw = np.asarray([v for v, _ in kept])
    named = np.asarray([lang for _, lang in kept])
    idf = (np.log((1 + len(raw)) / (1 + (raw > 0).sum(axis=0))) + 1).astype(np.float32)
    model = Model(sorted(set(named)), idf, np.zeros((0, WIDTH), np.float32), np.zeros(0, int), np.zeros(0))
    v = model.vectors(raw)
    for n, lang in enumerate(model.languages):
        own = v[named == lang]
        centres = _spherical(own, k).astype(np.float32)
        near = own @ centres.T
        best = near.argmax(axis=1)
        floor = [np.quantile(near[best == j, j], 0.01) * REJECT_SHARE if (best == j).any() else 0.0 for j in range(len(centres))]
        model.centroids = np.vstack([model.centroids, centres])
        model.owner = np.concatenate([model.owner, np.full(len(centres), n)])
        model.floor = np.concatenate([model.floor, floor])
    return model


def fit(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE) -> Model | None:
    """Fit on at most about `per_language` rows of each language; the caller leaves held-out rows out."""
    named = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    got = ngrams.sample(named, "lang", per_language, "id", "text").select("text", "lang").collect()
    return train([r["text"] for r in got], [r["lang"] for r in got])


def predict(docs: DataFrame, model: Model | None, held_out: Column, id_col: str = "doc_id", text_col: str = "text", reject: bool = False) -> DataFrame:
    """(id_col, held_out, lang_pred, score, rejected) for each row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [counts(t) for t in part.column(2).to_pylist()] if model else [None] * part.num_rows
                known = [k for k, v in enumerate(found) if v is not None]
                lang, score, far = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows), np.ones(part.num_rows, bool)
                if known:
                    names, score[known], far[known] = model.predict(np.asarray([found[k] for k in known]))
                    for k, name in zip(known, names):
                        lang[k] = UNKNOWN if reject and far[k] else name
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(lang, pa.string()), pa.array(score), pa.array(far)], names=["id", "held_out", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, held_out boolean, lang_pred string, score double, rejected boolean").withColumnRenamed("id", id_col)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3, held: int = 1) -> DataFrame:
    """Fit on the rows whose fold isn't `held`, predict all."""
    out = fold(F.col(id_col), folds) == held
    return predict(docs, fit(docs.where(~out), id_col, text_col, lang_col), out, id_col, text_col)
