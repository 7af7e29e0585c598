"""Hashed character and word n-grams of a text with numpy, and bounded samples of labelled rows.

A word's hash sums its characters' codes times an odd number for their place, so no Python loop runs over words.
"""

from __future__ import annotations

import sys
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ODD = (np.random.default_rng(20240607).integers(0, 1 << 31, 64, dtype=np.uint64) * 2 + 1).astype(np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Parts into which a sample's hash cuts the rows; finer than any table has rows.
_FINE = 1 << 62


@lru_cache(1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


@lru_cache(1)
def spaces() -> np.ndarray:
    return np.fromiter((chr(c).isspace() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def bucket(h: np.ndarray, bits: int) -> np.ndarray:
    return ((h * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


def char_grams(c: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bucket of each n-gram of the codes `c`."""
    if len(c) < n:
        return np.zeros(0, np.int64)
    end = len(c) - n + 1
    h = c[:end] * _ODD[n]
    for k in range(1, n):
        h = h * _ODD[n + 1] + c[k : k + end]
    return bucket(h, bits)


def word_hashes(c: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, words being what white space leaves."""
    gap = spaces()[c]
    start = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
    if not len(start):
        return np.zeros(0, np.uint64)
    index = np.arange(len(c))
    place = np.zeros(len(c), np.int64)
    place[start] = start
    place = index - np.maximum.accumulate(place)
    weighted = np.where(gap, np.uint64(0), (c + np.uint64(1)) * _ODD[place & 63])
    return np.add.reduceat(weighted, start) * _MIX


def sample(rows: DataFrame, label: str, per_label: int, *keys: str, labels: int = 1000) -> DataFrame:
    """About `per_label` rows of each label, picked by a hash of `keys`.

    The bound is on what a classifier is fitted on; nothing is ranked or sorted, so a frequent label costs nothing. More
    than `labels` labels are an error, as the sample would have no bound then.
    """
    sizes = rows.where(F.col(label).isNotNull()).groupBy(label).count().orderBy(F.desc("count"), label).limit(labels + 1).collect()
    if len(sizes) > labels:
        raise ValueError(f"column {label} has more than {labels} labels")
    if not sizes:
        return rows.limit(0)
    share = None
    for value, n in sizes:
        rule = (F.col(label) == F.lit(value)) & (F.pmod(F.xxhash64(*keys), F.lit(_FINE)) < F.lit(max(1, -(-_FINE * min(per_label, n) // n))))
        share = rule if share is None else share | rule
    return rows.where(share)
