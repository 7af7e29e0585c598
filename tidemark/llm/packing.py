"""Best-fit packing of token sequences: patterns of few documents fitted to the histogram of lengths.

1. Documents are tokenized (each ends with an end token) and cut into pieces of at most `capacity` tokens.
2. The histogram of piece lengths has at most `capacity` entries whatever the corpus; only it comes to the driver.
   Patterns of one to three lengths that fill a sequence (nearly) whole are enumerated, and non-negative least squares
   fits how often each is used so that together they use up the histogram.
3. The counts are rounded down and held to what is left of each length. The residual pieces are packed best fit,
   longest first, again by lengths and counts: each step makes a pattern and repeats it as often as its lengths last.
4. The plan is a short table of runs: the pieces of one length ranked a to b take consecutive sequences at one offset.
   Pieces are ranked within their length in two levels (length and a hash group), as many groups as the commonest
   length needs, so a length that a third of all pieces have is not ranked by one task, and joined to the plan by length
   and rank. Whole pieces fill a sequence each and are not ranked at all.

Defined results: null and empty texts are one piece that holds the end token only. Repeated rows and ids are packed
each; ids don't matter for the packing. An empty table gives an empty result. Texts are tokenized whole. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import forget, written

CAPACITY = 2048
#: Words whose ids a Python worker remembers, from task to task; when full it forgets all but the first quarter. It
#: bounds memory and changes no result.
CACHE_WORDS = 600_000
#: Pieces of one length that a task ranks, about, and hash groups at least.
GROUP_ROWS, RANK_GROUPS = 200_000, 16
#: Rows of counts that are broadcast at most; a larger table is joined by a shuffle.
BROADCAST_ROWS = 500_000
_PIECES = "doc_id long, doc_key long, piece int, start long, length long, ids_crc32 long"
#: Python's split() also cuts at these; the tokenizers here don't.
_PUNCTUATION = ".,;:!?|%&*$#"
_ODD_SPACE = re.compile("[\x1c-\x1f]")


@lru_cache(2)
def encoder(path: str):
    """text -> its ids as little-endian 32-bit bytes. Words between white space are encoded once and remembered.

    This holds for tokenizers that drop white space, never merge across it and part letters from punctuation; a probe
    tells, and where it fails texts go whole through the tokenizer. New words made of letters are encoded many in one
    call and told apart by the tokens that end a word; where their number doesn't come out, one by one.
    """
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    raw = lambda ids: np.asarray(ids, dtype="<u4").tobytes()
    whole = lambda t: raw(tok.encode(t, add_special_tokens=False).ids)
    probe = ("Ab", ",", " ", " c's", "\n", "12", " éx", "..|")
    by_word = whole("Ab") == whole("ab") and whole("".join(probe)) == b"".join(whole(w) for w in probe)
    suffix = getattr(tok.model, "end_of_word_suffix", None)
    ends = np.zeros(tok.get_vocab_size(), bool)
    if suffix:
        ends[[i for token, i in tok.get_vocab().items() if token.endswith(suffix)]] = True
    seen: dict[str, bytes] = {}

    def many(ws: list[str]) -> list[bytes]:
        """The codes of words made of letters."""
        if suffix:
            ids = np.asarray(tok.encode(" ".join(ws), add_special_tokens=False).ids, dtype="<u4")
            cut = np.flatnonzero(ends[ids]) + 1
            if len(cut) == len(ws) and cut[-1] == len(ids):
                code, at = ids.tobytes(), [0, *(4 * cut).tolist()]
                return [code[a:b] for a, b in zip(at, at[1:])]
        return [raw(x.ids) for x in tok.encode_batch_fast(ws, add_special_tokens=False)]

    def learn(ws: list[str]) -> None:
        """Add words to `seen`. Punctuation after letters is a token run of its own."""
        parts = {w: (s, w[len(s) :]) for w in ws if (s := w.rstrip(_PUNCTUATION)).isalpha()}
        for some in ({s for s, _ in parts.values()}, {p for _, p in parts.values() if p}, set(ws) - parts.keys()):
            new = [w for w in some if w not in seen]
            for at in range(0, len(new), 2000):
                part = new[at : at + 2000]
                seen.update(zip(part, many(part) if part[0].isalpha() and all(map(str.isalpha, part)) else (whole(w) for w in part)))
        seen.update((w, seen[s] + seen[p] if p else seen[s]) for w, (s, p) in parts.items())

    def encode(texts: list[str]) -> list[bytes]:
        if not by_word:
            return [whole(t) for t in texts]
        words, cuts = [], [0]
        for text in texts:
            if text.isascii() and "<|" not in text:  # case is dropped anyway, and ASCII has only one way to
                text = text.lower()
            if not _ODD_SPACE.search(text):
                words += text.split()
            cuts.append(len(words))
        codes = list(map(seen.get, words))
        missing = [k for k, code in enumerate(codes) if code is None]
        learn(list({words[k] for k in missing}))
        for k in missing:
            codes[k] = seen[words[k]]
        out = [whole(t) if _ODD_SPACE.search(t) else b"".join(codes[a:b]) for t, a, b in zip(texts, cuts, cuts[1:])]
        if len(seen) > CACHE_WORDS:  # the first words that were met are the frequent ones
            kept = list(islice(seen.items(), CACHE_WORDS // 4))
            seen.clear()
            seen.update(kept)
        return out

    return encode


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each piece: doc_id, doc_key (a hash that ranks can be grouped by), piece, start, length, ids_crc32."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, end = encoder(tokenizer), np.asarray([end_id], dtype="<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            ids, keys, texts = (batch.column(k) for k in range(3))
            for at in range(0, batch.num_rows, 256):
                some = slice(at, at + 256)
                for doc, key, code in zip(ids[some].to_pylist(), keys[some].to_pylist(), encode(texts[some].to_pylist())):
                    code += end
                    step = 4 * capacity
                    for k, a in enumerate(range(0, len(code), step)):
                        part = code[a : a + step]
                        rows.append((doc, key, k, a // 4, len(part) // 4, zlib.crc32(part)))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                names = ["doc_id", "doc_key", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col), text).alias("doc_key"), text.alias("text"))
    return rows.mapInArrow(cut, _PIECES)


def patterns(counts: np.ndarray, slack: int) -> np.ndarray:
    """Length triples (0: none) that occur and leave at most `slack` of the capacity, longest first.

    Pairs: each length with the longest that fits beside it. Triples: each length with each of the most frequent
    shorter ones and the longest that fits beside both.
    """
    capacity = len(counts) - 1
    have = np.flatnonzero(counts)
    have = have[have > 0]
    if not len(have):
        return np.zeros((0, 3), int)
    fits = np.zeros(capacity + 1, int)  # the longest length that occurs and is at most so long
    fits[have] = have
    fits = np.maximum.accumulate(fits)
    rows = [(int(a), int(fits[capacity - a]), 0) for a in have]
    often = have[np.argsort(-counts[have], kind="stable")[:48]]
    for b in often:
        a = have[(have >= b) & (have + b <= capacity)]
        rows += [(int(x), int(b), int(fits[capacity - x - b])) for x in a]
    table = -np.sort(-np.asarray(rows), axis=1)
    table = np.unique(table, axis=0)
    return table[table.sum(axis=1) >= capacity - slack]


def fit(counts: np.ndarray, table: np.ndarray, steps: int = 300) -> np.ndarray:
    """Non-negative least squares: x >= 0 that makes sum(x * pattern) nearest the histogram; accelerated projection."""
    size, p = len(counts), len(table)
    flat, owner = table.ravel(), np.repeat(np.arange(p), table.shape[1])
    used = flat > 0
    flat, owner = flat[used], owner[used]
    make = lambda x: np.bincount(flat, weights=x[owner], minlength=size)
    back = lambda r: np.bincount(owner, weights=r[flat], minlength=p)
    v = np.ones(p)
    for _ in range(20):  # the largest eigenvalue gives the step
        v = back(make(v))
        norm = np.linalg.norm(v)
        v /= max(norm, 1e-12)
    rate = 1.0 / max(norm, 1e-12)
    x = np.zeros(p)
    y, t = x.copy(), 1.0
    target = counts.astype(float)
    for _ in range(steps):
        new = np.maximum(0.0, y - rate * back(make(y) - target))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def plan(counts: np.ndarray) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs (length, first rank, end rank, first sequence, offset) that place every piece, and the number of sequences.

    `counts[n]` is how many pieces have length n, up to the capacity.
    """
    capacity = len(counts) - 1
    left = counts.astype(np.int64).copy()
    placed = np.zeros(capacity + 1, np.int64)
    runs, sequences = [], 0

    def use(lengths: list[int], times: int) -> None:
        nonlocal sequences
        offset = 0
        for n in lengths:
            # a length that the pattern has twice takes two runs, one after the other
            runs.append((n, int(placed[n]), int(placed[n]) + times, sequences, offset))
            placed[n] += times
            left[n] -= times
            offset += n
        sequences += times

    def times_of(lengths: list[int]) -> int:
        return min(int(left[n]) // lengths.count(n) for n in lengths)

    if left[capacity]:
        use([capacity], int(left[capacity]))
    table = patterns(left, slack=max(1, capacity // 256))
    if len(table):
        times = np.floor(fit(left, table) + 1e-6).astype(np.int64)
        for k in np.argsort(-times, kind="stable"):
            lengths = [int(n) for n in table[k] if n]
            if times[k] > 0 and (n := min(int(times[k]), times_of(lengths))) > 0:
                use(lengths, n)
    while (have := np.flatnonzero(left)).size:
        lengths, room = [int(have[-1])], capacity - int(have[-1])
        rest = left.copy()
        rest[lengths[0]] -= 1
        while room and (fit_in := np.flatnonzero(rest[: room + 1])).size:
            n = int(fit_in[-1])
            many = min(int(rest[n]), room // n)
            lengths += [n] * many
            rest[n] -= many
            room -= n * many
        use(lengths, times_of(lengths))
    return runs, sequences


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each piece with its sequence_id and offset there."""
    spark = docs.sparkSession
    every = written(pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for r in every.groupBy("length").agg(F.count("*").alias("n")).collect():  # at most `capacity` rows
        counts[r["length"]] = r["n"]
    whole, counts[capacity] = int(counts[capacity]), 0
    runs, sequences = plan(counts)
    # a run for each pattern's use of a length: patterns are at most as many as lengths and residual steps
    placed = spark.createDataFrame(runs, "length long, a long, b long, first long, at long")
    groups = max(RANK_GROUPS, -(-int(counts.max()) // GROUP_ROWS))
    cut = every.where(F.col("length") < capacity).withColumn("group", F.pmod(F.xxhash64("doc_key", "piece"), F.lit(groups)))
    sizes = cut.groupBy("length", "group").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    def bounded(df: DataFrame, rows: int) -> DataFrame:
        return F.broadcast(df) if rows <= BROADCAST_ROWS else df

    order = Window.partitionBy("length", "group").orderBy("doc_key", "doc_id", "piece", "ids_crc32")
    ranked = cut.withColumn("r", F.row_number().over(order) - 1).join(bounded(offsets, groups * np.count_nonzero(counts)), ["length", "group"])
    ranked = ranked.withColumn("rank", F.col("r") + F.col("before"))
    held = ranked.join(bounded(placed, len(runs)), (ranked["length"] == placed["length"]) & (F.col("rank") >= F.col("a")) & (F.col("rank") < F.col("b")))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    held = held.select("doc_id", "piece", "start", ranked["length"].alias("length"), "ids_crc32", (F.col("first") + F.col("rank") - F.col("a")).alias("sequence_id"), F.col("at").alias("offset"))
    alone = every.where(F.col("length") == capacity).withColumns({"sequence_id": F.lit(sequences) + F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    out = held.unionByName(alone.select(columns)) if whole else held
    out = written(out.withColumnRenamed("doc_id", id_col), "packed")  # the numbers of whole pieces are drawn once
    forget(every)
    return out
