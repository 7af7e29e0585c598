"""Language-model scores by a weighted backoff automaton.

Tokens are words (A-Z lower-cased, split at ASCII white space) and an end for each text. The model's unigrams are all
words of the training rows with additive smoothing. Above them stand all their bigrams and trigrams with absolute
discounting. Each context is a state, each seen n-gram an arc with its log-probability to the state of the longest known
suffix, and each state has a failure arc, weighted so that probabilities sum to one, to the state of the next shorter
context. A text is scored by a traversal from left to right, which sums what it passes.

What grows with the corpus never meets in one place:

1. The rows of a partition are dealt, as they are read, into blocks of BLOCK_BYTES of text, which are written once as
   numbers of words; texts are never shuffled. A block counts its own n-grams and sends each different one once, with its
   count, to the bucket of its hash, so a frequent n-gram costs a bucket one entry for each block. Buckets grow in number
   with the tokens.
2. A bucket sums the counts and answers for what several blocks hold; of what one block alone holds, that block's count
   is the corpus's. The bucket also names one owner of each n-gram.
3. Each block sums, over the n-grams that it owns, what the failure arc of their context needs: the number of different
   followers and their lower counts. Contexts that several blocks hold are summed by their buckets.
4. So each block has the arcs and failure weights that its texts can reach, as arrays, and all its places traverse
   together: those without an arc at a state pass its failure arc.

Every count is an exact integer whatever its frequency, so no result depends on how rows are dealt. N-grams are matched
by 64-bit hashes.

Defined results: null texts count as empty; an empty text is the end alone. Without training rows the base gives every
token log10(0.5/0.5) = 0. Texts count whole. Each row gives one result row, also repeated ones; an empty table an empty
result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold, forget, written

DISCOUNT = 0.5
ADD = 0.5
#: Text of a block; its n-grams take several times as much room.
BLOCK_BYTES = 8 << 20
#: Blocks' worth of n-grams that a bucket sums, at about eight bytes of text a token.
BUCKET_BLOCKS = 2
START, END = b" ", b""
SIZES = (1, 2, 3)
_TIMES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def tokens(text: bytes | None) -> list[bytes]:
    """The words of UTF-8 `text`; bytes know only ASCII case and white space."""
    return (text or b"").lower().split()


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


@dataclass
class Automaton:
    """State 0 is the root. arcs[s]: word -> (log10 probability, next state)."""

    total: int
    distinct: int
    start: int = 0
    arcs: list[dict[bytes, tuple[float, int]]] = field(default_factory=lambda: [{}])
    weight: list[float] = field(default_factory=lambda: [0.0])
    fail: list[int] = field(default_factory=lambda: [0])

    def unigram(self, count: int) -> float:
        return math.log10((count + ADD) / (self.total + ADD * (self.distinct + 1)))

    def score(self, words: list[bytes], logs: list[float]) -> float:
        """`logs`: the words' unigram log-probabilities, for words that the root has no arc for."""
        arcs, weight, fail, state, out = self.arcs, self.weight, self.fail, self.start, 0.0
        for w, p in zip(words, logs):
            hit = arcs[state].get(w)
            while hit is None and state:
                out += weight[state]
                state = fail[state]
                hit = arcs[state].get(w)
            if hit is None:
                out += p
            else:
                out += hit[0]
                state = hit[1]
        return out

    def log_probability(self, state: int, w: bytes, count: int) -> float:
        out = 0.0
        while (hit := self.arcs[state].get(w)) is None and state:
            out += self.weight[state]
            state = self.fail[state]
        return out + (hit[0] if hit else self.unigram(count))


def build(head: list[tuple[bytes, int]], texts: int, total: int, distinct: int, pairs: dict[tuple[int, int], int], triples: dict[tuple[int, int, int], int]) -> Automaton:
    """`head`: words and counts, the commonest first; indices into it name n-grams, len(head) the end, len(head)+1 the start."""
    auto = Automaton(total, distinct)
    end, start = len(head), len(head) + 1
    name = [w for w, _ in head] + [END]
    count = [c for _, c in head] + [texts]
    state: dict[tuple[int, ...], int] = {}

    def add(context: tuple[int, ...], fail: int) -> None:
        state[context] = len(auto.arcs)
        auto.arcs.append({})
        auto.weight.append(0.0)
        auto.fail.append(fail)

    for v in sorted({v for v, _ in pairs}):
        add((v,), 0)
    for u, v in sorted({(u, v) for u, v, _ in triples}):
        add((u, v), state.get((v,), 0))
    auto.start = state.get((start,), 0)
    for w in range(len(head)):
        auto.arcs[0][name[w]] = (auto.unigram(count[w]), state.get((w,), 0))
    if texts:
        auto.arcs[0][END] = (auto.unigram(texts), 0)

    def lay(grams: dict, seen_of) -> None:
        by: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for gram, n in grams.items():
            by.setdefault(gram[:-1], []).append((gram[-1], n))
        for context, after in by.items():
            s, seen = state[context], seen_of(context)
            below = sum(10 ** auto.log_probability(auto.fail[s], name[w], count[w]) for w, _ in after)
            kept = sum(n - DISCOUNT for _, n in after) / seen
            for w, n in after:
                to = 0 if w == end else state.get((context[-1], w), state.get((w,), 0))
                auto.arcs[s][name[w]] = (math.log10((n - DISCOUNT) / seen), to)
            auto.weight[s] = math.log10(max(1e-12, 1 - kept) / max(1e-12, 1 - below))

    lay(pairs, lambda c: texts if c[0] == start else count[c[0]])
    lay(triples, lambda c: pairs[c])
    return auto


def train(rows: DataFrame) -> tuple[Automaton, Counter]:
    """The whole automaton of the rows' `text` and its word counts, gathered in the driver: for tables that fit it.

    `scores` never gathers; it gives the scores of this automaton.
    """
    words, pairs, triples, texts = Counter(), Counter(), Counter(), 0
    for row in rows.select(F.col("text").cast("binary")).toLocalIterator():
        ws = [START, *tokens(row[0]), END]
        texts += 1
        words.update(ws[1:])
        pairs.update(zip(ws, ws[1:]))
        triples.update(zip(ws[1:], ws[2:], ws[3:]))
    head = [(w, n) for w, n in words.most_common() if w != END]
    place = {w: k for k, (w, _) in enumerate(head)} | {END: len(head), START: len(head) + 1}
    named = [{tuple(place[w] for w in gram): n for gram, n in grams.items()} for grams in (pairs, triples)]
    return build(head, texts, sum(words.values()), len(words), *named), words


def _join(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    h = a * _TIMES[size - 2]
    h += b
    h ^= h >> np.uint64(31)
    h *= _TIMES[1]
    h ^= h >> np.uint64(29)
    return h


def _pack(x: np.ndarray) -> bytes:
    """Whole numbers as planes of bytes, as many as the largest needs, each compressed by itself; their sizes come first."""
    if not len(x):
        return b""
    planes = max(1, (int(x.max()).bit_length() + 7) // 8)
    parts = [pa.compress(row.tobytes(), "zstd", asbytes=True) for row in x.astype("<u8").view(np.uint8).reshape(-1, 8).T[:planes]]
    return np.array([len(x), planes, *map(len, parts)], "<u4").tobytes() + b"".join(parts)


def _unpack(b: bytes) -> np.ndarray:
    if not b:
        return np.zeros(0, np.uint64)
    n, planes = np.frombuffer(b, "<u4", 2).tolist()
    out, at = np.zeros((n, 8), np.uint8), 8 + 4 * planes
    for k, size in enumerate(np.frombuffer(b, "<u4", planes, 8).tolist()):
        out[:, k] = np.frombuffer(pa.decompress(b[at : at + size], n, "zstd", asbytes=True), np.uint8)
        at += size
    return out.view("<u8").ravel()


def _pack_sorted(h: np.ndarray) -> bytes:
    return _pack(np.diff(h, prepend=np.uint64(0)))


def _unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(_unpack(b), dtype=np.uint64)


def _edges(h: np.ndarray, buckets: int) -> list[int]:
    """Where each bucket begins in the sorted hashes `h`, and their end."""
    first = np.array([-(-(k << 32) // buckets) << 32 for k in range(buckets)], np.uint64)
    return [*np.searchsorted(h, first).tolist(), len(h)]


def _packed(rows: pa.Table, number: int) -> tuple:
    """A block's row: its texts as numbers of the words in its own vocabulary."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(rows.column("text").combine_chunks()))
    flat, parent = split.flatten(), pc.list_parent_indices(split)
    real = pc.greater(pc.binary_length(flat), 0)
    words = flat.filter(real).dictionary_encode()
    size = np.bincount(parent.filter(real).to_numpy(zero_copy_only=False), minlength=rows.num_rows)
    vocabulary = b" ".join(words.dictionary.cast(pa.binary()).to_pylist())
    numbers = words.indices.to_numpy(zero_copy_only=False).astype(np.uint64)
    return (
        number, rows.column("id").to_pylist(), rows.column("held_out").to_pylist(), len(numbers) + rows.num_rows,
        _pack(size.astype(np.uint64)), len(vocabulary), pa.compress(vocabulary, "zstd", asbytes=True), _pack(numbers),
    )


def _blocks(rows: DataFrame, block_bytes: int) -> DataFrame:
    """A row for each run of rows of a partition that holds about `block_bytes` of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a retried task deals and numbers its rows anew, but only one attempt's file is ever read
        number, have, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            bytes_of = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            at = 0
            for k, n in enumerate(bytes_of.tolist(), 1):
                size += n + 1
                if size >= block_bytes:
                    have.append(batch.slice(at, k - at))
                    yield _table([_packed(pa.Table.from_batches(have), number)], _BLOCK).to_batches()[0]
                    number, have, size, at = number + 1, [], 0, k
            if at < batch.num_rows:
                have.append(batch.slice(at))
        if have:
            yield _table([_packed(pa.Table.from_batches(have), number)], _BLOCK).to_batches()[0]

    return rows.mapInArrow(run, _BLOCK)


class _Block:
    """The n-grams of a block's texts. For each size: `h` the sorted hashes, `n` their training counts, `first` a place
    where each begins, `at` the n-gram that begins at each place (where one does). Each text stands as start, words, end.
    """

    def __init__(self, row: dict):
        vocabulary = pa.decompress(row["vocabulary"], row["room"], "zstd", asbytes=True)
        hashes = _hashes([START, END, *vocabulary.split()])
        del vocabulary
        words = _unpack(row["sizes"]).astype(np.int64)
        size = words + 2
        self.starts, self.size = np.cumsum(size) - size, words + 1
        ids = np.empty(int(size.sum()), np.int32)
        inside = np.ones(len(ids), bool)
        inside[self.starts] = inside[self.starts + words + 1] = False
        ids[self.starts], ids[self.starts + words + 1] = 0, 1
        ids[inside] = _unpack(row["numbers"]).astype(np.int32) + np.int32(2)
        trained = np.repeat(~np.array(row["held"], bool), size)
        end = ids == 1
        inner = np.flatnonzero(~end).astype(np.int32)
        self.h, self.n, self.first, self.at = {}, {}, {}, {}
        h, where = np.unique(hashes, return_inverse=True)
        self._put(1, h, None, where.astype(np.int32)[ids], trained)
        words = hashes[ids]
        self._lay(2, inner, _join(words[inner], words[inner + 1], 2), trained)
        inner = inner[(ids[inner] != 0) & ~end[inner + 1]]
        h = _join(_join(words[inner], words[inner + 1], 2), words[inner + 2], 3)
        del words
        self._lay(3, inner, h, trained)
        #: Whether each pair is the context of triples.
        self.context = (ids[self.first[2]] != 0) & ~end[self.first[2] + 1]

    def _lay(self, size: int, places: np.ndarray, h: np.ndarray, trained: np.ndarray) -> None:
        # np.unique would hold several times as much
        order = np.argsort(h).astype(np.int32)
        h = h[order]
        new = np.ones(len(h), bool)
        np.not_equal(h[1:], h[:-1], out=new[1:])
        places = places[order]
        at = np.full(len(trained), -1, np.int32)
        at[places] = np.cumsum(new, dtype=np.int32) - np.int32(1)
        self._put(size, h[new], places[new], at, trained)

    def _put(self, size: int, h: np.ndarray, first: np.ndarray | None, at: np.ndarray, trained: np.ndarray) -> None:
        self.h[size], self.first[size], self.at[size] = h, first, at
        self.n[size] = np.bincount(at[trained & (at >= 0)], minlength=len(h)).astype(np.int32)

    def answered(self, rows: list[dict], buckets: int) -> None:
        """Take the counts of the corpus: `c`; `own`, whether this block owns an n-gram; `shared`, whether others hold it."""
        self.c = {k: n.astype(np.int64) for k, n in self.n.items()}
        self.n = {}
        self.own = {k: c > 0 for k, c in self.c.items()}
        self.shared = {k: np.zeros(len(c), bool) for k, c in self.c.items()}
        edges = {k: _edges(h, buckets) for k, h in self.h.items()}
        seen = 0
        for r in rows:
            k, a, b = r["size"], edges[r["size"]][r["bucket"]], edges[r["size"]][r["bucket"] + 1]
            several = np.unpackbits(np.frombuffer(r["x"], np.uint8), count=b - a).astype(bool)
            many = int(several.sum())
            self.shared[k][a:b] = several
            self.c[k][a:b][several] = _unpack(r["y"]).astype(np.int64)
            self.own[k][a:b][several] = np.unpackbits(np.frombuffer(r["z"], np.uint8), count=many).astype(bool)
            seen += 1
        asked = sum(a < b for e in edges.values() for a, b in zip(e, e[1:]))
        if seen != asked:
            raise ValueError(f"{seen} answers for {asked} messages")

    def contexts(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For words and for pairs: which ones to ask for, and of all of them, over the owned n-grams that follow,
        their number and the sum of the counts of what they are without their first word."""
        out = {}
        for size in (1, 2):
            first = self.first[size + 1][self.own[size + 1]]
            context, lower = self.at[size][first], self.at[size][first + 1]
            m = len(self.h[size])
            ask = np.flatnonzero(self.shared[size] & self.context) if size == 2 else np.flatnonzero(self.shared[size])
            out[size] = ask, np.bincount(context, minlength=m), np.bincount(context, self.c[size][lower], m).astype(np.int64)
        return out

    def logs(self, rows: list[dict], buckets: int, total: int, distinct: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each place: whether its word is known, its unigram value and the value that the traversal adds there."""
        sums = self.contexts()
        for k, (ask, types, lower) in sums.items():
            edges = _edges(self.h[k][ask], buckets)
            for r in rows:
                if r["size"] == k:
                    mine = ask[edges[r["bucket"]] : edges[r["bucket"] + 1]]
                    types[mine], lower[mine] = _unpack(r["x"]), _unpack(r["y"])
        c1, c2, c3 = (self.c[k] for k in SIZES)
        room = total + ADD * (distinct + 1)
        one = np.log10((c1 + ADD) / room)
        tiny = 1e-12
        with np.errstate(divide="ignore", invalid="ignore"):
            _, types, lower = sums[1]
            # start is a context, counted in c1 like a word, and no follower
            fail1 = np.where(c1 > 0, np.log10(np.maximum(tiny, DISCOUNT * types / c1) / np.maximum(tiny, 1 - (lower + ADD * types) / room)), 0.0)
            u, v = self.at[1][self.first[2]], self.at[1][self.first[2] + 1]
            two = np.where(c2 > 0, np.log10((c2 - DISCOUNT) / c1[u]), fail1[u] + one[v])
            _, types, lower = sums[2]
            fail2 = np.where((c2 > 0) & self.context, np.log10(np.maximum(tiny, DISCOUNT * types / c2) / np.maximum(tiny, 1 - (lower - DISCOUNT * types) / c1[v])), 0.0)
            u, v = self.at[2][self.first[3]], self.at[2][self.first[3] + 1]
            three = np.where(c3 > 0, np.log10((c3 - DISCOUNT) / c2[u]), fail2[u] + two[v])
        known, base = c1[self.at[1]] > 0, one[self.at[1]]
        begin = np.zeros(len(base), bool)
        begin[self.starts] = True
        known[begin], base[begin] = False, 0.0
        out = np.zeros(len(base))
        for values, k in ((two, 2), (three, 3)):
            places = np.flatnonzero(self.at[k] >= 0)
            out[places + k - 1] = values[self.at[k][places]]
        return known, base, out


_BLOCK = "block long, ids array<long>, held array<boolean>, tokens long, sizes binary, room long, vocabulary binary, numbers binary"
_SENT = "bucket int, block long, size int, h binary, n binary, lower binary"
_SCORE = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_ANSWER = "block long, bucket int, size int, step int, total long, distinct long, x binary, y binary, z binary"
def _table(rows: list[tuple], schema: str) -> pa.Table:
    types = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}
    fields = [x.strip().split() for x in schema.split(",")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.table({name: pa.array(list(column), types[kind]) for (name, kind), column in zip(fields, columns)})


def _count(rows: pa.Table) -> pa.Table:
    """A bucket's answers to the counts it was sent."""
    start = _hashes([START])[0]
    out = []
    for size in SIZES:
        part = rows.filter(pc.equal(rows.column("size"), size))
        hs, ns = [_unpack_sorted(b.as_py()) for b in part.column("h")], [_unpack(b.as_py()) for b in part.column("n")]
        part = part.select(["block", "bucket"]).to_pylist()
        if not part:
            continue
        cuts = np.cumsum([0, *map(len, hs)])
        h, n = np.concatenate(hs), np.concatenate(ns).astype(np.int32)
        del hs, ns
        order = np.argsort(h).astype(np.int32)
        h = h[order]
        new = np.concatenate(([True], h[1:] != h[:-1]))
        first, group = np.flatnonzero(new), np.cumsum(new, dtype=np.int32) - np.int32(1)
        c = np.add.reduceat(n[order], first, dtype=np.int64)
        many = np.diff(first, append=len(h)) > 1
        counted = np.flatnonzero(n[order] > 0)
        g = group[counted]
        own, shared, sums = np.zeros(len(h), bool), np.zeros(len(h), bool), np.zeros(len(h), np.int64)
        own[order[counted[np.concatenate(([True], g[1:] != g[:-1]))] if len(g) else counted]] = True
        shared[order], sums[order] = many[group], c[group]
        word = h[first] != start
        total, distinct = (int(c[word].sum()), int((c[word] > 0).sum())) if size == 1 else (0, 0)
        for r, a, b in zip(part, cuts, cuts[1:]):
            several = shared[a:b]
            out.append((r["block"], r["bucket"], size, 1, total, distinct, np.packbits(several).tobytes(), _pack(sums[a:b][several]), np.packbits(own[a:b][several]).tobytes()))
    return _table(out, _ANSWER)


def _sum_contexts(rows: pa.Table) -> pa.Table:
    """A bucket's answers to the sums of contexts it was sent."""
    out = []
    sent = rows.to_pylist()
    for size in (1, 2):
        part = [r for r in sent if r["size"] == size]
        if not part:
            continue
        hs = [_unpack_sorted(r["h"]) for r in part]
        cuts = np.cumsum([0, *map(len, hs)])
        _, group = np.unique(np.concatenate(hs), return_inverse=True)
        # sums of counts stay exact in doubles up to 2^53
        sums = [np.bincount(group, np.concatenate([_unpack(r[x]) for r in part]))[group].astype(np.int64) for x in ("n", "lower")]
        for r, a, b in zip(part, cuts, cuts[1:]):
            out.append((r["block"], r["bucket"], size, 2, 0, 0, _pack(sums[0][a:b]), _pack(sums[1][a:b]), b""))
    return _table(out, _ANSWER)


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held: int = 1, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Train on the rows whose fold isn't `held`, score all."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), (fold(F.col(id_col), folds) == held).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    blocks = written(_blocks(rows, block_bytes), "blocks")
    tokens = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    buckets = max(1, -(-tokens * 8 // (BUCKET_BLOCKS * block_bytes)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            block, out = _Block(row), []
            for k in SIZES:
                edges = _edges(block.h[k], buckets)
                for bucket, (a, b) in enumerate(zip(edges, edges[1:])):
                    if a < b:
                        out.append((bucket, row["block"], k, _pack_sorted(block.h[k][a:b]), _pack(block.n[k][a:b]), b""))
            yield from _table(out, _SENT).to_batches()

    def send_contexts(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            block = _Block(row)
            block.answered(right.to_pylist(), buckets)
            for k, (ask, types, lower) in block.contexts().items():
                edges = _edges(block.h[k][ask], buckets)
                for bucket, (a, b) in enumerate(zip(edges, edges[1:])):
                    mine = ask[a:b]
                    if a < b:
                        out.append((bucket, row["block"], k, _pack_sorted(block.h[k][mine]), _pack(types[mine]), _pack(lower[mine])))
        return _table(out, _SENT)

    counted = written(blocks.mapInArrow(send, _SENT).groupBy("bucket").applyInArrow(_count, _ANSWER), "ngram-counts")
    by_bucket = counted.where("size = 1").groupBy("bucket").agg(F.max("total").alias("total"), F.max("distinct").alias("distinct"))
    total, distinct = by_bucket.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    asked = blocks.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(send_contexts, _SENT)
    contexts = written(asked.groupBy("bucket").applyInArrow(_sum_contexts, _ANSWER), "ngram-contexts")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            block, answers = _Block(row), right.to_pylist()
            block.answered([r for r in answers if r["step"] == 1], buckets)
            values = block.logs([r for r in answers if r["step"] == 2], buckets, total, distinct)
            known, base, value = (np.add.reduceat(x, block.starts, dtype=kind) for x, kind in zip(values, (np.int64, float, float)))
            out += zip(row["ids"], row["held"], block.size.tolist(), known.tolist(), [total] * len(known), base.tolist(), value.tolist())
        return _table(out, _SCORE)

    out = blocks.groupBy("block").cogroup(counted.unionByName(contexts).groupBy("block")).applyInArrow(score, _SCORE)
    out = written(out.withColumnRenamed("id", id_col), "lm-scores")
    for df in (blocks, counted, contexts):
        forget(df)
    return out
