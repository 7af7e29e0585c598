"""Substring deduplication: paragraph MinHash banding, exact verification, removals clustered by components.

Units of a text are
* its paragraphs (lines) of MIN_WORDS words or more, with a MinHash signature over shingles of five words, in BANDS bands
  of ROWS values: paragraphs of Jaccard similarity 0.8 share a band with probability 0.995. A text of fewer words, but
  five at least, is one unit as a whole;
* blocks of BLOCK words that begin where the least shingle hash of WINDOW neighbours stands, wherever lines end. Any
  run of WINDOW + BLOCK words that two texts share has such a place, and so a block, in common. They catch passages
  that stand inside longer paragraphs.

Units are equal if 96 bits of a hash of their words are: the key `unit` is 64 of them, and units that agree in those
alone are told apart before they are used. Equal units are one class from the start, so copies cost no pairs. A
repeated block at the end of a run of blocks is compared, word by word, with the first document of its class beyond
the block, so a span reaches as far as the two texts agree: up to WINDOW - 1 words on either side, the most that block
selection leaves.

Of paragraphs that share a band, each can be compared with the band's first one and, where several clusters remain, with
a few more. Parities of their sets rule out, exactly, most that are not similar, and of what is left, over all its bands,
a paragraph is compared with the TRIES that look closest, so a large group of near copies takes a few times as many
comparisons as it has members, in however many bands they meet. Bands are salted by
their size: no task gets more than some HOT members of one. Where a band then still holds several clusters, its
paragraphs are compared across clusters by an exact prefix filter, so no link between clusters is lost. The similarity
is the exact Jaccard coefficient of the shingle sets, 0.8 or more. Components of verified links are clusters, and a
cluster counts if it has two documents or more. The smallest document id keeps its text; the others' spans are removals.

Defined results: null and empty texts have no units, nor have texts of fewer than five words. Repeats inside one
document alone are no removals. Rows without an id are passed over; equal ids are one document. Repeated rows give
their spans once. Texts count whole. An empty table gives an empty result. Other columns are ignored, whatever their
names. Words are compared as they stand, case included. Spans are code points, the end exclusive.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import ngrams
from tidemark.llm.common import components, forget, written

SHINGLE = 5
SIMILARITY = 0.8
#: Shorter lines are no units of their own, unless they are a whole text; `duplicate_spans` takes another bound.
MIN_WORDS = 20
BANDS, ROWS = 10, 4
WINDOW, BLOCK = 20, 24
#: Further paragraphs of a band that all others of it may be compared with, before the exact search between clusters.
PIVOTS = 4
#: Of its bands' first paragraphs, and then of their further ones, as many are compared with one at most.
TRIES = 4
#: Members of a band that one task is meant to get at most.
HOT = 5_000
#: Classes of over HOT members that are broadcast at most; if there are more, adaptive execution splits their join.
HOT_CLASSES = 1_000_000

_RNG = np.random.default_rng(77)
_TIMES = (_RNG.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * 2 + 1).astype(np.uint32)
_PLUS = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a number over all of its 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of several texts, as white space parts them, one after another."""

    #: Hash, start and end in its text, number of its line (no two texts share one), for each word.
    h: np.ndarray
    first: np.ndarray
    last: np.ndarray
    line: np.ndarray
    #: Where each text's words begin, and their end.
    cuts: np.ndarray


def words_of(texts: list[str]) -> Words:
    """A word's hash sums one number for each character and its place, each drawn by mixing both."""
    c = ngrams.codes("\n".join([*texts, ""]))
    size = np.array([len(t) + 1 for t in texts], np.int64)
    begin = np.cumsum(size) - size
    gap = ngrams.spaces()[c]
    start = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
    stop = np.flatnonzero(~gap & np.concatenate((gap[1:], [True]))) + 1
    cuts = np.searchsorted(start, np.concatenate((begin, [len(c)])))
    if not len(start):
        none = np.zeros(0, np.int64)
        return Words(none.view(np.uint64), none, none, none, cuts)
    length = stop - start
    inside = np.flatnonzero(~gap)
    place = (inside - np.repeat(start, length)).astype(np.uint64)
    h = np.add.reduceat(_mixed(c[inside] + (place + np.uint64(1)) * _BASE), np.cumsum(length) - length)
    offset = np.repeat(begin, np.diff(cuts))
    return Words(_mixed(h + length.astype(np.uint64)), start - offset, stop - offset, np.cumsum(c == 10)[start], cuts)


#: Bytes of text that are taken apart at a time; arrays over its characters need about a hundred times as many.
PART = 1 << 18


def parts(texts: pa.Array, most: int = PART) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about `most` bytes together, each with where it begins; a longer text is a run of its own."""
    begin = size = 0
    for k, n in enumerate(pc.binary_length(texts).to_pylist()):
        if size and size + n > most:
            yield begin, texts.slice(begin, k - begin).to_pylist()
            begin, size = k, 0
        size += n + 1
    if begin < len(texts):
        yield begin, texts.slice(begin).to_pylist()


def shingle_hashes(h: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A hash of each run of `size` words."""
    n = len(h) - size + 1
    out = h[:n].copy()
    for k in range(1, size):
        out *= _BASE
        out ^= out >> np.uint64(32)
        out += h[k : k + n]
    return (out ^ (out >> np.uint64(29))) * _BASE


def identities(h: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits of a hash of the words from each `begin` to its `stop`; these runs don't overlap and are in order."""
    size = stop - begin
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    place = (at - np.repeat(begin, size)).astype(np.uint64)
    w, cuts = h[at], np.cumsum(size) - size
    a = np.add.reduceat(_mixed(w + (place + np.uint64(1)) * _MIX[0]), cuts) + size.astype(np.uint64)
    b = np.add.reduceat(_mixed((w ^ _MIX[0]) * _MIX[1] + (place + np.uint64(1)) * _BASE), cuts)
    return _mixed(a).view(np.int64), (_mixed(b) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def run_identities(h: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits of a hash of the `size` words from each place on."""
    a, b = np.full(len(at), _BASE, np.uint64), np.full(len(at), size, np.uint64)
    for k in range(size):
        w = h[at + k]
        a = (a ^ w) * _MIX[0]
        a ^= a >> np.uint64(29)
        b = (b + w) * _MIX[1]
        b ^= b >> np.uint64(32)
    return (a * _MIX[1] ^ (a >> np.uint64(31))).view(np.int64), (b >> np.uint64(32)).astype(np.uint32).view(np.int32)


def units(ws: Words, least: int = MIN_WORDS) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The text of each unit; [unit, check, start, length, is_paragraph] as columns; and the band keys of those that are paragraphs."""
    n = np.diff(ws.cuts)
    owner = np.repeat(np.arange(len(n)), n)
    total = len(owner)
    none = np.zeros(0, np.int64)
    if total < SHINGLE:
        return none, [none, none.astype(np.int32), none, none, none.astype(bool)], np.zeros((0, BANDS), np.uint64)
    end = ws.cuts[1:][owner]
    short = (n < least)[owner]
    # a short text is one line
    line = np.where(short, ws.line[ws.cuts[:-1][owner]], ws.line)
    begin = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))
    stop = np.concatenate((begin[1:], [total]))
    size = stop - begin
    long = (size >= least) | short[begin] & (size >= SHINGLE)
    shingles = shingle_hashes(ws.h)
    bands = np.zeros((int(long.sum()), BANDS), np.uint64)
    if long.any():
        outside = np.flatnonzero(np.concatenate((line[: total - SHINGLE + 1] != line[SHINGLE - 1 :], np.ones(SHINGLE - 1, bool))))
        base = np.concatenate(((shingles >> np.uint64(32)).astype(np.uint32), np.zeros(SHINGLE - 1, np.uint32)))
        key = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(bands), axis=0)
        for k in range(BANDS * ROWS):
            v = (base * _TIMES[k]) ^ _PLUS[k]
            v[outside] = 0xFFFFFFFF
            column = key[:, k // ROWS]
            column ^= np.minimum.reduceat(v, begin)[long]
            column *= _BASE
            column ^= column >> np.uint64(31)
        bands = key
    begin, stop = begin[long], stop[long]
    at = none
    if len(shingles) >= WINDOW:
        least_at = np.lib.stride_tricks.sliding_window_view(shingles, WINDOW).argmin(axis=1) + np.arange(len(shingles) - WINDOW + 1)
        whole = end[: len(least_at)] - np.arange(len(least_at)) >= WINDOW + SHINGLE - 1  # windows inside one text
        at = np.unique(least_at[whole])
        at = at[at + BLOCK <= end[at]]
    starts, stops = np.concatenate((begin, at)), np.concatenate((stop, at + BLOCK))
    para = np.concatenate((np.ones(len(begin), bool), np.zeros(len(at), bool)))
    unit, check = (np.concatenate(x) for x in zip(identities(ws.h, begin, stop), run_identities(ws.h, at, BLOCK)))
    return owner[starts], [unit, check, ws.first[starts], ws.last[stops - 1] - ws.first[starts], para], bands


def _all_units(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """doc, key (of the row's id and text), unit, check, start, length, para, bands (empty for blocks)."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, keys = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(2))
            for a, texts in parts(batch.column(2)):
                owner, columns, bands = units(words_of(texts), least)
                if not len(owner):
                    continue
                b = a + len(texts)
                ends = np.concatenate(([0], np.cumsum(columns[-1].astype(np.int64) * BANDS)))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bands.view(np.int64).ravel()))
                arrays = [pa.array(x).cast(t) for x, t in zip((docs[a:b][owner], keys[a:b][owner], *columns), kinds)]
                yield pa.RecordBatch.from_arrays([*arrays, lists], names=["doc", "key", "unit", "check", "start", "length", "para", "bands"])

    return docs.mapInArrow(run, "doc long, key long, unit long, check int, start int, length int, para boolean, bands array<long>")


def told_apart(found: DataFrame) -> DataFrame:
    """`found` without `check`: its `unit` alone now tells texts apart."""
    sums = found.groupBy("unit").agg(F.min("check").alias("c0"), F.max("check").alias("c1"))
    mixed = written(sums.where("c0 <> c1").select("unit"), "equal-keys")
    if mixed.head(1):
        named = found.join(mixed.withColumn("mixed", F.lit(True)), "unit", "left")
        found = named.withColumn("unit", F.when(F.col("mixed"), F.xxhash64("unit", "check")).otherwise(F.col("unit"))).drop("mixed")
    else:
        forget(mixed)
    return found.drop("check")


def repeated_blocks(blocks: DataFrame, made: list[DataFrame], hot: int = HOT) -> DataFrame:
    """(doc, key, unit, check, start, end, first_doc_id) of the blocks that several documents have.

    The occurrences of classes of over `hot` members meet their class by a broadcast, so no task gets all of one; the
    others meet by a shuffle.
    """
    sums = blocks.groupBy("unit", "check").agg(F.min("doc").alias("first_doc_id"), F.max("doc").alias("high"), F.count("*").alias("n"))
    shared = kept(made, sums.where(F.col("first_doc_id") < F.col("high")).drop("high"), "shared")
    name, ends = ["unit", "check"], (F.col("start") + F.col("length")).alias("end")
    columns = ["doc", "key", *name, "start", ends, "first_doc_id"]
    large = shared.where(F.col("n") > hot).select(*name, "first_doc_id")
    many = large.limit(HOT_CLASSES + 1).count()
    if not 0 < many <= HOT_CLASSES:
        return blocks.join(shared, name).select(columns)
    ones = blocks.join(F.broadcast(large.select(name)), name, "left_anti").join(shared.where(F.col("n") <= hot), name)
    return blocks.join(F.broadcast(large), name).select(columns).unionByName(ones.select(columns))


_LOOKED_UP = "unit long, kind int, key long, at long, s array<long>, places array<long>"
#: What is looked up in a text: the shingle set of a unit, or what stands left or right of a place, there or in the first document.
SET, LEFT, RIGHT, FIRST_LEFT, FIRST_RIGHT = range(5)


def look_up(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """_LOOKED_UP for `wanted` (unit, kind, key, start, end): one shuffle of texts for all that is wanted of them.

    SET: `s` is the set of shingle hashes from start to end (the hash of all words, if too few). LEFT and RIGHT: `s` are the hashes of the words before or
    after, outwards, and `places` where each starts or ends; `at` is where it began.
    """
    asked = wanted.groupBy("key").agg(F.collect_list(F.struct("unit", "kind", "start", "end")).alias("asked"))  # units of one text
    rows = docs.select("key", "text").dropDuplicates(["key"]).join(asked, "key").select("key", "text", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, every = batch.column(0).to_pylist(), batch.column(2)
            ends = np.concatenate(([0], np.cumsum(every.value_lengths().to_numpy(zero_copy_only=False))))
            flat = every.flatten()
            unit, kind, start, end = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(4))
            for a, texts in parts(batch.column(1)):
                words = words_of(texts)
                out: list[list] = [[], [], [], [], [], []]
                for k in range(a, a + len(texts)):
                    own = slice(words.cuts[k - a], words.cuts[k - a + 1])
                    h, first, last = words.h[own], words.first[own], words.last[own]
                    mine = slice(ends[k], ends[k + 1])
                    low, high = np.searchsorted(first, start[mine]).tolist(), np.searchsorted(last, end[mine], side="right").tolist()
                    for u, what, at, to, i, j in zip(unit[mine].tolist(), kind[mine].tolist(), start[mine].tolist(), end[mine].tolist(), low, high):
                        if what == SET:
                            found = np.unique(shingle_hashes(h[i:j], min(SHINGLE, max(1, j - i))))
                            place, there = at, found[:0]
                        elif what in (LEFT, FIRST_LEFT):
                            found, place, there = h[max(0, i - WINDOW + 1) : i][::-1], at, first[max(0, i - WINDOW + 1) : i][::-1]
                        else:
                            found, place, there = h[j : j + WINDOW - 1], to, last[j : j + WINDOW - 1]
                        for column, x in zip(out, (u, what, keys[k], place, found.view(np.int64), there.view(np.int64))):
                            column.append(x)
                if out[0]:
                    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
                    lists = [pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(x) for x in c]))), pa.int32()), pa.array(np.concatenate(c).astype(np.int64))) for c in out[4:]]
                    yield pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(out, kinds)], *lists], names=["unit", "kind", "key", "at", "s", "places"])

    return rows.mapInArrow(run, _LOOKED_UP)


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    both = pairs.join(sets.select(F.col("unit").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("unit").alias("b"), F.col("s").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.where(shared >= similarity * (F.size("sa") + F.size("sb") - shared)).select("a", "b")


def _ceil(x: Column) -> Column:
    return F.ceil(x - 1e-9).cast("int")


def kept(made: list[DataFrame], df: DataFrame, name: str) -> DataFrame:
    made.append(written(df, name))
    return made[-1]


def _parities(s: str = "s") -> list[Column]:
    """Four longs, in which each shingle of column `s` flips one of 256 bits.

    Shingles of both of two sets cancel out, so the bits in which they differ are at most the shingles that only one has.
    """
    one = F.lit(1).cast("long")
    flip = lambda word: lambda bits, x: F.when(F.pmod(x, F.lit(4)) == word, bits.bitwiseXOR(F.call_function("shiftleft", one, F.pmod(F.shiftright(x, 2), F.lit(64)).cast("int")))).otherwise(bits)
    return [F.aggregate(s, F.lit(0).cast("long"), flip(w)).alias(f"p{w}") for w in range(4)]


def _across(open_units: DataFrame, sets: DataFrame, similarity: float, made: list[DataFrame]) -> DataFrame:
    """(a, b): pairs of `open_units` (unit, cluster) of different clusters that can be similar: exact filters only.

    Shingles are ordered from rare to common. A pair of sufficient similarity shares a shingle among the first ones of
    the larger set (all but `similarity` of it) and among fewer first ones of the smaller set (all but the overlap that
    two sets of its size need). So what many paragraphs share, such as a passage inside them, comes last and makes no
    pairs. After the first shared shingle enough others must remain in both, and the sets' parities may differ in no
    more bits than the shingles that two similar sets don't share. Of each shingle's units those of its largest cluster
    are not compared with each other.
    """
    n = F.size("s")
    marked = kept(made, open_units.join(sets, "unit").select("unit", "cluster", n.alias("n"), "s", *_parities()), "open-sets")
    tokens = marked.select("unit", F.explode("s").alias("token"))
    often = tokens.groupBy("token").agg(F.count("*").alias("often"))
    ordered = tokens.join(often, "token").groupBy("unit").agg(F.array_sort(F.collect_list(F.struct("often", "token"))).alias("order"))  # one paragraph's shingles
    parities = ["p0", "p1", "p2", "p3"]
    size = F.col("n")
    large = size - _ceil(size * similarity) + 1
    small = size - _ceil(size * (2 * similarity / (1 + similarity))) + 1
    first = kept(made, ordered.join(marked, "unit").select("unit", "cluster", "n", *parities, F.posexplode(F.slice("order", 1, large)).alias("place", "t")).select("unit", "cluster", "n", *parities, "place", "t.token"), "probe")
    by = first.groupBy("token", "cluster").agg(F.count("*").alias("k")).groupBy("token").agg(F.count("*").alias("clusters"), F.max_by("cluster", F.struct("k", "cluster")).alias("main"))
    rows = kept(made, first.join(by.where("clusters > 1").select("token", "main"), "token"), "shared-shingles")
    p = rows.select("token", "main", *[F.col(x).alias(y) for x, y in (("unit", "c"), ("cluster", "cc"), ("n", "nc"), ("place", "ic"))], *[F.col(x).alias("c" + x) for x in parities])
    i = rows.where(F.col("place") < small).select("token", (F.col("cluster") != F.col("main")).alias("aside"), *[F.col(x).alias(y) for x, y in (("unit", "d"), ("cluster", "cd"), ("n", "nd"), ("place", "id"))], *[F.col(x).alias("d" + x) for x in parities])
    total = F.col("nc") + F.col("nd")
    overlap = total * (similarity / (1 + similarity)) - 1e-9
    apart = sum((F.bit_count(F.col("c" + x).bitwiseXOR(F.col("d" + x))) for x in parities), F.lit(0))
    fit = (
        (F.col("cc") != F.col("cd")) & (F.col("nd") <= F.col("nc")) & (F.col("nd") >= similarity * F.col("nc") - 1e-9)
        & (F.least(F.col("nc") - F.col("ic"), F.col("nd") - F.col("id")) >= overlap) & (apart <= total - 2 * overlap)
    )
    one = p.where("cc <> main").join(i, "token").where(fit).select("c", "d")
    two = p.where("cc = main").join(i.where("aside"), "token").where(fit).select("c", "d")
    return one.unionByName(two).select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).distinct()


def members(paragraphs: DataFrame, made: list[DataFrame], hot: int = HOT) -> DataFrame:
    """(band, salt, unit): the units (of `unit`, `bands`, each once) that share a band with others.

    A unit's salt is drawn among as many as the band's size calls for, so a band that a third of all units have is as
    many groups as it needs. To learn that size, rows are first summed within as many salts as all rows might need.
    """
    most = max(1, -(-paragraphs.count() // hot))
    rows = paragraphs.select("unit", F.explode("bands").alias("band")).withColumn("part", F.pmod(F.xxhash64("unit", F.lit(7)), F.lit(most)).cast("int"))
    parts = rows.groupBy("band", "part").agg(F.count("*").alias("n"))
    sizes = parts.select("band", "part").join(parts.groupBy("band").agg(F.sum("n").alias("n")).where("n > 1"), "band")
    salt = F.pmod(F.xxhash64("unit", F.lit(9)), F.ceil(F.col("n") / hot)).cast("int")
    return kept(made, rows.join(sizes, ["band", "part"]).select("band", salt.alias("salt"), "unit"), "members")


def _fit(c: str, d: str, similarity: float) -> tuple[Column, Column]:
    """Whether sets of `n` members with parities p0 to p3, of name endings c and d, can be similar, and how far apart they look.

    Sets of this similarity differ in no more shingles than the bound, so their parities differ in no more bits.
    """
    n, m = F.col("n" + c), F.col("n" + d)
    apart = sum((F.bit_count(F.col(f"p{w}{c}").bitwiseXOR(F.col(f"p{w}{d}"))) for w in range(4)), F.lit(0))
    bound = (n + m) * ((1 - similarity) / (1 + similarity)) + 1e-6
    return (F.least(n, m) >= similarity * F.greatest(n, m) - 1e-6) & (apart <= bound), apart / bound


def _tried(pairs: DataFrame) -> DataFrame:
    """(a, b): of each b's `pairs` (a, b, far) the TRIES that look closest, however many bands b is in."""
    order = Window.partitionBy("b").orderBy("far", "a")  # as many as b has bands, times PIVOTS
    ranked = pairs.groupBy("a", "b").agg(F.min("far").alias("far")).select("a", "b", F.row_number().over(order).alias("rank"))
    return ranked.where(F.col("rank") <= TRIES).select("a", "b")


def links(grouped: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b): verified links that connect whatever units share a band and are similar; `sets` has their shingles. A written table."""
    made: list[DataFrame] = []
    sketch = ["n", *(f"p{w}" for w in range(4))]
    marked = kept(made, grouped.join(sets.select("unit", F.size("s").alias("n"), *_parities()), "unit").select("band", "salt", "unit", *sketch), "marked-members")
    fit, far = _fit("", "0", similarity)
    other = [F.col(f"p.{x}").alias(x + "0") for x in ("unit", *sketch)]
    firsts = marked.groupBy("band", "salt").agg(F.min(F.struct("unit", *sketch)).alias("p")).select("band", "salt", *other)
    inside = _tried(marked.join(firsts, ["band", "salt"]).where((F.col("unit") != F.col("unit0")) & fit).select(F.col("unit0").alias("a"), F.col("unit").alias("b"), far.alias("far")))
    across = firsts.join(firsts.groupBy("band").agg(F.min("unit0").alias("b")), "band").select(F.col("b").alias("a"), F.col("unit0").alias("b"))
    near = kept(made, _verified(inside.unionByName(across).where("a <> b").distinct(), sets, similarity), "near")
    open_units = _open(marked, near, made)
    # a few more pivots join most of what the first left apart
    picks = [F.min(F.struct(F.xxhash64("unit", F.lit(k)).alias("h"), "unit", "cluster", *sketch)).alias(f"p{k}") for k in range(PIVOTS)]
    pivots = open_units.groupBy("band", "salt").agg(*picks).select("band", "salt", F.explode(F.array(*[f"p{k}" for k in range(PIVOTS)])).alias("p"))
    pivots = pivots.select("band", "salt", F.col("p.cluster").alias("cluster0"), *other)
    pairs = _tried(open_units.join(pivots, ["band", "salt"]).where((F.col("cluster") != F.col("cluster0")) & fit).select(F.col("unit0").alias("a"), F.col("unit").alias("b"), far.alias("far")))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    more = kept(made, near.unionByName(_verified(pairs, sets, similarity)).distinct(), "near")
    forget(open_units)
    apart = kept(made, _open(grouped, more, made).select("unit", "cluster").distinct(), "apart")
    out = written(more.unionByName(_verified(_across(apart, sets, similarity, made), sets, similarity)).distinct(), "links")
    for df in made:
        forget(df)
    return out


def _open(grouped: DataFrame, near: DataFrame, made: list[DataFrame]) -> DataFrame:
    """`grouped` (band, salt, unit) with `cluster`, of the bands whose units the links `near` leave in several clusters."""
    clusters = components(near)
    named = grouped.join(clusters.select(F.col("node").alias("unit"), "root"), "unit", "left").select(*grouped.columns, F.coalesce("root", "unit").alias("cluster"))
    named = written(named, "named-members")
    forget(clusters)
    ends = named.groupBy("band", "salt").agg(F.min("cluster").alias("low"), F.max("cluster").alias("high"))
    mixed = ends.groupBy("band").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high").select("band")
    groups = ends.select("band", "salt").join(mixed, "band")
    out = kept(made, named.join(groups, ["band", "salt"], "left_semi"), "open")
    forget(named)
    return out


def _edges(blocks: DataFrame) -> DataFrame:
    """(doc, key, unit, first_doc_id, kind, start, end): the repeated blocks, of other documents than their class's first,
    with no other such block touching them on the left or on the right."""
    order = Window.partitionBy("doc", "key").orderBy("start", "unit")  # blocks of one text
    gone = blocks.where(F.col("doc") != F.col("first_doc_id"))
    marked = gone.select("*", (F.coalesce(F.lag("end").over(order), F.lit(-1)) < F.col("start")).alias("open"))
    marked = marked.select("*", F.coalesce(F.lead("open").over(order), F.lit(True)).alias("close"))
    kinds = F.filter(F.array(F.when(F.col("open"), F.lit(LEFT)), F.when(F.col("close"), F.lit(RIGHT))), lambda k: k.isNotNull())
    return marked.select("doc", "key", "unit", "first_doc_id", F.explode(kinds).alias("kind"), "start", "end")


def _beyond(edges: DataFrame, seen: DataFrame) -> DataFrame:
    """(doc, start, end, first_doc_id): what the text next to each edge has in common with the first document's."""
    there = seen.where(F.col("kind").isin(FIRST_LEFT, FIRST_RIGHT)).select("unit", (F.col("kind") - 2).alias("kind"), F.col("s").alias("theirs"))
    here = seen.where(F.col("kind").isin(LEFT, RIGHT)).distinct()
    at = F.when(F.col("kind") == LEFT, F.col("start")).otherwise(F.col("end")).alias("at")
    both = edges.select("doc", "key", "unit", "first_doc_id", "kind", at).join(here, ["key", "unit", "kind", "at"]).join(there, ["unit", "kind"])
    same = F.zip_with("s", "theirs", lambda a, b: F.coalesce(a == b, F.lit(False)))
    stop = F.array_position(same, F.lit(False)).cast("int")
    n = F.when(stop == 0, F.size(same)).otherwise(stop - 1)
    far = F.get("places", n - 1)
    reach = both.where(n > 0).select("doc", "at", far.alias("far"), "first_doc_id")
    return reach.select("doc", F.least("at", "far").alias("start"), F.greatest("at", "far").alias("end"), "first_doc_id")


def duplicate_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, min_words: int = MIN_WORDS) -> DataFrame:
    """(id_col, start, end, removed, first_doc_id): repeated spans of each document that has any.

    Overlapping units are merged to one span. `first_doc_id` is the smallest document among the clusters of a span, and
    `removed` says that another document keeps the text; kept spans are listed as well. Lines of `min_words` words or more are units.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(F.col(id_col), text).alias("key"), text.alias("text"))
    made: list[DataFrame] = []
    found = written(_all_units(rows, max(SHINGLE, min_words)), "units")
    blocks = told_apart(kept(made, repeated_blocks(found.where(~F.col("para")), made).distinct(), "named-blocks"))
    ends = (F.col("start") + F.col("length")).alias("end")
    paragraphs = kept(made, told_apart(found.where("para").select("doc", "key", "unit", "check", "start", ends, "bands")), "paragraphs")
    forget(found)
    edges = kept(made, _edges(blocks), "edges")
    one = kept(made, paragraphs.groupBy("unit").agg(F.min(F.struct("key", "start", "end", "bands")).alias("p")).select("unit", "p.*"), "one-each")
    grouped = members(one.select("unit", "bands"), made)
    sides = edges.select("unit", "kind").distinct()
    firsts = blocks.where("doc = first_doc_id").join(sides, "unit").groupBy("unit", "kind").agg(F.min(F.struct("key", "start", "end")).alias("p"))
    columns = ["unit", "kind", "key", "start", "end"]
    sets = one.join(grouped.select("unit").distinct(), "unit", "left_semi").withColumn("kind", F.lit(SET))
    wanted = edges.select(columns).unionByName(firsts.select("unit", (F.col("kind") + 2).alias("kind"), "p.*")).unionByName(sets.select(columns))
    seen = kept(made, look_up(rows, wanted), "looked-up")
    near = links(grouped, seen.where(F.col("kind") == SET).select("unit", "s"), similarity)
    linked = components(near)
    forget(near)

    sizes = paragraphs.groupBy("unit").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    made.append(linked)
    named = kept(made, sizes.join(linked.withColumnRenamed("node", "unit"), "unit", "left").select("unit", "low", "high", F.coalesce("root", "unit").alias("cluster")), "named")
    joined = named.groupBy("cluster").agg(F.min("low").alias("first_doc_id"), F.max("high").alias("high")).where(F.col("first_doc_id") < F.col("high"))
    near = named.join(joined.select("cluster", "first_doc_id"), "cluster").select("unit", "first_doc_id")
    columns = ["doc", "start", "end", "first_doc_id"]
    spans = paragraphs.select("doc", "unit", "start", "end").join(near, "unit").select(columns).distinct()
    spans = spans.unionByName(blocks.select(columns)).unionByName(_beyond(edges, seen))
    spans = spans.select("*", (F.col("doc") != F.col("first_doc_id")).alias("removed"))
    order = Window.partitionBy("doc", "removed").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("new", (F.coalesce(reach, F.lit(-1)) < F.col("start")).cast("int"))
    marked = marked.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    out = marked.groupBy("doc", "removed", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("first_doc_id").alias("first_doc_id"))
    out = written(out.select(F.col("doc").alias(id_col), "start", "end", "removed", "first_doc_id"), "spans")
    for df in made:
        forget(df)
    return out


def remove_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the spans marked `removed`; all columns stay."""
    tag = uuid.uuid4().hex
    cut = spans.where("removed").groupBy(F.col(id_col).alias(f"id{tag}")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(f"cut{tag}"))  # spans of one document
    both = docs.join(cut, docs[id_col] == cut[f"id{tag}"], "left").select(*[docs[f"`{c}`"] for c in docs.columns], cut[f"cut{tag}"])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, cuts = batch.columns
            texts = columns[at].to_pylist()
            for k, spans in enumerate(cuts.to_pylist()):
                if spans and texts[k] is not None:
                    edges = [0, *[x for s in spans for x in (s["start"], s["end"])], len(texts[k])]
                    texts[k] = "".join(texts[k][a:b] for a, b in zip(edges[::2], edges[1::2]))
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return both.mapInArrow(run, docs.schema)
